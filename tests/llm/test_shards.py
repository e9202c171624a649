import zlib
from collections import Counter

import pytest

from docweave.llm import shards
from docweave.llm.common import shared_path
from docweave.llm.queries import op7_stratified_shards


@pytest.mark.parametrize("n,parts", [(1000, 7), (5, 40), (0, 3), (1, 1), (333, 10)])
def test_law_and_mixture(spark, n, parts):
    rows = [(i, ["hot", "b", None][min(i % 10, 2)]) for i in range(n)]
    got = shards.assign_shards(spark.createDataFrame(rows, "doc_id long, source string"), parts).collect()
    assert len(got) == n
    counts = Counter(r.shard for r in got)
    assert max(counts.values(), default=0) - min((counts[s] for s in range(parts)), default=0) <= 1
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
        for source in {r[1] for r in rows}:
            whole, mine = sum(r[1] == source for r in rows), sum(r.source == source for r in got if r.shard == s)
            assert abs(mine - whole * counts[s] / n) <= 2


def test_rows_are_shuffled_and_reruns_agree(spark):
    df = spark.range(3000).selectExpr("id doc_id", "'s' source", "id % 3 extra")
    a, b = ({(r.doc_id, r.shard, r.slot) for r in shards.assign_shards(x, 10).collect()} for x in (df, df.repartition(5)))
    assert a == b and [x[0] for x in sorted(a, key=lambda x: x[1:])] != list(range(3000))


def test_repeated_rows_and_clashes(spark):
    df = spark.createDataFrame([(1, "x")] * 9 + [(None, None)], "doc_id long, source string")
    assert sorted((r.shard, r.slot) for r in shards.assign_shards(df, 5).collect()) == [(s, i) for s in range(5) for i in range(2)]
    clash = spark.range(8).selectExpr("id doc_id", "'s' source", "id + 100 slot", "map(1, 2) _rank", "'x' `a.b`")
    got = shards.assign_shards(clash, 2)
    assert got.columns == ["doc_id", "source", "_rank", "a.b", "shard", "slot"] and sorted(r.slot for r in got.collect()) == [0, 0, 1, 1, 2, 2, 3, 3]


def test_written(spark):
    path = shared_path(spark, "shards-test")
    shards.write_shards(shards.assign_shards(spark.range(100).selectExpr("id doc_id", "'s' source"), 4), path)
    assert {r["shard"]: r["count"] for r in spark.read.parquet(path).groupBy("shard").count().collect()} == dict.fromkeys(range(4), 25)


def test_query(spark, sf):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op7_stratified_shards(spark, sf).collect()
    assert {r.doc_id for r in got} == set(texts) and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    for r in got:
        data = texts[r.doc_id].encode()
        assert r.size == len(data) + 16 and r.text_crc32 == zlib.crc32(data)
