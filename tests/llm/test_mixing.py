import random
import re

import pytest

from docweave.llm import mixing
from docweave.llm.queries import op6_curriculum_mix


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def water(sizes, weights, passes=3):
    """Targets by sharing out again and again."""
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(passes * sizes[s] for s in full)
        weight = sum(weights[s] for s in sizes if s not in full)
        target = {s: passes * sizes[s] if s in full else left * weights[s] / weight for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > passes * sizes[s]}
        if not over:
            return target
        full |= over


def check(rows, got):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = water(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)})
    by_id = {i: (text, source) for i, text, source in rows}
    taken, biggest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    assert len(got) == len(rows)
    for r in got:
        text, source = by_id[r.doc_id]
        assert r.size == words(text) and r.source_size == sizes[source] and r.target == pytest.approx(target[source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == len(r.positions) * r.size
        assert list(r.positions) == sorted(r.positions) and all(0 <= p <= 1 for p in r.positions)
        taken[source] += r.taken
        biggest[source] = max(biggest[source], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= biggest[s] / 2 + 1e-6


def test_against_sharing_again(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 50), rng.choice(["a", "b", "c", "é", "Z", None, "tiny"])) for i in range(400)]
    rows = [(i, t if s != "tiny" or i < 60 else None, s) for i, t, s in rows] + [(1000, "\x0b \t", "blank"), (1001, None, "blank")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first, again = mixing.mix(df).collect(), mixing.mix(df.repartition(7)).collect()
    check(rows, first)
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_positions_follow_the_schedule(spark):
    """At any time t, each source has given what its integrated schedule asks for."""
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(2000)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by = {r[0]: r[2] for r in rows}
    for source, knots in zip("ab", mixing.SCHEDULES, strict=False):
        at = sorted(p for r in mixed if by[r.doc_id] == source for p in r.positions)
        (a, u), (b, v) = knots[:2]
        for t in (0.1, 0.25, 0.5):
            area = t * (u + u + (v - u) * t / b) / 2 / mixing.integral(knots)
            assert abs(sum(p <= t for p in at) / len(at) - area) < 0.01


def test_copies_and_edges(spark):
    df = spark.createDataFrame([(1, "a b c", "x", 5), (1, "a b c", "x", 5), (2, None, "y", 6)], "doc_id long, text string, source string, position2 int")
    out = mixing.curriculum(mixing.mix(df))
    assert out.columns[:4] == df.columns and {r.doc_id for r in out.collect()} == {1}
    assert mixing.mix(df.where("false")).count() == 0
    clash = df.withColumnRenamed("position2", "taken").selectExpr("*", "'h' AS _hash", "named_struct('a', 1) AS words_start")
    got = mixing.mix(clash).where("doc_id = 1").first()
    assert got.taken in (3, 6, 9) and got._hash == "h" and got.words_start.a == 1
    assert {(r.taken, r._hash) for r in mixing.mixture(clash).collect()} == {(5, "h")} and mixing.mixture(clash).columns == clash.columns


def test_places_are_those_of_all_copies_sorted_by_position(spark):
    rows = [(i % 150, "w " * (i % 7), ["a", "b", None][i % 3]) for i in range(300)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = mixing.training_order(mixed).collect()
    assert len(got) == 300 and all(len(r.places) == len(r.positions) and r.taken == r.size * len(r.places) for r in got)
    copies = sorted((place, position) for r in got for place, position in zip(r.places, r.positions, strict=True))
    assert [c[0] for c in copies] == list(range(1, len(copies) + 1))
    assert [c[1] for c in copies] == sorted(p for r in mixed.collect() for p in r.positions)
    assert mixing.training_order(mixed.where("false")).count() == 0


def test_query_goes_through_the_training_order(spark, sf):
    got = op6_curriculum_mix(spark, sf).collect()
    order = sorted((place, position, r.size) for r in got for place, position in zip(r.places, r.positions, strict=True))
    assert [o[0] for o in order] == list(range(1, len(order) + 1)) and [o[1] for o in order] == sorted(o[1] for o in order)
    assert sum(o[2] for o in order) == sum(r.taken for r in got) > 0


def test_query(spark, sf):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = op6_curriculum_mix(spark, sf)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    check(rows, df.collect())
