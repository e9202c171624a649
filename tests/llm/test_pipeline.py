import base64
import unicodedata
from collections import Counter

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from docweave.llm import bpe, mixing
from test_minhash import brute
from test_mixing import water, words


def test_stages(spark, sf):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "source_mixing", "byte_bpe"] and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = docs.limit(1).withColumns({"doc_id": F.lit(-5).cast("long"), "text": F.lit("12 34 !?")})
    odd = docs.unionByName(extra).selectExpr("*", "doc_id AS score", "'t' AS target", "array(doc_id) AS ids", "1 AS _hash")
    first = corpus_pipeline.language_id(spark, odd, sf)
    assert first.columns == odd.columns and first.count() == docs.count() and first.where("score <> doc_id").count() == 0
    third = corpus_pipeline.source_mixing(spark, first, sf)
    assert third.columns == odd.columns and third.where("target = 't' AND ids[0] = doc_id").count() == third.count() > 0
    assert corpus_pipeline.tokens(spark, third.limit(5), sf).count() == 5
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), sf).count() == 0
    second = corpus_pipeline.near_dedup(spark, docs, sf)
    assert second.columns == docs.columns and 0 < second.count() < docs.count()
    third = corpus_pipeline.source_mixing(spark, second, sf)
    assert third.columns == docs.columns
    words = lambda df: df.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert abs(words(third) / words(second) - 1) < 0.1


def test_run(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = corpus_pipeline.run(spark, sf).collect()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(bpe.VOCABULARY), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert got
    for r in got:
        assert r.round_trip and list(r.ids) == library.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)


def expected_copies(spark, docs):
    """doc_id: copies that the mix takes of it; letters, exact similarity groups at 0.8, targets shared out in seeded order."""
    known = [r for r in docs if any(unicodedata.category(c)[0] == "L" for c in r.text or "")]
    label = brute([(r.doc_id, r.text) for r in known], 80)
    rows = [r for r in known if label[r.doc_id][1] == r.doc_id]
    hashed = spark.createDataFrame([(r.doc_id,) for r in rows], "doc_id long").select("doc_id", F.xxhash64(F.lit(17), "doc_id").alias("h")).collect()
    place = {r.doc_id: r.h & ((1 << 63) - 1) for r in hashed}
    sizes = Counter()
    for r in rows:
        sizes[r.source] += words(r.text)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = water(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)})
    copies, before = Counter(), Counter()
    for r in sorted(rows, key=lambda r: place[r.doc_id]):
        n = words(r.text)
        middle = before[r.source] + n / 2
        before[r.source] += n
        copies[r.doc_id] += sum(middle + p * sizes[r.source] < target[r.source] for p in range(3)) if n else 0
    return len(known), len(rows), +copies


def test_run_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    known, kept, copies = expected_copies(spark, docs)
    got = corpus_pipeline.run(spark, sf).select("doc_id", "lang", "source", "file", "row").collect()
    assert len({(r.file, r.row) for r in got}) == len(got)
    mixed = mixing.mix(corpus_pipeline.near_dedup(spark, corpus_pipeline.language_id(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf), sf))
    order = sorted((p, r.doc_id) for r in mixed.select("doc_id", "positions").collect() for p in r.positions)
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.file, r.row))] == [i for _, i in order]
    assert Counter(r.doc_id for r in got) == copies
    by_id = {r.doc_id: (r.lang, r.source) for r in docs}
    assert all((r.lang, r.source) == by_id[r.doc_id] for r in got)
    assert len(docs) >= known > kept > 0 and set(copies.values()) != {1}
