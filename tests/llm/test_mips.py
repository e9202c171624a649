import math
import random

import pytest
from pyspark.sql import functions as F

from docweave.llm import mips
from docweave.llm.queries import op10_norm_bucket_top_k


def brute(rows, asks, k):
    known = {i: [math.floor(256 * x) for x in v] for i, v in rows if v is not None and not any(x is None or math.isnan(x) or math.isinf(x) for x in v)}
    out = set()
    for q, v in known.items():
        if asks(q):
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in known.items() if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)}
    return out


def check(spark, rows, every=3, k=5, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = {tuple(r) for r in mips.top_k(df, F.col("vec_id") % every == 0, k, **options).collect()}
    assert got == brute(rows, lambda q: q % every == 0, k)


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_against_brute_force(spark, spread):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        scale = math.exp(rng.gauss(0, spread))
        rows.append((i, [rng.gauss(0, 1) * scale for _ in range(8)]))
    rows += [(400 + i, [3.0] + [0.1 * rng.random() for _ in range(7)]) for i in range(60)]  # near one direction: coordinate pruning
    check(spark, rows, bucket=32, block=16)


def test_ties_zeros_and_bad_vectors(spark):
    rows = [(i, [0.5, -0.25]) for i in range(12)] + [(12, None), (13, [1.0, None]), (14, [float("nan"), 1.0]), (15, [float("inf"), 1.0]), (16, [0.0, 0.0]), (17, [-1.0, 0.2]), (18, [2.0, 0.0])]
    check(spark, rows, bucket=4, block=2)
    check(spark, rows[:3])
    check(spark, rows[:1])
    check(spark, rows[12:14], every=1)
    check(spark, rows[:2], every=7_000)
    assert mips.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_repeated_rows_and_large_scores(spark):
    rows = [(3, [1.0, 2.0]), (3, [1.0, 2.0]), (6, [2.0, 2.0]), (6, [2.0, 2.0]), (7, [1.0, 0.5]), (8, [0.5, 0.5]), (8, [4.0, 0.0]), (9, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    for options in ({}, {"bucket": 2, "block": 1}):
        got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in mips.top_k(df, F.col("vec_id") == 3, 4, **options).collect()]
        assert sorted(got) == [(3, 1, 6, 6 << 16), (3, 2, 9, 5 << 16), (3, 3, 8, 4 << 16), (3, 4, 7, 2 << 16)]
    big = [(1, [2965821.0 + 1 / 256, 1.0]), (2, [2965820.0 + 3 / 256, 3.0]), (3, [7.0, 2965821.0])]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in mips.top_k(df, F.lit(True), 2).collect()} == brute(big, lambda q: True, 2)


def test_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert {tuple(r) for r in op10_norm_bucket_top_k(spark, sf).collect()} == brute(rows, lambda q: q % 50 == 0, 5)


def test_buckets_travel_only_to_blocks_that_need_them(spark, monkeypatch):
    """A few long vectors answer all queries: the many short ones reach no block."""
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) * (1 if i >= 40 else 1000) for _ in range(4)]) for i in range(600)]
    met = []
    answers = mips._answers

    def counted(k):
        inner = answers(k)

        def run(batches):
            batches = list(batches)
            seen = sum(b.num_rows for b in batches)
            if seen > 2:
                raise ValueError(f"{seen} buckets came")
            yield from inner(batches)

        met.append(k)
        return run

    monkeypatch.setattr(mips, "_answers", counted)
    monkeypatch.setattr(mips, "RUN", 1000)
    rows += [(1000, [1.0, 1.0, 1.0, 1.0])]
    check(spark, rows, every=1000, bucket=40, block=64)
    assert met == [5]
