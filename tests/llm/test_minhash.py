import random

import numpy as np
import pytest

from docweave.llm import minhash
from docweave.llm.queries import op9_minhash_near_dedup

SCHEMA = "doc_id long, text string"


def shingles(text, words=5):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split(" ")
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", " ".join(w))
    return {tuple(w)} if 0 < len(w) < words else {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}


def brute(rows, percent):
    sets = [(i, shingles(t)) for i, t in rows]
    label = {i: i for i, _ in rows}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    where = {}
    for n, (_, s) in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(n)
    met = set()
    for n, (i, s) in enumerate(sets):
        for m in {m for x in s for m in where[x] if m > n}:
            j, r = sets[m]
            both = len(s & r)
            if (i, j) not in met and 100 * both >= percent * len(s | r):
                met.add((i, j))
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {i: (len(s), root(i)) for i, s in sets}


def check(got, rows, percent):
    want = brute(rows, percent)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r.doc_id
        assert r.kept == (r.doc_id == r.component_id)


def corpus(seed, base_docs=12, copies=14, length=120):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for _ in range(base_docs):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 30, length, length * 5]))]
        rows.append(words)
        for _ in range(rng.randint(0, copies)):
            edited = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 60))):
                edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
            rows.append(edited)
    rows += [[rng.choice(vocabulary) for _ in range(50)] + passage for _ in range(25)]
    rng.shuffle(rows)
    texts = [(i, rng.choice([" ", "\n", "\x0b "]).join(w if rng.random() < 0.5 else [x.upper() for x in w])) for i, w in enumerate(rows)]
    return [*texts, (10_000, None), (10_001, ""), (10_002, " \n"), (10_003, "one two"), (10_004, "ONE  two"), (10_005, "two one")]


@pytest.mark.parametrize("seed,k,percent", [(1, 256, 85), (2, 256, 80), (3, 64, 85)])
def test_against_brute_force(spark, seed, k, percent):
    rows = corpus(seed)
    check(minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5), percent=percent, k=k).collect(), rows, percent)


def test_a_chain_is_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(100 - n, " ".join(words[n * 6 : n * 6 + 100])) for n in range(40)]
    check(minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), percent=80).collect(), rows, 80)


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "x y z"), (2, "completely different words in here now")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (1, 1), (2, 2), (2, 2)]
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_dropping_keeps_one_of_each_group_and_all_columns(spark):
    rows = [(1, "a b c d e f", 1), (1, "a b c d e f", 1), (3, "a b c d e f", 2), (4, "g h i j k l", 3), (None, "a b c d e f", 4), (5, None, 5)]
    df = spark.createDataFrame(rows, SCHEMA + ", n int").selectExpr("*", "n AS _nth", "map(1, n) AS sig")
    out = minhash.drop_near_duplicates(df)
    assert out.columns == df.columns and sorted(r._nth for r in out.collect()) == [1, 3, 4, 5]


def test_texts_that_share_an_id_each_have_their_links(spark):
    w = [[f"{c}{i}" for i in range(60)] for c in "abcdef"]
    near = lambda n, last: " ".join([*w[n][:-1], last])
    whole = [" ".join(x) for x in w]
    rows = [(5, whole[0]), (5, whole[1]), (8, near(0, "x")), (9, near(1, "x")), (7, whole[2]), (7, whole[3]), (7, ""), (2, near(2, "x")), (10, near(3, "x"))]
    rows += [(None, whole[4]), (None, whole[5]), (12, near(4, "x")), (11, near(4, "y")), (20, near(5, "x")), (30, whole[0].upper()), (5, whole[0].upper())]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in minhash.near_duplicates(df, percent=90).collect())
    want = [(i, 2, i == 2) for i in (2, 7, 7, 7, 10)] + [(i, 5, i == 5) for i in (5, 5, 5, 8, 9, 30)] + [(0, 11, True), (0, 20, True), (11, 11, True), (12, 11, False), (20, 20, True)]
    assert got == sorted(want)
    left = [(r.doc_id, r.text.lower()) for r in minhash.drop_near_duplicates(df, percent=90).collect()]
    want = [(5, whole[0]), (5, whole[1]), (2, near(2, "x")), (7, whole[3]), (7, ""), (None, whole[4]), (None, whole[5]), (11, near(4, "y")), (20, near(5, "x"))]
    assert sorted(left, key=str) == sorted(want, key=str)


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(op9_minhash_near_dedup(spark, sf).collect(), rows, 85)


def blocks(seed, n, vocabulary=4000):
    """Documents of 20 blocks in 3 variants each: any two share a third of their blocks, none is linked with another."""
    rng = random.Random(seed)
    stock = [[" ".join(f"w{rng.randrange(vocabulary)}" for _ in range(60)) for _ in range(3)] for _ in range(20)]
    return [(i, " ".join(rng.choice(variants) for variants in stock)) for i in range(n)]


def test_pairs_grow_with_the_documents_where_all_share_stock_passages(spark, monkeypatch):
    met, hopeful = [], minhash._hopeful

    def counted(pairs, *rest):
        met.append(pairs.count())
        return hopeful(pairs, *rest)

    monkeypatch.setattr(minhash, "_hopeful", counted)
    for n in (400, 1600):
        assert minhash.near_duplicates(spark.createDataFrame(blocks(3, n), SCHEMA)).where("doc_id <> component_id").isEmpty()
        assert sum(met) < 20 * n  # of n / 2 for each document
        met.clear()


@pytest.mark.parametrize("percent", [80, 85])
def test_links_in_long_lists_are_found(spark, percent):
    """Near copies of documents of stock passages differ by some words."""
    rng = random.Random(7)
    rows = blocks(5, 60)
    for i, text in rows[:50]:
        words = text.split(" ")
        for _ in range(rng.randint(1, 24)):
            words[rng.randrange(len(words))] = f"new{rng.random()}"
        rows.append((100 + i, " ".join(words[: rng.randint(1100, 1200)])))
    check(minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), percent=percent).collect(), rows, percent)


def test_signatures_agree_by_similarity():
    rng = np.random.default_rng(2)
    agree = []
    for _ in range(40):
        values = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
        a, b = (minhash.signature(x) for x in (np.sort(values[:2700]), np.sort(values[300:])))
        agree.append(1 - np.unpackbits((a ^ b).view(np.uint8)).mean())
    assert abs(np.mean(agree) - 0.9) < 0.02 and min(agree) * minhash.BITS >= minhash.least_shared(minhash.BITS, 0.9)
