import base64
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from docweave.llm import ppm
from docweave.llm.queries import op8_ppm_language


def brute_bits(training: dict[str, list[str]], text: str, lang: str) -> float:
    counts = [Counter() for _ in range(ppm.ORDER + 1)]
    for t in training[lang]:
        b = ppm.BEFORE + t.encode()
        for i in range(len(ppm.BEFORE), len(b)):
            for o in range(ppm.ORDER + 1):
                counts[o][b[i - o : i], b[i]] += 1
    seen = [Counter() for _ in counts]
    kinds = [Counter() for _ in counts]
    for o, c in enumerate(counts):
        for (context, _), n in c.items():
            seen[o][context] += n
            kinds[o][context] += 1

    def cost(context, byte, o):
        if o < 0:
            return 8.0
        n, d = seen[o][context], kinds[o][context]
        if not n:
            return cost(context[1:], byte, o - 1)
        c = counts[o][context, byte]
        return -math.log2(c / (n + d)) if c else -math.log2(d / (n + d)) + cost(context[1:], byte, o - 1)

    b = ppm.BEFORE + text.encode()
    return sum(cost(b[i - ppm.ORDER : i], b[i], ppm.ORDER) for i in range(len(ppm.BEFORE), len(b)))


def test_code_lengths_are_exact(spark):
    training = {"en": ["the cat and the hat", "then"], "de": ["der hund und die katze", "ß ü"], "xx": ["qqqq"]}
    rows = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, ts in training.items() for t in ts)]
    model = ppm.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = ["the hund", "", "z", "ßßß the the", "q" * 50]
    bits = ppm.code_lengths(model, [t.encode() for t in texts])
    assert model.languages == ["de", "en", "xx"]
    for i, t in enumerate(texts):
        for j, lang in enumerate(model.languages):
            assert bits[i, j] == pytest.approx(brute_bits(training, t, lang), abs=1e-3)


def test_edges(spark):
    schema = "doc_id long, text string, lang string"
    df = spark.createDataFrame([(1, "the and of", "en"), (2, "der die das", "de"), (3, None, "en"), (4, "", None), (5, "12 !", "en"), (6, "und die der", None), (6, "und die der", None)], schema)
    model = ppm.train(df)
    got = {r.doc_id: (r.lang_pred, r.score) for r in ppm.predict(df.select("doc_id", "text"), model).collect()}
    assert [got[i] for i in (3, 4, 5)] == [("und", 0.0)] * 3
    assert got[1][0] == "en" and got[2][0] == got[6][0] == "de" and all(0 <= s <= 1 for _, s in got.values())
    assert ppm.train(df.where("lang is null")) is None
    assert {r.lang_pred for r in ppm.predict(df, None).collect()} == {"und"}
    assert ppm.predict(df.where("false"), model).count() == 0
    clash = df.selectExpr("*", "'mine' AS score", "2 AS _letter")
    got = ppm.predict(clash, model)
    assert got.columns == ["doc_id", "text", "lang", "_letter", "lang_pred", "score"] and got.where("score BETWEEN 0 AND 1 AND _letter = 2").count() == 7
    assert {r.score for r in ppm.known_languages(clash, model).collect()} == {"mine"}


def test_known_languages_rejects_by_code_length(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    noise = random.Random(5)
    odd = [noise.randbytes(200).hex(), base64.b64encode(noise.randbytes(200)).decode(), "zqxj kvwq pfgh wvbx", "Это русский текст о погоде", "12 34", None]
    extra = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(odd)], docs.schema)
    model = ppm.train(docs)
    kept = {r.doc_id for r in ppm.known_languages(docs.unionByName(extra), model).collect()}
    assert kept == {r.doc_id for r in docs.collect()}
    assert {r.lang_pred for r in ppm.predict(extra.where("doc_id >= -4"), model).collect()} <= set(model.languages)
    words = docs.where("lang = 'en'").orderBy("doc_id").first().text.split()[:4]
    short = spark.createDataFrame([(1, f"{' '.join(words)} XKJQ7ZWV0PQXH9JZKW2F", None), (2, words[0], None)], docs.schema)
    assert ppm.known_languages(short, model).count() == 2  # a key in a short text is not noise
    assert sorted(r.doc_id for r in ppm.known_languages(extra, ppm.train(extra)).collect()) == [-4, -3, -2, -1]


def test_a_long_text_in_parts(spark, monkeypatch):
    df = spark.createDataFrame([(i, "the cat " * (i * 500), "en") for i in range(1, 9)] + [(20, "el gato " * 10, "es")], "doc_id long, text string, lang string")
    model = ppm.train(df)
    whole = ppm.code_lengths(model, [b"the cat " * 4000])
    assert np.argmin(whole) == model.languages.index("en")
    monkeypatch.setattr(ppm, "SLICE", 7)
    assert ppm.code_lengths(model, [b"the cat " * 4000, b"", b"el gato"])[0] == pytest.approx(whole[0])


def test_long_labelled_texts_are_learned_after_the_short_ones(spark, monkeypatch):
    rows = [(i, "the cat and the hat " * 2, "en") for i in range(3)] + [(10, "el gato y el perro " * 50, "es"), (11, "el perro " * 90, "es"), (12, "the end " * 80, "en"), (13, None, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = ppm.sample(df, "lang", "doc_id", "text", 41, 3, 100).collect()
    assert sorted(map(tuple, got)) == sorted((r[2], r[1]) for r in rows[:5])
    monkeypatch.setattr(ppm, "SLICE", 50)
    model = ppm.train(df, per_language=3, most_bytes=100)
    assert {r.doc_id: r.lang_pred for r in ppm.predict(df, model).collect()} == {i: "und" if t is None else lang for i, t, lang in rows}
    training = {"en": [rows[0][1]] * 3, "es": [rows[3][1], rows[4][1]]}
    for t in ("el gato the", rows[4][1]):
        assert ppm.code_lengths(model, [t.encode()])[0] == pytest.approx([brute_bits(training, t, x) for x in model.languages], rel=1e-4)


def test_all_contexts_are_kept_and_too_many_are_refused(spark):
    rng = random.Random(6)
    rows = [(i, " ".join("".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(80)), "xx") for i in range(50)] + [(99, "wurzyvuz", "yy")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = ppm.unpacked(ppm.pack(ppm.train(df)))
    for _, text, _ in rows:
        data = ppm.BEFORE + text.encode()
        for order in (1, 2, 3):
            assert all(model.ids[order][int.from_bytes(data[i - order : i], "big")] for i in range(3, len(data)))
    with pytest.raises(ValueError, match="fewer rows"):
        ppm.train(df, most_counts=300)


def test_query_on_held_out_documents(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op8_ppm_language(spark, sf).collect()
    assert {r.doc_id for r in got} == set(docs)
    right = total = 0
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.held_out:
            total += 1
            right += r.lang_pred == docs[r.doc_id].lang
    assert right / total > 0.95
