import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from docweave.llm import bpe
from docweave.llm.queries import op4_byte_bpe

CODE = bpe.coder(*bpe.default_vocabulary())
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(bpe.VOCABULARY), "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "'", "re", "'s", " ", "  ", "\n", "\t ", "1", "é", "!", "漢", "\x1c", "\u00a0", "ſ", "'r", "e"]), max_size=40).map("".join), st.integers(1, 9))
def test_joined_halves_are_the_whole(text, leaf):
    assert CODE.pieces(text, leaf) == CODE.match(text)
    assert list(CODE.encode(text)) == LIBRARY.encode_ordinary(text)
    assert CODE.decode(list(CODE.encode(text))) == text.encode()


def test_long_runs():
    rng = random.Random(5)
    for text in ("ab" * 9000, " " * 7000 + "x", "x" + "\n" * 5001, "".join(rng.choice("ab '\n1") for _ in range(30000))):
        assert list(CODE.encode(text)) == LIBRARY.encode_ordinary(text)


def test_nulls_and_clashes(spark):
    df = spark.createDataFrame([(1, None, 7), (2, "", 8), (3, "hello world", 9)], "doc_id long, text string, decoded int")
    ids = bpe.bpe_encode(df)
    assert {r.doc_id: len(r.ids) for r in ids.collect()} == {1: 0, 2: 0, 3: len(LIBRARY.encode_ordinary("hello world"))}
    assert bpe.bpe_decode(ids).columns == ["doc_id", "text", "ids", "decoded"]
    back = bpe.bpe_decode(ids, out="bytes").collect()
    assert [bytes(r["bytes"]) for r in back] == [b"", b"", b"hello world"]
    assert bpe.bpe_decode(spark.createDataFrame([(None,)], "ids array<int>")).collect()[0].decoded is None
    with pytest.raises(Exception, match="no id 99999999"):
        bpe.bpe_decode(spark.createDataFrame([([99999999],)], "ids array<int>")).collect()
    assert bpe.bpe_encode(df.where("false")).count() == 0


def test_names_and_patterns(spark):
    df = spark.createDataFrame([(1, "hello world", "x")], "Id long, Text string, last string")
    assert list(bpe.bpe_encode(df, "text").collect()[0].ids) == LIBRARY.encode_ordinary("hello world")
    own = bpe.bpe_encode(df, out="TEXT")
    assert own.columns == ["Id", "last", "TEXT"] and list(own.collect()[0].TEXT) == LIBRARY.encode_ordinary("hello world")
    assert bytes(bpe.bpe_decode(own, "text", "text").collect()[0].text) == b"hello world"
    with pytest.raises(ValueError, match="no column"):
        bpe.bpe_encode(df, "none")
    pattern = r"\s*[\r\n]+|\w+|[^\w\s]+|\s+"
    with pytest.raises(ValueError, match="look"):
        bpe.bpe_encode(df, pattern=pattern)
    text = "a\n      \nb" * 50
    assert bpe.Coder(bpe.default_vocabulary()[0], pattern, 12).pieces(text, 8) == CODE.__class__(bpe.default_vocabulary()[0], pattern).match(text)


def test_query(spark, sf):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op4_byte_bpe(spark, sf).collect():
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
