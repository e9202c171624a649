"""A corpus from raw documents to token ids: language ID, near-dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages it is written as Parquet
and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import bpe, minhash, mixing, ppm
from docweave.llm.common import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found go: no letter, or the text is noise to every learned language."""
    return ppm.known_languages(docs, ppm.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 or more) the one with the smallest doc_id stays. Texts, not ids,
    are judged: different texts of one id each by itself; texts without words are in no group; rows with a null id always stay."""
    return minhash.drop_near_duplicates(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes, sorted by training position; documents it takes nothing of go, texts without words among
    them. Null is a source of its own; repeated rows are documents of their own."""
    return mixing.mixture(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source (other columns go), the text's token ids and their number, whether they decode to the text, and the place in
    the training order: `file` and `row`, by which the rows sort. The mix before has written its files in that order. A null text
    has no ids; rows that are read from no file have null places."""
    try:
        placed = docs.select("doc_id", "lang", "source", "text", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        none = F.lit(None).cast("long")
        placed = docs.select("doc_id", "lang", "source", "text", none.alias("file"), none.alias("row"))
    read = bpe.bpe_decode(bpe.bpe_encode(placed))
    whole = F.coalesce(F.encode("text", "utf-8"), F.lit(b"")) == F.col("decoded")
    return read.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", whole.alias("round_trip"), "file", "row")


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("source_mixing", source_mixing), ("byte_bpe", tokens)]

#: The stages' models, sketches and vocabularies are beyond SQL; tests/llm checks run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
