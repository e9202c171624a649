"""Shards that each match the mixture of sources: proportional stratified interleaving.

Within each source rows are ranked in seeded-shuffled order; a row's fractional rank is
(rank - 1/2) / rows of its source. Sorted by fractional rank, every stretch of the table holds each
source in proportion, to one row; cutting the sorted table into equal parts gives shards whose row
counts differ by one at most, and whose mixture is the table's.

Both rankings (within a source, and over the whole table) go by buckets, see ranking.py: no source,
however large, and no sort passes through one task.

Defined results: null text has no bytes; null is a source of its own; repeated rows are ranked one after
the other; with fewer rows than shards some shards are empty; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Sheltered, quoted
from .ranking import bucket_number, bucket_of, bucket_starts, uniform_hash

#: Bytes of a row besides its text.
ROW_BYTES = 16


def row_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def assign_shards(df: DataFrame, shards: int, source: str = "source", key: str = "doc_id", seed: int = 29) -> DataFrame:
    """df with shard (from 0) and slot (place within the shard, from 0, without gaps). Columns of these names are replaced."""
    held = Sheltered(df, {"shard", "slot", "_source", "_hash", "_tie", "_bucket", "rows_start", "rows_all", "_rank", "_fraction", "_stretch", "before_start", "before_all", "_place"}, {source, key})
    buckets = bucket_number(df.count())
    ties = [quoted(c) for c, kind in held.df.dtypes if c not in (source, key) and "map<" not in kind and kind != "variant"]
    rows = held.df.withColumns({"_source": F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")), "_hash": uniform_hash(seed, key), "_tie": F.xxhash64(*ties) if ties else F.lit(0)})
    rows = rows.withColumn("_bucket", bucket_of(F.col("_hash"), buckets).cast("int"))
    starts = bucket_starts(rows, ["_source"], "_bucket", {"rows": F.count("*")})
    within = Window.partitionBy("_source", "_bucket").orderBy("_hash", key, "_tie")
    ranked = rows.join(starts, ["_source", "_bucket"]).withColumn("_rank", F.col("rows_start") + F.row_number().over(within))
    ranked = ranked.withColumn("_fraction", (F.col("_rank") - 0.5) / F.col("rows_all"))
    ranked = ranked.withColumn("_stretch", F.least(F.floor(F.col("_fraction") * buckets), F.lit(buckets - 1)).cast("int"))
    # the second start table only needs sources and counts: it counts the same rows anew, without their other columns
    places = bucket_starts(ranked.select("_stretch"), [], "_stretch", {"before": F.count("*")})
    over = Window.partitionBy("_stretch").orderBy("_fraction", "_source", "_rank")
    placed = ranked.join(places, "_stretch").withColumn("_place", F.col("before_start") + F.row_number().over(over) - 1)
    # shard s holds places ceil(s n / shards) up to the next shard's first
    shard = F.expr(f"(_place * {shards}) div before_all")
    first = F.expr(f"(({shards} - 1) + ((_place * {shards}) div before_all) * before_all) div {shards}")
    return held.restored(placed.withColumns({"shard": shard.cast("int"), "slot": F.col("_place") - first}), ("shard", "slot"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder a shard, rows in order of slot."""
    assigned.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
