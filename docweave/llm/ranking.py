"""Ranks and running sums over whole tables without one task that sees them all.

Rows get a bucket by a uniform hash (or by their place on a scale), buckets are counted and summed
before the shuffle, a window over the few bucket rows gives each bucket its start, and a window
within each bucket does the rest. A group that holds a third of all rows is spread over as many
buckets as any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a bucket, about, where the table is large.
BUCKET_ROWS = 100_000
LEAST_BUCKETS = 64


def bucket_number(rows: int) -> int:
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


def uniform_hash(seed: int, *columns: str) -> Column:
    """A non-negative 63-bit hash."""
    return F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit((1 << 63) - 1))


def bucket_of(hashed: Column, buckets: int) -> Column:
    """Buckets in the order of the hash."""
    return F.shiftright(hashed, 32) * buckets / F.lit(float(1 << 31))


def bucket_starts(df: DataFrame, group: list[str], bucket: str, sums: dict[str, Column]) -> DataFrame:
    """A row for each group and bucket: for each name of `sums` its sum over the group's earlier buckets (name_start)
    and over the whole group (name_all)."""
    small = df.groupBy(*group, bucket).agg(*[v.alias(k) for k, v in sums.items()])
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    order = whole.orderBy(bucket)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return small.select(
        *group,
        bucket,
        *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"{k}_start") for k in sums],
        *[F.sum(k).over(whole).alias(f"{k}_all") for k in sums],
    )
