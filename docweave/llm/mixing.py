"""Mixing sources to target weights along a curriculum, with DataFrame functions only.

Each source has a weight schedule over training, piecewise linear in progress t from 0 to 1. Its
integral, as a share of all sources' integrals, is the source's share of the words the mix takes.
A target stops at `most_passes` times its source's size; what is above is shared out again by weight
until no target is above (water filling, solved in one pass over the sources sorted by cap per weight).

Documents of a source, in seeded order, line up pass after pass on the source's word axis. A copy's
training position is the t at which the source's cumulative demand reaches the middle of its stretch: the
inverse of the integrated schedule. A copy is taken if the demand gets there before training ends, so the words
taken miss the target by half a document at most. Copies are range-sorted by position: `training_order` gives each
its place in the whole mix, `curriculum` a row each in that order.

Nothing is gathered per source: running sums go by hash buckets, see ranking.py. The table of sources
(one row each) passes through one task.

Defined results: null text has size 0; documents of size 0 are taken 0 times; null is a source of its
own, sorted last; repeated rows are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Sheltered, word_count
from .ranking import bucket_number, bucket_of, bucket_starts, uniform_hash

#: Schedules, by the place of a source among the sources sorted by code point (null last), repeating:
#: knots (t, weight). Their integrals are 5, 2 and 1: the first source thins out, the others grow.
SCHEDULES = (((0.0, 6.0), (0.5, 5.0), (1.0, 4.0)), ((0.0, 1.5), (0.5, 2.0), (1.0, 2.5)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))

#: The columns that `mix` adds.
RESULTS = ("size", "source_size", "target", "taken", "positions", "words_before")


def integral(knots) -> float:
    return sum((b - a) * (u + v) / 2 for (a, u), (b, v) in zip(knots, knots[1:], strict=False))


def source_targets(sizes: DataFrame, schedules=SCHEDULES, most_passes: int = 3) -> DataFrame:
    """sizes: source, source_size. Adds schedule (number of the schedule), weight and target (words)."""
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(integral(s))) for s in schedules])
    ranked = sizes.withColumn("schedule", ((F.row_number().over(by_name) - 1) % len(schedules)).cast("int"))
    ranked = ranked.withColumn("weight", F.element_at(weights, F.col("schedule") + 1)).withColumn("_cap", F.col("source_size") * most_passes)
    by_level = Window.partitionBy(F.lit(0)).orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy(F.lit(0))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("weight").over(onwards)
    # in this order the level rises while sources are full, and falls from the first that is not
    leveled = ranked.withColumn("_level", F.when(level * F.col("weight") <= F.col("_cap"), level))
    water = F.coalesce(F.max("_level").over(all_rows), F.lit(float("inf")))
    return leveled.select("source", "source_size", "schedule", "weight", F.least(F.col("_cap").cast("double"), water * F.col("weight")).alias("target"))


def position_of(share: Column, schedule: Column, schedules=SCHEDULES) -> Column:
    """The progress t at which the integral of the schedule has reached `share` of its whole; null for a share that it never passes, 1 or more."""
    out = F.lit(1.0)
    for number, knots in enumerate(schedules):
        area, steps, whole = 0.0, F.lit(1.0), integral(knots)
        pieces = []
        for (a, u), (b, v) in zip(knots, knots[1:], strict=False):
            part = (b - a) * (u + v) / 2
            need = share * whole - area
            slope = (v - u) / (b - a)
            # u x + slope x^2 / 2 = need; this form of the root holds for a slope of 0 too
            root = 2 * need / (u + F.sqrt(F.greatest(F.lit(u * u) + 2 * slope * need, F.lit(0.0))))
            pieces.append((area + part, F.least(F.lit(b), a + root)))
            area += part
        for upper, at in reversed(pieces):
            steps = F.when(share * whole <= upper, at).otherwise(steps)
        out = F.when(schedule == number, steps).otherwise(out)
    return F.when(share < 1, out)


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", schedules=SCHEDULES, most_passes: int = 3, seed: int = 17) -> DataFrame:
    """docs with size, source_size, target, taken, positions (array<double>: the training position of each copy, ascending) and words_before
    (the words of the source's documents before this one, by which its documents with words differ). Columns of these names are replaced.

    One shuffle of the rows, by source and hash bucket; the order within a source is that of a seeded hash of the key."""
    held = Sheltered(docs, {*RESULTS, "_source", "_hash", "_tie", "_bucket", "_schedule", "words_start"}, {text, source, key})
    buckets = bucket_number(docs.count())
    rows = held.df.withColumns({"size": word_count(F.col(text)), "_source": F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")), "_hash": uniform_hash(seed, key), "_tie": F.xxhash64(text)})
    rows = rows.withColumn("_bucket", bucket_of(F.col("_hash"), buckets).cast("int"))
    starts = bucket_starts(rows, ["_source"], "_bucket", {"words": F.sum("size")})
    sizes = starts.groupBy("_source").agg(F.max("words_all").alias("source_size")).withColumn("source", F.expr("if(_source = '', null, substring(_source, 2))"))
    targets = source_targets(sizes.select("source", "source_size"), schedules, most_passes)
    targets = targets.withColumn("_source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).select("_source", "source_size", "schedule", "target")
    starts = starts.join(targets, "_source").select("_source", "_bucket", "words_start", "source_size", F.col("schedule").alias("_schedule"), "target")
    joined = rows.join(starts, ["_source", "_bucket"])
    within = Window.partitionBy("_source", "_bucket").orderBy("_hash", key, "size", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    joined = joined.withColumn("words_before", F.col("words_start") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    middle = F.col("words_before") + F.col("size") / 2
    reached = F.transform(F.sequence(F.lit(0), F.lit(most_passes - 1)), lambda p: position_of((middle + p * F.col("source_size")) / F.col("target"), F.col("_schedule"), schedules))
    joined = joined.withColumn("positions", F.when(F.col("size") > 0, F.filter(reached, lambda t: t.isNotNull())).otherwise(F.array().cast("array<double>")))
    return held.restored(joined.withColumn("taken", F.size("positions") * F.col("size")), RESULTS)


def training_order(mixed: DataFrame, source: str = "source") -> DataFrame:
    """mixed (of `mix`) with places (array<long>): the place of each copy among all copies of all sources sorted by position, from 1.
    Equal positions go by source (null last) and words_before. A column of this name is replaced.

    The sort is by stretches of position that are counted first; texts are best dropped before, and mixed written, as it is read thrice."""
    mixed = mixed.drop("places")
    buckets = bucket_number(mixed.count())
    copies = mixed.select(F.col(source).alias("_source"), F.col("words_before").alias("_before"), F.posexplode("positions").alias("_copy", "_position"))
    copies = copies.withColumn("_stretch", F.least(F.floor(F.col("_position") * buckets), F.lit(buckets - 1)).cast("int"))
    starts = bucket_starts(copies.select("_stretch"), [], "_stretch", {"copies": F.count("*")})
    over = Window.partitionBy("_stretch").orderBy("_position", F.col("_source").asc_nulls_last(), "_before", "_copy")
    placed = copies.join(starts, "_stretch").withColumn("_place", F.col("copies_start") + F.row_number().over(over))
    places = placed.groupBy("_source", "_before").agg(F.sort_array(F.collect_list("_place")).alias("places"))
    # a document without words starts where the next one does
    same = (F.col("size") > 0) & F.col(source).eqNullSafe(F.col("_source")) & (F.col("words_before") == F.col("_before"))
    joined = mixed.join(places, same, "left").drop("_source", "_before")
    return joined.withColumn("places", F.coalesce("places", F.array().cast("array<long>")))


def curriculum(mixed: DataFrame, partitions: int | None = None, key: str = "doc_id") -> DataFrame:
    """A row for each copy, range-sorted by its training `position`."""
    copies = mixed.withColumn("position", F.explode("positions")).drop("positions", "words_before")
    n = [partitions] if partitions else []
    return copies.repartitionByRange(*n, "position", key).sortWithinPartitions("position", key)


def mixture(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **options) -> DataFrame:
    """The documents that the mix takes, each as often as it takes it, in order of training position, with docs' columns alone."""
    held = Sheltered(docs, {*RESULTS, "position"}, {text, source, key})
    return held.restored(curriculum(mix(held.df, text, source, key, **options), key=key))
