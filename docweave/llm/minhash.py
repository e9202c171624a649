"""Near-duplicate documents by bottom-k sketches from one hash function.

1. Each text becomes the sorted set of 64-bit hashes of its word shingles. Texts with equal sets are one
   class, whatever their doc_ids; a class is one node of what follows, by a number, and one row's text
   stands for it. A first sketch, the PROBE smallest values, finds documents
   most of whose values no other document retains: they can have no link, and go. Those that stay get
   the full sketch, the k smallest values.
2. Inverted lists. A pair at the threshold shares at least `alpha` retained values: all but a share of
   1 - threshold where sets are kept whole, and a quantile of the binomial distribution (chance CHANCE of less) where
   they are not. So of two linked sketches, both ordered by how many documents retain a value (rare first), the
   first size - alpha + 1 values meet; only those are listed, and values that one document alone retains
   are never listed. Common passages and lines have long lists, but come last in the order, and a document
   in which more is its own than any link allows has no entry at all. Nothing is capped.
3. Stars. Each document meets the centre of each of its lists: the document with the largest share of
   values it has in common with others. The sketch of the union (the k smallest of both) estimates the
   overlap, what is not hopeless is verified on the full sets, and documents of one component of these
   links need not meet one another. A group of thousands of near copies costs a few pairs a document.
4. The rest: links between documents of different components. Pairs of a list meet if sizes, shares in common and the
   places of their first common value allow a link, and if a signature of each whole set does: BITS
   bits, each one of the smallest of the set's values under a further hash, agree in a share of (1 + similarity) / 2
   on average. The signature is compared within the join, so documents that have stock passages in common, and so
   long lists, but no link make no pairs. What is left is estimated and verified in the same way.
5. Components of the components by these links: labels spread along links and through labels until none changes.
   Where rows share a doc_id, the groups that an id has rows in are joined in the same way.

Verification is on sets of 64-bit hashes of whole shingles, rebuilt from whole texts.

Defined results: a text without words has the empty set, is linked with nothing and is its own
component unless its doc_id has rows with words; a text of fewer words than a shingle is one shingle; rows
that share a doc_id have one component_id, with the links of all their texts, and each keeps its own row. A
null is not an id that rows share: rows with a null doc_id link others like any row, their component_id is
the smallest doc_id reachable or else null, and they are kept. An empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Sheltered, quoted, small_batches, written

WORDS = 5
K = 256
#: Values of the first sketch.
PROBE = 32
#: Words whose hashes a task remembers.
REMEMBERED = 300_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: With which a linked pair falls below a bound on shared values.
CHANCE = 1e-7
#: Bits of a set's signature, a multiple of 64.
BITS = 256
SIGNATURE = [f"bits{i}" for i in range(BITS // 64)]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value
        return value


def shingle_set(data: bytes, hashes: dict, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles. Words are runs of bytes other than ASCII white space; the
    text's A-Z are lower-cased already."""
    tokens = data.split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    n = max(len(h) - words + 1, 1)
    out = np.full(n, len(h) if len(h) < words else words, np.uint64)
    for i in range(min(words, len(h))):
        out = (out ^ h[i : i + n]) * MULTIPLIER
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(values: np.ndarray) -> np.ndarray:
    """Bits of a set's signature, as longs; those of sets of similarity s agree each with chance (1 + s) / 2."""
    least = np.full(BITS, ~np.uint64(0))
    number = np.arange(1, BITS + 1, dtype=np.uint64) * MULTIPLIER
    for at in range(0, len(values), 1024):
        h = (values[None, at : at + 1024] ^ number[:, None]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        np.minimum(least, h.min(1), out=least)
    # the lowest bit of a product by an odd number is that of its first factor: a middle bit is mixed
    return np.packbits(((least >> np.uint64(17)) & np.uint64(1)).astype(np.uint8)).view(np.int64)


def _signed(values: np.ndarray) -> np.ndarray:
    """Longs in the order of the unsigned values."""
    return (values ^ np.uint64(1 << 63)).view(np.int64)


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, k: int = K, with_body: bool = False, also: tuple = ()) -> DataFrame:
    """key, n (size of the set), sig (128-bit digest of the set; null if empty), sketch (k smallest values, ascending);
    with_body: also the text's UTF-8 bytes, lower-cased and compressed, and the set's signature; also: columns of docs that go with each row."""

    def run(batches):
        hashes, squeeze = _Hashes(), zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                ns, sigs, flat, ends, bodies, bits = [], [], [], [0], [], []
                for t in batch.column(1):
                    data = (t.as_py() or "").encode("utf-8", "replace").lower()
                    s = shingle_set(data, hashes, words)
                    ns.append(len(s))
                    sigs.append(xxhash.xxh3_128_digest(s) if len(s) else None)
                    flat.append(_signed(s[:k]))
                    ends.append(ends[-1] + min(len(s), k))
                    if with_body:
                        bodies.append(squeeze.compress(data))
                        bits.append(signature(s))
                sketch = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat)))
                columns = {"key": batch.column(0), "n": pa.array(ns, pa.int32()), "sig": pa.array(sigs, pa.binary()), "sketch": sketch}
                if with_body:
                    columns |= {"body": pa.array(bodies, pa.binary())} | {c: pa.array(x) for c, x in zip(SIGNATURE, np.stack(bits, 1), strict=True)}
                yield pa.RecordBatch.from_pydict(columns | {c: batch.column(2 + i) for i, c in enumerate(also)})

    rows = small_batches(docs).select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), *also)
    schema = StructType.fromDDL("key long, n int, sig binary, sketch array<long>" + ("".join([", body binary", *[f", {c} long" for c in SIGNATURE]]) if with_body else ""))
    return rows.mapInArrow(run, StructType([*schema.fields, *rows.schema.fields[2:]]))


@lru_cache(maxsize=1024)
def least_shared(k: int, p: float, chance: float = CHANCE) -> int:
    """The most successes that k trials of probability p fall short of with at most this chance."""
    if p >= 1:
        return k
    below = 0.0
    for n in range(k + 1):
        below += math.exp(math.lgamma(k + 1) - math.lgamma(n + 1) - math.lgamma(k - n + 1) + (n * math.log(p) if n else 0.0) + (k - n) * math.log1p(-p)) if p > 0 else 1.0
        if below > chance:
            return n
    return k


def alpha_of(n: Column, k: int, threshold: float) -> Column:
    """Retained values that a set of size n shares with any set that it is linked with. Sets up to k are whole, and so are
    all their partners if n <= threshold * k."""
    whole = F.ceil(n * F.lit(threshold) - F.lit(1e-9)).cast("int")
    return F.when(n <= F.lit(threshold * k), whole).otherwise(F.least(whole, F.lit(least_shared(k, threshold))))


def overlap(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int]:
    """Shared values among the k smallest of the union of two sketches (ascending), and how many those are."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    again = both[1:] == both[:-1]
    distinct = len(both) - int(again.sum())
    if distinct <= k:
        return len(both) - distinct, distinct
    # the place of each value among the distinct ones
    place = np.arange(1, len(both)) - np.cumsum(again)
    return int((again & (place < k)).sum()), k


def _hopeful(pairs: DataFrame, reps: DataFrame, k: int, threshold: float) -> DataFrame:
    """Pairs (a, b) whose union sketch allows a link: exactly where it is the whole union, else but for CHANCE."""
    least = least_shared(k, threshold)
    met = pairs.join(reps.select(F.col("key").alias("a"), F.col("sketch").alias("sa")), "a")
    met = met.join(reps.select(F.col("key").alias("b"), F.col("sketch").alias("sb")), "b").select("a", "b", "sa", "sb")

    def run(batches):
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = np.zeros(batch.num_rows, bool)
            parts = [(np.asarray(c.values), np.asarray(c.offsets)) for c in (left, right)]
            (lv, lo), (rv, ro) = parts
            for i in range(batch.num_rows):
                shared, size = overlap(lv[lo[i] : lo[i + 1]], rv[ro[i] : ro[i + 1]], k)
                keep[i] = shared >= size * threshold - 1e-9 if size < k else shared >= least
            yield batch.select([0, 1]).filter(pa.array(keep))

    return small_batches(met).mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union. The bodies of both sides are joined to the
    pairs; a run of pairs with one b builds its set once."""
    met = pairs.join(reps.select(F.col("key").alias("a"), F.col("body").alias("ta")), "a")
    met = met.join(reps.select(F.col("key").alias("b"), F.col("body").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches):
        hashes, last, right, widen = _Hashes(), None, None, zstandard.ZstdDecompressor()
        for batch in batches:
            found = []
            for a, b, ta, tb in zip(*batch.columns, strict=True):
                left = shingle_set(widen.decompress(ta.as_py()), hashes, words)
                if b != last:
                    last, right = b, shingle_set(widen.decompress(tb.as_py()), hashes, words)
                both = len(np.intersect1d(left, right, assume_unique=True))
                if both and 100 * both >= percent * (len(left) + len(right) - both):
                    found.append((a.as_py(), b.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return small_batches(met).mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """key, label (smallest key reachable) of every key in links (a, b). Each round is a written table; labels
    spread to neighbours, then each takes its label's label, so rounds grow with the logarithm of the longest path."""
    both = links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct()
    both = written(both, "links")
    labels = written(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.col("key")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.key).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near.withColumnRenamed("a", "key"), "key").select("key", "label", F.least("label", "near").alias("new"))
        over = labels.select(F.col("key").alias("new"), F.col("label").alias("over"))
        new = written(spread.join(over, "new", "left").select("key", F.least("new", F.coalesce("over", "new")).alias("label"), F.col("label").alias("old")), "labels")
        if new.where("label <> old").isEmpty():
            return new.select("key", "label")
        labels = new.select("key", "label")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = 80, k: int = K) -> DataFrame:
    """For each row of docs: key, n_shingles, component_id (smallest key reachable), kept (key = component_id).
    Documents are linked if 100 * intersection >= percent * union of their shingle sets."""
    base, classes = _groups(docs, key, text, words, percent, k)
    shared_ids = base.select("key").distinct().count() < base.count()
    if shared_ids:  # groups that rows of one id lie in are one
        of_id = base.where("key is not null").join(classes.select("sig", "group"), "sig").select("key", "group").distinct()
        first = of_id.groupBy("key").agg(F.min("group").alias("b"), F.max("group").alias("last")).where("b < last").select("key", "b")
        over = components(of_id.join(first, "key").select(F.col("group").alias("a"), "b")).withColumnRenamed("key", "group")
        classes = classes.join(over, "group", "left").withColumn("group", F.coalesce("label", "group"))
    least = classes.groupBy("group").agg(F.min("rep").alias("least"))
    out = base.drop("sketch").join(classes.join(least, "group").select("sig", "least"), "sig", "left").select("key", "n", F.coalesce("least", "key").alias("component"))
    if shared_ids:  # rows without words go with their id
        of_id = out.groupBy("key").agg(F.min("component").alias("least")).where("key is not null")
        out = out.join(of_id, "key", "left").select("key", "n", F.coalesce("least", "component").alias("component"))
    kept = F.coalesce(F.col("key") == F.col("component"), F.lit(True))
    return out.select(F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"))


def _text_hash(text: str) -> Column:
    return F.xxhash64(text)


def _groups(docs: DataFrame, key: str, text: str, words: int, percent: int, k: int) -> tuple[DataFrame, DataFrame]:
    """base: for each row of docs key, n, sig, h (hash of the text). classes: for each sig the smallest key that has it (rep), the h
    of a row that stands for it, and its group: classes that links join, directly or through others."""
    t = percent / 100
    base = written(sketches(docs.withColumn("_h", _text_hash(text)), key, text, words, PROBE, also=("_h",)).withColumnRenamed("_h", "h"), "sketches")
    one = base.where("sig is not null").groupBy("sig").agg(F.min("key").alias("rep"), F.coalesce(F.min_by("h", "key"), F.min("h")).alias("h"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = written(one.withColumn("node", F.monotonically_increasing_id()), "classes")
    probes = classes.withColumnRenamed("node", "key").withColumn("alpha", alpha_of(F.col("n"), PROBE, t))
    stay = _common(probes, ("key", "rep", "h", "sig", "alpha")).where(F.size("shared") >= F.col("alpha"))
    stay = stay.select(F.col("key").alias("node"), "rep", F.col("h").alias("rep_h"), F.col("sig").alias("own"))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), _text_hash(text).alias("h"))
    rows = rows.join(stay, rows.id.eqNullSafe(stay.rep) & (rows.h == stay.rep_h)).select("node", "text", "own")
    reps = sketches(rows, "node", "text", words, k, with_body=True, also=("own",)).where("sig = own").drop("sig", "own")
    reps = written(reps.withColumn("alpha", alpha_of(F.col("n"), k, t)), "candidates")
    if reps.select("key").distinct().count() < reps.count():  # repeated rows: one of them stands in the lists
        reps = written(reps.dropDuplicates(["key"]), "candidates")

    listed = _common(reps, ("key", "n", "alpha", *SIGNATURE)).where(F.size("shared") >= F.col("alpha"))
    room = F.greatest(F.size("shared") - F.col("alpha") + 1, F.lit(0))
    lists = listed.select("key", "n", *SIGNATURE, F.size("shared").alias("c"), "r", F.posexplode(F.slice("shared", 1, room)).alias("i", "x"))
    lists = lists.select("key", "n", *SIGNATURE, "c", "r", (F.col("r") - F.col("c") + F.col("i") + 1).alias("place"), F.col("x.value").alias("value"))
    lists = written(lists, "lists")

    centre = lists.groupBy("value").agg(F.max(F.struct((F.col("c") / F.col("r")).alias("share"), (-F.col("key")).alias("key"))).alias("m"), F.count("*").alias("many")).where("many > 1")
    stars = lists.join(centre.select("value", (-F.col("m.key")).alias("b")), "value").select(F.col("key").alias("a"), "b").where("a <> b").distinct()
    first = written(verified(_hopeful(stars, reps, k, t), reps, words, percent), "stars")

    own = components(first).select(F.col("key"), F.col("label").alias("centre"))
    placed = lists.join(own, "key", "left").withColumn("centre", F.coalesce("centre", "key"))
    # lists whose documents all have one centre make no pairs; the others lose only pairs within a centre
    mixed = placed.groupBy("value").agg(F.min("centre").alias("low"), F.max("centre").alias("high")).where("low < high").select("value")
    placed = written(placed.join(mixed, "value", "left_semi"), "placed")
    rest = _pairs_of_lists(placed, percent, k, t).distinct()
    second = written(verified(_hopeful(rest, reps, k, t), reps, words, percent), "rest")

    # links between stars join their components; what lies within one is known already
    ends = second.join(own.select(F.col("key").alias("a"), F.col("centre").alias("ca")), "a", "left").join(own.select(F.col("key").alias("b"), F.col("centre").alias("cb")), "b", "left")
    over = components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    labels = reps.select(F.col("key").alias("node")).join(own.withColumnRenamed("key", "node"), "node", "left").withColumn("centre", F.coalesce("centre", "node"))
    labels = labels.join(over.withColumnRenamed("key", "centre"), "centre", "left").select("node", F.coalesce("label", "centre").alias("label"))
    grouped = classes.select("sig", "rep", "h", "node").join(labels, "node", "left").select("sig", "rep", "h", F.coalesce("label", "node").alias("group"))
    return base, written(grouped, "groups")


def _common(reps: DataFrame, columns: tuple) -> DataFrame:
    """columns, r (size of the sketch), shared: the (df, value) of those sketch values that several documents retain, rare first."""
    entries = reps.select("key", F.explode("sketch").alias("value"))
    often = entries.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = entries.join(often, "value").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("shared"))  # at most k values
    return reps.select(*columns, F.size("sketch").alias("r")).join(shared, "key")


def _pairs_of_lists(placed: DataFrame, percent: int, k: int, t: float) -> DataFrame:
    """Pairs (a, b) of documents of one list, with different centres, that sizes, places and signatures let be linked."""
    own_values = placed.groupBy("key").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "value"))), lambda v: v["value"]).alias("values"))  # at most k
    placed = placed.join(own_values, "key")
    x, y = placed.alias("x"), placed.alias("y")
    # the first value that linked sketches share has the others they must share behind it, in both; a pair meets there alone
    need = _pair_shares(F.col("x.n"), F.col("y.n"), k, t)
    fits = (F.least("x.c", "y.c") >= need) & (F.col("x.place") <= F.col("x.r") - need + 1) & (F.col("y.place") <= F.col("y.r") - need + 1)
    differ = sum((F.bit_count(F.col(f"x.{b}").bitwiseXOR(F.col(f"y.{b}"))) for b in SIGNATURE), F.lit(0))
    alike = differ <= BITS - least_shared(BITS, (1 + t) / 2)
    meets = (F.col("x.value") == F.col("y.value")) & (F.col("x.key") < F.col("y.key")) & (F.col("x.centre") != F.col("y.centre")) & alike & _like("x.n", "y.n", percent) & fits
    met = x.join(y, meets & (F.get(F.array_intersect("x.values", "y.values"), F.lit(0)) == F.col("x.value")))
    return met.select(F.col("y.key").alias("a"), F.col("x.key").alias("b"))


def _like(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _pair_shares(a: Column, b: Column, k: int, t: float) -> Column:
    """Retained values that linked sets of sizes a and b share at least: t / (1 + t) of both sizes where both sets are
    whole, else that share of the larger one's k values, but for CHANCE."""
    both = F.lit(t / (1 + t)) * (a + b)
    bounds = F.lit([least_shared(k, i / k) for i in range(k + 1)])
    p = F.floor(F.least(both / F.greatest(a, b), F.lit(1.0)) * k).cast("int")
    return F.when(F.greatest(a, b) <= k, both - 1e-9).otherwise(F.get(bounds, p))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = 80, k: int = K) -> DataFrame:
    """docs without the rows of a group of near-duplicate texts other than one with the smallest key: what goes has a near
    copy that stays, or is joined to one by near copies. Different texts of one key are judged each by itself; of rows
    of one key without words one stays. Rows with a null key are kept."""
    held = Sheltered(docs, {"_nth", "_h"}, {key, text})
    docs = held.df
    base, classes = _groups(docs, key, text, words, percent, k)
    chosen = classes.where("rep is not null").groupBy("group").agg(F.min("rep").alias("rep"), F.min_by("h", "rep").alias("h")).select("rep", "h")
    chosen = chosen.union(base.where("sig is null and key is not null").groupBy("key").agg(F.min("h").alias("h")))
    known = docs.withColumn("_h", _text_hash(text))
    known = known.join(chosen, (known[key].cast("long") == chosen.rep) & (known._h == chosen.h), "left_semi")
    order = Window.partitionBy(key, "_h").orderBy(F.xxhash64(*[quoted(c) for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]))
    one = known.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth", "_h")
    return held.restored(one.unionByName(docs.where(F.col(key).isNull())))
