"""Exact top-k by integer inner product, with vectors bucketed by length.

Vectors are range-partitioned by length and packed into buckets of at most BUCKET neighbours in
length. Every query first meets the longest bucket alone, which one broadcast of BUCKET vectors brings to
it; its k-th best score there is a floor s under its answers, so it needs only vectors of length s / |q| or more.
Queries are then packed into blocks by that length, and a bucket is sent to those blocks that need it. A block meets its
buckets by descending length, in runs of RUN buckets each, and the floors rise as it goes. For a query of length |q|
whose floor or k-th best score so far is s, and a bucket of lengths up to l, the local cosine threshold is c = s / (|q| l):
- c > 1: no vector of the bucket, or of any later one, can enter; the run ends for this query;
- c >= COSINE: coordinate pruning. On the query's largest coordinates f, a unit vector p whose cosine with
  the unit query q reaches c has p_f within q_f c -/+ sqrt((1 - q_f^2)(1 - c^2)), without the upper bound where
  q_f > c and without the lower where q_f < -c; others are passed over;
- otherwise length pruning: only the bucket's vectors of length s / |q| or more.
What is left is verified by its integer product. Bounds are widened by a relative 1e-9, so rounding
never loses a vector; ties go to the smaller id. Products are exact: in doubles where |q| l is below 2^53, else in
64-bit integers; a score that may pass 2^63 is an error.

Queries against all rows is a grid of packed blocks and buckets, not of rows; each (block, run) keeps at most k scores of a
query, none below its floor, and a window ends it. A bucket travels once for each block that needs it, so bytes grow with rows times
blocks of BLOCK queries; vectors of one length leave nothing to prune before they travel. To the driver comes one number a block.

Defined results: vectors that are null, or hold null or non-finite components, take no part; shorter
vectors count as padded with zeros; a row never meets rows of its own id; with fewer than k other rows
all come; an empty table gives no rows. Rows that repeat an id with an equal vector count once, as queries and as neighbours; an id
with several vectors asks with each and is answered once, with the best of all scores, and is a neighbour with each of its scores.
Components beyond 2^31 in 256ths are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BUCKET = 2048
BLOCK = 2048
RUN = 16
#: Tasks of the grid at most; beyond, a task takes several (block, run) in turn.
MOST_TASKS = 20_000
#: The floor of a query that the longest bucket gives fewer than k rows.
NO_FLOOR = np.iinfo(np.int64).min
COSINE = 0.5
#: Doubles hold integers up to here.
EXACT = 2.0**52
FOCUS = 3


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null where the vector takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _pack(rows: int):
    """Packs consecutive rows (id, vector) of a task into one: ids, matrix, shape and the range of lengths."""

    def run(batches):
        held: list = []

        def packed():
            ids = np.array([i for i, _ in held], np.int64)
            wide = max((len(v) for _, v in held), default=0)
            m = np.zeros((len(held), wide), np.int64)
            for r, (_, v) in enumerate(held):
                m[r, : len(v)] = v
            if m.size and np.abs(m).max() >= 1 << 31:
                raise ValueError("a component is too large")
            length = np.sqrt((m.astype(np.float64) ** 2).sum(1))
            return pa.RecordBatch.from_pydict(
                {"n": pa.array([len(held)], pa.int32()), "wide": pa.array([wide], pa.int32()), "longest": [float(length.max())], "ids": [ids.tobytes()], "matrix": [m.astype(np.int32).tobytes()]}
            )

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append((i, v))
                if len(held) == rows:
                    yield packed()
                    held = []
        if held:
            yield packed()

    return run


PACKED = "n int, wide int, longest double, ids binary, matrix binary"


def _matrix(data: bytes, n: int, wide: int, at_least: int) -> np.ndarray:
    m = np.frombuffer(data, np.int32).reshape(n, wide).astype(np.float64)
    return m if wide >= at_least else np.pad(m, ((0, 0), (0, at_least - wide)))


class _Block:
    """A block of queries and their best rows so far; no row below a query's floor is among its k best."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, floors: np.ndarray | None = None):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.floors = np.full(len(ids), NO_FLOOR) if floors is None else floors.copy()
        self.length = np.sqrt((vectors**2).sum(1))
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]  # scores descending, ids

    def meet(self, ids: np.ndarray, m: np.ndarray) -> None:
        wide = max(m.shape[1], self.vectors.shape[1])
        if self.vectors.shape[1] < wide:
            self.vectors = np.pad(self.vectors, ((0, 0), (0, wide - self.vectors.shape[1])))
        length = np.sqrt((m**2).sum(1))
        order = np.lexsort((ids, -length))
        m, ids, length = m[order], ids[order], length[order]
        unit = m / np.maximum(length, 1e-300)[:, None]
        top = length[0]
        for i, q in enumerate(self.vectors):
            scores, rows = self.best[i]
            pick = slice(None)
            if (least := int(self.floors[i])) > NO_FLOOR:
                own = self.length[i]
                if own * top * (1 + 1e-9) < least:
                    continue
                if least > 0:
                    c = least / (own * top) * (1 - 1e-9)
                    count = int(np.searchsorted(-length, -least / own * (1 - 1e-9), "right"))
                    pick = slice(0, count)
                    if c >= COSINE:
                        unit_q = q / own
                        focus = np.argsort(-np.abs(unit_q))[:FOCUS]
                        mid, reach = unit_q[focus] * c, np.sqrt(np.maximum((1 - unit_q[focus] ** 2) * (1 - c * c), 0)) + 1e-9
                        low, high = np.where(unit_q[focus] < -c, -2.0, mid - reach), np.where(unit_q[focus] > c, 2.0, mid + reach)
                        near = unit[:count, focus]
                        pick = np.flatnonzero(((near >= low) & (near <= high)).all(1))
            who = ids[pick]
            if self.length[i] * top < EXACT:
                product = (m[pick] @ q).astype(np.int64)
            elif self.length[i] * top < 2.0**62:
                product = m[pick].astype(np.int64) @ q.astype(np.int64)
            else:
                raise ValueError("a score may be beyond 64 bits")
            enter = (who != self.ids[i]) & (product >= least)
            product, who = np.concatenate([scores, product[enter]]), np.concatenate([rows, who[enter]])
            by = np.lexsort((who, -product))
            product, who = product[by], who[by]
            fresh = np.ones(len(by), bool)
            fresh[1:] = (product[1:] != product[:-1]) | (who[1:] != who[:-1])
            self.best[i] = product[fresh][: self.k], who[fresh][: self.k]
            if len(self.best[i][0]) == self.k:
                self.floors[i] = max(least, int(self.best[i][0][-1]))

    def needs(self) -> np.ndarray:
        """The least length of a vector that may still be among a query's k best."""
        return np.where((self.floors > 0) & (self.length > 0), self.floors / np.maximum(self.length, 1e-300) * (1 - 1e-9), 0.0)


def _block_of(row: dict, k: int) -> _Block:
    floors = np.frombuffer(row["floors"], np.int64) if "floors" in row else None
    return _Block(np.frombuffer(row["qids"], np.int64), _matrix(row["qmatrix"], row["qn"], row["qwide"], 0), k, floors)


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(j)[i].as_py() for j, c in enumerate(batch.schema.names)}


def _floors(k: int):
    """Each query of a block with its vector, its floor after the longest bucket, and the length that it needs."""

    def run(batches):
        for row in _rows(batches):
            state = _block_of(row, k)
            if row["ids"] is not None:
                state.meet(np.frombuffer(row["ids"], np.int64), _matrix(row["matrix"], row["n"], row["wide"], state.vectors.shape[1]))
            wide = row["qwide"] * 4
            vectors = [row["qmatrix"][j * wide : (j + 1) * wide] for j in range(row["qn"])]
            yield pa.RecordBatch.from_arrays([pa.array(state.ids), pa.array(vectors, pa.binary()), pa.array(state.floors), pa.array(state.needs())], names=["id", "v", "floor", "need"])

    return run


def _pack_floors(rows: int):
    """Packs consecutive queries (id, vector, floor, need) of a task into blocks."""

    def run(batches):
        held: list = []

        def packed():
            ids, vectors, floors, needs = zip(*held, strict=True)
            wide = max(map(len, vectors)) // 4
            matrix = b"".join(v.ljust(4 * wide, b"\0") for v in vectors)
            floors = np.array(floors, np.int64).tobytes()
            return pa.RecordBatch.from_pydict({"qn": pa.array([len(ids)], pa.int32()), "qwide": pa.array([wide], pa.int32()), "qids": [np.array(ids, np.int64).tobytes()], "qmatrix": [matrix], "floors": [floors], "need": [min(needs)]})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                if len(held) == rows:
                    yield packed()
                    held = []
        if held:
            yield packed()

    return run


def _answers(k: int):
    """The best rows of each block in each run; rows of one (own, run) come together, the longest bucket first."""

    def run(batches):
        now, state = None, None

        def out():
            counts = [len(r) for _, r in state.best]
            scores, rows = (np.concatenate([b[j] for b in state.best]).astype(np.int64) for j in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(state.ids, counts)), pa.array(rows), pa.array(scores)], names=["query_id", "vec_id", "score"])

        for row in _rows(batches):
            if (row["own"], row["run"]) != now:
                if state is not None:
                    yield out()
                now, state = (row["own"], row["run"]), _block_of(row, k)
            state.meet(np.frombuffer(row["ids"], np.int64), _matrix(row["matrix"], row["n"], row["wide"], state.vectors.shape[1]))
        if state is not None:
            yield out()

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row where `queries` holds, its k best other rows."""
    known = vectors.select(F.col(key).cast("long").alias("id"), quantised(F.col(vector), scale).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")).where("v is not null and id is not null")
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, m = known.agg(F.count("*"), F.count_if("asks")).first()
    parts = max(1, -(-n // (4 * bucket)))
    ranged = known.withColumn("length", length).repartitionByRange(parts, F.desc("length"), "id").sortWithinPartitions(F.desc("length"), "id")
    buckets = written(ranged.select("id", "v").mapInArrow(_pack(bucket), PACKED), "buckets")
    held, peak = buckets.agg(F.count("*"), F.max("longest")).first()
    # one bucket, so `bucket` vectors, whatever the size of the table
    first = buckets.where(F.col("longest") == peak).limit(1).withColumn("one", F.lit(1))
    parts = max(1, -(-m // block))
    names = {"n": "qn", "wide": "qwide", "ids": "qids", "matrix": "qmatrix"}
    asked = known.where("asks").repartition(parts, "id").sortWithinPartitions("id").select("id", "v").mapInArrow(_pack(block), PACKED)
    asked = asked.drop("longest").withColumnsRenamed(names).withColumn("one", F.lit(1))
    floors = written(asked.join(F.broadcast(first), "one", "left").mapInArrow(_floors(k), "id long, v binary, floor long, need double"), "floors")
    # the number of a query's partition is its block's; a partition of more than `block` queries makes several rows of one number
    packed = floors.repartitionByRange(parts, "need", "id").mapInArrow(_pack_floors(block), "qn int, qwide int, qids binary, qmatrix binary, floors binary, need double")
    blocks = written(packed.withColumns({"block": F.spark_partition_id(), "own": F.monotonically_increasing_id()}), "blocks")
    least = {r.block: r.need for r in blocks.groupBy("block").agg(F.min("need").alias("need")).collect()}
    needs = F.lit([least.get(b, float("inf")) for b in range(parts)])
    runs = max(1, -(-held // RUN))
    tasks = min(parts * runs, MOST_TASKS)
    needed = F.filter(F.sequence(F.lit(0), F.lit(parts - 1)), lambda b: F.get(needs, b) <= F.col("longest"))
    sent = buckets.withColumn("run", F.pmod(F.xxhash64("ids"), F.lit(runs)).cast("int")).withColumn("block", F.explode(needed)).repartition(tasks, "block", "run")
    wanted = blocks.drop("need").withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1)))).repartition(tasks, "block", "run")
    met = sent.join(wanted.hint("merge"), ["block", "run"]).sortWithinPartitions("own", "run", F.desc("longest"))
    found = met.mapInArrow(_answers(k), "query_id long, vec_id long, score long")
    found = found.repartition("query_id").dropDuplicates(["query_id", "vec_id", "score"])
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
