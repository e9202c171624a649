"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of lengths 0 to ORDER counts which byte followed. The code
length of a byte is that of PPM with escapes of method C, under frozen counts: in a context seen n times
with d different successors, a byte seen c times costs -log2(c / (n + d)); any other costs the escape,
-log2(d / (n + d)), and then what it costs in the context one byte shorter. A context that a language
has never seen costs nothing and passes on; below the empty context every byte costs 8 bits. A text's
language is the one whose tree gives it the shortest code; the score is that language's share of
2^-length over all languages (ties: the smaller name).

Counting is a Spark aggregation over a sample of the labelled rows: for each language the `sample_docs`
rows with the smallest seeded hashes of their keys, texts of at most `sample_bytes` UTF-8 bytes first; longer
ones are taken whole where there are too few of those. All their contexts are kept. So the model grows with the number of
languages and is bounded by the sample; it goes to the driver and is broadcast, and beyond MOST_COUNTS counts that
is refused with an error, not cut. Scoring reads every text whole, in Python workers, by table lookups.

Defined results: null text, or text without a letter, is `und` with score 0, and so is every text if
nothing was learned. Rows with a null language are not learned from. Repeated rows get equal results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Sheltered, position, small_batches, written
from .ranking import uniform_hash

ORDER = 3
SAMPLE_DOCS = 400
SAMPLE_BYTES = 1 << 16
#: Counts (of a byte in a context of a language) that the driver takes: some 16 bytes each.
MOST_COUNTS = 50_000_000
MOST_LANGUAGES = 500
#: A text is noise to all languages if its shortest code passes so many bits a byte, a quarter more than plain bytes take, and
#: so many bits in all: a short text with a key or a number in it stays.
NOISE_BITS, SLACK_BITS = 10, 64
#: What stands before a text: its first bytes have a context too.
BEFORE = b"   "
#: Bytes whose code lengths are worked out at once; longer texts go by parts.
SLICE = 1 << 19


@dataclass
class Model:
    """Code lengths for all languages at once. By length of context:
    ids: context (its bytes as a number) -> its number, 0 if none of the languages has it;
    escapes: number of context -> escape lengths; pairs: the number * 256 + byte that some language has, ascending; costs:
    code lengths by place among the pairs, from 1, and 0 for all others."""

    languages: list[str]
    ids: list[np.ndarray]
    escapes: list[np.ndarray]
    pairs: list[np.ndarray]
    costs: list[np.ndarray]


def sample(docs: DataFrame, lang: str, key: str, text: str, seed: int, per_language: int, most_bytes: int) -> DataFrame:
    """The learned-from rows. Ids are ranked without their texts; per partition and language at most `per_language` rows reach the ranking."""
    fit = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    # the hash is not negative; the sign bit puts texts within the bound before the others
    place = F.when(F.octet_length(text) <= most_bytes, uniform_hash(seed, key).bitwiseOR(F.lit(-(1 << 63)))).otherwise(uniform_hash(seed, key))
    order = Window.partitionBy("_lang").orderBy("_hash")
    ranked = fit.select(F.col(lang).alias("_lang"), place.alias("_hash")).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_language)
    limits = ranked.groupBy("_lang").agg(F.max("_hash").alias("_limit")).limit(MOST_LANGUAGES + 1).collect()
    if len(limits) > MOST_LANGUAGES:
        raise ValueError(f"there are more than {MOST_LANGUAGES} languages")
    if not limits:
        return fit.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("false")
    least = F.element_at(F.create_map(*[F.lit(x) for r in limits for x in (r["_lang"], r["_limit"])]), F.col(lang))
    return fit.where(place <= least).select(F.col(lang).alias("lang"), F.col(text).alias("text"))


def _counts(batches):
    """Of each task: language, length of context, context << 8 | byte, count."""
    pad = len(BEFORE)
    for batch in batches:
        parts: dict = {}
        for lang, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = t.as_py().encode("utf-8", "replace")
            for at in range(0, len(data), SLICE):
                run = parts.setdefault(lang, [])
                run.append((BEFORE + data[:SLICE]) if at == 0 else data[at - pad : at + SLICE])
                if sum(map(len, run)) >= SLICE:
                    yield from _counted(lang, parts.pop(lang))
        for lang, run in parts.items():
            yield from _counted(lang, run)


def _counted(lang: str, parts: list[bytes]):
    """The counts of parts of texts, whose first bytes are context only."""
    pad = len(BEFORE)
    skip = np.cumsum([0] + [len(p) for p in parts])[:-1]
    b = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
    own = np.ones(len(b), bool)
    for i in range(pad):
        own[skip + i] = False
    at = np.flatnonzero(own)
    for order in range(ORDER + 1):
        gram = b[at]
        for back in range(1, order + 1):
            gram = gram + (b[at - back] << (8 * back))
        values, n = np.unique(gram, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), pa.array(np.full(len(values), order, np.int32)), pa.array(values), pa.array(n.astype(np.int64))], names=["lang", "order", "gram", "n"])


def train(docs: DataFrame, lang: str = "lang", key: str = "doc_id", text: str = "text", seed: int = 41, per_language: int = SAMPLE_DOCS, most_bytes: int = SAMPLE_BYTES, most_counts: int = MOST_COUNTS) -> Model | None:
    """A model of the languages in docs, or None if there is nothing to learn from. Its bounded counts come to the driver."""
    rows = sample(docs, lang, key, text, seed, per_language, most_bytes)
    counts = small_batches(rows).mapInArrow(_counts, "lang string, order int, gram long, n long").groupBy("lang", "order", "gram").agg(F.sum("n").alias("n"))
    counts = written(counts, "context-counts")
    if (n := counts.count()) > most_counts:
        raise ValueError(f"the learned-from rows have {n} counts, more than {most_counts}: learn from fewer rows a language, or from shorter ones")
    found = counts.toArrow()
    if not found.num_rows:
        return None
    names = np.array(found.column("lang").to_pylist(), object)
    languages = sorted(set(names.tolist()))
    which = np.searchsorted(languages, names)
    order_, gram_, n_ = (np.asarray(found.column(c).combine_chunks()) for c in ("order", "gram", "n"))
    size = len(languages)
    ids, escapes, pairs, costs = [], [], [], []
    for order in range(ORDER + 1):
        mine = order_ == order
        gram, n, lang_ = gram_[mine], n_[mine], which[mine]
        context, number = np.unique(gram >> 8, return_inverse=True)
        id_of = np.zeros(1 << (8 * order), np.int32)
        id_of[context] = np.arange(1, len(context) + 1)
        total, kinds = np.zeros((len(context) + 1, size)), np.zeros((len(context) + 1, size))
        np.add.at(total, (number + 1, lang_), n)
        np.add.at(kinds, (number + 1, lang_), 1)
        seen = total > 0
        escape = np.where(seen, -np.log2(np.maximum(kinds, 1) / np.maximum(total + kinds, 1)), 0)
        pair, place = np.unique((number + 1) * 256 + (gram & 255), return_inverse=True)
        count = np.zeros((len(pair), size))
        count[place, lang_] = n
        owner, byte = pair >> 8, pair & 255
        # what the byte costs in the shorter context, for languages that have not seen it here
        if order:
            shorter = _lookup(Model(languages, ids, escapes, pairs, costs), context[owner - 1] & ((1 << (8 * (order - 1))) - 1), byte, order - 1)
        else:
            shorter = np.full((len(pair), size), 8.0)
        bits = np.where(count > 0, -np.log2(np.maximum(count, 1) / (total + kinds)[owner].clip(1)), escape[owner] + shorter)
        ids.append(id_of)
        escapes.append(escape.astype(np.float32))
        pairs.append(pair)
        costs.append(np.concatenate([np.zeros((1, size)), bits]).astype(np.float32))
    return Model(languages, ids, escapes, pairs, costs)


def _lookup(model: Model, context: np.ndarray, byte: np.ndarray, order: int) -> np.ndarray:
    """Code lengths (rows by languages) of bytes in contexts of `order` bytes."""
    number = model.ids[order][context]
    pairs, wanted = model.pairs[order], number.astype(np.int64) * 256 + byte
    row = np.searchsorted(pairs, wanted)
    row = np.where(pairs[np.minimum(row, len(pairs) - 1)] == wanted, row + 1, 0)
    out = model.costs[order][row]
    missed = np.flatnonzero(row == 0)
    if len(missed):
        if order:
            below = _lookup(model, context[missed] & ((1 << (8 * (order - 1))) - 1), byte[missed], order - 1)
        else:
            below = np.float32(8.0)
        out[missed] = model.escapes[order][number[missed]] + below
    return out


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of each text by each language."""
    pad, out, run, held = len(BEFORE), np.zeros((len(texts), len(model.languages))), [], 0
    for i, t in enumerate(texts):
        for at in range(0, len(t), SLICE):
            run.append((i, (BEFORE + t[:SLICE]) if at == 0 else t[at - pad : at + SLICE]))
            held += len(run[-1][1])
            if held >= SLICE:
                _add_lengths(model, run, out)
                run, held = [], 0
    _add_lengths(model, run, out)
    return out


def _add_lengths(model: Model, parts: list[tuple[int, bytes]], out: np.ndarray) -> None:
    """Adds the bits of parts of texts, whose first bytes are context only, to their texts' rows."""
    if not parts:
        return
    pad = len(BEFORE)
    b = np.frombuffer(b"".join(p for _, p in parts), np.uint8).astype(np.int32)
    sizes = np.array([len(p) for _, p in parts])
    starts = np.cumsum(sizes) - sizes
    context = np.zeros(len(b), np.int32)
    for back in range(1, ORDER + 1):
        context[back:] |= b[:-back] << (8 * (back - 1))
    bits = _lookup(model, context, b, ORDER)
    for i in range(pad):
        bits[starts + i] = 0
    np.add.at(out, [i for i, _ in parts], np.add.reduceat(bits, starts, dtype=np.float64))


def has_letter(text: Column) -> Column:
    return F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False))


def predict(df: DataFrame, model: Model | None, text: str = "text", reject: bool = False) -> DataFrame:
    """df with lang_pred and score; columns of these names are replaced. No rows move. With reject, a text that is
    noise to all languages (NOISE_BITS, SLACK_BITS) is `und` too."""
    held = Sheltered(df, {"lang_pred", "score", "_letter"}, {text})
    df = held.df
    if model is None:
        return held.restored(df.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)}), ("lang_pred", "score"))
    at = position(df, text)
    shared = df.sparkSession.sparkContext.broadcast(pack(model))
    flagged = df.withColumn("_letter", has_letter(F.col(text)))

    def run(batches):
        m = unpacked(shared.value)  # for this task; a worker that goes on to other work holds no model
        for batch in batches:
            column, letter = batch.column(at), batch.column(batch.num_columns - 1).to_pylist()
            names, scores = ["und"] * batch.num_rows, [0.0] * batch.num_rows
            todo, held = [], 0
            for i in range(batch.num_rows + 1):
                if todo and (i == batch.num_rows or held > 2 * SLICE):
                    bits = code_lengths(m, [t for _, t in todo])
                    best = bits.argmin(1)
                    share = 1 / np.exp2(np.minimum(bits[np.arange(len(bits)), best][:, None] - bits, 0)).sum(1)
                    for (j, t), k, s, least in zip(todo, best.tolist(), share.tolist(), bits.min(1).tolist(), strict=True):
                        if not reject or least < NOISE_BITS * len(t) + SLACK_BITS:
                            names[j], scores[j] = m.languages[k], s
                    todo, held = [], 0
                if i < batch.num_rows and letter[i]:
                    data = column[i].as_py().encode("utf-8", "replace")
                    todo.append((i, data))
                    held += len(data)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], "lang_pred", "score"])

    judged = small_batches(flagged).mapInArrow(run, StructType([*df.schema.fields]).add("lang_pred", "string").add("score", "double"))
    return held.restored(judged, ("lang_pred", "score"))


def known_languages(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of df in which a language is found, with df's columns alone: those with a letter whose text is not noise to
    all of them (NOISE_BITS, SLACK_BITS). If nothing was learned, all rows with a letter."""
    if model is None:
        return df.where(has_letter(F.col(text)))
    held = Sheltered(df, {"lang_pred", "score"}, {text})
    return held.restored(predict(held.df, model, text, reject=True).where("lang_pred <> 'und'"))


def pack(model: Model) -> tuple:
    """Of the lookup arrays only the used places: what is broadcast is in proportion to the counts."""
    sparse = lambda a: (len(a), np.flatnonzero(a), a[a != 0])
    return model.languages, [sparse(a) for a in model.ids], model.escapes, model.pairs, model.costs


def unpacked(packed: tuple) -> Model:
    languages, ids, escapes, pairs, costs = packed

    def dense(part):
        out = np.zeros(part[0], np.int32)
        out[part[1]] = part[2]
        return out

    return Model(languages, [dense(x) for x in ids], escapes, pairs, costs)
