"""Byte-level BPE as a monoid: halves of a text are encoded alone and joined at their border.

An element is the list of a text's pieces (the matches of the vocabulary's pattern). Matching is
left to right and has no memory: a piece depends on the text from its start to LOOK characters past
its end. So, when two neighbours are joined,
- pieces that end LOOK characters or more before the border stay as they are;
- from there on the text is matched anew, over a window that grows to the right until one of its
  borders, itself LOOK characters inside the window, is also a border of the right neighbour: from
  that border on, both matchings are the same, so the right neighbour's other pieces stay.
Merges happen within pieces only, so the tokens of all pieces outside the window stay with them.
LOOK holds for the default pattern; another pattern is taken only with its own bound.
Decoding concatenates the bytes of halves up the same tree.

Defined results: null texts encode as the empty text (no ids); null ids decode to null; an id that
the vocabulary lacks is an error that names it.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .common import position, small_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Characters past its end on which a piece depends: two, as in 're.
LOOK = 2
#: Characters of a text that are matched at once.
LEAF = 2048
#: Pieces whose ids a Python worker remembers; then it starts anew.
REMEMBERED = 200_000
SLICE = 4 << 20


def default_vocabulary() -> tuple[str, str]:
    """Rank file and pattern."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


class Coder(dict):
    """Ids of pieces, by piece."""

    def __init__(self, path: str, pattern: str, look: int = LOOK):
        super().__init__()
        self.look = look
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.match = regex.compile(pattern).findall
        # merges within one piece; which text makes a piece is decided here
        self.merge = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.merge(piece))
        if len(self) >= REMEMBERED:
            self.clear()
        if len(piece) < 64:
            self[piece] = ids
        return ids

    def pieces(self, text: str, leaf: int = LEAF) -> list[str]:
        if len(text) <= leaf:
            return self.match(text)
        half = len(text) // 2
        return self.join(self.pieces(text[:half], leaf), self.pieces(text[half:], leaf))

    def join(self, left: list[str], right: list[str]) -> list[str]:
        if not left or not right:
            return left or right
        k, tail = len(left), 0
        while k and tail < self.look:
            k -= 1
            tail += len(left[k])
        head, m = "".join(left[k:]), 2
        while True:
            window = head + "".join(right[:m])
            final = len(window) - self.look if m < len(right) else len(window)
            new = self.match(window)
            at, border, j = 0, len(head), 0
            for i, piece in enumerate(new):
                at += len(piece)
                if at > final:
                    break
                while border < at and j < m:
                    border += len(right[j])
                    j += 1
                if border == at and at >= len(head):
                    del left[k:]
                    left += new[: i + 1]
                    left += right[j:]
                    return left
            m *= 2

    def encode(self, text: str) -> chain:
        return chain.from_iterable(map(self.__getitem__, self.pieces(text)))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF:
            try:
                return b"".join(map(self.bytes_of.__getitem__, ids))
            except KeyError as e:
                raise ValueError(f"the vocabulary has no id {e.args[0]}") from None
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@lru_cache(maxsize=2)
def coder(path: str, pattern: str, look: int = LOOK) -> Coder:
    return Coder(path, pattern, look)


def _known(path: str | None, pattern: str | None, look: int | None) -> tuple[str, str, int]:
    """Rank file, pattern and its bound; a pattern of one's own needs a bound of one's own."""
    own = default_vocabulary()
    if pattern is not None and pattern != own[1] and look is None:
        raise ValueError("another pattern needs `look`: the characters past its end on which a match depends")
    return path or own[0], pattern or own[1], LOOK if look is None else look


def _runs(sizes: np.ndarray, most: int):
    """Runs of rows whose sizes sum to `most` or less, or single rows."""
    first, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > first and total + n > most:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)


def _kept(df: DataFrame, out: str) -> list[int]:
    """Places of the columns that stay: all but one named like the result."""
    return [i for i, c in enumerate(df.columns) if c.lower() != out.lower()]


def _with(batch: pa.RecordBatch, kept: list[int], name: str, array_: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), array_], names=[*(batch.schema.names[i] for i in kept), name])


def bpe_encode(df: DataFrame, text: str = "text", out: str = "ids", path: str | None = None, pattern: str | None = None, look: int | None = None) -> DataFrame:
    """df with the column `out`, which replaces one of that name: array<int> of the ids of `text`. No rows move between partitions."""
    known, at, kept = _known(path, pattern, look), position(df, text), _kept(df, out)

    def run(batches):
        code = coder(*known)
        for batch in batches:
            column = batch.column(at).cast(pa.string())
            sizes = np.asarray(pa.compute.binary_length(column).fill_null(0))
            for a, b in _runs(sizes, SLICE):
                flat, ends = array("i"), [0]
                for t in column.slice(a, b - a):
                    t = t.as_py()
                    if t:
                        flat.extend(code.encode(t))
                    ends.append(len(flat))
                values = pa.array(np.frombuffer(flat, np.int32) if len(flat) else np.zeros(0, np.int32))
                yield _with(batch.slice(a, b - a), kept, out, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values))
        code.clear()  # a worker that goes on to other work remembers no pieces

    return small_batches(df).mapInArrow(run, StructType([*(df.schema.fields[i] for i in kept), StructField(out, ArrayType(IntegerType()))]))


def bpe_decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """df with the column `out`, which replaces one of that name: the bytes of the ids in the column `ids`."""
    known, at, kept = _known(path, None, None), position(df, ids), _kept(df, out)

    def run(batches):
        code = coder(*known)
        for batch in batches:
            column = batch.column(at)
            sizes = np.asarray(pa.compute.list_value_length(column).fill_null(0))
            for a, b in _runs(sizes, SLICE // 4):
                data = [None if x is None else code.decode(x) for x in column.slice(a, b - a).to_pylist()]
                yield _with(batch.slice(a, b - a), kept, out, pa.array(data, pa.binary()))

    return small_batches(df).mapInArrow(run, StructType([*(df.schema.fields[i] for i in kept), StructField(out, BinaryType())]))
