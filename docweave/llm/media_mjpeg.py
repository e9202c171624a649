"""AVI motion-JPEG columns: write and read RIFF files, decode intra frames, detect shots.

Every frame is a baseline JPEG, so each decodes alone. Decoding works on the DC image: one sample
for each 8x8 block of the first (luma) component, which is what shot detection needs and what costs
no inverse transform. `pack_bytes` stores arbitrary bytes losslessly as such samples: a flat block
whose DC coefficient is the byte less 128, at a DC quantiser of 8.

The entropy decoder runs all restart intervals of all frames of a batch in lock step: one NumPy
operation advances every interval by one symbol.

Defined results: null media give no frames and the error "null"; media that are no AVI, or whose
frames cannot be decoded, give no frames and an error text. Empty payloads are padded to one frame.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType, _parse_datatype_string

from .common import position, small_batches

#: Blocks of a frame that pack_bytes writes: 16 across, 12 down, so 192 samples.
COLS, ROWS = 16, 12
FRAME = COLS * ROWS
#: Blocks between restart markers.
RESTART = 24
FPS = 25
#: Payload bytes that are encoded or decoded together at most (or one row, if it is longer).
SLICE = 1 << 20

# Fixed values of the JPEG standard (ITU T.81, annex K.3): numbers of codes by length, and symbols.
# An AVI frame without tables of its own uses these.
DC_BITS = {0: [0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0], 1: [0, 3, 1, 1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0]}
DC_SYMBOLS = {0: list(range(12)), 1: list(range(12))}
AC_BITS = {0: [0, 2, 1, 3, 3, 2, 4, 3, 5, 5, 4, 4, 0, 0, 1, 125], 1: [0, 2, 1, 2, 4, 4, 3, 4, 7, 5, 4, 4, 0, 1, 2, 119]}
AC_SYMBOLS = {
    0: bytes.fromhex(
        "01020300041105122131410613516107227114328191a1082342b1c11552d1f02433627282090a161718191a25262728292a3435363738393a"
        "434445464748494a535455565758595a636465666768696a737475767778797a838485868788898a92939495969798999aa2a3a4a5a6a7a8a9"
        "aab2b3b4b5b6b7b8b9bac2c3c4c5c6c7c8c9cad2d3d4d5d6d7d8d9dae1e2e3e4e5e6e7e8e9eaf1f2f3f4f5f6f7f8f9fa"
    ),
    1: bytes.fromhex(
        "0001020311040521310612415107617113223281081442 91a1b1c109233352f0156272d10a162434e125f11718191a262728292a35363738"
        "393a434445464748494a535455565758595a636465666768696a737475767778797a82838485868788898a92939495969798999aa2a3a4a5a6"
        "a7a8a9aab2b3b4b5b6b7b8b9bac2c3c4c5c6c7c8c9cad2d3d4d5d6d7d8d9dae2e3e4e5e6e7e8e9eaf2f3f4f5f6f7f8f9fa"
    ),
}


def huffman_codes(bits: list[int], symbols) -> dict[int, tuple[int, int]]:
    """Symbol -> (code, length), as the standard derives them from the numbers of codes by length."""
    out, code, k = {}, 0, 0
    for length, n in enumerate(bits, 1):
        for _ in range(n):
            out[symbols[k]] = (code, length)
            code, k = code + 1, k + 1
        code <<= 1
    return out


def signed_bits(value: int, size: int) -> int:
    return value if value > 0 else value + (1 << size) - 1


def lookup(bits: list[int], symbols) -> np.ndarray:
    """By the next 16 bits: symbol << 8 | code length; 0 where no code fits."""
    table = np.zeros(1 << 16, np.int32)
    for symbol, (code, length) in huffman_codes(bits, symbols).items():
        low = code << (16 - length)
        table[low : low + (1 << (16 - length))] = symbol << 8 | length
    return table


# --- writing ---------------------------------------------------------------------------------


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


FRAME_HEADER = (
    b"\xff\xd8"
    + _segment(0xDB, bytes([0, 8] + [1] * 63))  # one table: 8 for DC, 1 for the rest
    + _segment(0xC0, struct.pack(">BHHB", 8, ROWS * 8, COLS * 8, 1) + bytes([1, 0x11, 0]))
    + _segment(0xDD, struct.pack(">H", RESTART))
    + _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0]))
)


def _flat_block_codes() -> tuple[np.ndarray, np.ndarray]:
    """By difference + 255: the bits of a flat block (DC difference, then end of block) and their number."""
    dc, eob = huffman_codes(DC_BITS[0], DC_SYMBOLS[0]), huffman_codes(AC_BITS[0], AC_SYMBOLS[0])[0]
    code, length = np.zeros(511, np.uint32), np.zeros(511, np.int64)
    for diff in range(-255, 256):
        size = abs(diff).bit_length()
        c, n = dc[size]
        c, n = (c << size | signed_bits(diff, size)) if size else c, n + size
        code[diff + 255], length[diff + 255] = c << eob[1] | eob[0], n + eob[1]
    return code, length


BLOCK_CODE, BLOCK_BITS = _flat_block_codes()
STRIDE = RESTART * int(BLOCK_BITS.max()) // 8 + 8


def _entropy(samples: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Entropy-coded bytes of flat blocks with a marker after each interval (the frame's end after the last), and where each frame ends."""
    lanes = samples.reshape(-1, RESTART).astype(np.int32)
    diff = np.empty_like(lanes)
    diff[:, 0] = lanes[:, 0] - 128
    diff[:, 1:] = lanes[:, 1:] - lanes[:, :-1]
    diff += 255
    n = len(lanes)
    grid, base, at = np.zeros(n * STRIDE, np.uint8), np.arange(n, dtype=np.int64) * STRIDE, np.zeros(n, np.int64)
    for i in range(RESTART):
        bits = BLOCK_BITS[diff[:, i]]
        word = BLOCK_CODE[diff[:, i]].astype(np.uint64) << (40 - bits - (at & 7)).astype(np.uint64)
        to = base + (at >> 3)
        for k in range(4):
            grid[to + k] |= (word >> np.uint64(32 - 8 * k)).astype(np.uint8)
        at += bits
    pad = -at & 7  # an interval ends with ones
    grid[base + (at >> 3)] |= ((1 << pad) - 1).astype(np.uint8)
    length = (at + 7) >> 3
    per = FRAME // RESTART
    marker = np.where(np.arange(n) % per == per - 1, 0xD9, 0xD0 + np.arange(n) % per % 8).astype(np.uint8)
    column = np.arange(STRIDE)
    grid = grid.reshape(n, STRIDE)
    stuffed = (grid == 0xFF) & (column < length[:, None])
    extra = stuffed.sum(1)
    grid[np.arange(n), length], grid[np.arange(n), length + 1] = 0xFF, marker
    valid = column < (length + 2)[:, None]
    flat = grid[valid]
    if extra.any():
        flat = np.insert(flat, np.flatnonzero(stuffed[valid]) + 1, 0)
    return flat.tobytes(), np.cumsum(length + 2 + extra)[per - 1 :: per]


def _avi(frames: list[bytes]) -> bytes:
    """An AVI file with one motion-JPEG stream and an index of its frames."""
    movi, index, at = [b"movi"], [], 4
    for f in frames:
        movi.append(struct.pack("<4sI", b"00dc", len(f)) + f + b"\0" * (len(f) & 1))
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        at += len(movi[-1])
    width, height, n, most = COLS * 8, ROWS * 8, len(frames), max(map(len, frames), default=0)
    avih = struct.pack("<14I", 1_000_000 // FPS, 0, 0, 0x10, n, 0, 1, most, width, height, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, FPS, 0, n, most, 0xFFFFFFFF, 0, 0, 0, width, height)
    strf = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 24, b"MJPG", width * height * 3, 0, 0, 0, 0)
    chunk = lambda name, body: struct.pack("<4sI", name, len(body)) + body + b"\0" * (len(body) & 1)
    strl = chunk(b"LIST", b"strl" + chunk(b"strh", strh) + chunk(b"strf", strf))
    body = b"AVI " + chunk(b"LIST", b"hdrl" + chunk(b"avih", avih) + strl) + chunk(b"LIST", b"".join(movi)) + chunk(b"idx1", b"".join(index))
    return struct.pack("<4sI", b"RIFF", len(body)) + body


def pack_bytes(payloads: list[bytes]) -> list[bytes]:
    """Each payload, padded with bytes 32 to a positive multiple of 192, as an AVI whose samples are its bytes."""
    padded = [p + b" " * (-len(p) % FRAME or (0 if p else FRAME)) for p in payloads]
    if not padded:
        return []
    flat, ends = _entropy(np.frombuffer(b"".join(padded), np.uint8))
    out, f, start = [], 0, 0
    for p in padded:
        frames = []
        for end in ends[f : (f := f + len(p) // FRAME)].tolist():
            frames.append(FRAME_HEADER + flat[start:end])
            start = end
        out.append(_avi(frames))
    return out


# --- reading ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Header:
    """What a frame's header says; frames with equal headers decode together."""

    width: int
    height: int
    units: tuple  # blocks of a unit of interleaving: (component, DC table, AC table)
    sampling: tuple[int, int]  # of the first component
    most: tuple[int, int]
    dc_quant: int
    restart: int
    tables: tuple  # (class, id) -> (bits, symbols)

    @property
    def mcus(self) -> tuple[int, int]:
        return -(-self.width // (8 * self.most[0])), -(-self.height // (8 * self.most[1]))


def parse_header(data: bytes) -> tuple[Header, int]:
    """The header of a JPEG frame, and where its entropy-coded data start."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("a frame is no JPEG")
    at, quant, tables, restart, frame = 2, {}, {}, 0, None
    while True:
        if at + 4 > len(data) or data[at] != 0xFF:
            raise ValueError("a frame's header is damaged")
        marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
        body, at = data[at + 4 : at + 2 + size], at + 2 + size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = struct.unpack_from(">H" if wide else ">B", body, 1)[0]
                body = body[1 + (128 if wide else 64) :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0] >> 4, body[0] & 15] = (tuple(body[1:17]), tuple(body[17 : 17 + n]))
                body = body[17 + n :]
        elif marker == 0xDD:
            restart = struct.unpack(">H", body[:2])[0]
        elif marker in (0xC0, 0xC1):
            depth, height, width, n = struct.unpack_from(">BHHB", body)
            if depth != 8:
                raise ValueError("samples are not of 8 bits")
            frame = (width, height, [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)])
        elif 0xC2 <= marker <= 0xCF and marker != 0xC8 and marker != 0xCC:
            raise ValueError("a frame is not of baseline JPEG")
        elif marker == 0xDA:
            break
    if frame is None or body[0] != len(frame[2]) or not frame[0] or not frame[1]:
        raise ValueError("a frame's scan is not of all its components")
    chosen = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
    one = len(frame[2]) == 1  # a single component is not interleaved: its unit is one block
    comps = [(c, 1 if one else h, 1 if one else v, q) for c, h, v, q in frame[2]]
    units = tuple((i, chosen[c] >> 4, chosen[c] & 15) for i, (c, h, v, _) in enumerate(comps) for _ in range(h * v))
    for _, d, a in units:
        tables.setdefault((0, d), (tuple(DC_BITS[min(d, 1)]), tuple(DC_SYMBOLS[min(d, 1)])))
        tables.setdefault((1, a), (tuple(AC_BITS[min(a, 1)]), tuple(AC_SYMBOLS[min(a, 1)])))
    most = max(h for _, h, _, _ in comps), max(v for _, _, v, _ in comps)
    return Header(frame[0], frame[1], units, comps[0][1:3], most, quant.get(comps[0][3], 1), restart, tuple(sorted(tables.items()))), at


def riff_frames(data: bytes) -> tuple[float, list[tuple[int, int]]]:
    """Seconds of a frame, and the place and length of each: by the index, or by walking the chunks where there is none."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    seconds, movi, index = 1 / FPS, None, None

    def walk(at: int, end: int) -> None:
        nonlocal seconds, movi, index
        while at + 8 <= end:
            name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
            if name == b"LIST" and data[at + 8 : at + 12] == b"movi":
                movi = at + 8, min(end, at + 8 + size)
            elif name == b"LIST":
                walk(at + 12, min(end, at + 8 + size))
            elif name == b"avih" and size >= 4:
                seconds = struct.unpack_from("<I", data, at + 8)[0] / 1e6 or seconds
            elif name == b"idx1":
                index = np.frombuffer(data, np.dtype([("name", "S4"), ("flags", "<u4"), ("at", "<u4"), ("size", "<u4")]), min(size, len(data) - at - 8) // 16, at + 8)
            at += 8 + size + (size & 1)

    walk(12, len(data))
    if movi is None:
        raise ValueError("no list of frames")
    if index is not None and len(index):
        index = index[np.isin(index["name"], [b"00dc", b"00db"])]
        # offsets count from the list's name, or from the file's start
        base = movi[0] if len(index) and data[movi[0] + int(index["at"][0]) :][:4] == index["name"][0] else 0
        places = index["at"].astype(np.int64) + base
        if len(places) == 0 or places[-1] + 8 + int(index["size"][-1]) <= len(data):
            return seconds, list(zip((places + 8).tolist(), index["size"].tolist(), strict=True))
    out, at = [], movi[0] + 4
    while at + 8 <= movi[1]:
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name in (b"00dc", b"00db"):
            out.append((at + 8, size))
        at += 12 if name == b"LIST" else 8 + size + (size & 1)
    return seconds, out


class Bits:
    """Reads many bit strings of one buffer side by side."""

    def __init__(self, data: np.ndarray):
        b = np.concatenate([data, np.full(8, 255, np.uint8)]).astype(np.uint32)
        self.words = b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]
        self.last = len(self.words) - 1

    def peek(self, at: np.ndarray) -> np.ndarray:
        """The next 16 bits at each place."""
        return ((self.words[np.minimum(at >> 3, self.last)] >> (16 - (at & 7)).astype(np.uint32)) & 0xFFFF).astype(np.int64)


def _extend(bits: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Signed values from the leading `size` of 16 peeked bits."""
    value = bits >> (16 - size)
    return np.where((value << 1) >> size == 0, value - (1 << size) + 1, value)


def _decode_lanes(bits: Bits, start: np.ndarray, blocks: np.ndarray, header: Header) -> list[np.ndarray]:
    """DC values of the first component of each interval, by its blocks in order of coding."""
    tables = {k: lookup(*v) for k, v in header.tables}
    n, per = len(start), len(header.units)
    at = start.astype(np.int64) * 8
    predicted = np.zeros((max(c for c, _, _ in header.units) + 1, n), np.int64)
    longest = int(blocks.max(initial=0))
    firsts = sum(c == 0 for c, _, _ in header.units)
    out = np.zeros((n, -(-longest // per) * firsts), np.int32)
    order = np.argsort(-blocks, kind="stable")  # so that the intervals still running are the first ones
    at, left = at[order], blocks[order]
    column = 0
    for b in range(longest):
        live = int(np.searchsorted(-left, -b, "left"))  # left > b
        component, d, a = header.units[b % per]
        here = at[:live]
        entry = tables[0, d][bits.peek(here)]
        if not entry.all():
            raise ValueError("a frame's data are damaged")
        here += entry & 255
        size = entry >> 8
        predicted[component, :live] += _extend(bits.peek(here), size)
        here += size
        if component == 0:
            out[order[:live], column] = predicted[0, :live]
            column += 1
        going, k = np.arange(live), np.ones(live, np.int64)
        while len(going):  # AC coefficients, passed over, up to the end of the block
            place = here[going]
            entry = tables[1, a][bits.peek(place)]
            if not entry.all():
                raise ValueError("a frame's data are damaged")
            run, size = entry >> 12, (entry >> 8) & 15
            here[going] = place + (entry & 255) + size
            k += run + 1
            stay = (k < 64) & ((size > 0) | (run == 15))
            going, k = going[stay], k[stay]
    return [out[i, : m // per * firsts] for i, m in enumerate(blocks.tolist())]


def _decode_frames(datas: list[tuple[bytes, int]], header: Header) -> list[np.ndarray]:
    """DC images (rows by columns of 8-bit samples) of frames with one header; datas: (frame, start of its entropy-coded data)."""
    coded = [memoryview(d)[at:] for d, at in datas]
    flat = np.frombuffer(b"".join(coded) + b"\0\0", np.uint8)
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    ends = np.cumsum(sizes)
    marks = np.flatnonzero(flat[:-1] == 0xFF)
    after = flat[marks + 1]
    restarts = marks[(after >= 0xD0) & (after <= 0xD7)]
    keep = np.ones(len(flat), bool)
    keep[marks[after == 0] + 1] = False
    gone = np.flatnonzero(~keep)
    clean = flat[keep]
    across, down = header.mcus
    mcus, per = across * down, len(header.units)
    every = header.restart or mcus
    lanes = -(-mcus // every)
    starts = np.sort(np.concatenate([ends - sizes, restarts + 2]))
    if len(starts) != lanes * len(datas) or (np.bincount(np.searchsorted(ends, restarts, "right"), minlength=len(datas)) != lanes - 1).any():
        raise ValueError("a frame lacks restart markers")
    starts -= np.searchsorted(gone, starts)
    blocks = np.full(lanes, every * per)
    blocks[-1] = (mcus - every * (lanes - 1)) * per
    values = _decode_lanes(Bits(clean), starts, np.tile(blocks, len(datas)), header)
    h, v = header.sampling
    wide, high = -(-header.width * h // (8 * header.most[0])), -(-header.height * v // (8 * header.most[1]))
    dc = np.concatenate(values).reshape(len(datas), down, across, v, h).transpose(0, 1, 3, 2, 4).reshape(len(datas), down * v, across * h)
    samples = np.clip(np.rint(dc[:, :high, :wide] * header.dc_quant / 8) + 128, 0, 255).astype(np.uint8)
    return list(samples)


@dataclass
class Video:
    seconds: float
    frames: list[np.ndarray]
    error: str | None = None


def decode_videos(media: list[bytes | None]) -> list[Video]:
    """The DC images of each file's frames. Frames with equal headers are decoded together."""
    out, groups, last = [], {}, (b"", None)
    for data in media:
        if data is None:
            out.append(Video(0.0, [], "null"))
            continue
        try:
            seconds, places = riff_frames(data)
            video, mine = Video(seconds, [None] * len(places)), []
            for i, (at, size) in enumerate(places):
                if not (last[0] and data.startswith(last[0], at)):
                    header, start = parse_header(data[at : at + size])
                    last = data[at : at + start], header
                mine.append((last[1], data[at : at + size], len(last[0]), i))
            out.append(video)
            for header, frame, start, i in mine:
                groups.setdefault(header, []).append((video, i, frame, start))
        except (ValueError, IndexError, KeyError, struct.error) as e:
            out.append(Video(0.0, [], str(e) or "damaged"))
    for header, items in groups.items():
        try:
            for (video, i, _, _), image in zip(items, _decode_frames([(f, s) for _, _, f, s in items], header), strict=True):
                video.frames[i] = image
        except (ValueError, IndexError):  # one damaged frame: find its file
            for video, i, frame, start in items:
                try:
                    video.frames[i] = _decode_frames([(frame, start)], header)[0]
                except (ValueError, IndexError) as e:
                    video.error = video.error or str(e)
    for video in out:
        if video.error:
            video.frames = []
    return out


# --- shots -----------------------------------------------------------------------------------

BINS = 32


def shot_starts(frames: list[np.ndarray], window: int = 8, factor: float = 1.5, floor: float = 0.05) -> tuple[list[int], np.ndarray]:
    """Frames at which a shot starts, and the histogram difference of each frame to the one before.

    A frame starts a shot if its difference exceeds the mean of the differences within `window`
    frames about it by `factor` of their standard deviations, and `floor`."""
    n = len(frames)
    if n == 0:
        return [], np.zeros(0)
    hist = np.zeros((n, BINS))
    sizes = np.array([f.size for f in frames])
    which = np.repeat(np.arange(n), sizes) * BINS + (np.concatenate([f.ravel() for f in frames]) >> 3)
    hist = np.bincount(which, minlength=n * BINS).reshape(n, BINS) / sizes[:, None]
    diff = np.zeros(n)
    diff[1:] = np.abs(hist[1:] - hist[:-1]).sum(1) / 2
    total, square = np.concatenate([[0], np.cumsum(diff)]), np.concatenate([[0], np.cumsum(diff**2)])
    low, high = np.maximum(np.arange(n) - window, 1 if n > 1 else 0), np.minimum(np.arange(n) + window + 1, n)
    count = np.maximum(high - low, 1)
    mean = (total[high] - total[low]) / count
    spread = np.sqrt(np.maximum((square[high] - square[low]) / count - mean**2, 0))
    cut = (diff > mean + factor * spread) & (diff > floor)
    cut[0] = True
    return np.flatnonzero(cut).tolist(), diff


def clips_of(video: Video) -> list[dict]:
    """Timed rows of the shots of a video."""
    starts, diff = shot_starts(video.frames)
    if not starts:
        return []
    ends = [*starts[1:], len(video.frames)]
    sizes = np.array([f.size for f in video.frames])
    sums = np.add.reduceat(np.concatenate([f.ravel() for f in video.frames]), np.cumsum(sizes) - sizes, dtype=np.int64)
    means = np.add.reduceat(sums / sizes, starts) / np.diff([*starts, len(sizes)])
    return [
        {"clip": i, "first_frame": a, "n_frames": b - a, "start_s": a * video.seconds, "end_s": b * video.seconds, "strength": float(diff[a]), "mean_level": float(means[i])}
        for i, (a, b) in enumerate(zip(starts, ends, strict=True))
    ]


# --- columns ---------------------------------------------------------------------------------


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most SLICE bytes together."""
    sizes = pa.compute.binary_length(column).fill_null(0).to_pylist()
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > SLICE:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)


def _append(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    arrays, names = list(batch.columns), list(batch.schema.names)
    return pa.RecordBatch.from_arrays(arrays + list(columns.values()), names=names + list(columns))


def pack_avi(df: DataFrame, payload: str, out: str = "media") -> DataFrame:
    """df with `out`: the AVI file that holds the column `payload` (binary or string; null counts as empty).
    It replaces a column of that name."""

    at, kept = position(df, payload), [i for i, c in enumerate(df.columns) if c.lower() != out.lower()]

    def run(batches):
        for batch in batches:
            column = batch.column(at).cast(pa.binary())
            batch = batch.select(kept)
            for a, b in _slices(column):
                packed = pack_bytes([x or b"" for x in column.slice(a, b - a).to_pylist()])
                yield _append(batch.slice(a, b - a), {out: pa.array(packed, pa.binary())})

    return small_batches(df).mapInArrow(run, StructType([df.schema.fields[i] for i in kept]).add(out, "binary"))


CLIPS = pa.list_(
    pa.struct([("clip", pa.int32()), ("first_frame", pa.int32()), ("n_frames", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("strength", pa.float64()), ("mean_level", pa.float64())])
)
VIDEO_COLUMNS = "frames int, samples binary, clips array<struct<clip:int,first_frame:int,n_frames:int,start_s:double,end_s:double,strength:double,mean_level:double>>, error string"


def read_avi(df: DataFrame, media: str = "media") -> DataFrame:
    """df with what its column of AVI files holds: `frames` (number), `samples` (of all frames' DC images, row by row),
    `clips` (timed shots) and `error` (null where all is well). Columns of these names are replaced."""
    new: StructType = _parse_datatype_string(VIDEO_COLUMNS)
    at, own = position(df, media), {f.name for f in new}
    kept = [i for i, c in enumerate(df.columns) if c.lower() not in own]

    def run(batches):
        for batch in batches:
            column = batch.column(at).cast(pa.binary())
            batch = batch.select(kept)
            for a, b in _slices(column):
                videos = decode_videos(column.slice(a, b - a).to_pylist())
                yield _append(
                    batch.slice(a, b - a),
                    {
                        "frames": pa.array([len(v.frames) for v in videos], pa.int32()),
                        "samples": pa.array([b"".join(f.tobytes() for f in v.frames) for v in videos], pa.binary()),
                        "clips": pa.array([clips_of(v) for v in videos], CLIPS),
                        "error": pa.array([v.error for v in videos], pa.string()),
                    },
                )

    return small_batches(df).mapInArrow(run, StructType([df.schema.fields[i] for i in kept] + new.fields))


def clip_rows(df: DataFrame, media: str = "media") -> DataFrame:
    """One row for each shot of each media row: df's other columns, then the clip's."""
    others = [c for c in df.columns if c.lower() != media.lower()]
    return read_avi(df, media).selectExpr(*[f"`{c}`" for c in others], "inline(clips)")
