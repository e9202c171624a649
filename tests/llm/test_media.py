import hashlib
import zlib

import numpy as np
import pytest

from docweave.llm import media_mjpeg as m
from docweave.llm.queries import op1_motion_jpeg


def padded(p: bytes) -> bytes:
    return p + b" " * (-len(p) % 192 or (0 if p else 192))


def test_round_trip_of_any_bytes():
    payloads = [b"", b"a", bytes(range(256)) * 5, b"\xff" * 700, b"\0\xff" * 500, np.random.default_rng(1).bytes(5000)]
    videos = m.decode_videos(m.pack_bytes(payloads))
    assert [b"".join(f.tobytes() for f in v.frames) for v in videos] == [padded(p) for p in payloads]


def test_a_file_without_index_is_walked():
    data = m.pack_bytes([b"x" * 900])[0]
    assert m.riff_frames(data.replace(b"idx1", b"JUNK"))[1] == m.riff_frames(data)[1]


def slow_encode(coefficients: np.ndarray, across: int, down: int, restart: int) -> bytes:
    """A scalar baseline encoder of one component, with AC coefficients."""
    dc, ac = m.huffman_codes(m.DC_BITS[0], m.DC_SYMBOLS[0]), m.huffman_codes(m.AC_BITS[0], m.AC_SYMBOLS[0])
    out, bits, last = bytearray(), "", 0

    def flush():
        nonlocal bits
        bits += "1" * (-len(bits) % 8)
        for i in range(0, len(bits), 8):
            out.append(int(bits[i : i + 8], 2))
            if out[-1] == 255:
                out.append(0)
        bits = ""

    def put(code, size):
        nonlocal bits
        bits += f"{code:0{size}b}" if size else ""

    for i, block in enumerate(coefficients.tolist()):
        if restart and i and i % restart == 0:
            flush()
            out.extend([255, 0xD0 + (i // restart - 1) % 8])
            last = 0
        size = abs(block[0] - last).bit_length()
        put(*dc[size])
        put(m.signed_bits(block[0] - last, size) if size else 0, size)
        last, run = block[0], 0
        for k in range(1, 64):
            if block[k] == 0:
                run += 1
                continue
            while run > 15:
                put(*ac[0xF0])
                run -= 16
            size = abs(block[k]).bit_length()
            put(*ac[run << 4 | size])
            put(m.signed_bits(block[k], size), size)
            run = 0
        if run:
            put(*ac[0])
    flush()
    head = b"\xff\xd8" + m._segment(0xDB, bytes([0, 8] + [1] * 63)) + m._segment(0xC0, (8).to_bytes(1, "big") + (down * 8).to_bytes(2, "big") + (across * 8).to_bytes(2, "big") + bytes([1, 1, 0x11, 0]))
    return head + (m._segment(0xDD, restart.to_bytes(2, "big")) if restart else b"") + m._segment(0xDA, bytes([1, 1, 0, 0, 63, 0])) + bytes(out) + b"\xff\xd9"


@pytest.mark.parametrize("restart", [0, 4, 7])
def test_frames_with_ac_coefficients(restart):
    rng = np.random.default_rng(restart)
    c = np.zeros((24, 64), int)
    c[:, 0] = rng.integers(-128, 128, 24)
    for row in c:
        row[rng.integers(1, 64, 9)] = rng.integers(-60, 60, 9)
    frame = slow_encode(c, 6, 4, restart)
    image = m.decode_videos([m._avi([frame, frame])])[0].frames[1]
    assert image.ravel().tolist() == (c[:, 0] + 128).tolist()


def test_shots_are_found_where_the_picture_changes():
    rng = np.random.default_rng(0)
    frames = [rng.integers(low, low + 40, (12, 16)).astype(np.uint8) for low in [10] * 12 + [200] * 9 + [90] * 10]
    assert m.shot_starts(frames)[0] == [0, 12, 21]
    assert m.shot_starts(frames[:1])[0] == [0] and m.shot_starts([])[0] == []
    clips = m.clips_of(m.Video(0.04, frames))
    assert [(c["first_frame"], c["n_frames"], round(c["start_s"], 2)) for c in clips] == [(0, 12, 0.0), (12, 9, 0.48), (21, 10, 0.84)]


def test_damaged_null_and_empty(spark):
    good = m.pack_bytes([b"hello"])[0]
    rows = [(1, good), (2, None), (3, b""), (4, b"RIFFxxxxAVI "), (5, good[:300])]
    df = spark.createDataFrame(rows, "id long, media binary")
    got = {r.id: r for r in m.read_avi(df).collect()}
    assert got[1].frames == 1 and got[1].error is None and got[1].samples.startswith(b"hello")
    assert all(got[i].frames == 0 and got[i].error for i in (2, 3, 4, 5))
    assert m.clip_rows(df).where("id = 1").count() == 1
    assert m.read_avi(df.withColumnRenamed("id", "clips")).columns == ["media", "frames", "samples", "clips", "error"]
    assert m.pack_avi(df, "media", "id").columns == ["media", "id"]
    assert m.read_avi(df.where("false")).count() == 0


def test_query(spark, sf):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = op1_motion_jpeg(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        p = padded(texts[r.doc_id])
        assert (r.n_bytes, r.payload_bytes) == (len(texts[r.doc_id]), len(p))
        assert r.payload_sha256 == hashlib.sha256(p).hexdigest() and r.tail_crc32 == zlib.crc32(p[-16:])
