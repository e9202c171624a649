"""WARC archives as a Python data source, format name "docweave_warc".

Writing: one record for each row, each a gzip member of its own, in files that are rolled at
`file_mb`. A member's gzip header carries its compressed length (extra field "sl"), so a reader
leaps from record to record without inflating payloads.

Reading: files are planned into partitions of about `split_mb` (a file is never cut, as its records
can only be found from its start). Filters on `record_type`, `target_uri`, `record_id`, `date` and
`payload_digest` are taken by the source and tried on the parsed headers; a record that fails them,
and every payload when `payload` is "false", is leapt over without decoding.

Spark lets a Python source see filters only while spark.sql.python.filterPushdown.enabled is true;
`read_warc` sets it. Files are reached through pyarrow.fs, so any URI that it opens will do.

Defined results: null or empty payloads are records of length 0; a damaged or truncated member ends
its file with an error that names the file and the place; an empty folder gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage

from .common import written

NAME = "docweave_warc"
SCHEMA = "record_id string, record_type string, target_uri string, date string, payload_digest string, refers_to_id string, http_length long, payload binary"
WRITE_SCHEMA = "record_id string, record_type string, target_uri string, date string, refers_to_id string, payload binary"
HEADERS = {"record_type": "warc-type", "target_uri": "warc-target-uri", "record_id": "warc-record-id", "date": "warc-date"}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROWS = 256
#: Of a member, read at first; most headers end within it.
HEAD = 4096


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri) if uri.startswith("file:") else uri)


def clean(value: str) -> str:
    """A header's value may not break its line."""
    return re.sub(r"[\r\n]+", " ", value)


# --- writing ---------------------------------------------------------------------------------


def record(kind: str, record_id: str, uri: str | None, date: str, refers_to: str | None, payload: bytes) -> bytes:
    """One record, not compressed. A revisit has the HTTP headers of its payload, but not the payload."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{clean(record_id)}>", f"WARC-Date: {date}", f"WARC-Payload-Digest: {digest}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {clean(uri)}")
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <{clean(refers_to or '')}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member whose extra field "sl" holds its own and its inflated length."""
    body = zlib.compress(data, level, -15)
    total = 10 + 2 + 4 + 8 + len(body) + 8
    return struct.pack("<4BIBBH2sHII", 0x1F, 0x8B, 8, 4, 0, 0, 255, 12, b"sl", 8, total, len(data)) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.most, self.overwrite = options["path"], int(float(options.get("file_mb", "1000")) * 1e6), overwrite

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        # names of attempts differ, and only those that commit() hears of lose their leading dot
        names, out, size = [], None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None or size >= self.most:
                    if out:
                        out.close()
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = fs.open_output_stream(f"{root}/.{names[-1]}", compression=None), 0
                data = member(record(row["record_type"], row["record_id"], row["target_uri"], row["date"], row["refers_to_id"], row["payload"] or b""))
                out.write(data)
                size += len(data)
        if out:
            out.close()
        return Written(names)

    def commit(self, messages) -> None:
        fs, root = open_fs(self.path)
        new = [n for m in messages if m for n in m.names]
        if self.overwrite:
            for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
                if f.base_name.startswith("part-"):
                    fs.delete_file(f.path)
        for n in new:
            fs.move(f"{root}/.{n}", f"{root}/{n}")

    def abort(self, messages) -> None:
        fs, root = open_fs(self.path)
        for m in messages:
            for n in m.names if m else []:
                if fs.get_file_info(f"{root}/.{n}").type != pafs.FileType.NotFound:
                    fs.delete_file(f"{root}/.{n}")


# --- reading ---------------------------------------------------------------------------------


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def parse_head(text: bytes) -> dict[str, str]:
    lines = text.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("no WARC record")
    pairs = (line.split(b":", 1) for line in lines[1:] if b":" in line)
    return {k.strip().lower().decode("utf-8", "replace"): v.strip().decode("utf-8", "replace") for k, v in pairs}


def hex_digest(value: str | None) -> str | None:
    """A SHA-1 header, in base 32 or hexadecimal, as bare lower-case hexadecimal; other digests as they are."""
    if value is None or not value.lower().startswith("sha1:"):
        return value
    bare = value[5:]
    return base64.b32decode(bare.upper()).hex() if len(bare) == 32 else bare.lower()


def strip(value: str | None) -> str | None:
    return value[1:-1] if value and value[0] == "<" and value[-1] == ">" else value


def records(f, wanted, with_payload: bool) -> Iterator[tuple[dict[str, str], int | None, bytes | None]]:
    """Headers, HTTP Content-Length and payload of each record that `wanted` accepts by its headers."""
    size, at = f.size(), 0
    while at < size:
        f.seek(at)
        head = f.read(HEAD)
        if head[:2] == b"\x1f\x8b":
            known = struct.unpack_from("<I", head, 16)[0] if len(head) > 24 and head[3] & 4 and head[12:14] == b"sl" else 0
            inflate = zlib.decompressobj(31)
            data = inflate.decompress(head)

            def more(need: int, inflate=inflate, f=f):
                part = f.read(max(HEAD, need))
                if not part and not inflate.eof:
                    raise ValueError("a record is cut off")
                return inflate.decompress(part) if part else b""

            while (cut := data.find(b"\r\n\r\n")) < 0 and not inflate.eof:
                data += more(HEAD)
            named = parse_head(data[:cut])
            ok = wanted(named)
            if ok and with_payload or not known:
                parts = [data]
                while not inflate.eof:
                    parts.append(more(1 << 16))
                data = b"".join(parts)
            at = at + known if known else f.tell() - len(inflate.unused_data)
            if at > size:
                raise ValueError("a record is cut off")
        else:
            data = head
            while (cut := data.find(b"\r\n\r\n")) < 0:
                part = f.read(HEAD)
                if not part:
                    if data.strip():
                        raise ValueError("a record is cut off")
                    return
                data += part
            named = parse_head(data[:cut])
            ok, need = wanted(named), cut + 4 + int(named.get("content-length", 0)) + 4
            if ok and with_payload and len(data) < need:
                data += f.read(need - len(data))
            at += need
            if at > size + 4:  # the blank lines behind the last record may be missing
                raise ValueError("a record is cut off")
        if not ok:
            continue
        length = int(named.get("content-length", 0))
        block, http, payload = data[cut + 4 : cut + 4 + length], None, None
        if "application/http" in named.get("content-type", ""):
            end = block.find(b"\r\n\r\n")
            found = re.search(rb"(?im)^content-length:\s*(\d+)", block[: end if end >= 0 else None])
            http, block = int(found[1]) if found else None, block[end + 4 :] if end >= 0 else b""
        if with_payload:
            if len(data) < cut + 4 + length:
                raise ValueError("a record is cut off")
            payload = None if named.get("warc-type") == "revisit" else block
        yield named, http, payload


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.split = options["path"], float(options.get("split_mb", "128")) * 1e6
        self.payload, self.tests = options.get("payload", "true").lower() == "true", []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS or name == "payload_digest":
                if isinstance(f, EqualTo):
                    self.tests.append((name, "in", (f.value,)))
                    continue
                if isinstance(f, In):
                    self.tests.append((name, "in", tuple(f.value)))
                    continue
                if isinstance(f, StringStartsWith):
                    self.tests.append((name, "starts", f.value))
                    continue
            yield f

    def partitions(self):
        fs, root = open_fs(self.path)
        files = [f for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if re.search(r"\.warc(\.gz)?$", f.base_name) and f.base_name[0] != "."]
        out, size = [[]], 0
        for f in sorted(files, key=lambda f: f.path):
            if out[-1] and size + f.size > self.split:
                out.append([])
                size = 0
            out[-1].append(f.path)
            size += f.size
        return [Files(x) for x in out]

    def accepts(self, named: dict[str, str]) -> bool:
        for column, kind, value in self.tests:
            got = hex_digest(named.get("warc-payload-digest")) if column == "payload_digest" else named.get(HEADERS[column])
            got = strip(got) if column == "record_id" else got
            if got is None or (got not in value if kind == "in" else not got.startswith(value)):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(self.path)
        schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("payload_digest", pa.string()), ("refers_to_id", pa.string()), ("http_length", pa.int64()), ("payload", pa.binary())])
        rows: list[tuple] = []
        held = 0
        for path in partition.paths:
            with fs.open_input_file(path) as f:
                try:
                    for named, http, payload in records(f, self.accepts, self.payload):
                        g = named.get
                        rows.append((strip(g("warc-record-id")), g("warc-type"), g("warc-target-uri"), g("warc-date"), hex_digest(g("warc-payload-digest")), strip(g("warc-refers-to")), http, payload))
                        held += len(payload or b"")
                        if len(rows) >= ROWS or held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows, held = [], 0
                except (ValueError, zlib.error) as e:
                    raise ValueError(f"{path}, near byte {f.tell()}: {e}") from e
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class WarcSource(DataSource):
    """options: path; file_mb (writing); split_mb, payload (reading)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def read_warc(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(NAME).options(path=path, **options).load()


def write_warc(df: DataFrame, path: str, **options) -> None:
    """df has the columns of WRITE_SCHEMA."""
    spark = df.sparkSession
    spark.dataSource.register(WarcSource)
    names = [x.split()[0] for x in WRITE_SCHEMA.split(", ")]
    df.select(*names).write.format(NAME).mode("append").options(path=path, **options).save()


#: At most so many payloads are joined by broadcast.
HOT_SHARE = 1000


def page_records(pages: DataFrame, revisit_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Records for pages (page_id, url, html): of those with equal payloads of at least `revisit_bytes`,
    the one with the largest page_id is the response and the others revisit it.

    The largest id of each payload is found by digest, counted before the shuffle, so a payload that a third of
    the pages share costs one row a task. Payloads that a 1 / HOT_SHARE of all repeated rows or more have, HOT_SHARE at most, are joined by
    broadcast, where their rows lie; so no key of the join that moves payloads has more than that share. Rows that
    repeat no payload get join keys of their own, which meet nothing.

    Defined results: a null html is empty; a null url gives a null target; a row with a null page_id is a response, and never the one that others
    revisit while one of them has an id; of equal payloads under one largest page_id, each such row is a response."""
    body = F.coalesce(F.encode("html", "utf-8"), F.lit(b""))
    own = pages.select("page_id", "url", body.alias("payload"))
    large = F.octet_length("payload") >= revisit_bytes
    keyed = own.withColumn("digest", F.when(large, F.sha1("payload")))
    last = written(keyed.where(large).groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null"), "revisits")
    total = last.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * HOT_SHARE >= total
    hot = F.broadcast(last.where(often).select("digest", F.col("last").alias("hot_last")))
    spread = F.concat(F.lit("#"), F.xxhash64("page_id", "url", "payload").cast("string"))
    near = keyed.join(hot, "digest", "left").withColumn("digest", F.when(F.col("hot_last").isNull() & F.col("digest").isNotNull(), F.col("digest")).otherwise(spread))
    joined = near.join(last.where(~often).select("digest", "last"), "digest", "left").withColumn("last", F.coalesce("hot_last", "last"))
    repeated = F.col("last") > F.col("page_id")
    name = lambda c: F.concat(F.lit("urn:page:"), c.cast("string"))
    return joined.select(
        F.coalesce(name(F.col("page_id")), F.lit("urn:page:")).alias("record_id"),
        F.when(repeated, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.when(repeated, name(F.col("last"))).alias("refers_to_id"),
        F.col("payload"),
    )
