"""URL rules in a sorted array of 64-bit digests.

Building sorts the xxhash digests of the rules' keys (host, then path) on Spark, by range, and
writes each range as a shard: a file of sorted 64-bit keys, and files with the full strings. Shards of the same
form hold the hosts that have rules, each with the lengths that its rules' paths have.
Probing maps those files into memory, so a rule list far larger than a worker's memory costs page
cache only; it looks up all candidate keys of a batch by vectorised binary search, and compares the
stored string of every hit, so two keys with one digest cannot be taken for each other.

A rule (host, path) fits its host and the subdomains, if the url's path starts with the rule's path.
The longest rule wins; of equally long ones that with the longer host. Each suffix of a host's labels is
looked up among the hosts first, once for all urls of a batch that have it; a url is then looked up under
those of its suffixes that have rules, with the path lengths of that suffix's own rules only.

Defined results: a null url, or one without "://", has empty host and path and meets no rule. Rules
with a null host are left out, a null path is empty; of rules repeated with another verdict, "block"
holds. Without rules every url gets the default verdict. Very long urls are judged whole: one is cut no further than its
rules' longest path. Repeated rows are judged each by itself and alike.
"""

from __future__ import annotations

import os
import struct
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .warc import open_fs

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules of a shard, about.
SHARD_RULES = 4_000_000
MANIFEST = "kind string, name string, n long, low string, high string"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


# --- building --------------------------------------------------------------------------------


def build_rules(rules: DataFrame, path: str, seed: int = 0, shard_rules: int = SHARD_RULES) -> str:
    """Writes the rules (host, path, verdict: "allow" or "block") as sorted shards below `path`, a new folder.

    The files carry a task attempt in their names, and the manifest names those of the attempts that ended well."""
    keys = (
        rules.where("host is not null")
        .select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), (F.col("verdict") == "block").alias("block"))
        .groupBy("host", "path")
        .agg(F.max("block").alias("block"))
    )
    hosts = keys.groupBy("host").agg(F.sort_array(F.collect_set(F.length("path"))).alias("lengths"))
    whole = keys.select(F.lit("rule").alias("kind"), F.encode("host", "utf-8").alias("host"), F.encode("path", "utf-8").alias("rest"), "block")
    # a host's entry is the host and then its lengths, eight hexadecimal digits each
    digits = F.array_join(F.transform("lengths", lambda n: F.lpad(F.hex(n), 8, "0")), "")
    heads = hosts.select(F.lit("host").alias("kind"), F.encode("host", "utf-8").alias("host"), F.encode(digits, "utf-8").alias("rest"), F.lit(False).alias("block"))
    for kind, entries, n in (("rule", whole, keys.count()), ("host", heads, hosts.count())):
        _write_shards(entries, path, kind, max(1, -(-n // shard_rules)), seed)
    return path


def _write_shards(entries: DataFrame, path: str, kind: str, shards: int, seed: int) -> None:
    def digest(batches):
        for b in batches:
            strings = [h + r if k == "rule" else h for k, h, r in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)]
            # signed and shifted, so that Spark's order of longs is the order of the unsigned digests
            order = [xxhash.xxh64_intdigest(s, seed) - (1 << 63) for s in strings]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(order, pa.int64())], names=[*b.schema.names, "digest"])

    hashed = entries.mapInArrow(digest, "kind string, host binary, rest binary, block boolean, digest long")
    ranged = hashed.repartitionByRange(shards, "digest") if shards > 1 else hashed.coalesce(1)
    ranged = ranged.sortWithinPartitions("digest", "host", "rest")

    def write(batches):
        fs, root = open_fs(path)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        name = f"{kind}-{task.partitionId():06d}-{task.taskAttemptId()}"
        count, low, high, at = 0, 0, 0, 0
        with fs.open_output_stream(f"{root}/{name}.keys") as keys_, fs.open_output_stream(f"{root}/{name}.places") as places, fs.open_output_stream(f"{root}/{name}.text") as text:
            for b in batches:
                digests = np.asarray(b.column(4)).astype(np.int64).view(np.uint64) + np.uint64(1 << 63)
                keys_.write(digests.tobytes())
                for host, rest, block in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                    places.write(struct.pack("<QIIB7x", at, len(host), len(rest), block))
                    text.write(host + rest)
                    at += len(host) + len(rest)
                if b.num_rows:
                    low = int(digests[0]) if not count else low
                    count, high = count + b.num_rows, int(digests[-1])
        if count:
            yield pa.RecordBatch.from_pydict({"kind": [kind], "name": [name], "n": [count], "low": [str(low)], "high": [str(high)]})

    ranged.mapInArrow(write, MANIFEST).write.mode("append").json(f"{path}/manifest")  # a row a shard


# --- probing ---------------------------------------------------------------------------------

PLACE = np.dtype([("at", "<u8"), ("host", "<u4"), ("path", "<u4"), ("block", "u1"), ("pad", "V7")])


class Shard:
    def __init__(self, fs, root: str, name: str, local: bool):
        place = lambda end: f"{root}/{name}.{end}" if local else self.fetched(fs, f"{root}/{name}.{end}")
        self.keys = np.memmap(place("keys"), np.uint64, "r")
        self.places = np.memmap(place("places"), PLACE, "r")
        text = place("text")
        self.text = np.memmap(text, np.uint8, "r") if os.path.getsize(text) else np.zeros(0, np.uint8)

    @staticmethod
    def fetched(fs, path: str) -> str:
        """A copy in the executor's folder of the application's files, for stores that cannot be mapped; Spark removes it at the end."""
        target = os.path.join(SparkFiles.getRootDirectory(), "docweave-rules-" + xxhash.xxh64_hexdigest(path))
        if not os.path.exists(target):
            part = f"{target}.{os.getpid()}"
            with fs.open_input_stream(path) as source, open(part, "wb") as out:
                while block := source.read(1 << 22):
                    out.write(block)
            os.replace(part, target)
        return target


class Rules:
    def __init__(self, path: str, shards: tuple, seed: int):
        fs, root = open_fs(path)
        local = path.startswith(("/", "file:"))
        opened_ = [(kind, np.uint64(low), np.uint64(high), Shard(fs, root, name, local)) for kind, name, low, high in shards]
        self.seed = seed
        self.shards, self.host_shards = ([x[1:] for x in opened_ if x[0] == kind] for kind in ("rule", "host"))

    def hits(self, shards: list, strings: list[bytes]):
        """(index of the string, host size, bytes stored, whether it blocks) for each entry whose digest is that of a string."""
        digests = np.fromiter((xxhash.xxh64_intdigest(s, self.seed) for s in strings), np.uint64, len(strings))
        for low, high, shard in shards:
            mine = np.flatnonzero((digests >= low) & (digests <= high))
            at = np.searchsorted(shard.keys, digests[mine])
            while len(mine):  # equal digests stand side by side
                ok = at < len(shard.keys)
                ok[ok] = shard.keys[at[ok]] == digests[mine[ok]]
                mine, at = mine[ok], at[ok]
                for i, j in zip(mine.tolist(), at.tolist(), strict=True):
                    place = shard.places[j]
                    start, h = int(place["at"]), int(place["host"])
                    yield i, h, shard.text[start : start + h + int(place["path"])].tobytes(), bool(place["block"])
                at = at + 1

    def find(self, strings: list[str], host_sizes: list[int]) -> np.ndarray:
        """For each key its rule's verdict: 1 block, 0 allow, -1 no such rule."""
        out = np.full(len(strings), -1, np.int8)
        keys = [s.encode() for s in strings]
        for i, h, stored, block in self.hits(self.shards, keys):
            if stored == keys[i] and len(strings[i][: host_sizes[i]].encode()) == h:
                out[i] = block
        return out

    def lengths(self, hosts: list[str]) -> dict[str, list[int]]:
        """The path lengths of each host's rules; hosts without rules are left out."""
        names, found = [h.encode() for h in hosts], {}
        for i, h, stored, _ in self.hits(self.host_shards, names):
            if stored[:h] == names[i]:
                found[hosts[i]] = [int(stored[j : j + 8], 16) for j in range(h, len(stored), 8)]
        return found

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str, int] | None]:
        """The winning rule of each url and whether it blocks."""
        suffixes = {host: [host[j:] for j in (0, *(m + 1 for m, c in enumerate(host) if c == "."))] for host in set(hosts)}
        lengths = self.lengths(sorted({x for each in suffixes.values() for x in each if x}))
        ruled = {host: [(x, lengths[x]) for x in each if x in lengths] for host, each in suffixes.items()}
        keys, host_sizes, owners = [], [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            for suffix, sizes in ruled[host]:
                for n in sizes[: bisect_right(sizes, len(path))]:
                    keys.append(suffix + path[:n])
                    host_sizes.append(len(suffix))
                    owners.append(i)
        out: list = [None] * len(hosts)
        verdicts = self.find(keys, host_sizes)
        for k in np.flatnonzero(verdicts >= 0).tolist():
            i, best = owners[k], out[owners[k]]
            if best is None or (len(keys[k]), host_sizes[k]) > best[0]:
                out[i] = (len(keys[k]), host_sizes[k]), keys[k], int(verdicts[k])
        return [None if x is None else x[1:] for x in out]


@lru_cache(maxsize=4)
def opened(path: str, shards: tuple, seed: int) -> Rules:
    return Rules(path, shards, seed)


def judge_urls(df: DataFrame, path: str, url: str = "url", default: str = "allow", seed: int = 0) -> DataFrame:
    """df with host, path, rule (null where none fits) and verdict by the rules built at `path`; columns of these names are replaced. No rows move.

    To the driver comes one row of the manifest for each shard of rules."""
    spark, df = df.sparkSession, df.drop("host", "path", "rule", "verdict")
    rows = spark.read.json(f"{path}/manifest", schema=MANIFEST).collect()
    shards = tuple(sorted((r.kind, r.name, int(r.low), int(r.high)) for r in rows))
    with_parts = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})

    def run(batches):
        rules = opened(path, shards, seed)
        for b in batches:
            found = rules.judge(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("host", "path")))
            rule = pa.array([x and x[0] for x in found], pa.string())
            verdict = pa.array([default if x is None else "block" if x[1] else "allow" for x in found], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, rule, verdict], names=[*b.schema.names, "rule", "verdict"])

    return with_parts.mapInArrow(run, StructType([*with_parts.schema.fields]).add("rule", "string").add("verdict", "string"))


def parse_rule(text: str) -> tuple[str, str]:
    host, slash, path = text.partition("/")
    return host.lower(), slash + path


