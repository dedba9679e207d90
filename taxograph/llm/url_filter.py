"""URL filter over a memory-mapped, sorted array of 64-bit xxhash keys.

Rules (verdict, host, path) are stored as host + path. The index file holds the sorted keys, the
offsets of the full strings, the strings and the verdicts. A url is probed with every
(host suffix, path prefix) whose label count and length occur among the rules; hits of the
vectorised binary search are confirmed against the stored strings.

Defined cases: a null url, or one without "://", has an empty host and path, fits no rule and gets
the default verdict. Repeated rows are judged one by one. Of the fitting rules the longest
host + path wins, then the longer host. A rule given twice with two verdicts blocks. Columns other
than the id and the url are not carried, so names cannot clash. Empty tables give empty results.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxograph.llm.common import new_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty where there is none."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def build_index(rules: list[tuple[str, str, str]]) -> bytes:
    """The index of (verdict, host, path) rules as the bytes of one mappable file."""
    verdict: dict[tuple[str, str], str] = {}
    for v, host, path in rules:
        if v not in (ALLOW, BLOCK):
            raise ValueError(f"verdict {v!r}")
        verdict[host, path] = BLOCK if BLOCK in (v, verdict.get((host, path), v)) else ALLOW
    entries = sorted((xxhash.xxh64_intdigest(f"{h}\0{p}".encode()), h, p, v) for (h, p), v in verdict.items())
    strings = [f"{h}\0{p}".encode() for _, h, p, _ in entries]
    head = {
        "n": len(entries),
        "labels": sorted({h.count(".") + 1 for _, h, _, _ in entries}),
        "lengths": sorted({len(p) for _, _, p, _ in entries}),
    }
    keys = np.array([e[0] for e in entries], dtype="<u8")
    ends = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype("<u8")
    allow = np.array([e[3] == ALLOW for e in entries], dtype="u1")
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 8)
    return np.array([len(text)], dtype="<u8").tobytes() + text + keys.tobytes() + ends.tobytes() + allow.tobytes() + b"".join(strings)


class RuleIndex:
    """An index file mapped into memory."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype="u1", mode="r")
        size = int(raw[:8].view("<u8")[0])
        head = json.loads(raw[8 : 8 + size].tobytes())
        n, at = head["n"], 8 + size
        self.labels, self.lengths, self.n = head["labels"], head["lengths"], n
        self.keys = raw[at : at + 8 * n].view("<u8")
        self.ends = raw[at + 8 * n : at + 16 * n + 8].view("<u8")
        self.allow = raw[at + 16 * n + 8 : at + 17 * n + 8]
        self.strings = raw[at + 17 * n + 8 :]

    def string(self, i: int) -> bytes:
        return self.strings[int(self.ends[i]) : int(self.ends[i + 1])].tobytes()

    def probe(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str] | None]:
        """(rule, verdict) of the winning rule of each url, or None."""
        best: list[tuple[str, str] | None] = [None] * len(hosts)
        rank: list[tuple[int, int]] = [(-1, -1)] * len(hosts)
        if not self.n:
            return best
        owner, candidates = [], []
        for k, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            if not host and not path:
                continue
            for count in self.labels:
                parts = host.rsplit(".", count)
                if len(parts) < count:
                    break
                suffix = ".".join(parts[-count:])
                for size in self.lengths:
                    if size > len(path):
                        break
                    owner.append(k)
                    candidates.append((suffix, path[:size]))
        if not candidates:
            return best
        raw = [f"{h}\0{p}".encode() for h, p in candidates]
        hashed = np.fromiter((xxhash.xxh64_intdigest(r) for r in raw), dtype="u8", count=len(raw))
        left = np.searchsorted(self.keys, hashed, side="left")
        found = np.flatnonzero((left < self.n) & (self.keys[np.minimum(left, self.n - 1)] == hashed))
        for c in found.tolist():
            i = int(left[c])
            while i < self.n and self.keys[i] == hashed[c]:
                if self.string(i) == raw[c]:
                    host, path = candidates[c]
                    if (size := (len(host) + len(path), len(host))) > rank[owner[c]]:
                        rank[owner[c]] = size
                        best[owner[c]] = (host + path, ALLOW if self.allow[i] else BLOCK)
                i += 1
        return best


def ship_index(spark: SparkSession, rules: list[tuple[str, str, str]]) -> str:
    """Write the index to the shared folder and hand it to every executor; its file name."""
    from pyarrow import fs

    path = new_path(spark, "url-rules")
    system, where = fs.FileSystem.from_uri(path)
    system.create_dir(where.rpartition("/")[0], recursive=True)
    with system.open_output_stream(where) as out:
        out.write(build_index(rules))
    spark.sparkContext.addFile(path)
    return path.rpartition("/")[2]


def url_verdicts(df: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """(id, host, path, rule, verdict) of every row."""
    spark = df.sparkSession
    name = ship_index(spark, rules)
    parsed = df.select(F.col(id_col), host_of(F.col(url_col)).alias("__host"), path_of(F.col(url_col)).alias("__path"))
    kind = df.schema[id_col].dataType.simpleString()

    def judge(batches):
        index = RuleIndex(SparkFiles.get(name))
        for b in batches:
            hosts, paths = b.column(1).to_pylist(), b.column(2).to_pylist()
            won = index.probe(hosts, paths)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([w and w[0] for w in won], pa.string()), pa.array([w[1] if w else default for w in won], pa.string())],
                ["id", "host", "path", "rule", "verdict"],
            )

    out = parsed.mapInArrow(judge, f"id {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_col)
