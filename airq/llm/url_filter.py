"""URL filters with a sorted digest array.

Rules are (host, path) keys with a verdict. Their 64-bit xxhash digests are stored sorted in a file that
workers map into memory, beside the full strings. For a URL, the digests of all host suffixes with all path
prefixes of a rule's length are probed by vectorised binary search; a hit counts only if the stored string
is the same, so two keys with one digest are told apart.
"""

from __future__ import annotations

import mmap
import os
import struct
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
_HEAD = struct.Struct("<QQ")


def write_digests(path: str, rules: Iterable[tuple[str, str, str]]) -> None:
    """Store rules ``(host, path, verdict)`` sorted by digest: digests, offsets, verdicts, full strings.

    Of equal keys the last stays.
    """
    keys = {(host + path): (len(host), verdict) for host, path, verdict in rules}
    bad = {v for _, v in keys.values()} - {ALLOW, BLOCK}
    if bad:
        raise ValueError(f"verdicts must be {ALLOW} or {BLOCK}, not {sorted(bad)}")
    order = sorted(keys, key=lambda k: (xxhash.xxh64_intdigest(k), k))
    raw = [k.encode() for k in order]
    digests = np.array([xxhash.xxh64_intdigest(k) for k in order], dtype="<u8")
    ends = np.cumsum([0, *map(len, raw)], dtype="<u8")
    lengths = sorted({(len(k) - keys[k][0]) for k in order})
    with open(path, "wb") as f:
        f.write(_HEAD.pack(len(order), len(lengths)))
        f.write(np.array(lengths, dtype="<u8").tobytes())
        f.write(digests.tobytes() + ends.tobytes())
        f.write(bytes(keys[k][1] == BLOCK for k in order))
        f.write(b"".join(raw))


class DigestArray:
    """The stored rules, mapped into memory; only touched pages are read."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.size, lengths = _HEAD.unpack_from(self.data, 0)
        at = _HEAD.size
        self.path_lengths = np.frombuffer(self.data, "<u8", lengths, at).tolist()
        at += 8 * lengths
        self.digests = np.frombuffer(self.data, "<u8", self.size, at)
        at += 8 * self.size
        self.ends = np.frombuffer(self.data, "<u8", self.size + 1, at)
        at += 8 * (self.size + 1)
        self.blocked = np.frombuffer(self.data, "u1", self.size, at)
        self.strings = at + self.size
        self.longest = int(np.diff(self.ends.astype(np.int64)).max(initial=0))

    def find(self, keys: list[str]) -> np.ndarray:
        """Position of each key, -1 where it is not stored."""
        wanted = np.fromiter(map(xxhash.xxh64_intdigest, keys), dtype=np.uint64, count=len(keys))
        out = np.full(len(keys), -1, dtype=np.int64)
        low = np.searchsorted(self.digests, wanted, "left")
        high = np.searchsorted(self.digests, wanted, "right")
        for i in np.flatnonzero(high > low):
            raw = keys[i].encode()
            for at in range(low[i], high[i]):
                if self.data[self.strings + int(self.ends[at]) : self.strings + int(self.ends[at + 1])] == raw:
                    out[i] = at
        return out

    def judge(self, hosts: list[str], paths: list[str], default: str) -> tuple[list[str | None], list[str]]:
        """The longest fitting rule (or None) and the verdict of each URL."""
        keys, owner = [], []
        for i, (host, path) in enumerate(zip(hosts, paths)):
            suffixes, dot = [], len(host)
            while dot >= 0:  # from the right; a name longer than all stored strings is none of them
                dot = host.rfind(".", max(0, len(host) - self.longest - 1), dot)
                if len(host) - dot - 1 <= self.longest:
                    suffixes.append(host[dot + 1 :])
            starts = [path[:n] for n in self.path_lengths if n <= len(path)]
            keys += [s + p for s in suffixes if s for p in starts]
            owner += [i] * (len(keys) - len(owner))
        rules: list[str | None] = [None] * len(hosts)
        verdicts = [default] * len(hosts)
        where = self.find(keys)
        for k in np.flatnonzero(where >= 0):
            i = owner[k]
            if rules[i] is None or len(keys[k]) > len(rules[i]):
                rules[i] = keys[k]
                verdicts[i] = BLOCK if self.blocked[where[k]] else ALLOW
        return rules, verdicts


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for null or without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), upper, lower)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


# One mapped array per worker process and file; on the driver, the files that were sent so far.
_ARRAYS: dict[str, DigestArray] = {}
_SENT: dict[str, str] = {}


def send_digests(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> str:
    """Have Spark hand the rules' file to every executor, also to one that joins later; its name there."""
    folder = tempfile.mkdtemp(prefix="airq-rules-")
    draft = os.path.join(folder, "draft")
    write_digests(draft, rules)
    with open(draft, "rb") as f:
        name = f"rules-{xxhash.xxh3_128_hexdigest(f.read())}.bin"
    key = f"{spark.sparkContext.applicationId} {name}"
    if key not in _SENT:
        _SENT[key] = os.path.join(folder, name)
        os.rename(draft, _SENT[key])
        spark.sparkContext.addFile(_SENT[key])
    return name


def filter_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]],
    default: str = ALLOW,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule`` (null if none fits), ``verdict``.

    A rule ``(host, path, verdict)`` fits its host and all subdomains if the URL's path starts with its path;
    of several the longest counts; with none the URL is not on the list and the verdict is ``default``. A
    null URL and one without ``://`` has an empty host and path. Repeated rows give repeated results.
    """
    name = send_digests(pages.sparkSession, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _ARRAYS:
            _ARRAYS[name] = DigestArray(SparkFiles.get(name))
        for batch in batches:
            found, verdicts = _ARRAYS[name].judge(batch.column(1).to_pylist(), batch.column(2).to_pylist(), default)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string()), pa.array(verdicts, pa.string())],
                ["_id", "host", "path", "rule", "verdict"],
            )

    host, path = host_and_path(F.col(url_column))
    kind = pages.schema[id_column].dataType.simpleString()
    judged = pages.select(F.col(id_column).alias("_id"), host.alias("host"), path.alias("path")).mapInArrow(
        run, f"_id {kind}, host string, path string, rule string, verdict string"
    )
    return judged.select(F.col("_id").alias(id_column), "host", "path", "rule", "verdict")
