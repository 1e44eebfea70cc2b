"""Best-fit packing by minimum bin slack: documents as token pieces, pieces into as few sequences as possible.

Which pieces share a sequence depends on their lengths alone. The histogram of all lengths, at most as many
rows as a sequence has tokens, is solved on the driver: the largest length left opens a bin, a bitset
subset-sum over the lengths left finds the combination that fills the bin most, and the combination is removed
as often as the counts allow. The pieces of a length are then numbered in Spark and take their places by number.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from airq.llm.common import byte_slices, texts_of
from airq.llm.token_count import printable_bytes
from airq.session import scratch_path

# Pieces of one length that are numbered together.
PART_ROWS = 512
# Fixed value: how byte-level tokenizers of this kind split a text, in the possessive form (same matches, faster).
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@dataclass(frozen=True)
class Pattern:
    """One way to fill a sequence, used ``repeats`` times: ``(length, how many of it)``, longest first."""

    repeats: int
    parts: tuple[tuple[int, int], ...]


def fullest(lengths: list[int], counts: dict[int, int], capacity: int) -> tuple[tuple[int, int], ...]:
    """The combination with ``lengths[0]`` in it that leaves the least of ``capacity`` free.

    ``lengths`` fall, all have a count. Bit ``s`` of the set says that the lengths met so far can make up ``s``; the
    copies of a length enter as 1, 2, 4, ... of them, so that a count needs its logarithm in steps. Of equally
    full combinations the one that needs the shorter lengths least is taken.
    """
    rest = capacity - lengths[0]
    mask = (1 << (rest + 1)) - 1
    reach, steps = 1, []
    for n in lengths:
        copies, chunk = min(counts[n] - (n == lengths[0]), rest // n), 1
        while copies > 0 and not reach >> rest & 1:
            chunk = min(chunk, copies)
            steps.append((n, chunk, reach))
            reach |= (reach << n * chunk) & mask
            copies -= chunk
            chunk *= 2
        if reach >> rest & 1:
            break
    used = {lengths[0]: 1}
    total = reach.bit_length() - 1
    for n, chunk, before in reversed(steps):
        if not before >> total & 1:
            used[n] = used.get(n, 0) + chunk
            total -= n * chunk
    return tuple(sorted(used.items(), reverse=True))


def solve(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """All pieces of a histogram in sequences of at most ``capacity``.

    A combination stays the fullest one until one of its lengths runs short, so it is taken that many times at
    once: the number of patterns follows from the capacity, not from the number of pieces.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left, reverse=True)
    if lengths and (lengths[0] > capacity or lengths[-1] < 1):
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    out = []
    while lengths:
        parts = fullest(lengths, left, capacity)
        repeats = min(left[n] // k for n, k in parts)
        out.append(Pattern(repeats, parts))
        for n, k in parts:
            left[n] -= repeats * k
        lengths = [n for n in lengths if left[n]]
    return out


class Places:
    """Where the pieces of a length go, by their number: a sorted table, one row per pattern and length in it."""

    def __init__(self, patterns: list[Pattern]):
        rows, taken, first = [], {}, 0
        for p in patterns:
            offset = 0
            for n, k in p.parts:
                rows.append((n, taken.get(n, 0), first, k, offset))
                taken[n] = taken.get(n, 0) + p.repeats * k
                offset += n * k
            first += p.repeats
        self.sequences = first
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
        self.span = max(taken.values(), default=0) + 1
        self.keys = table[:, 0] * self.span + table[:, 1]
        self.start, self.first, self.copies, self.offset = table[:, 1:].T.copy()

    def of(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces ``number`` (from 0) of ``length``."""
        at = np.searchsorted(self.keys, length * self.span + number, "right") - 1
        sequence, copy = np.divmod(number - self.start[at], self.copies[at])
        return self.first[at] + sequence, self.offset[at] + copy * length


def pack_pieces(pieces: DataFrame, capacity: int = 2048, length: str = "length", part_rows: int = PART_ROWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (long): no sequence over ``capacity``, its offsets without gaps.

    ``length`` is 1 to ``capacity`` in every row. Pieces of a length are numbered in hashed parts of about
    ``part_rows`` rows whose offsets come from their counts, so that one length may hold most of the rows; equal
    rows are told apart by their place in a written copy of ``pieces``. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    path = scratch_path(spark, "pieces")
    pieces.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("_length", F.col(length).cast("long"))
    counts = {r[0]: r[1] for r in stored.groupBy("_length").count().collect()}  # capacity rows at most
    places = spark.sparkContext.broadcast(Places(solve(counts, capacity)))
    parts = [max(1, -(-counts.get(n, 0) // part_rows)) for n in range(capacity + 1)]
    part = F.pmod(F.xxhash64("_row"), F.element_at(F.lit(parts), (F.col("_length") + 1).cast("int")))
    dealt = stored.withColumn("_part", part)
    ahead = Window.partitionBy("_length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("_length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select("_length", "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    own = Window.partitionBy("_length", "_part").orderBy("_row")
    numbered = dealt.withColumn("_number", F.row_number().over(own) - 1).join(offsets, ["_length", "_part"])
    numbered = numbered.select(*pieces.columns, "_length", (F.col("_ahead") + F.col("_number")).alias("_number"))
    names = [*pieces.columns, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, number = (batch.column(i).to_numpy(zero_copy_only=False) for i in (-2, -1))
            sequence, offset = places.value.of(size, number)
            columns = [*batch.columns[:-2], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = pieces.schema
    for name in names[-2:]:
        schema = schema.add(name, "long")
    return numbered.mapInArrow(run, schema)


def read_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks of all byte strings and ids of the special strings of a byte-level tokenizer file (JSON).

    Only for vocabularies whose merges are in the order of their ids, where ranks say the same as merges.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    step, added, vocabulary = spec["pre_tokenizer"], spec["added_tokens"], spec["model"]["vocab"]
    odd = [t["content"] for t in added if t["single_word"] or t["lstrip"] or t["rstrip"]]
    if spec["normalizer"] or step["type"] != "ByteLevel" or step["add_prefix_space"] or not step["use_regex"] or odd:
        raise ValueError(f"{path} is not a plain byte-level tokenizer")
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
    if merged != sorted(merged):
        raise ValueError(f"{path} does not merge in the order of its ids")
    value = {c: b for b, c in enumerate(printable_bytes())}
    specials = {t["content"]: t["id"] for t in added}
    return {bytes(value[c] for c in word): i for word, i in vocabulary.items() if word not in specials}, specials


class Encoder:
    """Ids as the tokenizer file gives them: by ranks, or by the file's own library for a text the splitter gives up on."""

    def __init__(self, ranks: dict[bytes, int], specials: dict[str, int], spec: str):
        self.fast = tiktoken.Encoding("pieces", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=specials)
        self.spec = spec

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
        except BaseException as error:  # the splitter's give-up is no Exception
            if isinstance(error, Exception) or type(error).__name__ == "PanicException":
                own = Tokenizer.from_str(self.spec)
                return np.array(own.encode(text, add_special_tokens=False).ids, dtype="<u4")
            raise


# One encoder per worker process and tokenizer file; workers outlive tasks.
_ENCODERS: dict[str, Encoder] = {}


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The ids of every document, ``end`` behind them, in pieces: id, ``piece`` (from 0), ``start``, ``length``, ``ids_crc32``.

    Only documents of more than ``capacity`` ids have several pieces; all but the first are full, the first has what
    remains. ``ids_crc32`` is that of the ids as little-endian unsigned 32-bit numbers; ``with_ids`` adds the ids
    as ``ids``. Ids are those of the tokenizer's library without added special tokens, special strings inside
    texts read as special. A null text counts as empty and has the one id ``end``. Null and repeated ids are
    kept; other columns of ``docs`` are not read.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    shipped = docs.sparkSession.sparkContext.broadcast((tokenizer_path, *read_vocabulary(tokenizer_path), spec))
    names = ["_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, *parts = shipped.value
        if name not in _ENCODERS:
            _ENCODERS[name] = Encoder(*parts)
        encode = _ENCODERS[name]
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                rows, found = [], []
                for row, text in enumerate(texts_of(part, "_text")):
                    ids = np.append(encode(text), np.uint32(end)).astype("<u4")
                    cuts = list(range(len(ids) % capacity or min(capacity, len(ids)), len(ids) + 1, capacity))
                    for piece, (a, b) in enumerate(zip([0, *cuts], cuts)):
                        own = ids[a:b]
                        rows.append(row)
                        found.append((piece, a, b - a, zlib.crc32(own.tobytes()), own))
                columns = list(zip(*found))
                arrays = [part.column(0).take(pa.array(rows, pa.int64())), pa.array(columns[0], pa.int32())]
                arrays += [pa.array(c, pa.int64()) for c in columns[1:4]]
                if with_ids:
                    arrays.append(pa.array([c.astype(np.int64) for c in columns[4]], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    cut = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(run, schema)
    return cut.withColumnRenamed("_id", id_column)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """``token_pieces`` of ``docs`` with their places by ``pack_pieces``."""
    return pack_pieces(token_pieces(docs, tokenizer_path, capacity, end), capacity)
