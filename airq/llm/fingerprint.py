"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last seven bytes marks the end of a chunk wherever it has enough leading zero bits;
each chunk becomes one character of the signature. The number of bits gives the block size, a power of two
fitted to the text so that a signature stays short. A fingerprint holds signatures at five block sizes, so
that texts of different lengths still have one in common; likeness is one minus the relative edit distance
at the smallest common block size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airq.llm.common import BASE, byte_slices, mixed, powers

ROLLING = 7
# The smallest block size is fitted so that fewer chunks than this end inside the text.
MOST_CHUNKS = 64
LEVELS = 5
SMALLEST_BITS = 1
# A signature character is one of this many, from this code point on (a run of assigned CJK characters).
ALPHABET, FIRST = 4096, 0x4E00
# Bytes that one step hashes together; a longer text is hashed in such pieces.
PIECE_BITS = 20
PIECE = 1 << PIECE_BITS


def fingerprint(text: bytes) -> str:
    """``bits:signature:signature:...`` for block sizes ``2 ** bits`` and the next larger ones.

    Equal texts have equal fingerprints; an empty text has empty signatures.
    """
    sums, rolled = _prefix_sums(text)
    # the 64th smallest hash decides how many leading zero bits leave fewer than 64 chunk ends
    bits = SMALLEST_BITS
    if len(rolled) >= MOST_CHUNKS:
        limit = int(np.partition(rolled, MOST_CHUNKS - 1)[MOST_CHUNKS - 1])
        bits = max(bits, 33 - limit.bit_length() if limit else 33)
    ends = np.flatnonzero(rolled < np.uint64(1) << np.uint64(max(0, 32 - bits))) + 1
    found = []
    for level in range(bits, bits + LEVELS):
        at = ends[rolled[ends - 1] < (1 << max(0, 32 - level))]
        at = np.append(at, [len(text)]) if len(text) and (not len(at) or at[-1] < len(text)) else at
        begin = np.concatenate(([0], at[:-1])).astype(np.int64)[: len(at)]
        chunk = mixed((sums[at] - sums[begin]) * _down(begin) + (at - begin).astype(np.uint64))
        found.append("".join(map(chr, (FIRST + (chunk % np.uint64(ALPHABET)).astype(np.int64)).tolist())))
    return ":".join([str(bits), *found])


def _down(at: np.ndarray) -> np.ndarray:
    """``BASE ** -at`` modulo 2**64, for any positions, from the table of one piece."""
    low, high = at & (PIECE - 1), at >> PIECE_BITS
    out = powers(PIECE)[1][low]
    if high.any():
        step = pow(BASE, -PIECE, 1 << 64)
        values, where = np.unique(high, return_inverse=True)
        out = out * np.array([pow(step, int(v), 1 << 64) for v in values], dtype=np.uint64)[where]
    return out


def _prefix_sums(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums over the whole text and the rolling hash at each byte, made piece by piece."""
    data = np.frombuffer(text, dtype=np.uint8)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    rolled = np.empty(len(data), dtype=np.uint32)
    up, down = powers(PIECE)
    for at in range(0, len(data), PIECE):
        part = data[at : at + PIECE].astype(np.uint64) + np.uint64(1)
        scale = np.uint64(pow(BASE, at, 1 << 64))
        np.cumsum(part * up[: len(part)], out=sums[at + 1 : at + 1 + len(part)])
        sums[at + 1 : at + 1 + len(part)] *= scale
        sums[at + 1 : at + 1 + len(part)] += sums[at]
        here = np.arange(at, at + len(part))
        window = sums[here + 1] - sums[np.maximum(here + 1 - ROLLING, 0)]
        unscale = np.uint64(pow(BASE, -at, 1 << 64))
        rolled[here] = (mixed(window * down[: len(part)] * unscale) >> np.uint64(32)).astype(np.uint32)
    return sums, rolled


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints from 0 to 1: one minus the relative edit distance of their signatures.

    They are compared at the smallest block size that both have; without one they are not alike. Equal
    fingerprints have likeness 1.
    """
    x, y = F.split(a, ":"), F.split(b, ":")
    bits_x, bits_y = x.getItem(0).cast("int"), y.getItem(0).cast("int")
    level = F.greatest(bits_x, bits_y)
    of = lambda parts, bits: F.try_element_at(parts, level - bits + 2)
    s, t = of(x, bits_x), of(y, bits_y)
    longest = F.greatest(F.length(s), F.length(t))
    alike = 1 - F.levenshtein(s, t) / F.greatest(longest, F.lit(1))
    empty = (F.length(x.getItem(1)) == 0) | (F.length(y.getItem(1)) == 0)
    return F.when(a == b, F.lit(1.0)).when(empty, F.lit(0.0)).otherwise(F.coalesce(alike, F.lit(0.0)))


def with_next(docs: DataFrame, ranges: int) -> DataFrame:
    """``(_range, _order, _id, _text)``: rows dealt into ranges of ids, each followed by the first row of the next.

    Ranges run from the largest ids to the smallest (null ids last). ``_order`` is 0 for a range's own rows
    and 1 for the copied row behind them, which is the first row of the next range that has any; behind the
    last range it is the very first row. What reaches the driver is one id per range.
    """
    ids = docs.select("_id").where(F.col("_id").isNotNull())
    shares = F.array(*[F.lit(k / ranges) for k in range(1, ranges)]) if ranges > 1 else None
    ends = sorted(set(ids.agg(F.percentile_approx("_id", shares, 10_000)).first()[0] or [])) if ranges > 1 else []
    limits = np.array(ends)

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        out = np.full(len(key), len(limits) + 1)
        known = key.notna().to_numpy()
        out[known] = len(limits) - np.searchsorted(limits, key[known].to_numpy(), "left") if len(limits) else 0
        return pd.Series(out)

    placed = docs.withColumn("_range", range_of("_id"))
    heads = sorted(tuple(r) for r in placed.groupBy("_range").agg(F.max("_id")).collect())
    # the first row of a range goes to the range before it as well, that of the first range to the last one
    copies = [(place, head, heads[k - 1][0]) for k, (place, head) in enumerate(heads)]
    kind = docs.schema["_id"].dataType.simpleString()
    copies = docs.sparkSession.createDataFrame(copies, f"_place int, _head {kind}, _to int")
    copied = placed.join(F.broadcast(copies), (F.col("_range") == F.col("_place")) & F.col("_id").eqNullSafe(F.col("_head")))
    own = placed.select("_range", F.lit(0).alias("_order"), "_id", "_text")
    return own.unionByName(copied.select(F.col("_to").alias("_range"), F.lit(1).alias("_order"), "_id", "_text"))


def fingerprint_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", ranges: int | None = None
) -> DataFrame:
    """Fingerprints of each text, of its edited text, and of the next document's text.

    The next document follows in descending order of ids (equal ids: by text; null ids last), the first
    follows the last; a single row follows itself. The edited text has its last half (rounded down, in code
    points) replaced by as many of the next document's first. Null texts count as empty; repeated rows give
    repeated results. Columns: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``next_fingerprint``, ``near_edited``, ``near_next``.

    Texts are shuffled once, to ranges of ids; a task reads its range as a stream with one row in hand.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    kind = docs.schema[id_column].dataType.simpleString()
    count = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ordered = (
        with_next(rows, count)
        .repartitionById(count + 1, "_range")
        .sortWithinPartitions("_range", "_order", F.desc_nulls_last("_id"), "_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # a row whose next one has not come yet: range, id, text, fingerprint
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                out: list[list] = [[] for _ in range(6)]
                for place, order, key, text in zip(*(part.column(i).to_pylist() for i in range(4))):
                    if held is not None and held[0] == place:
                        _, own_key, own, own_print = held
                        print_ = fingerprint(text.encode())
                        half = len(own) // 2
                        edited = (own[: len(own) - half] + text[:half]).encode()
                        for column, value in zip(
                            out,
                            (own_key, len(own), hashlib.sha256(edited).hexdigest(), own_print, fingerprint(edited), print_),
                        ):
                            column.append(value)
                    elif order == 0:
                        print_ = fingerprint(text.encode())
                    held = (place, key, text, print_) if order == 0 else None
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], part.column(2).type), pa.array(out[1], pa.int64()), *(pa.array(c, pa.string()) for c in out[2:])],
                    ["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"],
                )

    found = ordered.mapInArrow(
        run,
        f"_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string",
    )
    return found.select(
        F.col("_id").alias(id_column),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "next_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
