"""Packing by optimal length buckets.

The histogram of all document lengths decides, by dynamic programming, which bucket boundaries leave the
least padding when every document is padded to the boundary of its bucket. Inside a bucket all documents
have the same padded length, so a batch of the token budget holds a fixed number of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airq.session import materialise

# Rows that are numbered together.
PART_ROWS = 4096


@dataclass(frozen=True)
class Bucket:
    """Documents longer than the bucket before, up to ``length``; ``per_batch`` of them fill a batch."""

    length: int
    per_batch: int


def word_count(text: Column) -> Column:
    """Number of words, runs of other characters than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """At most ``buckets`` of the ascending ``lengths`` such that rounding up to them adds the least in all.

    The last length is always one. Of equally good choices the one with the smaller boundaries is taken. A bucket
    that begins behind the first ``i`` lengths costs what a line with a slope of minus their count says at its boundary,
    and boundaries ascend, so each round walks once along the lower hull of these lines, in whole numbers.
    """
    up, n = [int(x) for x in lengths], len(lengths)
    if n <= buckets:
        return up
    before, mass = [0], [0]
    for x, c in zip(up, counts):
        before.append(before[-1] + int(c))
        mass.append(mass[-1] + x * int(c))
    # cost[j]: least padding of the first j lengths, none where they need more buckets; cut: where the last one begins
    cost: list[int | None] = [0, *[None] * n]
    cuts = []
    for _ in range(buckets):
        hull: list[tuple[int, int, int]] = []  # count, intercept, first lengths
        at = 0
        following, cut = [0], np.zeros(n + 1, dtype=np.int32)
        for j in range(1, n + 1):
            if cost[j - 1] is not None:
                line = (before[j - 1], cost[j - 1] + mass[j - 1], j - 1)
                while len(hull) > 1 and _hidden(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
                at = min(at, len(hull) - 1)
            x = up[j - 1]
            while at + 1 < len(hull) and hull[at + 1][1] - x * hull[at + 1][0] < hull[at][1] - x * hull[at][0]:
                at += 1
            following.append(x * before[j] - mass[j] + hull[at][1] - x * hull[at][0])
            cut[j] = hull[at][2]
        cost = following
        cuts.append(cut)
    out, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        out.append(up[j - 1])
        j = int(cut[j])
    return sorted(out)


def _hidden(first: tuple[int, int, int], middle: tuple[int, int, int], last: tuple[int, int, int]) -> bool:
    """Whether the middle line is nowhere lower than both others; counts ascend."""
    return (last[1] - first[1]) * (middle[0] - first[0]) <= (middle[1] - first[1]) * (last[0] - first[0])


def fit_buckets(lengths: DataFrame, buckets: int, budget: int) -> list[Bucket]:
    """Buckets from the histogram of all rows of ``lengths(n_tokens)``.

    The driver gets one row per distinct length: ``d`` of them take a corpus of at least ``d * d / 2`` tokens, so
    ten trillion tokens have fewer than five million, and given texts a few thousand.
    """
    rows = lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).orderBy("n_tokens").collect()
    at = np.array([r[0] for r in rows], dtype=np.int64)
    counts = np.array([r[1] for r in rows], dtype=np.int64)
    return [Bucket(n, max(1, budget // max(n, 1))) for n in best_boundaries(at, counts, buckets)]


def pack(
    docs: DataFrame,
    length: Column,
    buckets: int = 16,
    budget: int = 16_384,
    id_column: str = "doc_id",
    part_rows: int = PART_ROWS,
    group_column: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_tokens``, ``bucket`` (from 0), ``padded`` (its length), ``batch``, ``slot``.

    ``length`` is a column of ``docs``; null counts as 0. Batches are numbered in their bucket; all but the last
    of a bucket are full. A document longer than the budget is a batch of its own, none is cut or dropped.
    Rows of a bucket are numbered in hashed parts of about ``part_rows`` rows, whose offsets come from their
    counts, so that a bucket with most of the rows is spread over many tasks. With ``group_column`` (few values, such
    as languages; null is one) no batch has rows of two groups: each group has its own buckets of the same lengths,
    numbered on from those of the group before it in order, and the result has the column too.
    """
    own_group = [] if group_column is None else [F.col(group_column).alias("_group")]
    sized = materialise(docs.select(F.col(id_column).alias("_id"), F.coalesce(length, F.lit(0)).cast("long").alias("n_tokens"), *own_group))
    found = fit_buckets(sized, buckets, budget)
    total = sized.count()
    parts = max(1, -(-total // part_rows))
    bucket, padded, per_batch = F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(None).cast("long")
    for i, b in reversed(list(enumerate(found))):
        fits = F.col("n_tokens") <= b.length
        bucket = F.when(fits, F.lit(i)).otherwise(bucket)
        padded = F.when(fits, F.lit(b.length).cast("long")).otherwise(padded)
        per_batch = F.when(fits, F.lit(b.per_batch).cast("long")).otherwise(per_batch)
    part = F.pmod(F.xxhash64("_id", "n_tokens"), F.lit(parts)).cast("int")
    if own_group:
        names = [r[0] for r in sized.where(F.col("_group").isNotNull()).select("_group").distinct().orderBy("_group").collect()]
        place = F.coalesce(F.array_position(F.array(*[F.lit(n) for n in names]), F.col("_group")), F.lit(0)) if names else F.lit(0)
        bucket = bucket + place.cast("int") * F.lit(len(found))
    kept = ["_group"] if own_group else []
    dealt = sized.select("_id", "n_tokens", *kept, bucket.alias("bucket"), padded.alias("padded"), per_batch.alias("_per"), part.alias("_part"))
    ahead = Window.partitionBy("bucket").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("bucket", "_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select("bucket", "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    own = Window.partitionBy("bucket", "_part").orderBy("n_tokens", "_id")
    numbered = dealt.withColumn("_row", F.row_number().over(own) - 1).join(offsets, ["bucket", "_part"])
    rank = F.col("_ahead") + F.col("_row")
    return numbered.select(
        F.col("_id").alias(id_column),
        "n_tokens",
        "bucket",
        "padded",
        F.floor(rank / F.col("_per")).cast("long").alias("batch"),
        (rank % F.col("_per")).cast("long").alias("slot"),
        *[F.col("_group").alias(group_column) for _ in own_group],
    )
