"""Regular time bins, gap filling and long/wide reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airq import schemas
from airq.functions.calendar import bin_start
from airq.functions.stats import mean
from airq.operators.clean import without_type

HOUR = 3600
# A grid is laid out in blocks of this many bins, so no array grows with the length of a series.
GRID_BLOCK = 1000


def bin_means(df: DataFrame, keys: list[str], measures: list[str], step: int = HOUR, ts: str = "timestamp") -> DataFrame:
    """Mean per key and bin. Rows are combined before the shuffle, so a busy sensor costs its bins only."""
    return (
        df.select(*keys, bin_start(ts, step).alias("timestamp"), *measures)
        .groupBy(*keys, "timestamp")
        .agg(*[mean(m).alias(m) for m in measures])
    )


def geo_time_aggregate(df: DataFrame, dropped_type: str | None = "PPD42NS") -> DataFrame:
    """Enriched observations per geohash and calendar bin."""
    rows = without_type(df, dropped_type) if dropped_type else df
    flat = rows.select(
        F.col("geohash.hash").alias("hash"),
        *[F.col(f"datedim.{c}").alias(c) for c in schemas.GEO_TIME_KEYS[1:]],
        *[F.col(source).alias(f"_{name}") for name, source, _ in schemas.GEO_TIME_MEASURES],
    )
    aggregates = {"max": F.max, "mean": mean}
    return flat.groupBy(*schemas.GEO_TIME_KEYS).agg(
        *[aggregates[kind](f"_{name}").alias(name) for name, _, kind in schemas.GEO_TIME_MEASURES]
    )


def hour_profile(df: DataFrame, keys: list[str], measures: list[str], ts: str = "timestamp") -> DataFrame:
    """Mean by hour of the day."""
    return df.groupBy(F.hour(ts).alias("hour"), *keys).agg(*[mean(m).alias(m) for m in measures])


def time_grid(spans: DataFrame, step: int, first: str = "first", last: str = "last", name: str = "timestamp") -> DataFrame:
    """Every bin from ``first`` to ``last`` of each row, both ends included when on the grid."""
    tick = step * 1_000_000
    start, end = F.unix_micros(first), F.unix_micros(last)
    blocks = spans.withColumn("_block", F.explode(F.sequence(start, end, F.lit(tick * GRID_BLOCK).cast("long"))))
    stop = F.least(F.col("_block") + F.lit(tick * (GRID_BLOCK - 1)).cast("long"), F.unix_micros(last))
    bins = F.explode(F.sequence(F.col("_block"), stop, F.lit(tick).cast("long")))
    return blocks.withColumn("_bin", bins).withColumn(name, F.timestamp_micros("_bin")).drop("_block", "_bin", first, last)


def gap_fill(df: DataFrame, keys: list[str], step: int = HOUR, ts: str = "timestamp") -> DataFrame:
    """Complete the regular grid of each key between its first and last time with null rows.

    Rows off their key's grid are left out and duplicates stay, as in a right join from the grid. Each row
    brings along the empty bins up to its successor, so one shuffle by key does it; a wide gap is filled in
    blocks, so no array grows with it. Input is binned (see ``bin_means``), which bounds a key's rows by
    its bins.
    """
    tick = step * 1_000_000
    order = Window.partitionBy(*keys).orderBy("_at")
    first = F.min("_at").over(order.rowsBetween(Window.unboundedPreceding, 0))
    rest = [c for c in df.columns if c not in (*keys, ts)]
    placed = (
        df.where(F.col(ts).isNotNull())
        .withColumn("_at", F.unix_micros(ts))
        .withColumn("_off", (F.col("_at") - first) % tick)
        .where(F.col("_off") == 0)
        .withColumn("_next", F.lead("_at").over(order))
    )
    until = F.greatest(F.col("_at"), F.coalesce(F.col("_next"), F.col("_at")) - F.lit(tick))
    blocks = F.sequence(F.col("_at"), until, F.lit(tick * GRID_BLOCK).cast("long"))
    blocked = placed.select(*keys, *rest, "_at", until.alias("_until"), F.explode(blocks).alias("_block"))
    stop = F.least(F.col("_block") + F.lit(tick * (GRID_BLOCK - 1)).cast("long"), F.col("_until"))
    bins = F.sequence(F.col("_block"), stop, F.lit(tick).cast("long"))
    filled = blocked.select(*keys, *rest, "_at", F.explode(bins).alias("_bin"))
    own = F.col("_bin") == F.col("_at")
    return filled.select(
        *[
            F.timestamp_micros("_bin").alias(c) if c == ts else F.col(c) if c in keys else F.when(own, F.col(c)).alias(c)
            for c in df.columns
        ]
    )


def unpivot_measures(df: DataFrame, ids: list[str], measures: list[str]) -> DataFrame:
    """Wide to long; rows with a null value are kept."""
    return df.unpivot(ids, measures, "variable", "value")


def pivot_mean(df: DataFrame, keys: list[str], variables: list[str], value: str = "value") -> DataFrame:
    """Long to wide with the mean of duplicates; the column list is given, so no extra pass looks for it."""
    cells = [mean(F.when(F.col("variable") == v, F.col(value))).alias(v) for v in variables]
    return df.groupBy(*keys).agg(*cells)
