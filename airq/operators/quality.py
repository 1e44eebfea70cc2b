"""Checks and reports on sensors: keys, lifetimes, order, summaries and errors."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airq.functions.stats import mean
from airq.operators.scale import exact_quantiles, exact_quantiles_by, global_order, keep_keys, lookup_join

# Largest mean number of copies of a row; its thresholds are a literal of the plan.
MOST_DRAWS = 100


def counted_keys(df: DataFrame, keys: list[str], more_than: int = 0) -> DataFrame:
    """Rows per key, only keys with more than the given number (1 shows keys that are not unique)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than)


def distinct_per_group(df: DataFrame, group: str, member: str) -> DataFrame:
    """Number of distinct members per group. Pairs are made distinct first, so no group is held whole."""
    return df.select(group, member).distinct().groupBy(group).agg(F.count(F.lit(1)).alias("n"))


def lifetime_summary(df: DataFrame, keys: list[str], ts: str = "timestamp") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count(F.lit(1)).alias("n"))


def first_ranked(df: DataFrame, keys: list[str], order: str, k: int = 5) -> DataFrame:
    """Rows whose rank by ``order`` within the key is at most ``k``, ties included; nulls rank first.

    Equal values are counted before the shuffle and only the ``k`` smallest distinct values of a key leave
    a task; the rank of a value is one more than the rows before it. No key is sorted whole. Null keys are a
    group.
    """
    counted = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("_n"))
    window = Window.partitionBy(*keys).orderBy(order)
    smallest = counted.withColumn("_place", F.row_number().over(window)).where(F.col("_place") <= k)
    before = F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1))
    ranked = smallest.withColumn("rank", (F.coalesce(before, F.lit(0)) + 1).cast("int")).where(F.col("rank") <= k)
    found = lookup_join(df, ranked.drop("_n", "_place"), [*keys, order], "inner", null_safe=True)
    return found.select(*df.columns, "rank")


def first_seen_order(df: DataFrame, key: str = "sensor_id", ts: str = "timestamp") -> DataFrame:
    """Entities numbered in the order of their first appearance."""
    seen = df.groupBy(key).agg(F.min(ts).alias("first_seen"))
    return global_order(seen, [F.col("first_seen"), F.col(key)])


def squared_error(df: DataFrame, key: str = "sensor_id", diff: str = "diff") -> DataFrame:
    """Mean squared deviation and its root per key, nulls ignored."""
    mse = mean(F.col(diff) * F.col(diff))
    return df.groupBy(key).agg(mse.alias("mse"), F.sqrt(mse).alias("rmse"))


def best_and_worst(errors: DataFrame, k: int = 10, key: str = "sensor_id") -> DataFrame:
    """The ``k`` smallest and the ``k`` largest errors, marked ``best`` and ``worst``; ties by key."""
    known = errors.where(F.col("mse").isNotNull())
    best = known.orderBy(F.col("mse"), F.col(key)).limit(k).withColumn("side", F.lit("best"))
    worst = known.orderBy(F.col("mse").desc(), F.col(key)).limit(k).withColumn("side", F.lit("worst"))
    return best.unionByName(worst)


def error_curves(df: DataFrame, chosen: DataFrame, sensor: str = "sensor_id", column: str = "TT_TU") -> DataFrame:
    """Sensor and station curves of the chosen sensors in long form."""
    kept = keep_keys(df, chosen, [sensor]).select(sensor, "timestamp", "value", column)
    long = kept.unpivot([sensor, "timestamp"], ["value", column], "variable", "value")
    label = F.when(F.col("variable") == "value", "sensor").otherwise("station")
    return long.withColumn("variable", label)


def rmse(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    d = F.col(predicted) - F.col(actual)
    return df.agg(F.sqrt(mean(d * d)).alias("rmse"))


def describe(df: DataFrame, column: str, probabilities: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of one column as one row."""
    quantiles = exact_quantiles(df, column, list(probabilities)).groupBy().agg(
        *[F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(f"p{round(100 * p)}") for p in probabilities]
    )
    names = [f"p{round(100 * p)}" for p in probabilities]
    packed = quantiles.select(F.struct(*names)).scalar()
    base = df.agg(
        F.count(column).alias("n"),
        mean(column).alias("mean"),
        F.stddev_samp(column).alias("sd"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    return base.withColumn("_q", packed).select("*", *[F.col(f"_q.{n}").alias(n) for n in names]).drop("_q")


def describe_table(df: DataFrame, columns: list[str], probabilities: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per numeric column: count, nulls, mean, sample deviation, extremes and exact quartiles."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    base = long.groupBy("column").agg(
        F.count("value").alias("n"),
        F.sum(F.col("value").isNull().cast("long")).alias("nulls"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("sd"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    names = {p: f"p{round(100 * p)}" for p in probabilities}
    wide = exact_quantiles_by(long, "column", "value", list(probabilities)).groupBy("column").agg(
        *[F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(n) for p, n in names.items()]
    )
    return lookup_join(base, wide, ["column"])


def null_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row telling for each column whether it has a null (or NaN)."""

    def missing(c: str) -> Column:
        is_float = dict(df.dtypes)[c] in ("double", "float")
        return F.col(c).isNull() | F.isnan(c) if is_float else F.col(c).isNull()

    return df.agg(*[F.max(missing(c)).alias(c) for c in columns])


def hashed_sample(df: DataFrame, key: str, every: int, remainder: int = 0) -> DataFrame:
    """Reproducible sample: the keys whose hash falls in one of ``every`` buckets."""
    digest = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.where(digest % every == remainder)


def draw_thresholds(expected: float) -> list[float]:
    """Chances that a Poisson count is at most 0, 1, 2 and so on, as far as they differ from 1."""
    chance = total = math.exp(-expected)
    found = []
    while total < 1.0 and chance > 0.0:
        found.append(total)
        chance *= expected / len(found)
        total += chance
    return found


def random_sample(df: DataFrame, keys: list[str], fraction: float, with_replacement: bool = True, seed: int = 42) -> DataFrame:
    """Rows drawn by a digest of their ``keys`` and the seed: the same on any cluster and for any partitioning.

    With replacement a row occurs as often as a Poisson count of mean ``fraction`` says, read off the row's own
    uniform number; without, it stays if that number is below ``fraction``. Rows with equal keys share their number,
    so the keys should tell rows apart; null keys are a value like others.
    """
    if not 0 <= fraction <= MOST_DRAWS:
        raise ValueError(f"fraction must lie between 0 and {MOST_DRAWS}")
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    digest = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")
    uniform = digest.cast("double") / F.lit(2.0**52)
    if not with_replacement:
        return df.where(uniform < F.lit(float(fraction)))
    # as many copies as thresholds at or below the number
    below = F.filter(F.array(*[F.lit(t) for t in draw_thresholds(fraction)]), lambda t: t <= uniform)
    return df.select("*", F.explode(below).alias("_copy")).drop("_copy")
