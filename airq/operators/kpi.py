"""Quality figures of a series in native window and aggregate expressions.

Input is a regular series: one row per key and bin (see ``resample.bin_means`` and ``gap_fill``), so the
rows of a key are bounded by the bins of its time span, however many raw readings it sent. All windows
share one partitioning and one order and the final aggregate groups by the same keys, so any set of
figures costs one shuffle and one sort; the terms of figures not asked for are pruned. Rolling means and variances
are differences of running sums, so their cost does not grow with the width; the sums are whole numbers, so nothing cancels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from airq.functions.stats import kurtosis_sample_sd, mean, mean_over, skewness_sample_sd

TILE = 48
VALUE_BINS = 10


def _is_decimal(df: DataFrame, column: str) -> bool:
    kind = df.schema[column].dataType
    return isinstance(kind, T.DecimalType) and kind.precision <= 18 and kind.scale <= 6


def fixed_points(decimal: bool) -> dict[str, Column]:
    """A row's value and its squared standard score as whole numbers, whose running sums are exact.

    The unit of a score follows from the number of rows: all squares of a series add up to that number, so no sum
    leaves a long. Decimals are whole numbers of their sixth place where their sum surely is a long; else, and for
    other types, the value is its score. What is not finite is missing.
    """
    x, n = F.col("_d"), F.col("_known").cast("double")
    score = F.when(F.col("_sd") > 0, (x - F.col("_middle")) / F.col("_sd")).otherwise(x * 0)
    largest = F.greatest(F.abs("_low"), F.abs("_high"))
    whole = ((largest * n < F.lit(9e12)) & (largest < F.lit(4e9))) if decimal else F.lit(False)
    places = F.round(x * F.lit(1e6)).try_cast("long") if decimal else F.lit(None).cast("long")
    unit = F.lit(2.0**61) / F.greatest(n, F.lit(1.0))
    return {
        "_whole": whole,
        "_unit": unit,
        "_f": F.when(whole, places).otherwise(F.round(score * unit).try_cast("long")),
        "_g": F.round(score * score * unit).try_cast("long"),
    }


def rolling(order: WindowSpec, width: int) -> dict[str, Column]:
    """Mean and sample variance of the last ``width`` rows, from the running sums of ``fixed_points``."""

    def last(c: str) -> Column:
        return (F.col(c) - F.coalesce(F.lag(c, width).over(order), F.lit(0))).cast("double")

    n, s, q, sd, middle = last("_n"), last("_s"), last("_q"), F.col("_sd"), F.col("_middle")
    total = F.when(F.col("_whole"), s / F.lit(1e6))
    mean_of = F.coalesce(F.try_divide(total, n), middle + sd * F.try_divide(s, n * F.col("_unit")))
    off = F.coalesce(total - n * middle, sd * s / F.col("_unit"))
    squares = F.greatest(F.lit(0.0), sd * sd * q / F.col("_unit") - F.try_divide(off * off, n))
    return {"_mean": F.when(n > 0, mean_of), "_var": F.when(n > 1, squares / (n - F.lit(1.0)))}


def series_terms(df: DataFrame, keys: list[str], value: str, ts: str, width: int = TILE, bins: int = VALUE_BINS) -> DataFrame:
    """The terms all figures are sums, maxima or variances of, per row of a series."""
    order = Window.partitionBy(*keys).orderBy(ts)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    x = F.col("_d")
    rows = df.select(*keys, ts, F.col(value).alias("_x"), F.col(value).cast("double").alias("_d"))

    first = rows.select(
        "*",
        F.row_number().over(order).alias("_at"),
        (x <= F.percentile("_d", F.lit(0.5)).over(whole)).alias("_below"),
        F.min("_d").over(whole).alias("_low"),
        F.max("_d").over(whole).alias("_high"),
        mean_over("_x", whole).alias("_middle"),
        F.coalesce(F.stddev_samp("_d").over(whole), F.lit(0.0)).alias("_sd"),
        F.count("_d").over(whole).alias("_known"),
    )
    level = F.ceil(F.try_divide(x - F.col("_low"), (F.col("_high") - F.col("_low")) / F.lit(bins)))
    second = first.withColumns(
        {
            "_centred": x - F.col("_middle"),
            "_level": F.when(x.isNotNull(), F.greatest(F.lit(1), level)),
            **fixed_points(_is_decimal(rows, "_x")),
        }
    )
    third = second.select(
        "*",
        (F.col("_below") != F.lag("_below").over(order)).cast("long").alias("_flip"),
        (F.col("_centred") * F.lag("_centred").over(order)).alias("_pair"),
        F.coalesce(F.col("_level") == F.lag("_level").over(order), F.lit(False)).alias("_goes_on"),
        F.count("_f").over(running).alias("_n"),
        F.coalesce(F.sum("_f").over(running), F.lit(0)).alias("_s"),
        F.coalesce(F.sum("_g").over(running), F.lit(0)).alias("_q"),
    )
    full = F.col("_at") >= width
    began = F.max(F.when(~F.col("_goes_on"), F.col("_at"))).over(running)
    fourth = third.withColumns(
        {
            "_run": F.when(F.col("_level").isNotNull(), F.col("_at") - began + 1),
            **{c: F.when(full, term) for c, term in rolling(order, width).items()},
        }
    )
    return fourth.withColumns(
        {
            "_mean_shift": F.abs(F.col("_mean") - F.lag("_mean", width).over(order)),
            "_var_shift": F.abs(F.col("_var") - F.lag("_var", width).over(order)),
        }
    )


def moment_figures() -> list[Column]:
    return [
        mean("_x").alias("mw"),
        F.stddev_samp("_x").alias("sd"),
        skewness_sample_sd("_x").alias("skewness"),
        kurtosis_sample_sd("_x").alias("kurtosis"),
    ]


def crossing_figure() -> Column:
    return F.coalesce(F.sum("_flip"), F.lit(0)).alias("crossing_points")


def flat_figure() -> Column:
    return F.coalesce(F.max("_run"), F.lit(0)).cast("long").alias("flat_spots")


def acf1_figure() -> Column:
    lagged = F.try_divide(F.sum("_pair"), F.count("_pair") + F.lit(1.0))
    spread = F.try_divide(F.sum(F.col("_centred") * F.col("_centred")), F.count("_centred"))
    return F.try_divide(lagged, spread).alias("acf1")


def tile_figures(width: int = TILE) -> list[Column]:
    """The rolling figures at the end of a tile are the tile's own."""
    ends = F.col("_at") % width == 0

    def between(c: str) -> Column:
        return F.when(F.count(F.lit(1)) >= 2 * width, F.var_samp(F.when(ends, F.col(c)))).otherwise(F.lit(0.0))

    return [between("_var").alias("lumpiness"), between("_mean").alias("stability")]


def shift_figures(width: int = TILE) -> list[Column]:
    figures = []
    for c, label in (("_mean_shift", "level"), ("_var_shift", "var")):
        place = F.when(F.col(c).isNotNull(), F.struct(-F.col(c), F.col("_at")))
        first = F.min_by(F.col("_at") - width, place).cast("long")
        figures += [F.max(c).alias(f"max_{label}_shift"), first.alias(f"max_{label}_index")]
    return figures


def moments(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Mean, sample deviation, skewness and kurtosis; needs no order."""
    return df.select(*keys, F.col(value).alias("_x")).groupBy(*keys).agg(*moment_figures())


def crossing_points(df: DataFrame, keys: list[str], value: str = "value", ts: str = "timestamp") -> DataFrame:
    """How often neighbours lie on different sides of the median; pairs with a null do not count."""
    return series_terms(df, keys, value, ts).groupBy(*keys).agg(crossing_figure())


def flat_spots(df: DataFrame, keys: list[str], value: str = "value", ts: str = "timestamp", bins: int = VALUE_BINS) -> DataFrame:
    """Longest run inside one of ``bins`` equal-width value bins; a null ends a run."""
    return series_terms(df, keys, value, ts, bins=bins).groupBy(*keys).agg(flat_figure())


def acf1(df: DataFrame, keys: list[str], value: str = "value", ts: str = "timestamp") -> DataFrame:
    """Autocorrelation at lag 1 over the complete pairs."""
    return series_terms(df, keys, value, ts).groupBy(*keys).agg(acf1_figure())


def tile_variation(df: DataFrame, keys: list[str], value: str = "value", ts: str = "timestamp", width: int = TILE) -> DataFrame:
    """Lumpiness and stability: variance of the tiles' variances and of their means, over full tiles."""
    return series_terms(df, keys, value, ts, width).groupBy(*keys).agg(*tile_figures(width))


def largest_shifts(df: DataFrame, keys: list[str], value: str = "value", ts: str = "timestamp", width: int = TILE) -> DataFrame:
    """Largest change of the rolling mean and of the rolling variance between neighbouring windows.

    The index is the 1-based position of the last row of the earlier window; ties take the first.
    """
    return series_terms(df, keys, value, ts, width).groupBy(*keys).agg(*shift_figures(width))


def native_kpis(df: DataFrame, keys: list[str], value: str = "value", ts: str = "timestamp", width: int = TILE) -> DataFrame:
    """All figures of this module, one row per series, in one pass."""
    figures = [*moment_figures(), crossing_figure(), flat_figure(), acf1_figure(), *tile_figures(width), *shift_figures(width)]
    return series_terms(df, keys, value, ts, width).groupBy(*keys).agg(*figures)
