"""Quality figures that fit a small model to each regular series, in native expressions.

Input as for ``kpi``: one row per key and bin. The estimators are declared substitutes for those of statistics
packages: least squares for the ARCH regression and a Gaussian kernel with the usual rule-of-thumb width for the
divergence. ``smoothing`` has the parameters of the trend smoother.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE = 48
ARCH_LAGS = 24
GRID_POINTS = 100
# Least density of a kernel, 38 widths away from its centre.
FLOOR = math.exp(-0.5 * 38.0**2) / math.sqrt(2 * math.pi)


# A pivot below this share of its own sum of squares says that its lag is a mixture of those before it.
DEPENDENT = 1e-10


def arch_statistic(df: DataFrame, keys: list[str], value: str = "value", ts: str = "timestamp", lags: int = ARCH_LAGS) -> DataFrame:
    """R squared of the demeaned squares regressed on their own lags, over the rows where all lags are known.

    One aggregate sums the products of all pairs of lags; eliminating the lags from that matrix one after another leaves
    the residual's square in the target's cell. A lag that is a mixture of those before it is left out. Null with too
    few rows.
    """
    order = Window.partitionBy(*keys).orderBy(ts)
    whole = Window.partitionBy(*keys)
    rows = df.select(*keys, ts, F.col(value).cast("double").alias("_x"))
    rows = rows.withColumn("_square", F.pow(F.col("_x") - F.avg("_x").over(whole), F.lit(2.0)))
    rows = rows.withColumn("_0", F.col("_square") - F.avg("_square").over(whole))  # a shift that the regression does not see
    rows = rows.withColumns({f"_{k}": F.lag("_0", k).over(order) for k in range(1, lags + 1)})
    size = lags + 1
    names = [f"_{k}" for k in range(size)]
    listed = lambda cells: F.expr(f"array({', '.join(cells)})")
    sums = rows.dropna(subset=names).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        listed(f"sum({c})" for c in names).alias("_s"),
        listed(f"sum({names[i]} * {names[j]})" for i in range(size) for j in range(i, size)).alias("_p"),
    )

    def cell(at: Column) -> Column:
        """Covariance times the number of rows; ``_p`` holds the upper triangle row by row."""
        i, j = F.floor(at / F.lit(size)).cast("int"), at % F.lit(size)
        low, high = F.least(i, j), F.greatest(i, j)
        place = (low * F.lit(2 * size - 1) - low * low) / F.lit(2) + high
        return F.get("_p", place.cast("int")) - F.get("_s", i) * F.get("_s", j) / F.col("_n")

    matrix = sums.select(*keys, "_n", F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), cell).alias("_m"))

    def eliminate(m: Column, k: Column) -> Column:
        pivot = F.get(m, k * size + k)
        enough = pivot > F.get(F.col("_m"), k * size + k) * F.lit(DEPENDENT)

        def rest(v: Column, at: Column) -> Column:
            row, column = F.floor(at / F.lit(size)).cast("int"), at % F.lit(size)
            return v - F.get(m, row * size + k) * F.get(m, k * size + column) / pivot

        return F.when(enough, F.transform(m, rest)).otherwise(m)

    left = F.aggregate(F.sequence(F.lit(1), F.lit(lags)), F.col("_m"), eliminate)
    r2 = F.lit(1.0) - F.try_divide(F.get(left, F.lit(0)), F.get(F.col("_m"), F.lit(0)))
    fitted = matrix.select(*keys, F.when(F.col("_n") > lags + 1, r2).alias("arch_stat"))
    return with_all_keys(df, keys, fitted, ["arch_stat"])


def with_all_keys(df: DataFrame, keys: list[str], found: DataFrame, figures: list[str]) -> DataFrame:
    """One row for every key of ``df``, with null figures where nothing was found."""
    empty = df.select(*keys).distinct().withColumns({f: F.lit(None).cast(found.schema[f].dataType) for f in figures})
    return found.unionByName(empty).groupBy(*keys).agg(*[F.max(f).alias(f) for f in figures])


def _quoted(columns: list[str]) -> list[str]:
    return [f"`{c.replace('`', '``')}`" for c in columns]


def kl_shift(df: DataFrame, keys: list[str], value: str = "value", ts: str = "timestamp", width: int = TILE) -> DataFrame:
    """Largest increase of the divergence between neighbouring windows, and its 1-based position.

    The window ending at row t is compared with the one ending ``width - 1`` rows later; the position is the t
    of the later of the two compared divergences. Densities are kernels on a grid of 100 points over the range
    of the series. A row carries them as one array, so only values are shuffled. A window's sum is the rest of the tile of
    ``width`` rows that it starts in and the beginning of the one it ends in: two running sums of each density and
    no difference, which would lose the small densities, whose logarithms count.
    """
    whole = Window.partitionBy(*keys)
    order = whole.orderBy(ts)
    x = F.col("_x")
    rows = df.select(*keys, ts, F.col(value).cast("double").alias("_x")).withColumn("_at", F.row_number().over(order))
    quartile = lambda p: F.percentile(x, F.lit(p)).over(whole)
    rows = rows.withColumns(
        {
            "_low": F.min(x).over(whole), "_high": F.max(x).over(whole), "_known": F.count(x).over(whole), "_all": F.count(F.lit(1)).over(whole),
            "_sd": F.stddev_samp(x).over(whole), "_iqr": quartile(0.75) - quartile(0.25),
        }
    )
    rows = rows.where((F.col("_all") > 2 * width) & (F.col("_known") >= 2) & (F.col("_high") > F.col("_low")))
    narrow = F.least(F.col("_sd"), F.col("_iqr") / F.lit(1.34))
    scale = F.when(narrow > 0, narrow).otherwise(F.col("_sd"))
    rows = rows.withColumn("_h", F.lit(0.9) * scale * F.pow(F.col("_known").cast("double"), F.lit(-0.2)))
    gap = (F.col("_high") - F.col("_low")) / F.lit(float(GRID_POINTS - 1))
    z = [f"((_low + {g} * _gap - _x) / _h)" for g in range(GRID_POINTS)]
    density = [f"greatest(exp(-0.5D * {v} * {v}) / (_h * {math.sqrt(2 * math.pi)!r}D), {FLOOR!r}D)" for v in z]
    names = _quoted(keys)
    by, base = ", ".join(names), [*names, "_at", "_tile", "_x", "_h", "_low", "_gap"]
    rows = rows.withColumns({"_gap": gap, "_tile": F.floor((F.col("_at") - 1) / F.lit(width))}).selectExpr(*base)

    def in_tile(df: DataFrame, out: str, direction: str, *others: str) -> DataFrame:
        frame = f"OVER (PARTITION BY {by}, _tile ORDER BY _at {direction} ROWS UNBOUNDED PRECEDING)"
        sums = [f"coalesce(sum(CASE WHEN _x IS NOT NULL THEN {d} END) {frame}, 0D) AS _c{g}" for g, d in enumerate(density)]
        packed = f"array({', '.join(f'_c{g}' for g in range(GRID_POINTS))}) AS {out}"
        return df.selectExpr(*base, *others, *sums).selectExpr(*base, *others, packed)

    own = Window.partitionBy(*keys).orderBy("_at")
    summed = in_tile(in_tile(rows, "_rest", "DESC"), "_begun", "ASC", "_rest").withColumns(
        {"_before": F.lag("_rest", width - 1).over(own), "_seen": F.count("_x").over(own.rowsBetween(-(width - 1), 0))}
    )
    both = F.when(F.col("_at") % width == 0, F.col("_begun")).otherwise(F.zip_with("_begun", "_before", lambda p, q: p + q))
    means = summed.select(*keys, "_at", "_gap", F.when(F.col("_seen") > 0, both).alias("_sum"), "_seen")
    means = means.where(F.col("_at") >= width).select(*keys, "_at", "_gap", F.transform("_sum", lambda v: v / F.col("_seen")).alias("_m"))
    pairs = means.withColumn("_later", F.lead("_m", width - 1).over(own))
    terms = F.zip_with("_m", "_later", lambda m, later: m * (F.log(m) - F.log(later)))
    total = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t) * F.col("_gap")
    divergence = pairs.select(*keys, "_at", total.alias("_k"))
    steps = divergence.withColumn("_step", F.col("_k") - F.lag("_k").over(own))
    # equal steps up to rounding take the first
    place = F.when(F.col("_step").isNotNull(), F.struct(-F.round("_step", 9), F.col("_at")))
    found = steps.groupBy(*keys).agg(F.max("_step").alias("max_kl_shift"), F.min_by("_at", place).cast("double").alias("max_kl_index"))
    return with_all_keys(df, keys, found, ["max_kl_shift", "max_kl_index"])
