"""Ranks, summaries and quality figures: native ones of hourly series, fitted ones of half-day series."""

from __future__ import annotations

from pyspark.sql import functions as F

from airq.operators import kpi, kpi_models
from airq.operators.clean import keep_usable, scale_by_maximum, usable_sensors
from airq.operators.kpi_fit import fitted_kpis, spectral_entropies
from airq.operators.quality import describe, describe_table, first_ranked, first_seen_order, null_report, rmse
from airq.operators.scale import exact_quantiles
from airq.operators.smoothing import holt_parameters
from airq.plans.heatmap import heatmap_table
from airq.queries.base import (
    DENSE_HOURS, HALF_DAYS, HOURS, OBS, ORACLES, dense_series, half_day_series, hourly_series, observations, query, sql_stamp, stamp, table,
)

# Rows of a tile: hours of two days for the native figures, half days of five for the fitted ones.
WIDTH = 48
FIT_WIDTH = 10
FIT_LAGS = 4
KEY = ["sensor_id"]
_SERIES = f"WITH {HOURS}"
_X = "CAST(value AS DOUBLE)"
_W = "OVER (PARTITION BY sensor_id ORDER BY timestamp)"


@query(
    "usable_sensors",
    f"""WITH {OBS} SELECT sensor_id, CAST(min(CAST(timestamp AS DATE)) AS VARCHAR) AS first_day,
CAST(max(CAST(timestamp AS DATE)) AS VARCHAR) AS last_day, count(*) AS n, round(stddev_samp(CAST(value AS DOUBLE)), 6) AS sd FROM obs GROUP BY 1
HAVING max(CAST(timestamp AS DATE)) = DATE '2024-01-30' AND count(*) > 60 AND stddev_samp(CAST(value AS DOUBLE)) > 0""",
)
def _(spark, folder):
    found = usable_sensors(observations(spark, folder), "2024-01-30", 60)
    return found.withColumns(
        {"first_day": F.col("first_day").cast("string"), "last_day": F.col("last_day").cast("string"), "sd": F.round("sd", 6)}
    )


@query(
    "usable_rows",
    f"""WITH {OBS} SELECT event_id, sensor_id FROM obs WHERE sensor_id IN (SELECT sensor_id FROM obs GROUP BY 1
HAVING max(CAST(timestamp AS DATE)) = DATE '2024-01-30' AND count(*) > 60 AND stddev_samp(CAST(value AS DOUBLE)) > 0)""",
)
def _(spark, folder):
    rows = observations(spark, folder)
    return keep_usable(rows, usable_sensors(rows, "2024-01-30", 60)).select("event_id", "sensor_id")


@query(
    "rank_first_five",
    """SELECT l_orderkey, l_linenumber, k AS l_suppkey, rank FROM (SELECT *, CAST(rank() OVER (PARTITION BY k ORDER BY d NULLS FIRST) AS INT) AS rank
FROM (SELECT *, nullif(l_suppkey, 3) AS k, CASE WHEN l_orderkey % 500 <> 0 THEN l_shipdate END AS d FROM lineitem)) WHERE rank <= 5""",
)
def _(spark, folder):
    """One supplier has a null key, some lines have no date."""
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_suppkey", F.lit(3)).alias("l_suppkey"),
        F.when(F.col("l_orderkey") % 500 != 0, F.col("l_shipdate")).alias("l_shipdate"),
    )
    return first_ranked(rows, ["l_suppkey"], "l_shipdate").drop("l_shipdate")


@query(
    "scale_by_max",
    "SELECT c_custkey, CASE WHEN m <> 0 THEN v / m END AS value FROM (SELECT c_custkey, c_acctbal AS v, "
    "max(c_acctbal) OVER (PARTITION BY nullif(c_nationkey, 4)) AS m FROM customer)",
)
def _(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(4)).alias("c_nationkey"), F.col("c_acctbal").alias("value"))
    return scale_by_maximum(rows, ["c_nationkey"]).drop("c_nationkey")


@query(
    "first_seen_order",
    f"""SELECT o_custkey, {sql_stamp('first_seen')} AS first_seen, row_number() OVER (ORDER BY first_seen, o_custkey) AS position
FROM (SELECT o_custkey, min(o_orderdate) AS first_seen FROM orders GROUP BY 1)""",
)
def _(spark, folder):
    found = first_seen_order(table(spark, folder, "orders"), "o_custkey", "o_orderdate")
    return found.withColumn("first_seen", stamp("first_seen"))


@query(
    "describe_value",
    """SELECT count(v) AS n, CAST(sum(v) AS DOUBLE) / count(v) AS mean, round(stddev_samp(CAST(v AS DOUBLE)), 6) AS sd, CAST(min(v) AS DOUBLE) AS min,
CAST(max(v) AS DOUBLE) AS max, round(quantile_cont(CAST(v AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST(v AS DOUBLE), 0.5), 6) AS p50,
round(quantile_cont(CAST(v AS DOUBLE), 0.75), 6) AS p75 FROM (SELECT CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem)""",
)
def _(spark, folder):
    prices = table(spark, folder, "lineitem").select(F.col("l_extendedprice").cast("decimal(18,2)").alias("v"))
    found = describe(prices, "v")
    rounded = {c: F.round(c, 6) for c in ("sd", "p25", "p50", "p75")}
    return found.withColumns({**rounded, "min": F.col("min").cast("double"), "max": F.col("max").cast("double")})


_DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "describe_table",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(v) AS n, count(*) - count(v) AS nulls, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS sd, min(v) AS min, max(v) AS max,
round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75
FROM (SELECT CASE WHEN l_linenumber <> 3 THEN {c} END AS v FROM lineitem)"""
        for c in _DESCRIBED
    ),
)
def _(spark, folder):
    rows = table(spark, folder, "lineitem").select(*[F.when(F.col("l_linenumber") != 3, F.col(c)).alias(c) for c in _DESCRIBED])
    return _rounded(describe_table(rows, _DESCRIBED), "mean", "sd", "p25", "p50", "p75")


@query(
    "heatmap_table",
    f"""WITH {OBS}, seen AS (SELECT sensor_id, row_number() OVER (ORDER BY min(timestamp), sensor_id) AS position FROM obs GROUP BY 1),
clean AS (SELECT event_id, sensor_id, timestamp, CASE WHEN value >= 20 THEN CAST(value AS DOUBLE) - 20 END AS v FROM obs)
SELECT event_id, CASE WHEN m <> 0 THEN v / m END AS value, {sql_stamp('first')} AS minDate, position
FROM (SELECT *, max(v) OVER (PARTITION BY sensor_id) AS m, min(timestamp) OVER (PARTITION BY sensor_id) AS first FROM clean) JOIN seen USING (sensor_id)""",
)
def _(spark, folder):
    """The chain of a heatmap: negative values out, scaled by the sensor, placed by its first appearance."""
    rows = observations(spark, folder).select("event_id", "sensor_id", "timestamp", (F.col("value").cast("double") - 20).alias("value"))
    return heatmap_table(rows).select("event_id", "value", stamp("minDate").alias("minDate"), "position")


@query(
    "exact_quantiles",
    """SELECT unnest([0.1, 0.333, 0.9]) AS probability, round(unnest(quantile_cont(o_totalprice, [0.1, 0.333, 0.9])), 6) AS quantile FROM orders"""
    .replace("unnest([0.1, 0.333, 0.9])", "unnest([CAST(0.1 AS DOUBLE), CAST(0.333 AS DOUBLE), CAST(0.9 AS DOUBLE)])"),
)
def _(spark, folder):
    found = exact_quantiles(table(spark, folder, "orders"), "o_totalprice", [0.1, 0.333, 0.9])
    return found.withColumn("quantile", F.round("quantile", 6))


@query(
    "null_report",
    "SELECT bool_or(a IS NULL) AS a, bool_or(b IS NULL) AS b FROM (SELECT nullif(l_quantity, 50) AS a, l_tax AS b FROM lineitem)",
)
def _(spark, folder):
    rows = table(spark, folder, "lineitem").select(F.nullif("l_quantity", F.lit(50.0)).alias("a"), F.col("l_tax").alias("b"))
    return null_report(rows, ["a", "b"])


@query("global_rmse", "SELECT round(sqrt(avg(pow(l_quantity - l_linenumber, 2))), 6) AS rmse FROM lineitem")
def _(spark, folder):
    return rmse(table(spark, folder, "lineitem"), "l_quantity", "l_linenumber").withColumn("rmse", F.round("rmse", 6))


def _rounded(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


_MOMENTS = f"""{_SERIES}, s AS (SELECT sensor_id, {_X} AS x FROM series WHERE value IS NOT NULL),
c AS (SELECT sensor_id, x, x - avg(x) OVER (PARTITION BY sensor_id) AS d FROM s),
e AS (SELECT sensor_id, CAST(sum(value) AS DOUBLE) / count(value) AS mw FROM series GROUP BY 1),
m AS (SELECT sensor_id, stddev_samp(x) AS sd, avg(d*d*d) AS m3, avg(d*d*d*d) AS m4 FROM c GROUP BY 1)
SELECT sensor_id, mw, round(sd, 6) AS sd, round(m3 / (sd*sd*sd), 6) AS skewness, round(m4 / (sd*sd*sd*sd) - 3, 6) AS kurtosis
FROM m JOIN e USING (sensor_id)"""


@query("kpi_moments", _MOMENTS)
def _(spark, folder):
    return _rounded(kpi.moments(hourly_series(spark, folder), KEY), "sd", "skewness", "kurtosis")


@query(
    "kpi_crossing_points",
    f"""{_SERIES}, m AS (SELECT sensor_id, quantile_cont({_X}, 0.5) AS med FROM series GROUP BY 1),
b AS (SELECT sensor_id, timestamp, {_X} <= med AS below FROM series JOIN m USING (sensor_id)),
f AS (SELECT sensor_id, below <> lag(below) {_W} AS flip FROM b)
SELECT sensor_id, CAST(coalesce(sum(CAST(flip AS INT)), 0) AS BIGINT) AS crossing_points FROM f GROUP BY 1""",
)
def _(spark, folder):
    return kpi.crossing_points(hourly_series(spark, folder), KEY)


@query(
    "kpi_flat_spots",
    f"""{_SERIES}, r AS (SELECT sensor_id, min({_X}) AS lo, max({_X}) AS hi FROM series GROUP BY 1),
b AS (SELECT sensor_id, timestamp, CASE WHEN value IS NOT NULL THEN greatest(1, CAST(ceil(({_X} - lo) / ((hi - lo) / 10)) AS INT)) END AS bin
FROM series JOIN r USING (sensor_id)),
s AS (SELECT *, CASE WHEN coalesce(bin = lag(bin) {_W}, false) THEN 0 ELSE 1 END AS st FROM b),
g AS (SELECT *, sum(st) {_W} AS run FROM s), n AS (SELECT sensor_id, run, count(bin) AS n FROM g GROUP BY 1, 2)
SELECT sensor_id, max(n) AS flat_spots FROM n GROUP BY 1""",
)
def _(spark, folder):
    return kpi.flat_spots(hourly_series(spark, folder), KEY)


@query(
    "kpi_acf1",
    f"""{_SERIES}, c AS (SELECT sensor_id, timestamp, {_X} - avg({_X}) OVER (PARTITION BY sensor_id) AS d FROM series),
p AS (SELECT sensor_id, d, d * lag(d) {_W} AS q FROM c)
SELECT sensor_id, round((sum(q) / (count(q) + 1)) / (sum(d*d) / count(d)), 8) AS acf1 FROM p GROUP BY 1""",
)
def _(spark, folder):
    return _rounded(kpi.acf1(hourly_series(spark, folder), KEY), "acf1", places=8)


@query(
    "kpi_lumpiness_stability",
    f"""{_SERIES}, t AS (SELECT sensor_id, {_X} AS x, (row_number() {_W} - 1) // {WIDTH} AS tile FROM series),
a AS (SELECT sensor_id, tile, count(*) AS n, var_samp(x) AS v, avg(x) AS m FROM t GROUP BY 1, 2)
SELECT sensor_id, round(CASE WHEN sum(n) < {2 * WIDTH} THEN 0 ELSE var_samp(v) FILTER (n = {WIDTH}) END, 4) AS lumpiness,
round(CASE WHEN sum(n) < {2 * WIDTH} THEN 0 ELSE var_samp(m) FILTER (n = {WIDTH}) END, 6) AS stability FROM a GROUP BY 1""",
)
def _(spark, folder):
    found = kpi.tile_variation(hourly_series(spark, folder), KEY, width=WIDTH)
    return found.withColumns({"lumpiness": F.round("lumpiness", 4), "stability": F.round("stability", 6)})


_SHIFT = f"""{_SERIES}, r AS (SELECT sensor_id, row_number() {_W} AS pos, timestamp, CAST(sum(value) OVER w AS DOUBLE) / nullif(count(value) OVER w, 0) AS m, var_samp({_X}) OVER w AS v,
count(*) OVER w AS n FROM series WINDOW w AS (PARTITION BY sensor_id ORDER BY timestamp ROWS BETWEEN {WIDTH - 1} PRECEDING AND CURRENT ROW)),
f AS (SELECT sensor_id, pos, CASE WHEN n = {WIDTH} THEN m END AS m, CASE WHEN n = {WIDTH} THEN v END AS v FROM r),
d AS (SELECT sensor_id, pos - {WIDTH} AS i, abs(m - lag(m, {WIDTH}) OVER o) AS dm, abs(v - lag(v, {WIDTH}) OVER o) AS dv FROM f
WINDOW o AS (PARTITION BY sensor_id ORDER BY pos))
SELECT sensor_id, max(dm) AS max_level_shift, arg_min(i, (-dm, i)) FILTER (dm IS NOT NULL) AS max_level_index,
round(max(dv), 2) AS max_var_shift, arg_min(i, (-round(dv, 7), i)) FILTER (dv IS NOT NULL) AS max_var_index FROM d GROUP BY 1"""


@query("kpi_level_var_shift", _SHIFT)
def _(spark, folder):
    found = kpi.largest_shifts(hourly_series(spark, folder), KEY, width=WIDTH)
    return _rounded(found, "max_var_shift", places=2)


_FIGURES = ["kpi_moments", "kpi_crossing_points", "kpi_flat_spots", "kpi_acf1", "kpi_lumpiness_stability", "kpi_level_var_shift"]


@query(
    "kpi_native_all",
    "SELECT * FROM " + " JOIN ".join(f"({ORACLES[n]}) AS {n}" + (" USING (sensor_id)" if i else "") for i, n in enumerate(_FIGURES)),
)
def _(spark, folder):
    found = kpi.native_kpis(hourly_series(spark, folder), KEY, width=WIDTH)
    found = _rounded(found, "sd", "skewness", "kurtosis", "stability")
    return _rounded(_rounded(_rounded(found, "acf1", places=8), "lumpiness", places=4), "max_var_shift", places=2)


_P = "OVER (PARTITION BY sensor_id)"
_FIT = f"""WITH RECURSIVE {HALF_DAYS}, v AS (SELECT sensor_id, timestamp, CAST(value AS DOUBLE) AS x FROM series),
every AS (SELECT DISTINCT sensor_id FROM v)"""


def _arch_sql(lags: int) -> str:
    """The lags made orthogonal one after another, as in the operator."""
    names = [f"c{k}" for k in range(lags + 1)]
    steps = [
        f"squares AS (SELECT sensor_id, timestamp, pow(x - avg(x) {_P}, 2) AS c0 FROM v)",
        "lagged AS (SELECT sensor_id, c0, "
        + ", ".join(f"lag(c0, {k}) OVER (PARTITION BY sensor_id ORDER BY timestamp) AS c{k}" for k in range(1, lags + 1))
        + " FROM squares)",
        f"g0 AS (SELECT sensor_id, c0 - avg(c0) {_P} AS y, {', '.join(f'{c} - avg({c}) {_P} AS {c}' for c in names)} FROM lagged "
        f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in names)})",
    ]
    for k in range(1, lags + 1):
        left = ["c0", *names[k + 1 :]]
        cells = ", ".join(f"{c} - coalesce(sum({c} * c{k}) {_P} / nullif(sum(c{k} * c{k}) {_P}, 0), 0) * c{k} AS {c}" for c in left)
        steps.append(f"g{k} AS (SELECT sensor_id, y, {cells} FROM g{k - 1})")
    return (
        f"{_FIT}, {', '.join(steps)}, r AS (SELECT sensor_id, CASE WHEN count(*) > {lags + 1} THEN 1 - sum(c0 * c0) / nullif(sum(y * y), 0) END AS a "
        f"FROM g{lags} GROUP BY 1) SELECT sensor_id, round(a, 6) AS arch_stat FROM every LEFT JOIN r USING (sensor_id)"
    )


@query("kpi_arch", _arch_sql(FIT_LAGS))
def _(spark, folder):
    return _rounded(kpi_models.arch_statistic(half_day_series(spark, folder), KEY, lags=FIT_LAGS), "arch_stat")


@query(
    "kpi_holt",
    f"""{_FIT}, r AS (SELECT *, sum(CASE WHEN x IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY sensor_id ORDER BY timestamp) AS run FROM v),
c AS (SELECT sensor_id, run, count(*) AS n FROM r WHERE x IS NOT NULL GROUP BY 1, 2),
b AS (SELECT sensor_id, arg_max(run, (n, -run)) AS run FROM c GROUP BY 1),
p AS (SELECT sensor_id, x, row_number() OVER (PARTITION BY sensor_id ORDER BY timestamp) AS pos FROM r JOIN b USING (sensor_id, run) WHERE x IS NOT NULL),
ok AS (SELECT sensor_id, max(pos) AS last, max(x) FILTER (pos = 1) AS x1, max(x) FILTER (pos = 2) AS x2 FROM p GROUP BY 1 HAVING count(*) >= 4 AND min(x) < max(x)),
pairs AS (SELECT i / CAST(20 AS DOUBLE) AS a, j / CAST(20 AS DOUBLE) AS b FROM range(1, 20) t(i), range(1, 20) u(j) WHERE j <= i),
fold AS (SELECT sensor_id, CAST(1 AS BIGINT) AS pos, a, b, x1 AS level, x2 - x1 AS trend, CAST(0 AS DOUBLE) AS sse FROM ok, pairs
  UNION ALL SELECT sensor_id, pos, a, b, level + trend + a * e, trend + b * e, sse + e * e
  FROM (SELECT f.sensor_id, p.pos, a, b, level, trend, sse, p.x - level - trend AS e FROM fold f JOIN p ON p.sensor_id = f.sensor_id AND p.pos = f.pos + 1)),
best AS (SELECT f.sensor_id, arg_min(a, (sse, a, b)) AS holt_alpha, arg_min(b, (sse, a, b)) AS holt_beta
  FROM fold f JOIN ok ON ok.sensor_id = f.sensor_id AND f.pos = ok.last GROUP BY 1)
SELECT sensor_id, holt_alpha, holt_beta FROM every LEFT JOIN best USING (sensor_id)""",
)
def _(spark, folder):
    return holt_parameters(half_day_series(spark, folder), KEY)


@query(
    "kpi_kl_shift",
    f"""{_FIT}, n AS (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY timestamp) AS pos FROM v),
f AS (SELECT sensor_id, min(x) AS lo, max(x) AS hi, count(x) AS known, count(*) AS n, stddev_samp(x) AS sd,
  (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / CAST(1.34 AS DOUBLE) AS iqr FROM n GROUP BY 1),
h AS (SELECT sensor_id, lo, (hi - lo) / 99 AS gap, CAST(0.9 AS DOUBLE) * CASE WHEN least(sd, iqr) > 0 THEN least(sd, iqr) ELSE sd END
  * pow(CAST(known AS DOUBLE), -0.2) AS h FROM f WHERE n > {2 * FIT_WIDTH} AND known >= 2 AND hi > lo),
d AS (SELECT sensor_id, pos, g, gap, CASE WHEN x IS NOT NULL THEN greatest(exp(-0.5 * pow((lo + g * gap - x) / h, 2)) / (h * sqrt(2 * pi())), {kpi_models.FLOOR!r}) END AS d
  FROM n JOIN h USING (sensor_id), range(100) t(g)),
m AS (SELECT *, CASE WHEN pos >= {FIT_WIDTH} THEN avg(d) OVER (PARTITION BY sensor_id, g ORDER BY pos ROWS {FIT_WIDTH - 1} PRECEDING) END AS m FROM d),
t AS (SELECT sensor_id, pos, m * (ln(m) - ln(lead(m, {FIT_WIDTH - 1}) OVER (PARTITION BY sensor_id, g ORDER BY pos))) * gap AS t FROM m),
k AS (SELECT sensor_id, pos, CASE WHEN count(t) = 100 THEN sum(t) END AS k FROM t GROUP BY 1, 2),
s AS (SELECT sensor_id, pos, k - lag(k) OVER (PARTITION BY sensor_id ORDER BY pos) AS s FROM k),
r AS (SELECT sensor_id, max(s) AS s, CAST(arg_min(pos, (-round(s, 9), pos)) FILTER (s IS NOT NULL) AS DOUBLE) AS pos FROM s GROUP BY 1)
SELECT sensor_id, round(s, 6) AS max_kl_shift, pos AS max_kl_index FROM every LEFT JOIN r USING (sensor_id)""",
)
def _(spark, folder):
    return _rounded(kpi_models.kl_shift(half_day_series(spark, folder), KEY, width=FIT_WIDTH), "max_kl_shift")


# The same figures with the scripts' settings, on series that are long and dense enough for them.
@query("kpi_arch_hourly", _arch_sql(kpi_models.ARCH_LAGS).replace(HALF_DAYS, DENSE_HOURS))
def _(spark, folder):
    return _rounded(kpi_models.arch_statistic(dense_series(spark, folder), KEY), "arch_stat")


def _kl_sql(width: int) -> str:
    sql = ORACLES["kpi_kl_shift"].replace(f"n > {2 * FIT_WIDTH}", f"n > {2 * width}").replace(f"pos >= {FIT_WIDTH}", f"pos >= {width}")
    return sql.replace(f"ROWS {FIT_WIDTH - 1} PRECEDING", f"ROWS {width - 1} PRECEDING").replace(f"lead(m, {FIT_WIDTH - 1})", f"lead(m, {width - 1})")


@query("kpi_kl_hourly", _kl_sql(WIDTH).replace(HALF_DAYS, DENSE_HOURS))
def _(spark, folder):
    return _rounded(kpi_models.kl_shift(dense_series(spark, folder), KEY, width=WIDTH), "max_kl_shift")


@query("kpi_holt_hourly", ORACLES["kpi_holt"].replace(HALF_DAYS, DENSE_HOURS))
def _(spark, folder):
    return holt_parameters(dense_series(spark, folder), KEY)


@query("kpi_entropy")
def _(spark, folder):
    return spectral_entropies(half_day_series(spark, folder), KEY)


@query("kpi_fitted_all")
def _(spark, folder):
    return fitted_kpis(half_day_series(spark, folder), KEY, width=FIT_WIDTH, lags=FIT_LAGS)
