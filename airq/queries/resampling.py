"""Time bins, gap filling and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from airq import schemas
from airq.functions.calendar import add_calendar
from airq.functions.geo import add_geohash
from airq.functions.stats import mean
from airq.operators.resample import bin_means, gap_fill, geo_time_aggregate, hour_profile, pivot_mean, time_grid, unpivot_measures
from airq.operators.stations import join_weather
from airq.plans.sensor_kpis import coverage
from airq.queries.base import (
    FAMILY_UNION,
    HALF_DAY,
    OBS,
    PLACED,
    VARIABLES,
    families,
    observations,
    placed,
    query,
    sql_bin,
    sql_mean,
    sql_stamp,
    sql_weather,
    stamp,
    table,
    weather_of,
)
from airq.queries.values import _EASTER_STEPS, _GEOHASH
from airq.sources.sensors import unify

DAY = 86400

_DAILY = (
    f"{OBS}, daily AS (SELECT sensor_id, {sql_bin('timestamp', DAY)} AS timestamp, {sql_mean('value')} AS value FROM obs GROUP BY 1, 2), "
    "spans AS (SELECT sensor_id, min(timestamp) AS a, max(timestamp) AS b FROM daily GROUP BY 1), "
    "grid AS (SELECT sensor_id, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS timestamp FROM spans), "
    "complete AS (SELECT g.sensor_id, g.timestamp, d.value FROM grid g LEFT JOIN daily d "
    "ON g.sensor_id = d.sensor_id AND g.timestamp = d.timestamp)"
)


@query(
    "sensor_coverage",
    f"WITH {_DAILY} SELECT sensor_id, {sql_stamp('min(timestamp)')} AS first, {sql_stamp('max(timestamp)')} AS last, "
    "count(*) AS bins, CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS filled, "
    "round(avg(value), 8) AS mean FROM complete GROUP BY 1",
)
def coverage_query(spark, folder):
    found = coverage(observations(spark, folder), step=DAY)
    return found.withColumns({"first": stamp("first"), "last": stamp("last"), "mean": F.round("mean", 8)})


@query(
    "hourly_mean",
    f"WITH {OBS} SELECT sensor_id, {sql_stamp("date_trunc('hour', timestamp)")} AS timestamp, {sql_mean('value')} AS value "
    "FROM obs GROUP BY 1, 2",
)
def _(spark, folder):
    return bin_means(observations(spark, folder), ["sensor_id"], ["value"]).withColumn("timestamp", stamp("timestamp"))


@query("hour_profile", f"WITH {PLACED} SELECT CAST(hour(timestamp) AS INT) AS hour, sensor_id, lat, lon, {sql_mean('value')} AS value FROM placed GROUP BY ALL")
def _(spark, folder):
    return hour_profile(placed(spark, folder), ["sensor_id", "lat", "lon"], ["value"])


@query(
    "gap_fill",
    f"WITH {_DAILY} SELECT sensor_id, {sql_stamp('timestamp')} AS timestamp, value FROM complete",
)
def _(spark, folder):
    daily = bin_means(observations(spark, folder), ["sensor_id"], ["value"], DAY)
    return gap_fill(daily, ["sensor_id"], DAY).withColumn("timestamp", stamp("timestamp"))


@query(
    "time_grid",
    f"WITH spans AS (SELECT o_custkey, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY 1) "
    f"SELECT o_custkey, {sql_stamp('unnest(generate_series(a, b, INTERVAL 7 DAY))')} AS timestamp FROM spans",
)
def _(spark, folder):
    spans = table(spark, folder, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return time_grid(spans, 7 * DAY).withColumn("timestamp", stamp("timestamp"))


@query(
    "gap_fill_by_variable",
    f"""WITH {OBS}, means AS (SELECT sensor_id, variable, {sql_bin('timestamp', HALF_DAY)} AS timestamp, {sql_mean('value')} AS value
FROM obs GROUP BY 1, 2, 3), spans AS (SELECT sensor_id, variable, min(timestamp) AS a, max(timestamp) AS b FROM means GROUP BY 1, 2),
grid AS (SELECT sensor_id, variable, unnest(generate_series(a, b, INTERVAL 12 HOUR)) AS timestamp FROM spans)
SELECT g.sensor_id, g.variable, {sql_stamp('g.timestamp')} AS timestamp, m.value FROM grid g LEFT JOIN means m
ON g.sensor_id = m.sensor_id AND g.variable = m.variable AND g.timestamp = m.timestamp""",
)
def _(spark, folder):
    means = bin_means(observations(spark, folder), ["sensor_id", "variable"], ["value"], HALF_DAY)
    return gap_fill(means, ["sensor_id", "variable"], HALF_DAY).withColumn("timestamp", stamp("timestamp"))


@query(
    "unpivot_long",
    "SELECT l_orderkey, l_linenumber, unnest(['l_quantity', 'l_discount', 'l_tax']) AS variable, "
    "unnest([CASE WHEN l_quantity < 50 THEN l_quantity END, l_discount, l_tax]) AS value FROM lineitem",
)
def _(spark, folder):
    rows = table(spark, folder, "lineitem").withColumn("l_quantity", F.when(F.col("l_quantity") < 50, F.col("l_quantity")))
    return unpivot_measures(rows, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


def _pivot_cells() -> str:
    return ", ".join(f"{sql_mean(f"CASE WHEN variable = '{v}' THEN value END")} AS {v}" for v in VARIABLES)


@query(
    "pivot_mean",
    f"WITH {OBS} SELECT sensor_id, {sql_stamp("date_trunc('day', timestamp)")} AS timestamp, {_pivot_cells()} FROM obs GROUP BY 1, 2",
)
def _(spark, folder):
    rows = observations(spark, folder).withColumn("timestamp", F.date_trunc("day", "timestamp"))
    return pivot_mean(rows, ["sensor_id", "timestamp"], VARIABLES).withColumn("timestamp", stamp("timestamp"))


def augmented(spark, folder):
    """Unified observations with calendar, geohash and the hourly weather of five products."""
    rows = add_geohash(add_calendar(unify(list(families(spark, folder).values()))))
    rows = rows.withColumn("closest", (F.col("sensor_id") % 20).cast("long"))
    names = {"view": "TT_TU", "click": "F", "purchase": "D", "signup": "R1", "error": "SD_SO"}
    # the products share stations and hours, so they are one table and one join
    hours = observations(spark, folder).groupBy(
        (F.col("sensor_id") % 20).alias("STATIONS_ID"), F.date_trunc("hour", "timestamp").alias("timestamp")
    )
    products = hours.agg(*[mean(F.when(F.col("variable") == event, F.col("value"))).alias(column) for event, column in names.items()])
    rows = join_weather(rows, products, "closest", list(names.values()))
    dwd = [F.col(c) if c in rows.columns else F.lit(None).cast("double").alias(c) for c in schemas.WEATHER_FIELDS]
    return rows.withColumn("dwddim", F.struct(*dwd))


def _geo_time_sql() -> str:
    products = {"view": "TT_TU", "click": "F", "purchase": "D", "signup": "R1", "error": "SD_SO"}
    tables = ", ".join(sql_weather(f"w_{c}", e, c) for e, c in products.items())
    joins = " ".join(
        f"LEFT JOIN w_{c} ON w_{c}.STATIONS_ID = u.sensor_id % 20 AND w_{c}.timestamp = date_trunc('hour', u.timestamp)"
        for c in products.values()
    )
    cells = []
    for name, source, kind in schemas.GEO_TIME_MEASURES:
        field = source.split(".")[-1]
        if kind == "max":
            cells.append("CAST(NULL AS DOUBLE) AS dwd_precipitation_indicator" if field == "RS_IND" else f"max({field}) AS {name}")
        elif field in ("V_N",):
            cells.append(f"CAST(NULL AS DOUBLE) AS {name}")
        else:
            cells.append(f"round(avg({field}), 8) AS {name}")
    return f"""WITH {FAMILY_UNION}, {_GEOHASH}, {tables},
days AS (SELECT DISTINCT CAST(timestamp AS DATE) AS d FROM unified), {_EASTER_STEPS},
wide AS (SELECT u.*, hash, CAST(year(u.timestamp) AS INT) AS year, CAST(month(u.timestamp) AS INT) AS month,
  CAST(day(u.timestamp) AS INT) AS day, CAST((hour(u.timestamp) * 60 + minute(u.timestamp)) // 15 AS INT) AS time_bin,
  CAST(isodow(u.timestamp) >= 6 AS INT) AS weekend, holiday, CAST(isodow(u.timestamp) - 1 AS INT) AS day_of_week,
  (hour(u.timestamp) * 60 + ((hour(u.timestamp) * 60 + minute(u.timestamp)) // 15 * 15) % 60 + CAST(7.5 AS DOUBLE)) / 1440 AS time_num,
  {', '.join(f'w_{c}.{c}' for c in products.values())}
  FROM unified u JOIN hashes USING (lat, lon) JOIN holiday ON d = CAST(u.timestamp AS DATE) {joins}),
keyed AS (SELECT *, (day_of_week + time_num) / 7 AS day_num FROM wide WHERE sensor_type <> 'PPD42NS')
SELECT hash, year, month, day, time_bin, {', '.join(cells)} FROM keyed GROUP BY 1, 2, 3, 4, 5"""


@query("geo_time_aggregate", _geo_time_sql())
def _(spark, folder):
    found = geo_time_aggregate(augmented(spark, folder))
    return found.withColumns({n: F.round(n, 8) for n, _, kind in schemas.GEO_TIME_MEASURES if kind == "mean"})


@query(
    "quarter_hour_mean",
    f"WITH {OBS} SELECT variable, {sql_stamp(sql_bin('timestamp', 900))} AS timestamp, {sql_mean('value')} AS value FROM obs GROUP BY 1, 2",
)
def _(spark, folder):
    return bin_means(observations(spark, folder), ["variable"], ["value"], 900).withColumn("timestamp", stamp("timestamp"))


@query("group_means", f"SELECT l_returnflag, {sql_mean('CAST(l_quantity AS DECIMAL(18,2))')} AS l_quantity FROM lineitem GROUP BY 1")
def _(spark, folder):
    rows = table(spark, folder, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("decimal(18,2)"))
    return rows.groupBy("l_returnflag").agg(mean("l_quantity").alias("l_quantity"))
