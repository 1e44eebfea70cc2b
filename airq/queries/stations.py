"""Stations, capabilities and weather joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from airq import schemas
from airq.functions.stats import mean
from airq.operators.clean import with_group_minimum
from airq.operators.quality import best_and_worst, error_curves, squared_error
from airq.operators.scale import lookup_join, split_join
from airq.operators.stations import (
    active_stations,
    capability_flags,
    combine_products,
    deviation_from_station,
    join_weather,
    location_wide,
    readings_of,
    weather_long,
)
from airq.queries.base import (
    OBS, STATIONS, VARIABLES, five_products, observations, query, sql_five, sql_mean, sql_stamp, sql_weather, stamp, stations, table, weather,
)


@query(
    "weather_join_5key",
    f"""WITH {OBS}, {sql_weather()} SELECT event_id, sensor_id % 20 AS closestTemp, CAST(o.value AS DOUBLE) AS value, w.TT_TU
FROM obs o LEFT JOIN weather w ON w.STATIONS_ID = o.sensor_id % 20 AND year(o.timestamp) = year(w.timestamp)
AND month(o.timestamp) = month(w.timestamp) AND day(o.timestamp) = day(w.timestamp) AND hour(o.timestamp) = hour(w.timestamp)""",
)
def _(spark, folder):
    rows = observations(spark, folder).withColumn("closestTemp", F.col("sensor_id") % 20)
    joined = join_weather(rows, weather(spark, folder), "closestTemp", ["TT_TU"])
    return joined.select("event_id", "closestTemp", F.col("value").cast("double").alias("value"), "TT_TU")


@query("inner_dim_join", "SELECT l_orderkey, l_linenumber, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 0")
def _(spark, folder):
    dim = table(spark, folder, "supplier").where(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    joined = lookup_join(table(spark, folder, "lineitem"), dim, ["l_suppkey"], "inner")
    return joined.select("l_orderkey", "l_linenumber", "s_name")


@query(
    "left_join_one_key",
    "SELECT o_orderkey, c_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey",
)
def _(spark, folder):
    dim = table(spark, folder, "customer").where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return lookup_join(table(spark, folder, "orders"), dim, ["o_custkey"]).select("o_orderkey", "c_name")


@query(
    "left_join_two_keys",
    f"""WITH {OBS}, {sql_weather('w', 'click', 'F', 'day')} SELECT event_id, w.F FROM obs o
LEFT JOIN w ON w.STATIONS_ID = o.sensor_id % 20 AND w.timestamp = date_trunc('day', o.timestamp)""",
)
def _(spark, folder):
    right = weather(spark, folder, "click", "F", "day").withColumnsRenamed({"STATIONS_ID": "dwd_id", "timestamp": "day"})
    rows = observations(spark, folder).withColumns({"dwd_id": F.col("sensor_id") % 20, "day": F.date_trunc("day", "timestamp")})
    return lookup_join(rows, right, ["dwd_id", "day"]).select("event_id", "F")


_SKEWED = f"""WITH {OBS}, dim AS (SELECT DISTINCT sensor_id, sensor_id * 2 AS twice FROM obs WHERE variable = 'view')
SELECT event_id, twice FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 4 WHEN event_id % 3 = 1 THEN sensor_id END AS k FROM obs)
LEFT JOIN dim ON k = sensor_id"""


@query("skewed_lookup", _SKEWED)
def _(spark, folder):
    """A third of the rows on one key and a third without any: hot keys leave the shuffle."""
    rows = observations(spark, folder)
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(4).cast("long")).when(F.col("event_id") % 3 == 1, F.col("sensor_id"))
    dim = rows.where(F.col("variable") == "view").select("sensor_id", (F.col("sensor_id") * 2).alias("twice")).distinct()
    fact = rows.select("event_id", hot.alias("sensor_id"))
    return split_join(fact, dim, ["sensor_id"], heavy_rows=200).select("event_id", "twice")


_FLAG_SQL = ", ".join(
    f"CAST(coalesce(max(CASE WHEN p = '{p}' THEN 1 END), 0) AS INT) AS {flag}" for p, (flag, _) in schemas.CAPABILITIES.items()
)
_PRODUCT_OF = {"click": "wind", "view": "temperature", "error": "sun", "signup": "cloud", "purchase": "precipitation"}
_PRODUCT_CASE = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{p}'" for e, p in _PRODUCT_OF.items()) + " END"


@query(
    "capability_flags",
    f"""WITH offers AS (SELECT DISTINCT user_id % 200 AS s, {_PRODUCT_CASE} AS p FROM events WHERE value > 100)
SELECT s_suppkey AS STATIONS_ID, {_FLAG_SQL} FROM supplier LEFT JOIN offers ON s = s_suppkey GROUP BY 1""",
)
def _(spark, folder):
    product = F.lit(None).cast("string")
    for event, name in _PRODUCT_OF.items():
        product = F.when(F.col("variable") == event, F.lit(name)).otherwise(product)
    offers = (
        observations(spark, folder)
        .where(F.col("value") > 100)
        .select((F.col("sensor_id") % 200).alias("STATIONS_ID"), product.alias("product"))
    )
    dim = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("STATIONS_ID"))
    return capability_flags(dim, offers)


@query(
    "active_stations",
    f"""WITH {OBS}, {STATIONS}, seen AS (SELECT sensor_id, max(timestamp) AS last FROM obs WHERE variable = 'view' GROUP BY 1)
SELECT STATIONS_ID, geoBreite, geoLaenge, Stationshoehe, trim(Stationsname) AS Stationsname FROM stations JOIN seen
ON sensor_id = STATIONS_ID WHERE last >= TIMESTAMP '2024-01-30 00:00:00'""",
)
def _(spark, folder):
    readings = observations(spark, folder).where(F.col("variable") == "view").withColumnRenamed("sensor_id", "STATIONS_ID")
    described = lookup_join(readings, stations(spark, folder), ["STATIONS_ID"], "inner")
    return active_stations(described, "2024-01-30 00:00:00")


@query(
    "active_readings",
    f"""WITH {OBS}, seen AS (SELECT sensor_id, max(timestamp) AS last FROM obs GROUP BY 1)
SELECT event_id, sensor_id AS STATIONS_ID FROM obs WHERE sensor_id IN (SELECT sensor_id FROM seen WHERE last >= TIMESTAMP '2024-01-30 12:00:00')""",
)
def _(spark, folder):
    readings = observations(spark, folder).withColumnRenamed("sensor_id", "STATIONS_ID")
    seen = readings.withColumn("Stationsname", F.lit("x"))
    return readings_of(readings, active_stations(seen, "2024-01-30 12:00:00")).select("event_id", "STATIONS_ID")


_NUMBERS = [c for c in schemas.WEATHER_FIELDS if c != "V_N_I"]


@query(
    "combine_products",
    f"WITH {OBS}, {sql_five()} SELECT STATIONS_ID, {sql_stamp('timestamp')} AS timestamp, {', '.join(_NUMBERS)} FROM five",
)
def _(spark, folder):
    return combine_products(five_products(spark, folder)).drop("V_N_I").withColumn("timestamp", stamp("timestamp"))


@query(
    "weather_long",
    f"WITH {OBS}, {sql_five()} "
    + " UNION ALL ".join(
        f"SELECT STATIONS_ID, {sql_stamp('timestamp')} AS timestamp, '{c}' AS variable, {c} AS value FROM five WHERE {c} IS NOT NULL" for c in _NUMBERS
    ),
)
def _(spark, folder):
    return weather_long(five_products(spark, folder)).withColumn("timestamp", stamp("timestamp"))


@query(
    "group_minimum",
    f"WITH {OBS} SELECT event_id, {sql_stamp('min(timestamp) OVER (PARTITION BY nullif(sensor_id, 5))')} AS minDate FROM obs",
)
def _(spark, folder):
    """One sensor has a null key."""
    rows = observations(spark, folder).withColumn("sensor_id", F.nullif("sensor_id", F.lit(5)))
    rows = with_group_minimum(rows, ["sensor_id"], "timestamp", "minDate")
    return rows.select("event_id", stamp("minDate").alias("minDate"))


_DEVIATION = (
    f"{OBS}, {sql_weather('weather', 'view', 'TT_TU', 'hour')}, readings AS (SELECT sensor_id, "
    f"date_trunc('hour', timestamp) AS timestamp, {sql_mean('value')} AS value FROM obs WHERE variable = 'click' "
    "GROUP BY 1, 2), linked AS (SELECT *, nullif(sensor_id % 20, 7) AS station FROM readings), "
    "deviations AS (SELECT r.sensor_id, r.timestamp, r.value, w.TT_TU, r.value - w.TT_TU AS diff FROM linked r "
    "LEFT JOIN weather w ON w.STATIONS_ID = station AND w.timestamp = r.timestamp WHERE station IS NOT NULL), "
    "errors AS (SELECT sensor_id, avg(diff * diff) AS mse FROM deviations GROUP BY 1)"
)


def _deviations(spark, folder):
    rows = observations(spark, folder).where(F.col("variable") == "click")
    hourly = rows.groupBy("sensor_id", F.date_trunc("hour", "timestamp").alias("timestamp")).agg(mean("value").alias("value"))
    linked = hourly.withColumn("closestTemp", F.nullif(F.col("sensor_id") % 20, F.lit(7)))
    return deviation_from_station(linked, weather(spark, folder))


@query("mse_to_reference", f"WITH {_DEVIATION} SELECT sensor_id, round(mse, 6) AS mse, round(sqrt(mse), 6) AS rmse FROM errors")
def _(spark, folder):
    found = squared_error(_deviations(spark, folder))
    return found.withColumns({"mse": F.round("mse", 6), "rmse": F.round("rmse", 6)})


_SIDES = (
    f"{_DEVIATION}, best AS (SELECT sensor_id, mse, 'best' AS side FROM errors WHERE mse IS NOT NULL ORDER BY mse, sensor_id LIMIT 10), "
    "worst AS (SELECT sensor_id, mse, 'worst' AS side FROM errors WHERE mse IS NOT NULL ORDER BY mse DESC, sensor_id LIMIT 10), "
    "chosen AS (SELECT * FROM best UNION ALL SELECT * FROM worst)"
)


@query("best_worst_sensors", f"WITH {_SIDES} SELECT sensor_id, round(mse, 6) AS mse, side FROM chosen")
def _(spark, folder):
    found = best_and_worst(squared_error(_deviations(spark, folder)))
    return found.select("sensor_id", F.round("mse", 6).alias("mse"), "side")


@query(
    "best_worst_curves",
    f"""WITH {_SIDES} SELECT sensor_id, {sql_stamp('timestamp')} AS timestamp, unnest(['sensor', 'station']) AS variable,
unnest([value, TT_TU]) AS value FROM deviations WHERE sensor_id IN (SELECT sensor_id FROM chosen)""",
)
def _(spark, folder):
    deviations = _deviations(spark, folder)
    curves = error_curves(deviations, best_and_worst(squared_error(deviations)))
    return curves.withColumn("timestamp", stamp("timestamp"))


_CLOSEST = {"closestPerc": 5, "closestCloud": 4, "closestSun": 3, "closestWind": 2, "closestTemp": 6}


def _location_sql() -> str:
    columns = ", ".join(f"sensor_id % {k} AS {c}" for c, k in _CLOSEST.items())
    cells = ", ".join(f"round({sql_mean(f"CASE WHEN variable = '{v}' THEN value END")}, 8) AS {v}" for v in VARIABLES)
    outer = ", ".join(f"round({sql_mean(f"CASE WHEN variable = '{v}' THEN value END")}, 8) AS {v}DWD" for v in VARIABLES)
    names = ', '.join(f'{v}DWD' for v in VARIABLES)
    return f"""WITH {OBS}, sensors AS (SELECT DISTINCT sensor_id, sensor_id % 12 AS location, {columns} FROM obs),
days AS (SELECT *, date_trunc('day', timestamp) AS t FROM obs),
local AS (SELECT location, t, {cells} FROM days JOIN sensors USING (sensor_id) GROUP BY 1, 2),
links AS (SELECT DISTINCT location, unnest([{', '.join(_CLOSEST)}]) AS station FROM sensors),
weather AS (SELECT sensor_id % 6 AS station, t, variable, value FROM days WHERE variable <> 'click'
  OR timestamp >= TIMESTAMP '2024-01-05 00:00:00'),
of_location AS (SELECT location, t, variable, value, min(t) OVER (PARTITION BY location, variable) AS a FROM weather JOIN links USING (station)),
begun AS (SELECT location, max(a) AS start FROM of_location GROUP BY 1),
dwd AS (SELECT location, t, {outer} FROM of_location JOIN begun USING (location) WHERE t >= start GROUP BY 1, 2)
SELECT location, {sql_stamp('t')} AS timestamp, {', '.join(VARIABLES)}, {names} FROM local LEFT JOIN dwd USING (location, t)"""


@query("location_wide", _location_sql())
def _(spark, folder):
    rows = observations(spark, folder).withColumn("timestamp", F.date_trunc("day", "timestamp"))
    dim = (
        rows.select("sensor_id", (F.col("sensor_id") % 12).alias("location"), *[(F.col("sensor_id") % k).alias(c) for c, k in _CLOSEST.items()])
        .distinct()
    )
    station = F.col("sensor_id") % 6
    late = F.col("timestamp") >= F.lit("2024-01-05 00:00:00").cast("timestamp")
    readings = rows.where((F.col("variable") != "click") | late)
    long = readings.select(station.alias("STATIONS_ID"), "timestamp", "variable", "value")
    wide = location_wide(rows, dim, long, VARIABLES, VARIABLES)
    rounded = {c: F.round(c, 8) for c in [*VARIABLES, *[f"{v}DWD" for v in VARIABLES]]}
    return wide.withColumns({**rounded, "timestamp": stamp("timestamp")})
