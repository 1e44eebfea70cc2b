"""Series as arrays; arrays are compared as text."""

from __future__ import annotations

from pyspark.sql import functions as F

from airq.functions.geo import geohash
from airq.operators.series import build_series, geo_series, long_series, position_lists, sensor_dimension, series_to_rows, tile_series
from airq.operators.resample import geo_time_aggregate
from airq.operators.scale import lookup_join
from airq.queries.base import HALF_DAYS, OBS, ORACLES, half_day_series, observations, query, sensors, sql_lat, sql_lon, sql_stamp, stamp
from airq.queries.resampling import augmented
from airq.queries.values import _GEOHASH


def _joined(column: str):
    return F.array_join(F.transform(column, lambda v: v.cast("string")), ",", "-")


_TEXTS = "string_agg(coalesce(CAST(value AS VARCHAR), '-'), ',' ORDER BY timestamp)"


@query(
    "series_build",
    f"WITH {HALF_DAYS} SELECT sensor_id, CAST(year(timestamp) AS INT) AS year, count(*) AS n, {sql_stamp('min(timestamp)')} AS first, "
    f"{sql_stamp('max(timestamp)')} AS last, {_TEXTS} AS values FROM series GROUP BY 1, 2",
)
def _(spark, folder):
    series = build_series(half_day_series(spark, folder), ["sensor_id"], ["value"])
    return series.select(
        "sensor_id", "year", "n", stamp("first").alias("first"), stamp("last").alias("last"), _joined("value").alias("values")
    )


@query(
    "series_parts",
    f"""WITH {HALF_DAYS} SELECT sensor_id, {sql_stamp("date_trunc('week', timestamp)")} AS period, count(*) AS n, {_TEXTS} AS values
FROM series GROUP BY 1, 2""",
)
def _(spark, folder):
    """The same series cut into calendar weeks."""
    series = build_series(half_day_series(spark, folder), ["sensor_id"], ["value"], period="week")
    return series.select("sensor_id", stamp("period").alias("period"), "n", _joined("value").alias("values"))


@query(
    "min_series_length",
    f"WITH {HALF_DAYS}, k AS (SELECT nullif(sensor_id, 7) AS sensor_id, timestamp FROM series) "
    "SELECT sensor_id, CAST(week(timestamp) AS INT) AS week, any_value(t.n) AS n FROM k JOIN (SELECT sensor_id AS s, count(*) AS n FROM k GROUP BY 1 "
    "HAVING count(*) > 57) t ON k.sensor_id IS NOT DISTINCT FROM t.s GROUP BY 1, 2",
)
def _(spark, folder):
    """The length counts over all parts of a series; one series has a null key."""
    rows = half_day_series(spark, folder).withColumn("sensor_id", F.nullif("sensor_id", F.lit(7)))
    kept = long_series(build_series(rows, ["sensor_id"], ["value"], period="week"), 57, "value", "sensor_id")
    return kept.select("sensor_id", F.weekofyear("period").alias("week"), F.col("N_value").alias("n"))


@query(
    "series_to_rows",
    f"WITH {HALF_DAYS} SELECT sensor_id, row_number() OVER (PARTITION BY sensor_id, year(timestamp) ORDER BY timestamp) - 1 AS position, "
    f"{sql_stamp('timestamp')} AS timestamp, CAST(value AS DOUBLE) AS value FROM series",
)
def _(spark, folder):
    series = build_series(half_day_series(spark, folder), ["sensor_id"], ["value"])
    rows = series_to_rows(series, ["sensor_id"], ["times", "value"])
    return rows.select(
        "sensor_id", F.col("position").cast("long").alias("position"), stamp("times").alias("timestamp"), F.col("value").cast("double").alias("value")
    )


_PLACES = (
    f"placed AS (SELECT *, {sql_lat('sensor_id')} AS lat, {sql_lon('sensor_id')} AS lon FROM obs), "
    "sensors AS (SELECT DISTINCT sensor_id, lat, lon FROM placed)"
)


@query(
    "tile_series",
    f"""WITH {HALF_DAYS}, {_PLACES}, {_GEOHASH},
texts AS (SELECT sensor_id, CAST(year(timestamp) AS INT) AS year, {_TEXTS} AS values FROM series GROUP BY 1, 2),
named AS (SELECT substr(hash, 1, 5) AS hash_bin, hash || '#' || sensor_id AS hash, year, values, min(year) OVER (PARTITION BY sensor_id) AS y
FROM texts JOIN sensors USING (sensor_id) JOIN hashes USING (lat, lon))
SELECT hash_bin, max(y) OVER (PARTITION BY hash_bin) AS start_year, hash, year, values FROM named""",
)
def _(spark, folder):
    series = build_series(half_day_series(spark, folder), ["sensor_id"], ["value"])
    series = lookup_join(series, series.groupBy("sensor_id").agg(F.min("year").alias("start_year")), ["sensor_id"])
    places = sensors(spark, folder).select("sensor_id", F.concat(geohash("lat", "lon"), F.lit("#"), F.col("sensor_id").cast("string")).alias("hash"))
    # Two sensors may share a place, so the hash carries the sensor's number.
    tiles = tile_series(lookup_join(series, places, ["sensor_id"], "inner"), ["value"])
    return tiles.select("hash_bin", "start_year", "hash", "year", _joined("value").alias("values"))


@query(
    "geo_series",
    f"""SELECT hash, CAST(year AS INT) AS year, CAST(min(min(year)) OVER (PARTITION BY hash) AS INT) AS start_year, count(*) AS n,
string_agg(coalesce(CAST(CAST(P1 AS DECIMAL(18,4)) AS VARCHAR), '-'), ',' ORDER BY month, day, time_bin) AS P1
FROM ({ORACLES['geo_time_aggregate']}) GROUP BY hash, year""",
)
def _(spark, folder):
    series = geo_series(geo_time_aggregate(augmented(spark, folder)))
    texts = F.transform("P1", lambda v: v.cast("decimal(18,4)").cast("string"))
    return series.select("hash", "year", "start_year", F.size("P1").cast("long").alias("n"), F.array_join(texts, ",", "-").alias("P1"))


_MOVES = (
    f"{OBS}, moves AS (SELECT sensor_id, timestamp, CAST(event_id % 4 AS DOUBLE) AS lon, CAST(event_id % 2 AS DOUBLE) AS lat, "
    "CAST(sensor_id % 40 AS INT) AS location, variable AS sensor_type FROM obs)"
)


def _moves(spark, folder):
    return observations(spark, folder).select(
        "sensor_id",
        "timestamp",
        (F.col("event_id") % 4).cast("double").alias("lon"),
        (F.col("event_id") % 2).cast("double").alias("lat"),
        (F.col("sensor_id") % 40).cast("int").alias("location"),
        F.col("variable").alias("sensor_type"),
    )


@query(
    "sensor_dimension",
    f"WITH {_MOVES} SELECT sensor_id, arg_max(location, timestamp) AS location, arg_max(sensor_type, timestamp) AS sensor_type, "
    "arg_max(lon, timestamp) AS lon, arg_max(lat, timestamp) AS lat, count(DISTINCT (lon, lat)) AS positions FROM moves GROUP BY 1",
)
def _(spark, folder):
    return sensor_dimension(_moves(spark, folder))


@query(
    "position_lists",
    f"""WITH {_MOVES}, history AS (SELECT sensor_id, lon, lat, min(timestamp) AS f FROM moves GROUP BY 1, 2, 3)
SELECT sensor_id, CAST(row_number() OVER (PARTITION BY sensor_id ORDER BY f, lon, lat) AS INT) AS rank, lon, lat, {sql_stamp('f')} AS first_seen
FROM history""",
)
def _(spark, folder):
    return position_lists(_moves(spark, folder)).withColumn("first_seen", stamp("first_seen"))
