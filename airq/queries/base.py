"""The driver tables seen as sensor data, in DataFrame and in SQL form.

``events`` is the long observation table (user = sensor, event type = variable), ``supplier`` the station
catalogue. Readings have two decimals and are handled as decimals, so means do not depend on row order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airq import schemas
from airq.functions.stats import mean
from airq.operators.resample import HOUR, bin_means, gap_fill
from airq.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

READING = "decimal(18,2)"
HALF_DAY = 43200
VARIABLES = ["click", "error", "purchase", "signup", "view"]

# Which event type stands for which sensor type, and the columns its value and key fill.
FAMILIES = {
    "DHT22": ("view", "temperature", "humidity"),
    "SDS011": ("click", "P1", "P2"),
    "PPD42NS": ("purchase", "P1", "P2"),
    "BMP180": ("signup", "pressure", "temperature"),
    "BME280": ("error", "pressure", "humidity"),
}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table; times without zone are read as UTC, the session's zone is set to that."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = read_table(spark, folder, name)
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def stamp(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def lat_of(key: str, factor: int = 37) -> Column:
    return F.lit(48.30) + ((F.col(key) * factor) % 80).cast("double") / F.lit(100.0)


def lon_of(key: str, factor: int = 53) -> Column:
    return F.lit(8.90) + ((F.col(key) * factor) % 60).cast("double") / F.lit(100.0)


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """``(event_id, sensor_id, timestamp, variable, value, props)``."""
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("sensor_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("variable"),
        F.col("value").cast(READING).alias("value"),
        "props",
    )


def placed(spark: SparkSession, folder: str) -> DataFrame:
    return observations(spark, folder).withColumns({"lat": lat_of("sensor_id"), "lon": lon_of("sensor_id")})


def sensors(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct sensors with their place."""
    return placed(spark, folder).select("sensor_id", "lat", "lon").distinct()


def stations(spark: SparkSession, folder: str) -> DataFrame:
    """Stations with capability flags; every second measures temperature, every third wind and so on."""
    flags = {"isTemp": 2, "isWind": 3, "isSun": 4, "isCloud": 5, "isPerc": 7}
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("STATIONS_ID"),
        lat_of("s_suppkey", 29).alias("geoBreite"),
        lon_of("s_suppkey", 31).alias("geoLaenge"),
        F.col("s_acctbal").alias("Stationshoehe"),
        F.concat(F.lit("  "), F.col("s_name"), F.lit(" ")).alias("Stationsname"),
        *[(F.col("s_suppkey") % k == 0).cast("int").alias(flag) for flag, k in flags.items()],
    )


def families(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Per sensor type, the events that stand for it in the columns of its archive files."""
    rows = placed(spark, folder)
    return {sensor_type: _family(rows, sensor_type) for sensor_type in FAMILIES}


def _family(rows: DataFrame, sensor_type: str) -> DataFrame:
    event, first, second = FAMILIES[sensor_type]
    rows = rows.where(F.col("variable") == event)
    filled = {first: F.col("value").cast("double"), second: F.get_json_object("props", "$.k").cast("double")}
    measures = [
        filled.get(c, F.lit(None).cast("double")).alias(c) for c in schemas.SENSOR_MEASURES[sensor_type]
    ]
    return rows.select(
        F.col("sensor_id").cast("int").alias("sensor_id"),
        F.lit(sensor_type).alias("sensor_type"),
        (F.col("sensor_id") % 40).cast("int").alias("location"),
        "lat",
        "lon",
        "timestamp",
        *measures,
    )


def weather(spark: SparkSession, folder: str, event: str = "view", column: str = "TT_TU", step: str = "hour") -> DataFrame:
    """Hourly means of one event type over 20 stations, standing for a weather product."""
    return weather_of(observations(spark, folder), event, column, step)


def weather_of(rows: DataFrame, event: str, column: str, step: str = "hour") -> DataFrame:
    return (
        rows.where(F.col("variable") == event)
        .groupBy((F.col("sensor_id") % 20).alias("STATIONS_ID"), F.date_trunc(step, "timestamp").alias("timestamp"))
        .agg(mean("value").alias(column))
    )


# Which event type stands for which weather column; a second numeric column of a product is twice the first.
WEATHER_EVENTS = {"TT_TU": "view", "R1": "signup", "V_N": "purchase", "SD_SO": "error", "F": "click"}
TWICE = {"RF_TU": "TT_TU", "RS_IND": "R1", "WRTR": "R1", "D": "F"}


def five_products(spark: SparkSession, folder: str, step: str = "hour") -> dict[str, DataFrame]:
    """All weather products of 20 stations, each from one event type."""
    rows = observations(spark, folder)
    found = {}
    for product, columns in schemas.WEATHER_COLUMNS.items():
        column = next(c for c in columns if c in WEATHER_EVENTS)
        readings = weather_of(rows, WEATHER_EVENTS[column], column, step)
        others = {c: F.col(TWICE[c]) * 2 if c in TWICE else F.lit(None).cast("string") for c in columns if c != column}
        found[product] = readings.withColumns(others)
    return found


def hourly_series(spark: SparkSession, folder: str) -> DataFrame:
    """Gap-free hourly means per sensor, as decimals."""
    means = bin_means(observations(spark, folder), ["sensor_id"], ["value"], HOUR)
    return gap_fill(means, ["sensor_id"], HOUR).withColumn("value", F.col("value").cast("decimal(18,6)"))


def half_day_series(spark: SparkSession, folder: str) -> DataFrame:
    """Gap-free half-day means per sensor, as decimals."""
    means = bin_means(observations(spark, folder), ["sensor_id"], ["value"], HALF_DAY)
    return gap_fill(means, ["sensor_id"], HALF_DAY).withColumn("value", F.col("value").cast("decimal(18,6)"))


def dense_series(spark: SparkSession, folder: str) -> DataFrame:
    """Gap-free hourly means of two halves of the sensors, as decimals: hours without a reading are rare."""
    halves = observations(spark, folder).withColumn("sensor_id", F.col("sensor_id") % 2)
    means = bin_means(halves, ["sensor_id"], ["value"], HOUR)
    return gap_fill(means, ["sensor_id"], HOUR).withColumn("value", F.col("value").cast("decimal(18,6)"))


# ---- the same views in SQL ----

def sql_mean(x: str) -> str:
    return f"(CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0))"


def sql_stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def sql_bin(x: str, step: int) -> str:
    return f"make_timestamp(CAST(floor(epoch({x}) / {step}) AS BIGINT) * {step} * 1000000)"


def sql_lat(key: str, factor: int = 37) -> str:
    return f"(CAST(48.30 AS DOUBLE) + CAST(({key} * {factor}) % 80 AS DOUBLE) / CAST(100 AS DOUBLE))"


def sql_lon(key: str, factor: int = 53) -> str:
    return f"(CAST(8.90 AS DOUBLE) + CAST(({key} * {factor}) % 60 AS DOUBLE) / CAST(100 AS DOUBLE))"


OBS = (
    "obs AS (SELECT event_id, user_id AS sensor_id, ts AS timestamp, event_type AS variable, "
    "CAST(value AS DECIMAL(18,2)) AS value, props FROM events)"
)
PLACED = f"{OBS}, placed AS (SELECT *, {sql_lat('sensor_id')} AS lat, {sql_lon('sensor_id')} AS lon FROM obs)"
SENSORS = f"{PLACED}, sensors AS (SELECT DISTINCT sensor_id, lat, lon FROM placed)"
STATIONS = (
    "stations AS (SELECT s_suppkey AS STATIONS_ID, "
    f"{sql_lat('s_suppkey', 29)} AS geoBreite, {sql_lon('s_suppkey', 31)} AS geoLaenge, "
    "s_acctbal AS Stationshoehe, s_name AS Stationsname, "
    "CAST(s_suppkey % 2 = 0 AS INT) AS isTemp, CAST(s_suppkey % 3 = 0 AS INT) AS isWind, "
    "CAST(s_suppkey % 4 = 0 AS INT) AS isSun, CAST(s_suppkey % 5 = 0 AS INT) AS isCloud, "
    "CAST(s_suppkey % 7 = 0 AS INT) AS isPerc FROM supplier)"
)


def sql_weather(name: str = "weather", event: str = "view", column: str = "TT_TU", step: str = "hour") -> str:
    return (
        f"{name} AS (SELECT sensor_id % 20 AS STATIONS_ID, date_trunc('{step}', timestamp) AS timestamp, "
        f"{sql_mean('value')} AS {column} FROM obs WHERE variable = '{event}' GROUP BY 1, 2)"
    )


def sql_family(sensor_type: str) -> str:
    event, first, second = FAMILIES[sensor_type]
    cells = []
    for c in schemas.MEASURES:
        if c == first:
            cells.append(f"CAST(value AS DOUBLE) AS {c}")
        elif c == second:
            cells.append(f"CAST(json_extract_string(props, '$.k') AS DOUBLE) AS {c}")
        else:
            cells.append(f"CAST(NULL AS DOUBLE) AS {c}")
    return (
        f"SELECT CAST(sensor_id AS INT) AS sensor_id, '{sensor_type}' AS sensor_type, CAST(sensor_id % 40 AS INT) AS location, "
        f"lat, lon, timestamp, {', '.join(cells)} FROM placed WHERE variable = '{event}'"
    )


FAMILY_UNION = f"{PLACED}, unified AS ({' UNION ALL '.join(sql_family(t) for t in FAMILIES)})"


def sql_series(step: int, label: str) -> str:
    """Gap-free means per sensor in steps of that many seconds."""
    return (
        f"{OBS}, means AS (SELECT sensor_id, {sql_bin('timestamp', step)} AS timestamp, {sql_mean('value')} AS value "
        "FROM obs GROUP BY 1, 2), "
        "spans AS (SELECT sensor_id, min(timestamp) AS a, max(timestamp) AS b FROM means GROUP BY 1), "
        f"grid AS (SELECT sensor_id, unnest(generate_series(a, b, INTERVAL {label})) AS timestamp FROM spans), "
        "series AS (SELECT g.sensor_id, g.timestamp, CAST(m.value AS DECIMAL(18,6)) AS value FROM grid g "
        "LEFT JOIN means m ON g.sensor_id = m.sensor_id AND g.timestamp = m.timestamp)"
    )


HALF_DAYS = sql_series(HALF_DAY, "12 HOUR")
HOURS = sql_series(HOUR, "1 HOUR")
DENSE_HOURS = HOURS.replace("user_id AS sensor_id", "user_id % 2 AS sensor_id")


def sql_five(step: str = "hour") -> str:
    """The same products side by side, as view ``five`` of ``obs``."""
    cells = [f"{sql_mean(f"CASE WHEN variable = '{e}' THEN value END")} AS {c}" for c, e in WEATHER_EVENTS.items()]
    twice = [f"2 * {c} AS {t}" for t, c in TWICE.items()]
    return (
        f"single AS (SELECT sensor_id % 20 AS STATIONS_ID, date_trunc('{step}', timestamp) AS timestamp, {', '.join(cells)} "
        f"FROM obs GROUP BY 1, 2), five AS (SELECT *, {', '.join(twice)} FROM single)"
    )
