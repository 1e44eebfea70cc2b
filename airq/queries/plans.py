"""Whole plans on the driver tables: observations to weather, plausibility and all figures of long series."""

from __future__ import annotations

from pyspark.sql import functions as F

from airq import schemas
from airq.operators.scale import keep_keys
from airq.plans.archive import augment_by_distance
from airq.plans.sensor_kpis import hourly_table, long_table, series_kpis
from airq.plans.weather import temperature_plausibility
from airq.queries.base import (
    DENSE_HOURS, FAMILY_UNION, HOURS, ORACLES, STATIONS, dense_series, families, five_products, observations, query, sql_five, sql_stamp, stamp, stations,
)
from airq.queries.quality import _rounded
from airq.queries.values import sql_km
from airq.sources.sensors import unify

_FIELDS = [c for c in schemas.WEATHER_FIELDS if c != "V_N_I"]


def reporting_stations(spark, folder):
    """Stations of the catalogue that the products have readings of."""
    seen = observations(spark, folder).select((F.col("sensor_id") % 20).alias("STATIONS_ID"))
    return keep_keys(stations(spark, folder), seen, ["STATIONS_ID"])


_REPORTING = f"{STATIONS}, reporting AS (SELECT * FROM stations WHERE STATIONS_ID IN (SELECT sensor_id % 20 FROM obs))"


def _nearest(keys: str) -> str:
    """Views ``near_<product>``: per place the reporting station of that capability with the least distance."""
    km = sql_km("lat", "geoBreite", "lon", "geoLaenge")
    views = [
        f"near_{product} AS (SELECT {keys}, arg_min(STATIONS_ID, (km, STATIONS_ID)) AS {closest} FROM pairs WHERE {flag} = 1 GROUP BY {keys})"
        for product, (flag, closest) in schemas.CAPABILITIES.items()
    ]
    return f"pairs AS (SELECT {keys}, reporting.*, {km} AS km FROM places, reporting), {', '.join(views)}"


def _augmented_sql() -> str:
    joins, cells = [], []
    for product, (_, closest) in schemas.CAPABILITIES.items():
        joins.append(f"LEFT JOIN near_{product} USING (lat, lon) LEFT JOIN five w_{product} ON w_{product}.STATIONS_ID = {closest} AND w_{product}.timestamp = date_trunc('hour', u.timestamp)")
        cells += [f"w_{product}.{c}" for c in schemas.WEATHER_COLUMNS[product] if c in _FIELDS]
    return (
        f"WITH {FAMILY_UNION}, {_REPORTING}, places AS (SELECT DISTINCT lat, lon FROM unified), {_nearest('lat, lon')}, {sql_five()} "
        f"SELECT sensor_id, sensor_type, {sql_stamp('u.timestamp')} AS timestamp, CAST(year(u.timestamp) AS INT) AS year, {', '.join(cells)} "
        f"FROM unified u {' '.join(joins)} WHERE lat > 48.3 AND lat < 49.1 AND lon > 8.9 AND lon < 9.5"
    )


@query("weather_by_distance", _augmented_sql())
def _(spark, folder):
    """Unified observations, calendar, geohash, nearest station per capability and the weather of five products."""
    rows = unify(list(families(spark, folder).values()))
    found = augment_by_distance(rows, reporting_stations(spark, folder), five_products(spark, folder))
    return found.select(
        "sensor_id", "sensor_type", stamp("timestamp").alias("timestamp"), F.col("datedim.year").alias("year"), *[F.col(f"dwddim.{c}").alias(c) for c in _FIELDS]
    )


@query(
    "temperature_plausibility",
    f"""WITH {FAMILY_UNION}, {_REPORTING}, places AS (SELECT DISTINCT sensor_id, lat, lon FROM unified), {_nearest('sensor_id')}, {sql_five()},
hourly AS (SELECT sensor_id, date_trunc('hour', timestamp) AS timestamp, avg(temperature) AS value FROM unified GROUP BY 1, 2 HAVING count(temperature) > 0),
errors AS (SELECT h.sensor_id, avg((value - TT_TU) * (value - TT_TU)) AS mse FROM hourly h JOIN near_temperature USING (sensor_id)
  LEFT JOIN five w ON w.STATIONS_ID = closestTemp AND w.timestamp = h.timestamp GROUP BY 1),
known AS (SELECT *, row_number() OVER (ORDER BY mse, sensor_id) AS up, row_number() OVER (ORDER BY mse DESC, sensor_id) AS down FROM errors WHERE mse IS NOT NULL),
sides AS (SELECT sensor_id, mse, 'all' AS side FROM errors UNION ALL SELECT sensor_id, mse, 'best' FROM known WHERE up <= 10
  UNION ALL SELECT sensor_id, mse, 'worst' FROM known WHERE down <= 10)
SELECT sensor_id, round(mse, 6) AS mse, side FROM sides""",
)
def _(spark, folder):
    """Observations to the gap-free long table, nearest temperature station, errors, best and worst sensors."""
    rows = unify(list(families(spark, folder).values()))
    long = long_table(hourly_table(rows, ["temperature"]))
    sensors = rows.select("sensor_id", "lat", "lon").distinct()
    errors, chosen, _ = temperature_plausibility(long, sensors, reporting_stations(spark, folder), five_products(spark, folder)["temperature"])
    columns = ["sensor_id", F.round("mse", 6).alias("mse"), "side"]
    return errors.withColumn("side", F.lit("all")).select(*columns).unionByName(chosen.select(*columns))


_FIGURES = [ORACLES["kpi_native_all"].replace(HOURS, DENSE_HOURS), *[ORACLES[f"kpi_{n}_hourly"] for n in ("arch", "kl", "holt")]]


@query(
    "series_kpis_hourly",
    "SELECT *, CAST(sensor_id * 10 AS INT) AS location, 'half' AS sensor_type, 'value' AS variable FROM "
    + " JOIN ".join(f"({sql}) AS f{i}" + (" USING (sensor_id)" if i else "") for i, sql in enumerate(_FIGURES)),
)
def _(spark, folder):
    """All figures with the scripts' settings (hours, width 48, 24 lags) but the entropy, which has no SQL form."""
    long = dense_series(spark, folder).withColumn("variable", F.lit("value"))
    sensors = observations(spark, folder).select((F.col("sensor_id") % 2).alias("sensor_id")).distinct()
    labels = sensors.withColumns({"location": (F.col("sensor_id") * 10).cast("int"), "sensor_type": F.lit("half")})
    found = series_kpis(long, labels).drop("entropy")
    found = _rounded(found, "sd", "skewness", "kurtosis", "stability", "arch_stat", "max_kl_shift")
    return _rounded(_rounded(_rounded(found, "acf1", places=8), "lumpiness", places=4), "max_var_shift", places=2)
