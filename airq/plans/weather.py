"""Weather products to active stations, long weather table and the plausibility of sensor temperatures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.operators.clean import since
from airq.operators.quality import best_and_worst, error_curves, squared_error
from airq.operators.scale import lookup_join
from airq.operators.stations import (
    active_stations,
    capability_flags,
    deviation_from_station,
    nearest_by_capability,
    readings_of,
    weather_long,
)

SINCE = "2016-01-01 00:00:00"
CUTOFF = "2018-01-01 00:00:00"


def station_table(products: dict[str, DataFrame], cutoff: str = CUTOFF) -> DataFrame:
    """Active stations of all products with their 0/1 capability flags."""
    columns = ["STATIONS_ID", "timestamp", "geoBreite", "geoLaenge", "Stationshoehe", "Stationsname"]
    sightings = reduce(DataFrame.unionByName, [w.select(*columns) for w in products.values()])
    stations = active_stations(sightings, cutoff)
    offers = [
        active_stations(w.select(*columns), cutoff).select("STATIONS_ID", F.lit(p).alias("product")) for p, w in products.items()
    ]
    return capability_flags(stations, reduce(DataFrame.unionByName, offers))


def active_weather(products: dict[str, DataFrame], stations: DataFrame, start: str = SINCE) -> DataFrame:
    """Long weather table of the active stations from ``start`` on."""
    return weather_long({p: since(readings_of(w, stations), F.lit(start).cast("timestamp")) for p, w in products.items()})


def temperature_plausibility(
    long: DataFrame, sensors: DataFrame, stations: DataFrame, temperature: DataFrame, k: int = 10
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Errors per sensor against its nearest temperature station, the best and worst ``k``, and their curves."""
    linked = nearest_by_capability(sensors, stations).select("sensor_id", "closestTemp")
    readings = lookup_join(long.where(F.col("variable") == "temperature"), linked, ["sensor_id"])
    deviations = deviation_from_station(readings, temperature)
    errors = squared_error(deviations)
    chosen = best_and_worst(errors, k)
    return errors, chosen, error_curves(deviations, chosen)
