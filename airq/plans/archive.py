"""Sensor archive to enriched observations, geo-time aggregate and series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq import schemas
from airq.functions.calendar import add_calendar
from airq.functions.geo import REGION, Box, add_geohash
from airq.operators.clean import earliest, inside, since
from airq.operators.nearest import nearest_by_prefix
from airq.operators.resample import geo_time_aggregate
from airq.operators.scale import lookup_join
from airq.operators.series import geo_series
from airq.operators.stations import join_all_weather, nearest_by_capability


def enrich(observations: DataFrame, box: Box | None = REGION) -> DataFrame:
    """Calendar and geohash structs on the observations inside the box."""
    rows = inside(observations, box) if box else observations
    return add_geohash(add_calendar(rows))


def link_by_prefix(enriched: DataFrame, products: dict[str, DataFrame]) -> DataFrame:
    """Per product, the station whose geohash shares the longest prefix with the observation's.

    ``products`` carry a ``hash`` column; the links are made on distinct hashes and looked up once.
    """
    needles = enriched.select(F.col("geohash.hash").alias("hash")).distinct()
    links = needles
    for product, weather in products.items():
        closest = schemas.CAPABILITIES[product][1]
        sites = weather.select(F.col("hash").alias("site")).distinct()
        found = nearest_by_prefix(needles, sites, "hash", "site")
        links = links.join(found.select("hash", F.col("nearest").alias(closest)), "hash", "left")
    return lookup_join(enriched.withColumn("hash", F.col("geohash.hash")), links, ["hash"]).drop("hash")


def augment_by_prefix(observations: DataFrame, products: dict[str, DataFrame], box: Box | None = REGION) -> DataFrame:
    """Enriched observations with the weather of the station nearest by geohash prefix."""
    enriched = enrich(observations, box)
    start = earliest(enriched.select(F.date_trunc("year", F.col("timestamp")).alias("year")), "year")
    recent = {p: since(w, start) for p, w in products.items()}
    linked = link_by_prefix(enriched, recent)
    keyed = {p: w.withColumn("STATIONS_ID", F.col("hash")) for p, w in recent.items()}
    closest = [schemas.CAPABILITIES[p][1] for p in products]
    return join_all_weather(linked, keyed).drop(*closest)


def augment_by_distance(
    observations: DataFrame, stations: DataFrame, products: dict[str, DataFrame], box: Box | None = REGION
) -> DataFrame:
    """Enriched observations with the weather of the station nearest by distance."""
    enriched = enrich(observations, box)
    places = nearest_by_capability(enriched.select("lat", "lon").distinct(), stations)
    linked = lookup_join(enriched, places, ["lat", "lon"])
    closest = [schemas.CAPABILITIES[p][1] for p in products]
    return join_all_weather(linked, products).drop(*closest)


def aggregate_and_series(augmented: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The geo-time aggregate and its series table."""
    aggregated = geo_time_aggregate(augmented)
    return aggregated, geo_series(aggregated)

