"""Nearest-neighbour joins."""

from __future__ import annotations

from airq import schemas
from airq.functions.geo import geohash
from airq.operators.nearest import nearest_site
from airq.operators.stations import nearest_by_capability, nearest_station_hash
from airq.queries.base import PLACED, SENSORS, STATIONS, placed, query, sensors, stations
from airq.queries.values import _GEOHASH, sql_km


def _nearest_sql() -> str:
    best, columns = [], []
    for flag, closest in schemas.CAPABILITIES.values():
        best.append(
            f"{closest}_t AS (SELECT sensor_id, arg_min(STATIONS_ID, (km, STATIONS_ID)) AS {closest}, min(km) AS {closest}_km "
            f"FROM pairs WHERE {flag} = 1 GROUP BY 1)"
        )
        columns += [closest, f"{closest}_km"]
    joins = " ".join(f"LEFT JOIN {c}_t USING (sensor_id)" for _, c in schemas.CAPABILITIES.values())
    km = sql_km("lat", "geoBreite", "lon", "geoLaenge")
    return (
        f"WITH {SENSORS}, {STATIONS}, pairs AS (SELECT sensor_id, stations.*, {km} AS km FROM sensors, stations), "
        f"{', '.join(best)} SELECT sensor_id, {', '.join(columns)} FROM sensors {joins}"
    )


@query("nearest_station_by_capability", _nearest_sql())
def _(spark, folder):
    return nearest_by_capability(sensors(spark, folder), stations(spark, folder), with_km=True).drop("lat", "lon")


@query(
    "nearest_other_location",
    f"""WITH {SENSORS}, places AS (SELECT lat, lon, min(sensor_id) AS sensor_id FROM sensors GROUP BY 1, 2),
pairs AS (SELECT a.lat, a.lon, b.sensor_id, {sql_km('a.lat', 'b.lat', 'a.lon', 'b.lon')} AS km FROM places a, places b
WHERE a.lat <> b.lat OR a.lon <> b.lon)
SELECT lat, lon, arg_min(sensor_id, (km, sensor_id)) AS sensor_id, min(km) AS km FROM pairs GROUP BY 1, 2""",
)
def _(spark, folder):
    places = sensors(spark, folder)
    return nearest_site(places, places, "sensor_id", exclude_same_place=True)


_PREFIX = f"""WITH {PLACED}, {STATIONS}, places AS (SELECT lat, lon FROM placed UNION SELECT geoBreite, geoLaenge FROM stations),
{_GEOHASH.replace("FROM placed", "FROM places")}, sites AS (SELECT DISTINCT hash AS site FROM stations JOIN hashes ON lat = geoBreite AND lon = geoLaenge),
needles AS (SELECT DISTINCT hash FROM placed JOIN hashes USING (lat, lon)),
shared AS (SELECT h.hash, s.site, (SELECT count(*) FROM (SELECT unnest(range(1, 13)) AS i)
  WHERE substr(h.hash, 1, i) = substr(s.site, 1, i)) AS n FROM needles h, sites s),
best AS (SELECT hash, arg_min(site, (-n, site)) AS nearest FROM shared GROUP BY 1)
SELECT event_id, hash, nearest FROM placed JOIN hashes USING (lat, lon) JOIN best USING (hash)"""


@query("nearest_by_geohash_prefix", _PREFIX)
def _(spark, folder):
    rows = placed(spark, folder).withColumn("hash", geohash("lat", "lon"))
    sites = stations(spark, folder).select(geohash("geoBreite", "geoLaenge").alias("site"))
    return nearest_station_hash(rows, sites, "hash", "site").select("event_id", "hash", "nearest")
