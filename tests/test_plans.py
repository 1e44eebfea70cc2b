import datetime as dt

import pytest
from pyspark.sql import functions as F

from airq.functions.calendar import add_calendar
from airq.functions.geo import add_geohash
from airq.operators.stations import join_weather
from airq.plans import archive, sensor_kpis, weather
from airq.sources.sensors import to_observation

T0 = dt.datetime(2018, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def observations(spark):
    rows = []
    for sensor, kind, lat in ((1, "SDS011", 48.70), (2, "DHT22", 48.75), (3, "PPD42NS", 48.80), (4, "DHT22", 10.0)):
        for i in range(130):
            rows.append((sensor, kind, sensor * 10, lat, 9.1, T0 + dt.timedelta(minutes=30 * i), float(i % 7), float(i % 5), 1.0 * i))
    schema = "sensor_id int, sensor_type string, location int, lat double, lon double, timestamp timestamp, P1 double, P2 double, temperature double"
    return to_observation(spark.createDataFrame(rows, schema))


@pytest.fixture(scope="module")
def products(spark):
    rows = [(s, T0 + dt.timedelta(hours=h), 48.6 + s / 10, 9.1, 300.0, f" St {s} ", 1.0 * h + s, 50.0) for s in (1, 2) for h in range(60)]
    base = spark.createDataFrame(
        rows, "STATIONS_ID int, timestamp timestamp, geoBreite double, geoLaenge double, Stationshoehe double, Stationsname string, TT_TU double, RF_TU double"
    )
    return {"temperature": base, "wind": base.where("STATIONS_ID = 2").withColumnsRenamed({"TT_TU": "F", "RF_TU": "D"})}


def test_no_python_in_native_expressions(spark, sf):
    from airq.queries.base import placed

    text = plan_of(add_geohash(add_calendar(placed(spark, sf))))
    assert "EvalPython" not in text and "Exchange" not in text


def test_small_weather_is_broadcast_and_pruned(spark, sf):
    from airq.queries.base import observations as events

    rows = events(spark, sf).withColumn("closestTemp", F.col("sensor_id") % 20)
    small = rows.select(F.col("sensor_id").alias("STATIONS_ID"), "timestamp", F.col("value").alias("TT_TU"))
    text = plan_of(join_weather(rows, small, "closestTemp", ["TT_TU"]).select("event_id", "TT_TU"))
    assert "BroadcastHashJoin" in text and "props" not in text.split("ReadSchema")[1]


def test_filters_reach_the_scan(spark, sf):
    from airq.queries.base import observations as events

    text = plan_of(events(spark, sf).where("variable = 'view'").select("event_id"))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in text


def test_archive_to_series(spark, observations, products):
    stations = weather.station_table(products)
    flags = {r.STATIONS_ID: (r.isTemp, r.isWind, r.isSun, r.Stationsname) for r in stations.collect()}
    assert flags == {1: (1, 0, 0, "St 1"), 2: (1, 1, 0, "St 2")}
    augmented = archive.augment_by_distance(observations, stations, products)
    assert augmented.count() == 390
    row = augmented.where("sensor_id = 1").orderBy("timestamp").first()
    assert (row.dwddim.TT_TU, row.dwddim.F) == (1.0, 2.0)


def test_aggregate_needs_all_products(spark, observations, products):
    from airq import schemas

    stations = weather.station_table(products)
    augmented = archive.augment_by_distance(observations, stations, products)
    have = [c for p in products for c in schemas.WEATHER_COLUMNS[p]]
    full = [F.col(f"dwddim.{c}") if c in have else F.lit(None).cast("double").alias(c) for c in schemas.WEATHER_FIELDS]
    aggregated, series = archive.aggregate_and_series(augmented.withColumn("dwddim", F.struct(*full)))
    assert aggregated.count() == 260
    rows = series.collect()
    assert len(rows) == 2 and all(len(r.P1) == 130 and r.start_year == 2018 for r in rows)


def test_augment_by_prefix(spark, observations, products):
    hashed = {
        p: add_geohash(w, "geoBreite", "geoLaenge").withColumn("hash", F.col("geohash.hash")).drop("geohash") for p, w in products.items()
    }
    out = archive.augment_by_prefix(observations, hashed)
    assert out.count() == 390 and out.where("dwddim.F is null and timestamp < '2018-01-03'").count() == 0


def test_kpis_of_all_sensors(spark, observations):
    rows = sensor_kpis.sensor_kpis(observations, "2018-01-03", 50).collect()
    assert {(r.sensor_id, r.variable) for r in rows} >= {(1, "P1"), (1, "P2"), (1, "temperature"), (2, "P1")}
    assert len(rows[0]) == 4 + 19


def test_temperature_plausibility(spark, observations, products):
    long = sensor_kpis.long_table(sensor_kpis.hourly_table(observations))
    sensors = observations.select("sensor_id", "lat", "lon").distinct()
    errors, chosen, curves = weather.temperature_plausibility(long, sensors, weather.station_table(products), products["temperature"], 2)
    assert errors.count() == 4 and chosen.count() == 4
    assert {r.variable for r in curves.select("variable").distinct().collect()} == {"sensor", "station"}


def test_active_weather(spark, products):
    long = weather.active_weather(products, weather.station_table(products))
    assert {r.variable for r in long.select("variable").distinct().collect()} == {"TT_TU", "RF_TU", "F", "D"}


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
