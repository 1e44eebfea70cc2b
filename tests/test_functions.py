import datetime as dt
import math

from pyspark.sql import functions as F

from airq.functions import calendar as C
from airq.functions import geo, text
from airq.functions.stats import kurtosis_sample_sd, mean, skewness_sample_sd
from airq.functions.transformers import CalendarTransformer, GeohashTransformer


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def at(text_value):
    return F.lit(text_value).cast("timestamp")


def test_calendar_of_new_year(spark):
    row = one(spark, C.calendar_struct(at("2018-01-01 16:56:00")).alias("d"))["d"]
    assert (row.time_bin, row.hour_bin, row.min_bin, row.time_cat) == (67, 16, 45, "16:45")
    assert row.time_num == 1012.5 / 1440
    assert (row.day_of_week, row.day_of_year, row.weekend, row.holiday, row.day_cat) == (0, 1, 0, 1, "Monday")
    assert math.isclose(row.day_num, (0 + 1012.5 / 1440) / 7)
    assert math.isclose(row.time_cos, math.cos(2 * math.pi * row.time_num))


def test_calendar_edges(spark):
    late = one(spark, C.calendar_struct(at("2017-10-28 23:59:00")).alias("d"))["d"]
    assert (late.time_bin, late.weekend, late.time_cat) == (95, 1, "23:45")
    missing = one(spark, C.calendar_struct(F.lit(None).cast("timestamp")).alias("d"))["d"]
    assert all(v is None for v in missing)


def test_reformation_day_only_in_2017(spark):
    row = one(spark, C.is_holiday(at("2017-10-31 08:00:00")).alias("a"), C.is_holiday(at("2018-10-31 08:00:00")).alias("b"))
    assert (row.a, row.b) == (1, 0)


def test_easter(spark):
    rows = spark.createDataFrame([(2016,), (2017,), (2018,), (1818,), (2285,)], "y int").select(C.easter_sunday(F.col("y")).alias("e")).collect()
    assert [r.e for r in rows] == [
        dt.date(2016, 3, 27), dt.date(2017, 4, 16), dt.date(2018, 4, 1), dt.date(1818, 3, 22), dt.date(2285, 3, 22),
    ]


def test_bins_must_divide_the_hour():
    import pytest

    with pytest.raises(ValueError):
        C._bin_minutes(100)


def test_packed_hour(spark):
    row = one(spark, C.packed_hour(F.lit(2017020113)).alias("a"), C.packed_hour(F.lit("x")).alias("b"))
    assert row.a == dt.datetime(2017, 2, 1, 13) and row.b is None


def test_geohash(spark):
    row = one(
        spark,
        geo.geohash(F.lit(57.64911), F.lit(10.40744)).alias("a"),
        geo.geohash_struct(F.lit(48.78), F.lit(9.18)).alias("b"),
        geo.geohash(F.lit(0.0), F.lit(9.18)).alias("c"),
        geo.geohash_u64(F.lit(48.78), F.lit(0.0)).alias("d"),
        geo.geohash(F.lit(-33.86), F.lit(-70.5)).alias("e"),
    )
    assert row.a == "u4pruydqqvj8"
    assert (row.b.hash, row.b.hash_bin) == ("u0wt8bhsje04", "u0wt8bhs")
    assert row.c is None and row.d is None
    # The text is the leading 60 of the 64 bits.
    digits = "".join(f"{geo.GEOHASH_ALPHABET.index(c):05b}" for c in row.b.hash)
    assert f"{int(row.b.hash_u64):064b}".startswith(digits)
    assert row.e.startswith("6")


def test_distance_and_prefix(spark):
    row = one(
        spark,
        geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("half"),
        geo.common_prefix_length(F.lit("u0wt8"), F.lit("u0wx8")).alias("p"),
        geo.in_box(F.lit(48.3), F.lit(9.0), geo.REGION).alias("edge"),
    )
    assert math.isclose(row.half, math.pi * geo.EARTH_RADIUS_KM)
    assert row.p == 3 and row.edge is False


def test_list_text(spark):
    rows = spark.createDataFrame([("[9.10, 9.18]",), ("9.18",), ("[]",), (None,)], "t string").select(text.last_number_of_list("t").alias("v"))
    assert [r.v for r in rows.collect()] == [9.18, 9.18, None, None]


def test_names(spark):
    assert text.sanitise_name("  Stations Höhe (m) ") == "Stations_Höhe_m"
    row = one(spark, text.station_id_from_name(F.lit("stundenwerte_TU_04928_akt.zip")).alias("a"), text.archive_name(F.lit("x.txt")).alias("b"))
    assert row.a == 4928 and row.b is None


def test_moments(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 2.5, 7, 9, 3)] + [(None,)], "x double")
    row = df.agg(skewness_sample_sd("x").alias("s"), kurtosis_sample_sd("x").alias("k"), mean("x").alias("m")).first()
    assert math.isclose(row.s, 0.5241330396, rel_tol=1e-9) and math.isclose(row.k, -1.7213216600, rel_tol=1e-9)
    assert math.isclose(row.m, 24.5 / 6)


def test_transformers_survive_saving(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2018, 1, 1), 48.78, 9.18)], "timestamp timestamp, lat double, lon double")
    cal = CalendarTransformer(inputCol="timestamp", outputCol="datedim")
    cal.write().overwrite().save(str(tmp_path / "c"))
    again = CalendarTransformer.load(str(tmp_path / "c"))
    out = GeohashTransformer(inputCols=["lat", "lon"], outputCol="geohash").transform(again.transform(df)).first()
    assert out.datedim.year == 2018 and out.geohash.hash == "u0wt8bhsje04"


def test_geohash_of_odd_coordinates(spark):
    nan, inf = float("nan"), float("inf")
    places = [(nan, 9.0), (9.0, nan), (90.5, 9.0), (-91.0, 9.0), (inf, 9.0), (9.0, -inf), (None, 9.0), (9.0, None)]
    places += [(48.0, 9.0), (48.0, 369.0), (48.0, -351.0), (48.0, 180.0), (48.0, -180.0), (90.0, 9.0), (-90.0, 9.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "i int, lat double, lon double")
    rows = df.select("i", geo.geohash("lat", "lon").alias("h"), geo.geohash_u64("lat", "lon").alias("u")).orderBy("i").collect()
    assert all(r.h is None and r.u is None for r in rows[:8])
    assert rows[8].h == rows[9].h == rows[10].h and rows[8].u == rows[9].u
    assert rows[11].h == rows[12].h and rows[13].h[0] in "uvyz" and rows[14].h[0] in "hjnp"
    assert all(len(r.h) == 12 and 0 <= int(r.u) < 1 << 64 for r in rows[8:])


def test_sanitise_name_by_its_rule():
    cases = {" a b ": "a_b", "x/y": "xy", "m.n-o_p": "m.n-o_p", "Höhe (m)": "Höhe_m", "": "", "a  b": "a__b", "5%": "5"}
    assert {k: text.sanitise_name(k) for k in cases} == cases
