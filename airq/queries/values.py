"""Calendar, geohash and text expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from airq.functions import text
from airq.functions.calendar import add_calendar, hour_from_parts, is_holiday, packed_hour
from airq.functions.geo import add_geohash, common_prefix_length, geohash, geohash_u64, haversine_km
from airq.queries.base import PLACED, SENSORS, lat_of, lon_of, observations, placed, query, sensors, sql_lat, sql_lon, sql_stamp, stamp, table
from airq.sources.weather import archives_of_stations

_EASTER_STEPS = """
years AS (SELECT DISTINCT year(d) AS y FROM days),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
e2 AS (SELECT *, b // 4 AS d, b % 4 AS e, (b + 8) // 25 AS f, c // 4 AS i, c % 4 AS k FROM e1),
e3 AS (SELECT *, (b - f + 1) // 3 AS g FROM e2),
e4 AS (SELECT *, (19 * a + b - d - g + 15) % 30 AS h FROM e3),
e5 AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM e4),
e6 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM e5),
easter AS (SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS easter FROM e6),
holiday AS (SELECT d, CAST(strftime(d, '%m-%d') IN ('01-01','01-06','05-01','10-03','11-01','12-25','12-26')
  OR date_diff('day', easter, d) IN (-2, 1, 39, 50, 60) OR d = DATE '2017-10-31' AS INT) AS holiday
  FROM days JOIN easter ON year(d) = y)
"""
_TURN = "CAST(6.283185307179586 AS DOUBLE)"


@query(
    "calendar_struct",
    f"""WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events), {_EASTER_STEPS},
base AS (SELECT event_id, ts, CAST(ts AS DATE) AS d, hour(ts) AS h, (hour(ts) * 60 + minute(ts)) // 15 AS b,
  isodow(ts) - 1 AS w FROM events),
frac AS (SELECT *, (b * 15) % 60 AS mb, (CAST(h AS DOUBLE) * 60 + (b * 15) % 60 + CAST(7.5 AS DOUBLE)) / CAST(1440 AS DOUBLE) AS tn
  FROM base)
SELECT event_id, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day,
  CAST(w AS INT) AS day_of_week, CAST(dayofyear(ts) AS INT) AS day_of_year, CAST(w >= 5 AS INT) AS weekend, holiday,
  dayname(ts) AS day_cat, round((w + tn) / 7, 10) AS day_num, round(cos((w + tn) / 7 * {_TURN}), 10) AS day_cos,
  round(sin((w + tn) / 7 * {_TURN}), 10) AS day_sin, printf('%02d:%02d', h, mb) AS time_cat, CAST(b AS INT) AS time_bin,
  CAST(h AS INT) AS hour_bin, CAST(mb AS INT) AS min_bin, round(tn, 10) AS time_num, round(cos(tn * {_TURN}), 10) AS time_cos,
  round(sin(tn * {_TURN}), 10) AS time_sin FROM frac JOIN holiday USING (d)""",
)
def _(spark, folder):
    flat = add_calendar(observations(spark, folder)).select("event_id", "datedim.*")
    rounded = [c for c, t in flat.dtypes if t == "double"]
    return flat.withColumns({c: F.round(c, 10) for c in rounded})


@query(
    "holiday_flag",
    f"""WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), {_EASTER_STEPS}
SELECT o_orderkey, holiday FROM orders JOIN holiday ON CAST(o_orderdate AS DATE) = d""",
)
def _(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", is_holiday("o_orderdate").alias("holiday"))


_GEOHASH = """
quantised AS (SELECT DISTINCT lat, lon, CAST(floor((lat + 90) / CAST(180 AS DOUBLE) * CAST(1073741824 AS DOUBLE)) AS BIGINT) AS qa,
  CAST(floor((lon + 180) / CAST(360 AS DOUBLE) * CAST(1073741824 AS DOUBLE)) AS BIGINT) AS qo FROM placed),
bits AS (SELECT lat, lon, g // 5 AS i, (CASE WHEN g % 2 = 0 THEN (qo >> CAST(29 - g // 2 AS INT)) & 1
  ELSE (qa >> CAST(29 - g // 2 AS INT)) & 1 END) * CAST(pow(2, 4 - g % 5) AS BIGINT) AS v
  FROM quantised, (SELECT unnest(range(60)) AS g)),
letters AS (SELECT lat, lon, i, substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST(sum(v) AS INT) + 1, 1) AS c FROM bits GROUP BY 1, 2, 3),
hashes AS (SELECT lat, lon, string_agg(c, '' ORDER BY i) AS hash FROM letters GROUP BY 1, 2)"""


@query(
    "geohash_encode",
    f"WITH {PLACED}, {_GEOHASH} SELECT event_id, hash, substr(hash, 1, 8) AS hash_bin, substr(hash, 1, 5) AS tile "
    "FROM placed JOIN hashes USING (lat, lon)",
)
def _(spark, folder):
    rows = add_geohash(placed(spark, folder)).select("event_id", "geohash.hash", "geohash.hash_bin")
    return rows.withColumn("tile", F.substring("hash", 1, 5))


_ODD_PLACES = """raw AS (SELECT c_custkey, CASE WHEN c_custkey % 97 = 0 THEN CAST('nan' AS DOUBLE) ELSE CAST(c_custkey % 41 * 10 - 200 AS DOUBLE) END AS a,
  CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE CAST(c_custkey % 109 * 10 - 540 AS DOUBLE) END AS o FROM customer),
placed AS (SELECT c_custkey, CASE WHEN a = 90 THEN CAST(89.99999999 AS DOUBLE) ELSE a END AS lat, o - 360 * floor((o + 180) / 360) AS lon
  FROM raw WHERE a BETWEEN -90 AND 90 AND a <> 0 AND o <> 0)"""


@query(
    "geohash_edges",
    f"WITH {_ODD_PLACES}, {_GEOHASH} SELECT c_custkey, hash FROM customer LEFT JOIN placed USING (c_custkey) LEFT JOIN hashes USING (lat, lon)",
)
def _(spark, folder):
    """Poles, longitudes round the globe, coordinates out of range, NaN and null."""
    key = F.col("c_custkey")
    lat = F.when(key % 97 == 0, F.lit(float("nan"))).otherwise((key % 41 * 10 - 200).cast("double"))
    lon = F.when(key % 89 != 0, (key % 109 * 10 - 540).cast("double"))
    return table(spark, folder, "customer").select("c_custkey", geohash(lat, lon).alias("hash"))


@query(
    "geohash_u64",
    f"""WITH {SENSORS},
quantised AS (SELECT sensor_id, CAST(floor((lat + 90) / CAST(180 AS DOUBLE) * CAST(4294967296 AS DOUBLE)) AS BIGINT) AS qa,
  CAST(floor((lon + 180) / CAST(360 AS DOUBLE) * CAST(4294967296 AS DOUBLE)) AS BIGINT) AS qo FROM sensors),
bits AS (SELECT sensor_id, CAST(CASE WHEN g % 2 = 0 THEN (qo >> CAST(31 - g // 2 AS INT)) & 1
  ELSE (qa >> CAST(31 - g // 2 AS INT)) & 1 END AS HUGEINT) << CAST(63 - g AS INT) AS v
  FROM quantised, (SELECT unnest(range(64)) AS g))
SELECT sensor_id, CAST(sum(v) AS VARCHAR) AS hash_u64 FROM bits GROUP BY 1""",
)
def _(spark, folder):
    return sensors(spark, folder).select("sensor_id", geohash_u64("lat", "lon").alias("hash_u64"))


_KM = (
    "2 * CAST(6371.0088 AS DOUBLE) * asin(least(1, sqrt(pow(sin((radians({1}) - radians({0})) / 2), 2) + "
    "cos(radians({0})) * cos(radians({1})) * pow(sin((radians({3}) - radians({2})) / 2), 2))))"
)


def sql_km(lat1: str, lat2: str, lon1: str, lon2: str) -> str:
    return f"round({_KM.format(lat1, lat2, lon1, lon2)}, 6)"


@query(
    "pair_distance",
    f"""WITH p AS (SELECT l_orderkey, l_linenumber, {sql_lat('l_partkey')} AS a, {sql_lon('l_partkey')} AS b,
  {sql_lat('l_suppkey', 29)} AS c, {sql_lon('l_suppkey', 31)} AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, {sql_km('a', 'c', 'b', 'd')} AS km FROM p""",
)
def _(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        lat_of("l_partkey").alias("a"),
        lon_of("l_partkey").alias("b"),
        lat_of("l_suppkey", 29).alias("c"),
        lon_of("l_suppkey", 31).alias("d"),
    )
    return rows.select("l_orderkey", "l_linenumber", F.round(haversine_km("a", "b", "c", "d"), 6).alias("km"))


@query(
    "common_prefix",
    """SELECT c_custkey, (SELECT count(*) FROM (SELECT unnest(range(1, 13)) AS i)
  WHERE i <= length(c_name) AND i <= length(c_mktsegment || c_name) AND substr(substr(c_name, 10, 9), 1, i) = substr('000000123456', 1, i)
  AND i <= length(substr(c_name, 10, 9))) AS shared FROM customer""",
)
def _(spark, folder):
    digits = F.substring("c_name", 10, 9)
    shared = common_prefix_length(digits, F.lit("000000123456")).cast("long")
    return table(spark, folder, "customer").select("c_custkey", shared.alias("shared"))


@query(
    "parse_list_last",
    """SELECT event_id, TRY_CAST(trim(list_extract(string_split(regexp_replace(t, '[\\[\\]]', '', 'g'), ','), -1)) AS DOUBLE) AS lon
FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN '[' || value || ', ' || value / 2 || ']' WHEN 1 THEN CAST(value AS VARCHAR)
ELSE '[]' END AS t FROM events)""",
)
def _(spark, folder):
    value, half = F.col("value").cast("string"), (F.col("value") / 2).cast("string")
    listed = F.concat(F.lit("["), value, F.lit(", "), half, F.lit("]"))
    t = F.when(F.col("event_id") % 3 == 0, listed).when(F.col("event_id") % 3 == 1, value).otherwise("[]")
    return table(spark, folder, "events").select("event_id", text.last_number_of_list(t).alias("lon"))


_ARCHIVE = "url || '/stundenwerte_TU_' || lpad(CAST(page_id % 120 AS VARCHAR), 5, '0') || '_akt.zip'"


@query(
    "regex_station_id",
    f"""SELECT page_id, regexp_extract(u, 'stundenwerte_[A-Za-z0-9_]+\\.zip') AS file,
CAST(regexp_extract(u, '_(\\d{{5}})_', 1) AS INT) AS station FROM (SELECT page_id, {_ARCHIVE} AS u FROM pages)
WHERE CAST(regexp_extract(u, '_(\\d{{5}})_', 1) AS INT) IN (SELECT s_suppkey FROM supplier)""",
)
def _(spark, folder):
    tag = F.lpad((F.col("page_id") % 120).cast("string"), 5, "0")
    listing = table(spark, folder, "pages").select(
        "page_id", F.concat("url", F.lit("/stundenwerte_TU_"), tag, F.lit("_akt.zip")).alias("path")
    )
    kept = archives_of_stations(listing, table(spark, folder, "supplier"), station="s_suppkey")
    return kept.select("page_id", text.archive_name("path").alias("file"), text.station_id_from_name("path").alias("station"))


@query(
    "string_tools",
    """SELECT p_partkey, length(p_name) AS n, substr(p_name, 1, 5) AS head, replace(trim(p_name || '  '), ' ', '_') AS name,
printf('_%05d_', p_partkey) AS tag, regexp_replace(p_type, '[AEIOU]', '', 'g') AS short, string_split(p_name, ' ')[-1] AS tail FROM part""",
)
def _(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey",
        F.length("p_name").cast("long").alias("n"),
        F.substring("p_name", 1, 5).alias("head"),
        F.replace(F.trim(F.concat("p_name", F.lit("  "))), F.lit(" "), F.lit("_")).alias("name"),
        text.station_tag("p_partkey").alias("tag"),
        F.regexp_replace("p_type", "[AEIOU]", "").alias("short"),
        F.element_at(F.split("p_name", " "), -1).alias("tail"),
    )


@query(
    "packed_hour",
    f"""SELECT event_id, {sql_stamp("date_trunc('hour', ts)")} AS timestamp, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
{sql_stamp("date_trunc('hour', ts)")} AS rebuilt FROM events""",
)
def _(spark, folder):
    events = table(spark, folder, "events").withColumn("MESS_DATUM", F.date_format("ts", "yyyyMMddHH").cast("long"))
    rebuilt = hour_from_parts(F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts"))
    return events.select(
        "event_id",
        stamp(packed_hour("MESS_DATUM")).alias("timestamp"),
        F.to_date("ts").cast("string").alias("date"),
        stamp(rebuilt).alias("rebuilt"),
    )
