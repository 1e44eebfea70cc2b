"""Readers and writers: the driver tables are written in the input formats and read back."""

from __future__ import annotations

import datetime as dt
import io
import os
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from airq.functions.text import sanitise_columns
from airq.queries.base import FAMILY_UNION, OBS, families, lat_of, lon_of, observations, query, sql_lat, sql_lon, sql_stamp, stamp, table
from airq.session import scratch_path
from airq.sources.archives import local_path
from airq.sources.sensors import explode_snapshot, flatten_structs, read_sensor_csv, read_sensor_metadata, read_snapshot, unify
from airq.sources.tables import local_rows, write_csv_report, write_snapshot, write_table
from airq.sources.weather import (
    clean_product,
    combine_tiers,
    parse_product,
    parse_station_catalogue,
    read_product,
    read_station_catalogue,
    rejected_archives,
    unpack_archives,
    with_station_attributes,
)

_UNIFIED_SQL = f"WITH {FAMILY_UNION} SELECT * REPLACE ({sql_stamp('timestamp')} AS timestamp) FROM unified"


@query("schema_union", _UNIFIED_SQL)
def _(spark, folder):
    unified = unify(list(families(spark, folder).values()))
    return unified.withColumn("timestamp", stamp("timestamp"))


@query("csv_families", _UNIFIED_SQL)
def _(spark, folder):
    frames = []
    for sensor_type, rows in families(spark, folder).items():
        path = scratch_path(spark, sensor_type.lower())
        rows.write.option("sep", ";").option("header", True).option(
            "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
        ).csv(path)
        frames.append(read_sensor_csv(spark, path, sensor_type, pattern="*.csv"))
    return unify(frames).withColumn("timestamp", stamp("timestamp"))


@query(
    "sensor_csv",
    f"SELECT CAST(c_custkey AS INT) AS sensor_id, c_nationkey AS location, c_mktsegment AS sensor_type, "
    f"{sql_lon('c_custkey')} AS lon, {sql_lat('c_custkey')} AS lat FROM customer",
)
def _(spark, folder):
    path = scratch_path(spark, "sensors")
    lon, lat = lon_of("c_custkey").cast("string"), lat_of("c_custkey").cast("string")
    table(spark, folder, "customer").select(
        F.col("c_custkey").alias("_c0"),
        F.col("c_custkey").alias("sensor_id"),
        F.col("c_nationkey").alias("location"),
        F.col("c_mktsegment").alias("sensor_type"),
        F.concat(F.lit("[1.5, "), lon, F.lit("]")).alias("lon"),
        lat.alias("lat"),
    ).write.option("header", True).csv(path)
    return read_sensor_metadata(spark, path)


@query(
    "json_snapshot",
    f"WITH {OBS} SELECT event_id AS id, sensor_id AS location_id, event_id * 2 AS reading_id, "
    "CAST(value AS VARCHAR) AS reading_value, variable AS reading_value_type FROM obs WHERE variable <> 'error'",
)
def _(spark, folder):
    path = scratch_path(spark, "snapshot")
    reading = F.struct(
        (F.col("event_id") * 2).alias("id"), F.col("value").cast("string").alias("value"), F.col("variable").alias("value_type")
    )
    observations(spark, folder).select(
        F.col("event_id").alias("id"),
        F.struct(F.col("sensor_id").alias("id")).alias("location"),
        F.when(F.col("variable") != "error", F.array(reading)).otherwise(F.array()).alias("sensordatavalues"),
    ).write.json(path)
    return explode_snapshot(read_snapshot(spark, path, multi_line=False))


@query(
    "json_explode",
    "SELECT event_id, user_id AS location_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS reading_k FROM events",
)
def _(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id",
        F.struct(F.col("user_id").alias("id")).alias("location"),
        F.explode(F.array(F.from_json("props", "k long"))).alias("reading"),
    )
    return flatten_structs(rows)


_CATALOGUE = (
    f"SELECT CAST(s_suppkey + 1 AS INT) AS Stations_id, round({sql_lat('s_suppkey', 29)}, 4) AS geoBreite, "
    f"round({sql_lon('s_suppkey', 31)}, 4) AS geoLaenge, s_name || ' ü' AS Stationsname, 'NATION ' || s_nationkey AS Bundesland "
    "FROM supplier"
)


@query("station_catalogue", _CATALOGUE)
def _(spark, folder):
    path = scratch_path(spark, "catalogue")
    line = F.format_string(
        "%05d 20000101 20181231 %14d %12.4f %9.4f %-40s %s",
        F.col("s_suppkey") + 1,
        F.lit(300),
        lat_of("s_suppkey", 29),
        lon_of("s_suppkey", 31),
        F.concat("s_name", F.lit(" ü")),
        F.concat(F.lit("NATION "), F.col("s_nationkey").cast("string")),
    )
    table(spark, folder, "supplier").select(line.alias("line")).write.option("encoding", "ISO-8859-1").option(
        "sep", "\u0001"
    ).option("quote", "").csv(path)
    return read_station_catalogue(spark, path).select("Stations_id", "geoBreite", "geoLaenge", "Stationsname", "Bundesland")


@query("station_lines", _CATALOGUE.replace(" || ' ü'", ""))
def _(spark, folder):
    line = F.format_string(
        "%05d 20000101 20181231 %14d %12.4f %9.4f %-40s %s",
        F.col("s_suppkey") + 1,
        F.lit(300),
        lat_of("s_suppkey", 29),
        lon_of("s_suppkey", 31),
        F.col("s_name"),
        F.concat(F.lit("NATION "), F.col("s_nationkey").cast("string")),
    )
    header = F.when(F.col("s_suppkey") % 10 == 0, F.lit("Stations_id von_datum bis_datum")).otherwise(F.lit("----------- ---------"))
    lines = table(spark, folder, "supplier").select(F.explode(F.array(header, line)).alias("line"))
    return parse_station_catalogue(lines).select("Stations_id", "geoBreite", "geoLaenge", "Stationsname", "Bundesland")


def _zip_batches(batches):
    """Each batch of lines as one archive; every archive is bounded by the batch size."""
    for number, batch in enumerate(batches):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("readme.txt", "no data")
            body = "STATIONS_ID;MESS_DATUM;QN_9; TT_TU;RF_TU;eor\n" + "\n".join(batch["line"]) + "\n"
            archive.writestr(f"produkt_tu_{number}.txt", body)
        yield pd.DataFrame({"path": [f"stundenwerte_TU_{number:05d}_akt.zip"], "content": [buffer.getvalue()]})


def _archives(spark, folder):
    line = F.format_string(
        "%11d;%s;%5d;%6.2f;%6d;eor",
        "sensor_id",
        F.date_format("timestamp", "yyyyMMddHH"),
        F.lit(3),
        F.when(F.col("variable") == "error", F.lit(-999.0)).otherwise(F.col("value").cast("double")),
        F.col("event_id"),
    )
    return observations(spark, folder).select(line.alias("line")).mapInPandas(_zip_batches, "path string, content binary")


@query(
    "product_archives",
    f"WITH {OBS} SELECT CAST(sensor_id AS INT) AS STATIONS_ID, {sql_stamp("date_trunc('hour', timestamp)")} AS timestamp, "
    "CASE WHEN variable <> 'error' THEN CAST(value AS DOUBLE) END AS TT_TU, CAST(event_id AS DOUBLE) AS RF_TU FROM obs",
)
def _(spark, folder):
    rows = parse_product(unpack_archives(_archives(spark, folder)), "temperature")
    return rows.select("STATIONS_ID", stamp("timestamp").alias("timestamp"), "TT_TU", "RF_TU")


def _write_archives(rows, root: str, tier: str) -> None:
    """One archive per station below ``root``, its lines streamed to the file; station 0 has a broken one besides."""
    folder = local_path(root)
    os.makedirs(folder, exist_ok=True)

    def write(batches):
        path, archive, member = None, None, None

        def close():
            if path is not None:
                member.close()
                archive.close()
                os.replace(f"{path}.part", path)

        for batch in batches:
            for station, own in batch.groupby("station", sort=False):
                name = f"{folder}/stundenwerte_TU_{station:05d}_{tier}.zip"
                if name != path:
                    close()
                    path = name
                    archive = zipfile.ZipFile(f"{path}.part", "w", zipfile.ZIP_DEFLATED)
                    archive.writestr("readme.txt", "no data")
                    member = archive.open(f"produkt_tu_{station:05d}.txt", "w")
                    member.write(b"STATIONS_ID;MESS_DATUM;QN_9; TT_TU;RF_TU;eor\n")
                member.write(("\n".join(own["line"]) + "\n").encode())
        close()
        if path is not None:
            yield pd.DataFrame({"written": [1]})

    with open(f"{folder}/stundenwerte_TU_00000_broken.zip", "w") as f:
        f.write("no archive")
    rows.repartition("station").sortWithinPartitions("station", "line").mapInPandas(write, "written int").write.format("noop").mode("append").save()


_TIER = "SELECT sensor_id % 20 AS STATIONS_ID, date_trunc('hour', timestamp) AS timestamp, {how}(value) AS t, count(*) AS n, {tier} AS tier FROM obs WHERE variable IN ({names}) GROUP BY 1, 2"
_TIERS = (
    _TIER.format(how="max", tier=0, names="'view', 'click', 'signup'") + " UNION ALL " + _TIER.format(how="min", tier=1, names="'view', 'error', 'purchase'")
)


@query(
    "archive_scan",
    f"""WITH {OBS}, tiers AS ({_TIERS}), best AS (SELECT STATIONS_ID, timestamp, arg_max(t, tier) AS t, arg_max(n, tier) AS n FROM tiers GROUP BY 1, 2)
SELECT CAST(b.STATIONS_ID AS INT) AS STATIONS_ID, {sql_stamp('timestamp')} AS timestamp, CASE WHEN t <> 0 THEN CAST(t AS DOUBLE) END AS TT_TU,
CASE WHEN n > 1 THEN CAST(n AS DOUBLE) END AS RF_TU, s_name AS Stationsname FROM best b JOIN supplier ON s_suppkey = b.STATIONS_ID WHERE s_suppkey % 3 = 1""",
)
def _(spark, folder):
    """Zip files of both tiers written to the shared folder and read back as one product of some stations, with their names."""
    rows = observations(spark, folder).withColumn("station", (F.col("sensor_id") % 20).cast("int"))
    roots = []
    for tier, how, names in (("hist", F.max, ["view", "click", "signup"]), ("akt", F.min, ["view", "error", "purchase"])):
        hours = rows.where(F.col("variable").isin(names)).groupBy("station", F.date_trunc("hour", "timestamp").alias("hour"))
        readings = hours.agg(how("value").cast("double").alias("t"), F.count(F.lit(1)).alias("n"))
        line = F.format_string(
            "%11d;%s;%5d;%8.2f;%6d;eor",
            "station",
            F.date_format("hour", "yyyyMMddHH"),
            F.lit(3),
            F.when(F.col("t") == 0, F.lit(-999.0)).otherwise(F.col("t")),
            F.when(F.col("n") > 1, F.col("n")).otherwise(F.lit(-999)),
        )
        roots.append(scratch_path(spark, f"archives-{tier}"))
        _write_archives(readings.select("station", line.alias("line")), roots[-1], tier)
    catalogue = table(spark, folder, "supplier").where("s_suppkey % 3 = 1")
    catalogue = catalogue.select(F.col("s_suppkey").cast("int").alias("Stations_id"), F.col("s_name").alias("Stationsname"))
    found = with_station_attributes(read_product(spark, *roots, "temperature", catalogue), catalogue)
    return found.select("STATIONS_ID", stamp("timestamp").alias("timestamp"), "TT_TU", "RF_TU", "Stationsname")


@query("rejected_archives", "SELECT count(*) AS rejected FROM pages")
def _(spark, folder):
    broken = table(spark, folder, "pages").select(F.col("url").alias("path"), F.encode("html", "UTF-8").alias("content"))
    return rejected_archives(unpack_archives(broken)).agg(F.count("error").alias("rejected"))


@query(
    "two_tier_load",
    f"""WITH {OBS}, tiers AS (SELECT sensor_id AS STATIONS_ID, date_trunc('day', timestamp) AS timestamp, max(value) AS TT_TU, 0 AS tier
FROM obs WHERE variable IN ('view', 'click', 'signup') GROUP BY 1, 2 UNION ALL
SELECT sensor_id, date_trunc('day', timestamp), min(value), 1 FROM obs WHERE variable IN ('view', 'error', 'purchase') GROUP BY 1, 2)
SELECT STATIONS_ID, {sql_stamp('timestamp')} AS timestamp, CAST(arg_max(TT_TU, tier) AS DOUBLE) AS TT_TU FROM tiers
GROUP BY STATIONS_ID, timestamp""",
)
def _(spark, folder):
    rows = observations(spark, folder).withColumn("timestamp", F.date_trunc("day", "timestamp"))
    keys = [F.col("sensor_id").alias("STATIONS_ID"), "timestamp"]
    older = rows.where(F.col("variable").isin("view", "click", "signup")).groupBy(*keys).agg(F.max("value").alias("TT_TU"))
    newer = rows.where(F.col("variable").isin("view", "error", "purchase")).groupBy(*keys).agg(F.min("value").alias("TT_TU"))
    both = combine_tiers(older, newer)
    return both.select("STATIONS_ID", stamp("timestamp").alias("timestamp"), F.col("TT_TU").cast("double").alias("TT_TU"))


@query(
    "clean_product",
    f"WITH {OBS} SELECT sensor_id AS STATIONS_ID, event_id, CASE WHEN variable <> 'view' THEN CAST(value AS DOUBLE) END AS TT_TU, "
    f"{sql_stamp("date_trunc('hour', timestamp)")} AS timestamp FROM obs",
)
def _(spark, folder):
    raw = observations(spark, folder).select(
        F.col("sensor_id").alias("STATIONS_ID"),
        F.date_format("timestamp", "yyyyMMddHH").alias("MESS_DATUM"),
        F.lit(1.0).alias("QN_9"),
        F.when(F.col("variable") == "view", F.lit(-999.0)).otherwise(F.col("value").cast("double")).alias("TT_TU"),
        F.lit(1.0).alias("RF_TU"),
        F.lit("eor").alias("eor"),
        "event_id",
    )
    cleaned = clean_product(raw, "temperature")
    assert "eor" not in cleaned.columns
    return cleaned.select("STATIONS_ID", "event_id", "TT_TU", stamp("timestamp").alias("timestamp"))


@query("parquet_roundtrip", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def _(spark, folder):
    path = scratch_path(spark, "lineitem")
    write_table(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"), path, ["l_returnflag"])
    return spark.read.parquet(path)


@query("dated_snapshot", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return spark.read.parquet(write_snapshot(rows, scratch_path(spark, "snapshots"), "orders", dt.date(2018, 1, 31)))


@query("csv_report", "SELECT c_custkey, c_name, '[' || c_nationkey || ',' || c_nationkey + 1 || ']' AS pair FROM customer")
def _(spark, folder):
    path = scratch_path(spark, "report")
    pair = F.array(F.col("c_nationkey"), F.col("c_nationkey") + 1)
    write_csv_report(table(spark, folder, "customer").select("c_custkey", "c_name", pair.alias("pair")), path)
    schema = "c_custkey long, c_name string, pair string"
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@query("sanitise_names", "SELECT n_nationkey AS Station_Nr, n_name AS Stationsname FROM nation")
def _(spark, folder):
    odd = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias(" Station Nr "), F.col("n_name").alias("Stations:name?")
    )
    return sanitise_columns(odd)


@query(
    "local_dimension",
    "SELECT e.event_id, v.label FROM events e JOIN (VALUES ('view', 'DHT22'), ('click', 'SDS011')) v(event_type, label) "
    "ON e.event_type = v.event_type",
)
def _(spark, folder):
    labels = local_rows(spark, [("view", "DHT22"), ("click", "SDS011")], "event_type string, label string")
    return table(spark, folder, "events").join(labels, "event_type").select("event_id", "label")
