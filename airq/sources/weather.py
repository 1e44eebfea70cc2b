"""Weather-service inputs: station catalogue and zipped hourly product archives."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airq import schemas
from airq.functions.calendar import packed_hour
from airq.functions.geo import Box, in_box
from airq.functions.text import archive_name, station_id_from_name
from airq.operators.clean import sentinel_to_null
from airq.operators.scale import lookup_join
from airq.sources.archives import UNREADABLE, local_path, product_lines, scan_archives

# Fixed width catalogue line: number, two dates, height, latitude, longitude, name, state.
_CATALOGUE_LINE = r"^\s*(\d+)\s+(\d{8})\s+(\d{8})\s+(-?\d+)\s+(-?[\d.]+)\s+(-?[\d.]+)\s+(.+?)\s{2,}(\S.*?)\s*$"
_CATALOGUE_FIELDS = [
    ("Stations_id", "int"),
    ("von_datum", "string"),
    ("bis_datum", "string"),
    ("Stationshoehe", "double"),
    ("geoBreite", "double"),
    ("geoLaenge", "double"),
    ("Stationsname", "string"),
    ("Bundesland", "string"),
]

ARCHIVE_LINES = "path string, name string, header string, line string, error string"


def read_station_catalogue(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Station catalogue; the two header lines and malformed lines do not match and drop out."""
    lines = spark.read.schema("line string").option("encoding", encoding).option("sep", "\u0001").option("quote", "").csv(path)
    return parse_station_catalogue(lines)


def parse_station_catalogue(lines: DataFrame) -> DataFrame:
    found = lines.where(F.col("line").rlike(_CATALOGUE_LINE))
    return found.select(
        *[
            F.regexp_extract("line", _CATALOGUE_LINE, i).try_cast(kind).alias(name)
            for i, (name, kind) in enumerate(_CATALOGUE_FIELDS, start=1)
        ]
    )


def stations_in_box(catalogue: DataFrame, box: Box) -> DataFrame:
    return catalogue.where(in_box("geoBreite", "geoLaenge", box))


# Station numbers that are pushed to the file names; a catalogue has about a thousand. More are looked up by a join.
PUSHED = 10_000


def station_numbers(stations: DataFrame, station: str = "Stations_id") -> list[int] | None:
    """The numbers of a catalogue, None if there are more than ``PUSHED``."""
    rows = stations.select(F.col(station).cast("int").alias("n")).dropna().distinct().limit(PUSHED + 1).collect()
    return sorted(r["n"] for r in rows) if len(rows) <= PUSHED else None


def read_archives(spark: SparkSession, root: str, stations: DataFrame | None = None) -> DataFrame:
    """Zip archives below ``root`` in any store as ``(path, content)``, one row per file.

    With ``stations`` only the archives of these stations are kept. Up to ``PUSHED`` of them become part of the
    name pattern with which Spark lists the files, so that others are not read.
    """
    numbers = station_numbers(stations) if stations is not None else None
    middle = "*" if numbers is None else "*_{" + ",".join(f"{n:05d}" for n in numbers or [-1]) + "}_*"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"stundenwerte_{middle}.zip")
    found = files.load(root).select("path", "content")
    return found if stations is None else archives_of_stations(found, stations)


def read_lines(spark: SparkSession, root: str, stations: DataFrame) -> DataFrame:
    """Lines of the archives of the given stations: as a scan where the folder can be opened, else through Spark's file reader."""
    if local_path(root) is None:
        return unpack_archives(read_archives(spark, root, stations))
    lines = scan_archives(spark, root, station_numbers(stations))
    wanted = stations.select(F.col("Stations_id").cast("int").alias("station")).distinct()
    return lines.join(wanted, "station", "left_semi").drop("station")


def archives_of_stations(files: DataFrame, stations: DataFrame, path: str = "path", station: str = "Stations_id") -> DataFrame:
    """Files whose name is a product archive of one of the stations."""
    wanted = stations.select(F.col(station).cast("int").alias("_station")).distinct()
    named = files.where(archive_name(path).isNotNull()).withColumn("_station", station_id_from_name(path))
    return named.join(wanted, "_station", "left_semi").drop("_station")


def _archive_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of the product member of every archive; one error row for an unreadable one."""
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            try:
                for name, header, lines in product_lines(io.BytesIO(content)):
                    yield pd.DataFrame({"path": path, "name": name, "header": header, "line": lines, "error": None})
            except UNREADABLE as problem:
                yield pd.DataFrame({"path": [path], "name": None, "header": None, "line": None, "error": [str(problem)]})


def unpack_archives(archives: DataFrame) -> DataFrame:
    """Lines of all archives; unreadable archives are the rows with a non-null ``error``."""
    return archives.mapInPandas(_archive_lines, ARCHIVE_LINES)


def rejected_archives(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("error").isNotNull()).select("path", "error")


def parse_product(lines: DataFrame, product: str, sentinels: tuple[float, ...] = (-999.0,)) -> DataFrame:
    """Product rows: columns found by their header name, ``eor`` left out, sentinels null.

    A line with fewer cells than the header has nulls for the rest; blank lines are no rows.
    """
    names = F.transform(F.split("header", ";"), lambda c: F.trim(c))
    cells = F.transform(F.split("line", ";"), lambda c: F.trim(c))
    row = F.map_from_arrays(names, F.transform(names, lambda c, i: F.try_element_at(cells, i + 1)))
    schema = schemas.product_schema(product)
    ok = lines.where(F.col("error").isNull() & (F.trim("line") != "")).withColumn("_row", row)
    typed = ok.select(
        "path", *[F.try_element_at("_row", F.lit(f.name)).try_cast(f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    )
    return clean_product(typed, product, sentinels)


def clean_product(df: DataFrame, product: str, sentinels: tuple[float, ...] = (-999.0,)) -> DataFrame:
    """Drop the end-of-record column, add the timestamp and turn sentinels into null."""
    numeric = [c for c in schemas.PRODUCT_COLUMNS[product] if c != "V_N_I"]
    stamped = df.drop("eor").withColumn("timestamp", packed_hour("MESS_DATUM"))
    return sentinel_to_null(stamped, numeric, sentinels)


def combine_tiers(historical: DataFrame, recent: DataFrame, keys: tuple[str, ...] = ("STATIONS_ID", "timestamp")) -> DataFrame:
    """Both tiers with one row per key; a key present in both keeps the recent row.

    Ties inside one tier (the same hour in two files) are settled on the row's own values, so the
    choice does not depend on the order rows arrive in.
    """
    both = historical.withColumn("_tier", F.lit(0)).unionByName(recent.withColumn("_tier", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (*keys, "_tier")]
    best = both.groupBy(*keys).agg(F.max(F.struct("_tier", *rest)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])


def read_product(spark: SparkSession, historical_root: str, recent_root: str, product: str, stations: DataFrame) -> DataFrame:
    """One hourly product of the given stations from both tiers."""
    tiers = []
    for root in (historical_root, recent_root):
        tiers.append(parse_product(read_lines(spark, root, stations), product).drop("path"))
    return combine_tiers(*tiers)


def with_station_attributes(product: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Product rows with the station's attributes."""
    dim = catalogue.withColumnRenamed("Stations_id", "STATIONS_ID").dropDuplicates(["STATIONS_ID"])
    return lookup_join(product, dim, ["STATIONS_ID"], "inner")
