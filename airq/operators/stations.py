"""Weather stations: which are active, what they measure, which is nearest, and their readings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq import schemas
from airq.functions.stats import mean
from airq.operators.nearest import nearest_by_prefix, nearest_site
from airq.operators.scale import keep_keys, lookup_join

STATION_ATTRIBUTES = ["geoBreite", "geoLaenge", "Stationshoehe", "Stationsname"]


def active_stations(weather: DataFrame, cutoff: str, station: str = "STATIONS_ID", ts: str = "timestamp") -> DataFrame:
    """Stations with a reading on or after ``cutoff``, one row each with the latest attributes."""
    attributes = [c for c in STATION_ATTRIBUTES if c in weather.columns]
    latest = weather.groupBy(station).agg(
        F.max(ts).alias("last_seen"), F.max_by(F.struct(*attributes), F.struct(ts, *attributes)).alias("_a")
    )
    kept = latest.where(F.col("last_seen") >= F.lit(cutoff).cast("timestamp"))
    out = kept.select(station, *[F.col(f"_a.{c}").alias(c) for c in attributes])
    return out.withColumn("Stationsname", F.trim("Stationsname")) if "Stationsname" in attributes else out


def readings_of(weather: DataFrame, stations: DataFrame, station: str = "STATIONS_ID") -> DataFrame:
    return keep_keys(weather, stations, [station])


def capability_flags(stations: DataFrame, offers: DataFrame, station: str = "STATIONS_ID") -> DataFrame:
    """0/1 flag per product; ``offers`` has one or more rows ``(station, product)``."""
    flags = offers.groupBy(station).agg(
        *[F.max(F.when(F.col("product") == p, 1).otherwise(0)).alias(flag) for p, (flag, _) in schemas.CAPABILITIES.items()]
    )
    names = [flag for flag, _ in schemas.CAPABILITIES.values()]
    return lookup_join(stations, flags, [station]).fillna(0, subset=names)


def nearest_by_capability(
    sensors: DataFrame,
    stations: DataFrame,
    station: str = "STATIONS_ID",
    site_lat: str = "geoBreite",
    site_lon: str = "geoLaenge",
    with_km: bool = False,
) -> DataFrame:
    """Sensors with the nearest station of each capability; null where no station has it."""
    names = [closest for _, closest in schemas.CAPABILITIES.values()]
    flags = [F.col(flag).cast("int").alias(closest) for flag, closest in schemas.CAPABILITIES.values()]
    flagged = (
        stations.select(F.col(site_lat).alias("lat"), F.col(site_lon).alias("lon"), F.col(station).alias("_station"), *flags)
        .unpivot(["lat", "lon", "_station"], names, "_closest", "_flag")
        .where(F.col("_flag") == 1)
        .drop("_flag")
    )
    found = nearest_site(sensors, flagged, "_station", group="_closest")
    pick = [F.max(F.when(F.col("_closest") == n, F.col("_station"))).alias(n) for n in names]
    if with_km:
        pick += [F.max(F.when(F.col("_closest") == n, F.col("km"))).alias(f"{n}_km") for n in names]
    wide = found.groupBy("lat", "lon").agg(*pick)
    return lookup_join(sensors, wide, ["lat", "lon"])


def nearest_station_hash(df: DataFrame, stations: DataFrame, needle: str, site: str, out: str = "nearest") -> DataFrame:
    """Rows with the station hash that shares the longest geohash prefix."""
    found = nearest_by_prefix(df, stations, needle, site).select(needle, F.col("nearest").alias(out))
    return lookup_join(df, found, [needle])


def combine_products(products: dict[str, DataFrame], station: str = "STATIONS_ID", ts: str = "timestamp") -> DataFrame:
    """All products in one table with one row per station and hour, each product's columns null where it is silent.

    One aggregate over the union takes the place of a chain of outer joins. Of several rows of a product for
    one hour a whole one is kept (the largest), never a mixture.
    """
    aligned = [df.select(station, ts, F.struct(*schemas.WEATHER_COLUMNS[p]).alias(f"_{p}")) for p, df in products.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)
    packed = union.groupBy(station, ts).agg(*[F.max(f"_{p}").alias(f"_{p}") for p in products])
    fields = [F.col(f"_{p}.{c}").alias(c) for p in products for c in schemas.WEATHER_COLUMNS[p]]
    return packed.select(station, ts, *fields)


def join_weather(
    df: DataFrame,
    weather: DataFrame,
    closest: str,
    columns: list[str],
    station: str = "STATIONS_ID",
    ts: str = "timestamp",
) -> DataFrame:
    """Left join of each row with the reading of its station in the row's hour."""
    right = weather.select(
        F.col(station).alias(closest), F.date_trunc("hour", F.col(ts)).alias("_hour"), *[F.col(c) for c in columns]
    )
    left = df.withColumn("_hour", F.date_trunc("hour", F.col(ts)))
    return lookup_join(left, right, [closest, "_hour"]).drop("_hour").select(*df.columns, *columns)


def join_all_weather(df: DataFrame, products: dict[str, DataFrame], out: str = "dwddim", ts: str = "timestamp") -> DataFrame:
    """Each product from the nearest station that offers it, packed into one struct.

    Many rows share their stations and hour. The products are joined to these distinct combinations,
    and the rows meet the packed result once, whatever the number of products.
    """
    closest = [schemas.CAPABILITIES[p][1] for p in products]
    link = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in closest])
    keyed = df.withColumns({"_link": link, "_hour": F.date_trunc("hour", F.col(ts))})
    combined = keyed.select("_link", "_hour", *closest).where(F.col("_hour").isNotNull()).distinct()
    combined = combined.withColumnRenamed("_hour", "timestamp")
    for product, weather in products.items():
        combined = join_weather(combined, weather, schemas.CAPABILITIES[product][1], schemas.WEATHER_COLUMNS[product])
    fields = [c for p in products for c in schemas.WEATHER_COLUMNS[p]]
    packed = combined.select("_link", F.col("timestamp").alias("_hour"), F.struct(*fields).alias(out))
    return lookup_join(keyed, packed, ["_link", "_hour"]).select(*df.columns, out)


def weather_long(products: dict[str, DataFrame], station: str = "STATIONS_ID", ts: str = "timestamp") -> DataFrame:
    """Numeric weather columns as ``(station, timestamp, variable, value)``."""
    parts = []
    for product, df in products.items():
        columns = [c for c in schemas.WEATHER_COLUMNS[product] if c != "V_N_I"]
        parts.append(df.select(station, ts, *[F.col(c).cast("double") for c in columns]).unpivot([station, ts], columns, "variable", "value"))
    return reduce(DataFrame.unionByName, parts)


def location_wide(
    long: DataFrame, sensors: DataFrame, weather: DataFrame, variables: list[str], weather_variables: list[str]
) -> DataFrame:
    """Per location and time, the measurands side by side with the weather of the location's stations.

    The weather of a location starts where all its variables have started. Works on all locations at once.
    """
    names = [closest for _, closest in schemas.CAPABILITIES.values()]
    placed = lookup_join(long, sensors.select("sensor_id", "location"), ["sensor_id"], "inner")
    local = placed.groupBy("location", "timestamp").agg(
        *[mean(F.when(F.col("variable") == v, F.col("value"))).alias(v) for v in variables]
    )
    links = (
        sensors.select("location", F.explode(F.array(*names)).alias("STATIONS_ID"))
        .where(F.col("STATIONS_ID").isNotNull())
        .distinct()
    )
    first = weather.groupBy("STATIONS_ID", "variable").agg(F.min("timestamp").alias("_first"))
    begun = (
        links.join(first, "STATIONS_ID")
        .groupBy("location", "variable")
        .agg(F.min("_first").alias("_first"))
        .groupBy("location")
        .agg(F.max("_first").alias("_start"))
    )
    # Only the (location, hour) pairs that occur on the sensor side are looked up, station by station.
    asked = lookup_join(local.select("location", "timestamp"), begun, ["location"], "inner").where(
        F.col("timestamp") >= F.col("_start")
    )
    wanted = asked.join(links, "location").select("location", "timestamp", "STATIONS_ID")
    sums = [F.sum(F.when(F.col("variable") == v, F.col("value"))).alias(f"_s_{v}") for v in weather_variables]
    counts = [F.count(F.when(F.col("variable") == v, F.col("value"))).alias(f"_n_{v}") for v in weather_variables]
    per_station = weather.groupBy("STATIONS_ID", "timestamp").agg(*sums, *counts)
    totals = lookup_join(wanted, per_station, ["STATIONS_ID", "timestamp"], "inner").groupBy("location", "timestamp").agg(
        *[
            F.try_divide(F.sum(f"_s_{v}").cast("double"), F.sum(f"_n_{v}").cast("double")).alias(f"{v}DWD")
            for v in weather_variables
        ]
    )
    return local.join(totals, ["location", "timestamp"], "left")


def deviation_from_station(df: DataFrame, weather: DataFrame, closest: str = "closestTemp", column: str = "TT_TU") -> DataFrame:
    """Sensor value minus the reading of its reference station at the same time; rows without a station are left out."""
    joined = join_weather(df.where(F.col(closest).isNotNull()), weather, closest, [column])
    return joined.withColumn("diff", F.col("value") - F.col(column))
