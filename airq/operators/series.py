"""Series as arrays: one row per entity and calendar year, and back to rows.

The calendar year bounds the arrays by the bins of a year, whatever the length of a series or the number of
entities, so that results have one form at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airq import schemas
from airq.operators.scale import lookup_join


def build_series(
    df: DataFrame, keys: list[str], measures: list[str], ts: str = "timestamp", period: str = "year"
) -> DataFrame:
    """Parallel arrays in time order per key and calendar ``period``, with ``year`` (of the period's start), ``n``, ``first``, ``last``.

    Input is regular (one row per key and bin). Nulls keep their place in every array.
    """
    points = F.array_sort(F.collect_list(F.struct(F.col(ts).alias("_t"), *measures)))
    rows = df.groupBy(*keys, F.date_trunc(period, F.col(ts)).alias("period")).agg(
        points.alias("_points"), F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last")
    )
    arrays = [F.col(f"_points.{m}").alias(m) for m in measures]
    return rows.select(
        *keys, "period", F.year("period").alias("year"), "n", "first", "last", F.col("_points._t").alias("times"), *arrays
    )


def geo_series(aggregated: DataFrame) -> DataFrame:
    """Series table of the geo-time aggregate: ``hash, year, start_year`` and one array per measure.

    ``start_year`` is the first year of the whole hash, on each of its rows.
    """
    stamp = F.timestamp_seconds(
        F.unix_seconds(F.make_timestamp("year", "month", "day", F.lit(0), F.lit(0), F.lit(0))) + F.col("time_bin") * 900
    )
    series = build_series(aggregated.withColumn("timestamp", stamp), ["hash"], schemas.SERIES_MEASURES)
    started = aggregated.groupBy("hash").agg(F.min("year").cast("int").alias("start_year"))
    return lookup_join(series, started, ["hash"], null_safe=True).select(
        "hash", "year", "start_year", "times", *schemas.SERIES_MEASURES
    )


def long_series(series: DataFrame, min_length: int, measure: str = "P1", key: str = "hash") -> DataFrame:
    """Series with more than ``min_length`` points, counted over all years of an entity; ``N_<measure>`` is that count."""
    totals = series.groupBy(key).agg(F.sum(F.size(measure)).alias(f"N_{measure}")).where(F.col(f"N_{measure}") > min_length)
    return lookup_join(series, totals, [key], "inner", null_safe=True)


def series_to_rows(series: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Parallel arrays back to one row per point; ``position`` counts from 0 within a row's arrays."""
    return series.select(*keys, F.posexplode(F.arrays_zip(*measures)).alias("position", "_point")).select(
        *keys, "position", *[F.col(f"_point.{m}").alias(m) for m in measures]
    )


def tile_of(hash_column: str | Column, prefix: int = 5) -> Column:
    return F.substring(hash_column, 1, prefix)


def tile_series(series: DataFrame, measures: list[str], prefix: int = 5, key: str = "hash") -> DataFrame:
    """Series by geohash tile: ``hash_bin, start_year``, hash, year and its arrays.

    ``start_year`` is the latest of the tile's entities, on each of its rows. The hashes and years of a tile
    stay rows of their own, as a tile may hold any number of sensors.
    """
    tiled = series.withColumn("hash_bin", tile_of(key, prefix))
    started = tiled.groupBy("hash_bin").agg(F.max("start_year").alias("_tile_start"))
    joined = lookup_join(tiled, started, ["hash_bin"], null_safe=True)
    return joined.select("hash_bin", F.col("_tile_start").alias("start_year"), key, "year", *measures)


def coordinate_history(df: DataFrame, key: str = "sensor_id", ts: str = "timestamp") -> DataFrame:
    """Each distinct position of a sensor with the time it was first reported."""
    return df.groupBy(key, "lon", "lat").agg(F.min(ts).alias("first_seen"))


def sensor_dimension(df: DataFrame, key: str = "sensor_id", ts: str = "timestamp") -> DataFrame:
    """One row per sensor: location, type and position at its latest time, and the number of positions."""
    attributes = ["location", "sensor_type", "lon", "lat"]
    per_position = df.groupBy(key, "lon", "lat").agg(F.max(F.struct(F.col(ts), *attributes)).alias("_latest"))
    return (
        per_position.groupBy(key)
        .agg(F.max("_latest").alias("_latest"), F.count(F.lit(1)).alias("positions"))
        .select(key, *[F.col(f"_latest.{c}").alias(c) for c in attributes], "positions")
    )


def position_lists(df: DataFrame, key: str = "sensor_id", ts: str = "timestamp") -> DataFrame:
    """The positions of a sensor in order of appearance, one row each: ``key, rank, lon, lat, first_seen``."""
    order = Window.partitionBy(key).orderBy("first_seen", "lon", "lat")
    return coordinate_history(df, key, ts).select(key, F.row_number().over(order).alias("rank"), "lon", "lat", "first_seen")
