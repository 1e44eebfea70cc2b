"""Row and value cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airq.functions.geo import Box, in_box
from airq.operators.scale import keep_keys, lookup_join


def sentinel_to_null(df: DataFrame, columns: list[str], sentinels: tuple[float, ...] = (-999.0,)) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(c).isin(*sentinels), F.col(c)) for c in columns})


def negative_to_null(df: DataFrame, column: str = "value") -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) >= 0, F.col(column)))


def lenient_number(df: DataFrame, column: str = "value") -> DataFrame:
    """Text to double; text that is no number becomes null."""
    return df.withColumn(column, F.col(column).try_cast("double"))


def inside(df: DataFrame, box: Box, lat: str = "lat", lon: str = "lon") -> DataFrame:
    return df.where(in_box(lat, lon, box))


def since(df: DataFrame, start: Column | str, column: str = "timestamp") -> DataFrame:
    """Rows at or after ``start`` (a literal text or a scalar such as ``earliest(df, c)``)."""
    bound = F.lit(start) if isinstance(start, str) else start
    return df.where(F.col(column) >= bound)


def earliest(df: DataFrame, column: str) -> Column:
    """The smallest value of a column as a scalar subquery; nothing is collected."""
    return df.agg(F.min(column)).scalar()


def without_type(df: DataFrame, sensor_type: str = "PPD42NS", column: str = "sensor_type") -> DataFrame:
    """Drop one sensor type; rows without a type go too."""
    return df.where(F.col(column) != sensor_type)


def complete(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def usable_sensors(
    long: DataFrame, last_day: str, min_rows: int = 200, key: str = "sensor_id", by_variable: bool = False
) -> DataFrame:
    """Sensors still reporting on ``last_day`` with more than ``min_rows`` rows and some variation."""
    keys = [key, "variable"] if by_variable else [key]
    return (
        long.groupBy(*keys)
        .agg(
            F.to_date(F.min("timestamp")).alias("first_day"),
            F.to_date(F.max("timestamp")).alias("last_day"),
            F.count(F.lit(1)).alias("n"),
            F.stddev_samp("value").alias("sd"),
        )
        .where((F.col("last_day") == F.lit(last_day).cast("date")) & (F.col("n") > min_rows) & (F.col("sd") > 0))
    )


def keep_usable(df: DataFrame, usable: DataFrame, key: str = "sensor_id") -> DataFrame:
    return keep_keys(df, usable, [key])


def with_group_minimum(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """The group's minimum on every row, by a pre-aggregated lookup; null keys are a group."""
    return lookup_join(df, df.groupBy(*keys).agg(F.min(column).alias(name)), keys, null_safe=True)


def scale_by_maximum(df: DataFrame, keys: list[str], column: str = "value") -> DataFrame:
    """Divide by the group's maximum; null where that maximum is 0. Null keys are a group."""
    tops = df.groupBy(*keys).agg(F.max(column).alias("_top"))
    joined = lookup_join(df, tops, keys, null_safe=True)
    return joined.withColumn(column, F.try_divide(F.col(column), F.col("_top"))).drop("_top").select(*df.columns)
