"""Sensor inputs: archive CSV families, metadata CSV and the live JSON snapshot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airq import schemas
from airq.functions.text import last_number_of_list

SENSOR_TYPES = list(schemas.SENSOR_MEASURES)


def read_sensor_csv(spark: SparkSession, root: str, sensor_type: str, pattern: str | None = None) -> DataFrame:
    """All ``;`` CSV files of one sensor type below ``root``, with the type's declared schema.

    The type is part of the file name, unless another file name ``pattern`` is given.
    """
    return (
        spark.read.schema(schemas.sensor_schema(sensor_type))
        .option("sep", ";")
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern or f"*{sensor_type.lower()}*.csv")
        .csv(root)
    )


def to_observation(df: DataFrame) -> DataFrame:
    """Project to the unified columns; absent measurands become null doubles."""
    missing = {c: F.lit(None).cast("double") for c in schemas.MEASURES if c not in df.columns}
    return df.withColumns(missing).select(*schemas.OBSERVATION_COLUMNS)


def unify(frames: list[DataFrame]) -> DataFrame:
    """Union of differently shaped sensor tables in the unified columns."""
    return reduce(DataFrame.unionByName, [to_observation(f) for f in frames])


def read_sensor_archive(spark: SparkSession, root: str, sensor_types: list[str] | None = None) -> DataFrame:
    return unify([read_sensor_csv(spark, root, t) for t in sensor_types or SENSOR_TYPES])


def read_sensor_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Sensor dimension CSV with an index column and list-valued coordinates."""
    raw = spark.read.schema(schemas.SENSOR_METADATA).option("header", True).option("escape", '"').csv(path)
    return raw.drop("_c0").withColumns({c: last_number_of_list(c) for c in ("lon", "lat")})


def flatten_structs(df: DataFrame, separator: str = "_") -> DataFrame:
    """Every nested struct field as a top-level column named by its path."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield here

    return df.select(*[F.col(".".join(f"`{p}`" for p in path)).alias(separator.join(path)) for path in leaves(df.schema, ())])


def read_snapshot(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return spark.read.schema(schemas.SNAPSHOT).option("multiLine", multi_line).json(path)


def explode_snapshot(df: DataFrame) -> DataFrame:
    """One row per reading; snapshots without readings disappear."""
    readings = df.withColumn("reading", F.explode("sensordatavalues")).drop("sensordatavalues")
    return flatten_structs(readings)
