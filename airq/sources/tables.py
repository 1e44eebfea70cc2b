"""Parquet and CSV reading and writing."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a parquet table, split into folders by ``partition_by``."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def snapshot_path(root: str, name: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/{name}.{day:%Y-%m-%d}.parquet"


def write_snapshot(df: DataFrame, root: str, name: str, day: dt.date) -> str:
    """Write a dated copy and return its path."""
    path = snapshot_path(root, name, day)
    write_table(df, path)
    return path


def write_csv_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header, nested columns as JSON text.

    One file means one writing task, so ``single_file`` is for small reports only.
    """
    flat = df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    (flat.coalesce(1) if single_file else flat).write.mode("overwrite").option("header", True).csv(path)


def local_rows(spark: SparkSession, rows: pd.DataFrame | list, schema: str | T.StructType) -> DataFrame:
    """A small dimension given on the driver."""
    return spark.createDataFrame(rows, schema=schema)


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))
