"""Observations to the hourly table, the gap-free long table and the quality figures of each series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.functions.stats import mean
from airq.operators.clean import keep_usable, usable_sensors
from airq.operators.kpi import native_kpis
from airq.operators.kpi_fit import fitted_kpis
from airq.operators.resample import HOUR, bin_means, gap_fill, unpivot_measures
from airq.operators.scale import lookup_join
from airq.operators.series import sensor_dimension
from airq.session import materialise

HOURLY_MEASURES = ["P1", "P2", "humidity", "temperature"]
SERIES_KEYS = ["location", "sensor_type", "sensor_id", "variable"]


def hourly_table(observations: DataFrame, measures: list[str] | None = None, step: int = HOUR) -> DataFrame:
    return bin_means(observations, ["sensor_id"], measures or HOURLY_MEASURES, step)


def long_table(hourly: DataFrame, last_day: str | None = None, min_rows: int = 200, step: int = HOUR) -> DataFrame:
    """Gap-free ``(sensor_id, variable, timestamp, value)`` of the usable sensors."""
    measures = [c for c in hourly.columns if c not in ("sensor_id", "timestamp")]
    long = unpivot_measures(hourly, ["sensor_id", "timestamp"], measures).where(F.col("value").isNotNull())
    if last_day:
        long = keep_usable(long, usable_sensors(long, last_day, min_rows))
    return gap_fill(long, ["sensor_id", "variable"], step)


def series_kpis(long: DataFrame, sensors: DataFrame, width: int = 48, lags: int = 24) -> DataFrame:
    """All 19 figures per location, sensor type, sensor and variable; null labels are values like others.

    The long table is written once, as several passes read it.
    """
    labels = sensors.select("sensor_id", "location", "sensor_type")
    labelled = materialise(lookup_join(long, labels, ["sensor_id"], "inner", null_safe=True))
    native = native_kpis(labelled, SERIES_KEYS, width=width)
    return lookup_join(native, fitted_kpis(labelled, SERIES_KEYS, width=width, lags=lags), SERIES_KEYS, "inner", null_safe=True)


def sensor_kpis(observations: DataFrame, last_day: str | None = None, min_rows: int = 200) -> DataFrame:
    hourly = hourly_table(observations)
    return series_kpis(long_table(hourly, last_day, min_rows), sensor_dimension(observations))


def coverage(long: DataFrame, key: str = "sensor_id", step: int = HOUR) -> DataFrame:
    """Per sensor: first and last bin, bins of the complete grid, filled bins and the mean value."""
    binned = bin_means(long, [key], ["value"], step)
    complete = gap_fill(binned, [key], step)
    return complete.groupBy(key).agg(
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
        F.count(F.lit(1)).alias("bins"),
        F.sum(F.col("value").isNull().cast("long")).alias("filled"),
        mean("value").alias("mean"),
    )
