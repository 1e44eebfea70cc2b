"""Readings prepared for a picture of all sensors over time."""

from __future__ import annotations

from pyspark.sql import DataFrame

from airq.operators.clean import negative_to_null, scale_by_maximum, with_group_minimum
from airq.operators.quality import first_seen_order
from airq.operators.scale import lookup_join


def heatmap_table(long: DataFrame, key: str = "sensor_id", ts: str = "timestamp", value: str = "value") -> DataFrame:
    """Rows with negative values taken out, values as shares of the sensor's maximum, its first time and its place.

    Adds ``minDate`` and ``position``; sensors are placed in the order of their first appearance.
    """
    cleaned = negative_to_null(long, value)
    scaled = scale_by_maximum(with_group_minimum(cleaned, [key], ts, "minDate"), [key], value)
    places = first_seen_order(long, key, ts).select(key, "position")
    return lookup_join(scaled, places, [key], null_safe=True)
