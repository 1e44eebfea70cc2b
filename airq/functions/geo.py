"""Geohash, distance and bounding-box column expressions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the geohash base-32 alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
EARTH_RADIUS_KM = 6371.0088


class Box(NamedTuple):
    """Open box: points on an edge are outside."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


# The two areas of interest.
REGION = Box(48.3, 49.1, 8.9, 9.5)
CITY = Box(48.6, 49.0, 9.0, 9.4)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_box(lat: str | Column, lon: str | Column, box: Box) -> Column:
    la, lo = _col(lat), _col(lon)
    return (la > F.lit(box.lat_min)) & (la < F.lit(box.lat_max)) & (lo > F.lit(box.lon_min)) & (lo < F.lit(box.lon_max))


def _quantised(lat: Column, lon: Column, bits: int) -> tuple[Column, Column]:
    """Both coordinates as integers of ``bits`` bits.

    Null when either is null, 0, NaN or infinite, or when the latitude is outside [-90, 90]. Longitudes are
    taken round the globe into [-180, 180); the north pole belongs to the last cell below it.
    """
    known = ~F.isnan(lat) & ~F.isnan(lon) & (F.abs(lon) < F.lit(1e15))
    present = known & (lat != 0) & (lon != 0) & (lat >= F.lit(-90.0)) & (lat <= F.lit(90.0))
    scale = F.lit(float(1 << bits))
    turns = F.floor((lon + F.lit(180.0)) / F.lit(360.0)).cast("double")
    east = F.when((lon < -180) | (lon >= 180), lon - turns * F.lit(360.0)).otherwise(lon)
    last = F.lit((1 << bits) - 1).cast("bigint")
    qa = F.when(present, F.least(F.floor((lat + F.lit(90.0)) / F.lit(180.0) * scale), last))
    qo = F.when(present, F.least(F.floor((east + F.lit(180.0)) / F.lit(360.0) * scale), last))
    return qa, qo


def _spread(q: Column, kind: str) -> Column:
    """A zero bit before every bit: the binary digits read as digits of base 4."""
    return F.conv(F.bin(q), 4, 10).cast(kind)


def geohash(lat: str | Column, lon: str | Column, precision: int = 12) -> Column:
    """Base-32 geohash of up to 12 characters; null for a coordinate that has none (see ``_quantised``)."""
    qa, qo = _quantised(_col(lat), _col(lon), 30)
    code = _spread(qo, "bigint") * 2 + _spread(qa, "bigint")
    digits = F.lpad(F.conv(code.cast("string"), 10, 32), 12, "0")
    return F.substring(F.translate(digits, BASE32_DIGITS, GEOHASH_ALPHABET), 1, precision)


def geohash_u64(lat: str | Column, lon: str | Column) -> Column:
    """The 64-bit geohash as an unsigned decimal string; null for a coordinate that has none."""
    qa, qo = _quantised(_col(lat), _col(lon), 32)
    wide = "decimal(20,0)"
    return (_spread(qo, wide) * 2 + _spread(qa, wide)).cast(wide).cast("string")


def geohash_struct(lat: str | Column, lon: str | Column, prefix: int = 8) -> Column:
    code = geohash(lat, lon)
    return F.struct(
        code.alias("hash"),
        geohash_u64(lat, lon).alias("hash_u64"),
        F.substring(code, 1, prefix).alias("hash_bin"),
    )


def add_geohash(df: DataFrame, lat: str = "lat", lon: str = "lon", out: str = "geohash", prefix: int = 8) -> DataFrame:
    return df.withColumn(out, geohash_struct(lat, lon, prefix))


def haversine_km(lat1: str | Column, lon1: str | Column, lat2: str | Column, lon2: str | Column) -> Column:
    p1, p2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    dp, dl = p2 - p1, F.radians(_col(lon2)) - F.radians(_col(lon1))
    a = F.pow(F.sin(dp / 2), F.lit(2.0)) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), F.lit(2.0))
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def common_prefix_length(a: str | Column, b: str | Column, width: int = 12) -> Column:
    """Number of leading characters two texts share, up to ``width``."""
    x, y = _col(a), _col(b)
    hits = [
        F.when((F.length(x) >= i) & (F.length(y) >= i) & (F.substring(x, 1, i) == F.substring(y, 1, i)), 1).otherwise(0)
        for i in range(1, width + 1)
    ]
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return total


def unit_vector(lat: str | Column, lon: str | Column) -> tuple[Column, Column, Column]:
    p, l = F.radians(_col(lat)), F.radians(_col(lon))
    return F.cos(p) * F.cos(l), F.cos(p) * F.sin(l), F.sin(p)
