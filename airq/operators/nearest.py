"""Exact nearest-neighbour joins without comparing every pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airq.functions.geo import haversine_km, unit_vector
from airq.operators.scale import lookup_join

# The unit cube around the earth is split into 2**bits cells per axis; the last cells are about 50 m wide.
LEVEL_BITS = (3, 8, 13, 18)
# Slack for rounding and for distances that count as equal (a few millimetres, on a unit sphere).
SLACK = 1e-9
_AXES = ("x", "y", "z")


def _finest_cell(v: Column) -> Column:
    cells = 1 << LEVEL_BITS[-1]
    index = F.floor((v + F.lit(1.0)) / F.lit(2.0) * F.lit(float(cells)))
    return F.greatest(F.lit(0), F.least(F.lit(cells - 1), index)).cast("int")


def _with_vector(df: DataFrame, lat: str, lon: str) -> DataFrame:
    x, y, z = unit_vector(lat, lon)
    return df.withColumns({"x": x, "y": y, "z": z})


def _squared_gap(axis: str, width: float) -> Column:
    low = F.col(f"c{axis}") * F.lit(width) - F.lit(1.0)
    gap = F.greatest(low - F.col(axis), F.col(axis) - (low + F.lit(width)), F.lit(0.0))
    return gap * gap


def _squared_difference(axis: str, other: Column) -> Column:
    d = F.col(axis) - other
    return d * d


def nearest_site(
    points: DataFrame,
    sites: DataFrame,
    site_id: str,
    lat: str = "lat",
    lon: str = "lon",
    group: str | None = None,
    exclude_same_place: bool = False,
) -> DataFrame:
    """The nearest site of every distinct point, as ``(lat, lon[, group], site_id, km)``.

    Both tables carry ``lat`` and ``lon``; with ``group``, the nearest site of each value of that column
    is found. Distances equal to the millimetre go to the smallest id.

    Space is refined level by level. At each level a point keeps the occupied cells that may hold its
    nearest site: those not farther than a known site of another cell. Only the sites of the
    last level's cells are measured exactly.
    """
    by = [group] if group else []
    place = _with_vector(
        sites.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .groupBy(*by, F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
        .agg(F.min(site_id).alias(site_id)),
        "_lat",
        "_lon",
    )
    place = place.withColumns({f"f{a}": _finest_cell(F.col(a)) for a in _AXES})
    place = place.withColumnsRenamed({a: f"s{a}" for a in _AXES})

    start = _with_vector(points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(lat, lon).distinct(), lat, lon)
    point = [lat, lon, *by]
    candidates, above = None, 0
    for bits in LEVEL_BITS:
        shift = LEVEL_BITS[-1] - bits
        cell = [F.shiftright(f"f{a}", shift).alias(f"c{a}") for a in _AXES]
        known = F.struct("sx", "sy", "sz")
        cells = place.groupBy(*by, *cell).agg(F.min(known).alias("_one"), F.max(known).alias("_two"))
        if candidates is None:
            # At most 512 cells per group: one short list, held as a scalar, opens the search.
            roots = cells.agg(F.collect_list(F.struct(*by, "cx", "cy", "cz", "_one", "_two"))).scalar()
            opened = start.withColumns({"_roots": roots, "_bound": F.lit(float("inf"))}).select(
                *start.columns, "_bound", F.inline("_roots")
            )
        else:
            parents = cells.withColumns({f"p{a}": F.shiftright(f"c{a}", bits - above) for a in _AXES})
            opened = lookup_join(candidates, parents, [*by, "px", "py", "pz"], "inner")
        width = 2.0 / (1 << bits)
        near = F.sqrt(sum((_squared_gap(a, width) for a in _AXES), F.lit(0.0)))
        reach = [
            F.sqrt(sum((_squared_difference(a, F.col(f"{s}.s{a}")) for a in _AXES), F.lit(0.0))) for s in ("_one", "_two")
        ]
        if exclude_same_place:
            reach = [F.when(r > F.lit(SLACK), r) for r in reach]
        # The bound of the level above drops most cells before the rows of a point are brought together.
        possible = opened.withColumns({"_near": near, "_far": F.least(F.coalesce(F.least(*reach), "_bound"), "_bound")}).where(
            F.col("_near") <= F.col("_bound") + F.lit(SLACK)
        )
        candidates = possible.select(
            lat, lon, *by, *_AXES, "_near", *[F.col(f"c{a}").alias(f"p{a}") for a in _AXES],
            F.min("_far").over(Window.partitionBy(*point)).alias("_bound"),
        ).where(F.col("_near") <= F.col("_bound") + F.lit(SLACK)).drop("_near")
        above = bits

    final = place.select(*by, *[F.col(f"f{a}").alias(f"p{a}") for a in _AXES], "_lat", "_lon", site_id)
    measured = lookup_join(candidates, final, [*by, "px", "py", "pz"], "inner").withColumn(
        "km", F.round(haversine_km(lat, lon, "_lat", "_lon"), 6)
    )
    if exclude_same_place:
        measured = measured.where((F.col(lat) != F.col("_lat")) | (F.col(lon) != F.col("_lon")))
    best = measured.groupBy(*point).agg(F.min(F.struct("km", site_id)).alias("_best"))
    return best.select(*point, F.col(f"_best.{site_id}").alias(site_id), F.col("_best.km").alias("km"))


def nearest_by_prefix(needles: DataFrame, sites: DataFrame, needle: str, site: str, width: int = 12) -> DataFrame:
    """For every distinct geohash the site hash sharing the longest prefix, ties to the smallest.

    Each site hash stands for its own prefixes (the smallest hash of each), each needle asks
    for its prefixes, and the longest answer wins. A needle sharing nothing gets the smallest hash.
    """
    lengths = F.array(*[F.lit(i) for i in range(1, width + 1)])
    known = (
        sites.where(F.col(site).isNotNull())
        .select(F.col(site), F.explode(lengths).alias("_length"))
        .where(F.length(site) >= F.col("_length"))
        .select(F.col(site).substr(F.lit(1), F.col("_length")).alias("_prefix"), site)
        .groupBy("_prefix")
        .agg(F.min(site).alias("_site"))
    )
    asked = (
        needles.where(F.col(needle).isNotNull())
        .select(needle)
        .distinct()
        .select(needle, F.explode(lengths).alias("_length"))
        .where(F.length(needle) >= F.col("_length"))
        .select(needle, F.col(needle).substr(F.lit(1), F.col("_length")).alias("_prefix"), "_length")
    )
    answers = lookup_join(asked, known, ["_prefix"]).groupBy(needle).agg(
        F.max(F.when(F.col("_site").isNotNull(), F.struct("_length", "_site"))).alias("_best")
    )
    smallest = sites.agg(F.min(site)).scalar()
    return answers.select(
        needle,
        F.coalesce(F.col("_best._site"), smallest).alias("nearest"),
        F.coalesce(F.col("_best._length"), F.lit(0)).alias("prefix_length"),
    )
