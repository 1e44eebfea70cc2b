"""Building blocks that stay correct and balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airq.session import materialise

# A key with at least this many rows is taken out of the shuffle, and so many keys at most.
HEAVY_ROWS = 5_000_000
HEAVY_KEYS = 1000


def lookup_join(
    fact: DataFrame, dim: DataFrame, on: list[str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Equi-join of a fact with a table that has one row (or a small constant number) per key.

    No side is broadcast by a hint: adaptive execution turns the join into a broadcast by the size it has
    measured. Otherwise both sides shuffle, and a partition that a hot key (or null keys) made too big is cut
    into several tasks, each with its copy of the few matching dimension rows; the fact is the side that may
    be cut for both ``left`` and ``inner``. For a fact known to be dominated by few keys see ``split_join``.
    With ``null_safe`` null keys match each other, as they do in a window or a group.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup_join supports left and inner, not {how}")
    if not null_safe:
        return fact.join(dim, on, how)
    keys = {k: f"_key_{i}" for i, k in enumerate(on)}
    right = dim.withColumnsRenamed(keys)
    same = reduce(Column.__and__, [fact[k].eqNullSafe(right[other]) for k, other in keys.items()])
    return fact.join(right, same, how).drop(*keys.values())


def split_join(
    fact: DataFrame, dim: DataFrame, on: list[str], how: str = "left", heavy_rows: int = HEAVY_ROWS, heavy_keys: int = HEAVY_KEYS
) -> DataFrame:
    """``lookup_join`` for a stored fact with hot keys: they are joined apart, without a shuffle.

    The ``heavy_keys`` largest of the keys with ``heavy_rows`` rows or more are found first (combined before
    the shuffle); that number bounds what is broadcast. All other keys shuffle. Null keys match nothing and
    stay out of the shuffle too. The fact is read three times, so it should be a table, not a long plan.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"split_join supports left and inner, not {how}")
    columns = [*on, *(c for c in fact.columns if c not in on), *(c for c in dim.columns if c not in on)]
    heavy = (
        fact.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") >= heavy_rows)
        .orderBy(F.col("_rows").desc(), *on)
        .limit(heavy_keys)
        .select(*on, F.lit(True).alias("_heavy"))
    )
    no_key = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    tagged = fact.join(F.broadcast(heavy), on, "left")
    aside = F.col("_heavy").isNotNull() | no_key
    heavy_dim = dim.join(F.broadcast(heavy.drop("_heavy")), on, "left_semi")
    outside = tagged.where(aside).drop("_heavy").join(F.broadcast(heavy_dim), on, how)
    shuffled = tagged.where(~aside).drop("_heavy").join(dim, on, how)
    return shuffled.select(*columns).unionByName(outside.select(*columns))


def keep_keys(fact: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``fact`` whose key occurs in ``keys`` (a semi-join that survives hot keys)."""
    return lookup_join(fact, keys.select(*on).distinct(), on, "inner").select(*fact.columns)


def global_order(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Append the exact 1-based position of every row in one global order.

    The sort is a range shuffle, so no task sees more than one range. The sorted rows are written to the
    shared folder (the partition numbers have to stay fixed), then each range is moved by the number
    of rows before it, a table with one row per partition.
    """
    index_bits = F.lit((1 << 33) - 1)
    ranged = materialise(
        df.orderBy(*order).select(
            "*",
            F.spark_partition_id().alias("_range"),
            F.monotonically_increasing_id().bitwiseAND(index_bits).alias("_index"),
        )
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_before") + F.col("_index") + 1)
        .select(*df.columns, name)
    )


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float]) -> DataFrame:
    """Exact interpolated quantiles of one column as rows ``(probability, quantile)``."""
    single = df.select(F.lit(0).alias("_one"), F.col(column))
    found = exact_quantiles_by(single, "_one", column, probabilities)
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    asked = df.sparkSession.range(1).select(wanted)
    return asked.join(found.drop("_one"), "probability", "left")


def exact_quantiles_by(df: DataFrame, key: str, column: str, probabilities: list[float]) -> DataFrame:
    """Exact interpolated quantiles of one column per key, as rows ``(key, probability, quantile)``.

    Equal values are counted before the sort, so copies of one value cost one row. One range sort by key and
    value serves all keys; a key with most of the rows is spread over many ranges. Nulls do not count.
    """
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(key, F.col(column).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranged = materialise(counted.orderBy(key, "_v").withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(key, "_range")
        .agg(F.sum("_n").alias("_m"))
        .select(
            key,
            "_range",
            F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_before"),
            F.sum("_m").over(Window.partitionBy(key)).alias("_total"),
        )
    )
    upto = Window.partitionBy("_range", key).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    running = ranged.withColumn("_upto", F.sum("_n").over(upto)).join(offsets, [key, "_range"])
    reached = F.col("_before") + F.col("_upto")
    picks = []
    for i, p in enumerate(probabilities):
        rank = (F.col("_total") - 1) * F.lit(float(p))
        picks.append(F.min(F.when(reached > F.floor(rank), F.col("_v"))).alias(f"_lo{i}"))
        picks.append(F.min(F.when(reached > F.ceil(rank), F.col("_v"))).alias(f"_hi{i}"))
    row = running.groupBy(key).agg(*picks, F.max("_total").alias("_total"))
    items = []
    for i, p in enumerate(probabilities):
        rank = (F.col("_total") - 1) * F.lit(float(p))
        share = rank - F.floor(rank)
        value = F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * share
        items.append(F.struct(F.lit(float(p)).alias("probability"), value.alias("quantile")))
    return row.select(key, F.inline(F.array(*items)))
