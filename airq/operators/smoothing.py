"""Smoothing parameters of long series: blocks of a series are folded apart and their effects put together in order.

An additive-trend smoother is linear in its state, so what a block does to the level, the trend and the squared error
follows from any state before it once the block has been folded from one state near the true one (the value before
the block, no trend). Blocks of one series are folded in parallel; no task holds more of a series than a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airq.operators.kpi_models import with_all_keys

BLOCK = 512
# Blocks folded side by side: bounds the matrices of a step.
SIDE_BY_SIDE = 512
GRID = [(i / 20, j / 20) for i in range(1, 20) for j in range(1, i + 1)]
# What a block hands on, per pair of the grid: the state and error when folded from its own start, the error's mixed
# and squared terms in the distance of the true start, and the matrix that carries this distance to its end.
EFFECT = ["level", "trend", "sse", "mixed_l", "mixed_t", "square_ll", "square_lt", "square_tt", "move_ll", "move_lt", "move_tl", "move_tt"]


@lru_cache(maxsize=2)
def distance_tables(steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each number of steps and pair: how a distance of the start moves, its weight in the next error, and the
    running sums of products of these weights."""
    a, b = np.array(GRID).T
    step = np.array([[1 - a, 1 - a], [-b, 1 - b]]).transpose(2, 0, 1)
    moves = np.empty((steps + 1, len(GRID), 2, 2))
    moves[0] = np.eye(2)
    for t in range(steps):
        moves[t + 1] = step @ moves[t]
    weights = moves.sum(axis=2)
    products = np.stack([weights[..., 0] ** 2, weights[..., 0] * weights[..., 1], weights[..., 1] ** 2], axis=-1)
    squares = np.concatenate([np.zeros((1, len(GRID), 3)), np.cumsum(products, axis=0)[:-1]])
    return moves, weights, squares


def fold_blocks(blocks: list[list[float]], before: list[float | None], steps: int) -> np.ndarray:
    """``EFFECT`` of each block and pair; a block without a value before it starts from its own first two values."""
    a, b = np.array(GRID).T
    moves, weights, squares = distance_tables(steps)
    starts = [v is None for v in before]
    sizes = np.array([len(x) - s for x, s in zip(blocks, starts)])
    order = np.argsort(-sizes, kind="stable")
    values = np.zeros((len(blocks), int(sizes.max())))
    for place, i in enumerate(order):
        values[place, : sizes[i]] = blocks[i][starts[i] :]
    level = np.array([blocks[i][0] if starts[i] else before[i] for i in order])[:, None] + np.zeros(len(GRID))
    trend = np.array([blocks[i][1] - blocks[i][0] if starts[i] else 0.0 for i in order])[:, None] + np.zeros(len(GRID))
    sse, mixed_l, mixed_t = (np.zeros_like(level) for _ in range(3))
    longer = len(blocks) - np.searchsorted(np.sort(sizes), np.arange(values.shape[1]), side="right")
    for t, n in enumerate(longer):
        error = values[:n, t, None] - level[:n] - trend[:n]
        mixed_l[:n] += error * weights[t, :, 0]
        mixed_t[:n] += error * weights[t, :, 1]
        sse[:n] += error * error
        level[:n] = level[:n] + trend[:n] + a * error
        trend[:n] = trend[:n] + b * error
    ended = sizes[order]
    effects = np.stack([level, trend, sse, mixed_l, mixed_t, *np.moveaxis(squares[ended], -1, 0), *moves[ended].reshape(len(blocks), -1, 4).transpose(2, 0, 1)])
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return effects[:, back]


def longest_blocks(df: DataFrame, keys: list[str], value: str, ts: str, block: int) -> DataFrame:
    """``(keys, _block, _values, _before, _alone)``: the longest run without null of each series, in blocks.

    Of runs of one length the first; runs of fewer than four values and constant ones are left out.
    """
    order = Window.partitionBy(*keys).orderBy(ts)
    x = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    rows = df.select(*keys, ts, x.alias("_x")).withColumn("_at", F.row_number().over(order))
    gap = F.max(F.when(F.col("_x").isNull(), F.col("_at"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns({"_run": F.coalesce(gap, F.lit(0)), "_previous": F.lag("_x").over(order)}).where(F.col("_x").isNotNull())
    place = F.col("_at") - F.col("_run") - 1
    blocks = rows.groupBy(*keys, "_run", F.floor(place / F.lit(block)).alias("_block")).agg(
        F.array_sort(F.collect_list(F.struct("_at", "_x"))).alias("_points"),
        F.min_by("_previous", "_at").alias("_before"),
        F.min("_x").alias("_low"),
        F.max("_x").alias("_high"),
    )
    run = Window.partitionBy(*keys, "_run")
    sized = blocks.withColumns(
        {"_size": F.sum(F.size("_points")).over(run), "_parts": F.count(F.lit(1)).over(run), "_least": F.min("_low").over(run), "_most": F.max("_high").over(run)}
    )
    best = F.max(F.struct(F.col("_size"), (-F.col("_run")).alias("_early"))).over(Window.partitionBy(*keys))
    kept = sized.withColumn("_best", best).where(
        (F.col("_best._early") == -F.col("_run")) & (F.col("_size") >= 4) & (F.col("_least") < F.col("_most"))
    )
    before = F.when(F.col("_block") > 0, F.col("_before"))
    return kept.select(*keys, "_block", F.col("_points._x").alias("_values"), before.alias("_before"), (F.col("_parts") == 1).alias("_alone"))


def _onward(state: Column, block: Column) -> Column:
    """The state and error behind a block, from those before it."""
    apart_l, apart_t = state["level"] - block["_before"], state["trend"]
    mixed = apart_l * block["mixed_l"] + apart_t * block["mixed_t"]
    square = apart_l * apart_l * block["square_ll"] + F.lit(2.0) * apart_l * apart_t * block["square_lt"] + apart_t * apart_t * block["square_tt"]
    follows = block["_before"].isNotNull()
    return F.struct(
        F.when(follows, block["level"] + block["move_ll"] * apart_l + block["move_lt"] * apart_t).otherwise(block["level"]).alias("level"),
        F.when(follows, block["trend"] + block["move_tl"] * apart_l + block["move_tt"] * apart_t).otherwise(block["trend"]).alias("trend"),
        F.when(follows, state["sse"] + block["sse"] - F.lit(2.0) * mixed + square).otherwise(block["sse"]).alias("sse"),
    )


def holt_parameters(df: DataFrame, keys: list[str], value: str = "value", ts: str = "timestamp", block: int = BLOCK) -> DataFrame:
    """Level and trend smoothing of an additive-trend smoother, beta at most alpha, with the lowest squared one-step error.

    All pairs of a declared grid (steps of a twentieth) are folded over the longest run without null or NaN, in blocks of
    ``block`` values (at least two). Null for fewer than four values and for a constant; ties take the lowest pair.
    """
    if block < 2:
        raise ValueError("a block holds at least two values")
    blocks = longest_blocks(df, keys, value, ts, block)
    names = [f"_k{i}" for i in range(len(keys))]
    kinds = dict(blocks.dtypes)
    narrow = blocks.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "_block", "_values", "_before", "_alone")
    schema = ", ".join([*(f"{n} {kinds[k]}" for k, n in zip(keys, names)), "_block long", "_before double", "_pair int", *(f"{e} double" for e in EFFECT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SIDE_BY_SIDE):
                part = batch.slice(at, SIDE_BY_SIDE)
                column = {n: part.column(i) for i, n in enumerate(part.schema.names)}
                effects = fold_blocks(column["_values"].to_pylist(), column["_before"].to_pylist(), block)
                wanted = np.ones(effects.shape[1:], dtype=bool)
                alone = column["_alone"].to_numpy(zero_copy_only=False)
                # a run of one block needs its best pair only
                wanted[alone] = np.arange(len(GRID)) == effects[2].argmin(axis=1)[alone, None]
                row, pair = np.nonzero(wanted)
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(column[n].take(rows) for n in (*names, "_block", "_before")),
                        pa.array(pair, pa.int32()),
                        *(pa.array(e[row, pair]) for e in effects),
                    ],
                    [*names, "_block", "_before", "_pair", *EFFECT],
                )

    effects = narrow.mapInArrow(run, schema)
    ordered = effects.groupBy(*names, "_pair").agg(F.array_sort(F.collect_list(F.struct("_block", "_before", *EFFECT))).alias("_blocks"))
    nothing = F.struct(*[F.lit(0.0).alias(c) for c in ("level", "trend", "sse")])
    errors = ordered.select(*names, "_pair", F.aggregate("_blocks", nothing, _onward)["sse"].alias("_sse"))
    best = errors.groupBy(*names).agg(F.min_by("_pair", F.struct("_sse", "_pair")).alias("_pair"))
    alpha, beta = (F.array(*[F.lit(p[i]) for p in GRID]) for i in (0, 1))
    found = best.select(
        *[F.col(n).alias(k) for n, k in zip(names, keys)],
        F.get(alpha, "_pair").alias("holt_alpha"),
        F.get(beta, "_pair").alias("holt_beta"),
    )
    return with_all_keys(df, keys, found, ["holt_alpha", "holt_beta"])
