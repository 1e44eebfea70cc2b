"""Smoothing parameters folded in blocks against a plain loop over whole series."""

import datetime as dt

import numpy as np

from airq.operators.smoothing import GRID, holt_parameters


def plain(x):
    """The pair with the lowest error, and the relative distance to the next one."""
    errors = []
    for a, b in GRID:
        level, trend, sse = x[0], x[1] - x[0], 0.0
        for v in x[1:]:
            e = v - level - trend
            level, trend, sse = level + trend + a * e, trend + b * e, sse + e * e
        errors.append(sse)
    order = np.argsort(errors, kind="stable")
    return GRID[order[0]], errors[order[1]] / errors[order[0]] - 1


def test_blocks_give_what_one_fold_gives(spark):
    rng = np.random.default_rng(3)
    start = dt.datetime(2018, 1, 1)
    long = 1000.0 + np.cumsum(rng.normal(size=4000)) + np.sin(np.arange(4000) / 9.0) * 5
    series = {
        "walk": long,
        "noise": 5.0 + rng.normal(size=1500),
        "trend": np.arange(900) * 0.3 + np.cumsum(np.cumsum(rng.normal(size=900) * 0.05)) + rng.normal(size=900),
        "far": 1e6 + rng.normal(size=700),
        "gaps": np.array([1.0, 2.0, None, *rng.normal(size=40), np.nan, *rng.normal(size=39), None, 3.0], dtype=object),
        "four": np.array([1.0, 3.0, 2.0, 2.5]),
        "three": np.array([1.0, 3.0, 2.0]),
        "constant": np.full(600, 2.0),
        "nothing": np.array([None, None], dtype=object),
    }
    rows = [(k, start + dt.timedelta(hours=i), None if v is None else float(v)) for k, x in series.items() for i, v in enumerate(x)]
    rows += [(None, start + dt.timedelta(hours=i), float(v)) for i, v in enumerate(long[:300])]
    df = spark.createDataFrame(rows, "station string, timestamp timestamp, value double").repartition(5)
    expected = {k: plain(list(series[k])) for k in ("walk", "noise", "trend", "far", "four")}
    expected["gaps"] = plain([float(v) for v in series["gaps"][3:43]])
    expected[None] = plain(list(long[:300]))
    assert all(margin > 1e-9 for k, (_, margin) in expected.items() if k != "four")
    for block in (2, 7, 100, 512, 5000):
        found = {r.station: (r.holt_alpha, r.holt_beta) for r in holt_parameters(df, ["station"], block=block).collect()}
        assert found == {**{k: pair for k, (pair, _) in expected.items()}, "three": (None, None), "constant": (None, None), "nothing": (None, None)}


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "_k0 long, level string, timestamp timestamp, value double")
    assert holt_parameters(df, ["_k0", "level"]).collect() == []
    rows = [(1, "x", dt.datetime(2018, 1, 1, i), float(v)) for i, v in enumerate((1, 3, 2, 2, 4))]
    (row,) = holt_parameters(spark.createDataFrame(rows, df.schema), ["_k0", "level"], block=2).collect()
    assert (row.holt_alpha, row.holt_beta) == plain([1.0, 3.0, 2.0, 2.0, 4.0])[0]
