"""The spectral entropy of a series, by Arrow batches of sorted regular series, and all fitted figures together.

The spectrum is that of an autoregression (Burg's recursion, order by AIC): a declared substitute for the
estimator of a statistics package. The recursion has no form in aggregates, so a task reads its series
one after another; the other fitted figures are native (see ``kpi_models``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.operators.kpi_models import ARCH_LAGS, TILE, arch_statistic, kl_shift
from airq.operators.scale import lookup_join
from airq.operators.smoothing import holt_parameters


def longest_stretch(x: np.ndarray) -> np.ndarray:
    """The longest run without NaN (the first of equals)."""
    edges = np.flatnonzero(np.isnan(x))
    bounds = np.concatenate(([-1], edges, [len(x)]))
    widths = np.diff(bounds) - 1
    i = int(np.argmax(widths))
    return x[bounds[i] + 1 : bounds[i + 1]]


def burg(x: np.ndarray, max_order: int) -> tuple[np.ndarray, float]:
    """AR coefficients and innovation variance of the order with the lowest AIC."""
    x = x - x.mean()
    n = len(x)
    variance = float(x @ x) / n
    best = (n * np.log(variance), np.zeros(0), variance)
    forward, backward, coef = x[1:], x[:-1], np.zeros(0)
    for order in range(1, max_order + 1):
        power = float(forward @ forward + backward @ backward)
        if power <= 0:
            break
        reflection = 2.0 * float(forward @ backward) / power
        coef = np.concatenate((coef - reflection * coef[::-1], [reflection]))
        variance *= 1.0 - reflection * reflection
        if variance <= 0:
            break
        score = n * np.log(variance) + 2 * order
        if score < best[0]:
            best = (score, coef, variance)
        forward, backward = (forward - reflection * backward)[1:], (backward - reflection * forward)[:-1]
    return best[1], best[2]


def spectral_entropy(x: np.ndarray) -> float:
    """Shannon entropy of the fitted spectral density, 0 (one frequency) to 1 (white noise)."""
    x = longest_stretch(x)
    n = len(x)
    if n < 3 or np.ptp(x) == 0:
        return float("nan")
    coef, variance = burg(x, min(n - 1, int(10 * np.log10(n))))
    points = int(np.ceil(n / 2 + 1))
    frequency = np.linspace(0.0, 0.5, points)
    turns = np.exp(-2j * np.pi * np.outer(frequency, np.arange(1, len(coef) + 1)))
    density = variance / np.abs(1.0 - turns @ coef) ** 2
    both = np.concatenate((density[:0:-1], density))
    share = both / both.sum()
    share = 0.999 * share + 0.001 / len(share)
    return float(-(share * np.log(share)).sum() / np.log(len(share)))


def spectral_entropies(df: DataFrame, keys: list[str], value: str = "value", ts: str = "timestamp") -> DataFrame:
    """``entropy`` of every regular series; null for a constant or too short one."""
    # Partitions are not merged by size here: the work is in the fits, not in the few bytes. A digest of the
    # keys keeps this shuffle apart from one by the keys themselves, which would be merged.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = (
        df.select(*keys, ts, df[value].cast("double").alias(value))
        .repartition(partitions, F.xxhash64(*keys))
        .sortWithinPartitions(*keys, ts)
        .drop(ts)
    )
    types = dict(narrow.dtypes)
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "entropy double"])

    def fit_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Batches hold many short series or a piece of a long one; a task keeps one series at a time."""
        key, pieces = None, []
        for batch in batches:
            found = []
            for next_key, rows in batch.groupby(keys, sort=False, dropna=False):
                next_key = tuple(None if pd.isna(k) else k for k in next_key)
                if next_key != key and pieces:
                    found.append([*key, spectral_entropy(np.concatenate(pieces))])
                    pieces = []
                key = next_key
                pieces.append(rows[value].to_numpy(dtype=float, na_value=np.nan))
            if found:
                yield pd.DataFrame(found, columns=[*keys, "entropy"])
        if pieces:
            yield pd.DataFrame([[*key, spectral_entropy(np.concatenate(pieces))]], columns=[*keys, "entropy"])

    fitted = narrow.mapInPandas(fit_sorted, schema)
    return fitted.select(*keys, F.nanvl("entropy", F.lit(None).cast("double")).alias("entropy"))


def fitted_kpis(
    df: DataFrame, keys: list[str], value: str = "value", ts: str = "timestamp", width: int = TILE, lags: int = ARCH_LAGS
) -> DataFrame:
    """Entropy, divergence shift, ARCH statistic and smoothing parameters, one row per regular series."""
    parts = [
        spectral_entropies(df, keys, value, ts),
        kl_shift(df, keys, value, ts, width),
        arch_statistic(df, keys, value, ts, lags),
        holt_parameters(df, keys, value, ts),
    ]
    return reduce(lambda a, b: lookup_join(a, b, keys, "inner", null_safe=True), parts)
