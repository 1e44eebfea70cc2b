import math

import numpy as np
import pytest

from airq.llm import whitening
from airq.llm.queries import QUERIES


def by_hand(rows, components=16, shift=1_000_000):
    """The contract in plain Python and numpy, with the shift that the operator leaves out."""
    kept = [(i, [math.floor(64 * float(c)) + shift for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    y = np.array([[float(x[j] * n - sums[j]) / n for j in range(d)] for x in fit])
    covariance = y.T @ y / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    out = {}
    for i, x in kept:
        off = [x[j] * n - sums[j] for j in range(d)]
        out[i] = (n, sum(o * o for o in off), np.array(off, dtype=float) / n @ axes[:, :components] / np.sqrt(values[:components]))
    return out, values[:components] / np.trace(covariance)


def test_query_against_plain_numpy(spark, folder):
    rows = QUERIES["op12_whitening"](spark, folder).collect()
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    want, explained = by_hand([(r.vec_id, r.embedding) for r in table])
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert got.keys() == want.keys() and len(rows) == 16 * len(want)
    sign = {}
    for vec, (n, deviation, white) in want.items():
        for c, r in got[vec].items():
            assert (r.n, r.deviation) == (n, deviation)
            sign.setdefault(c, 1 if r.whitened * white[c - 1] > 0 else -1)
            assert abs(sign[c] * r.whitened - white[c - 1]) < 1e-8
            assert abs(r.explained / explained[c - 1] - 1) < 1e-9
            assert r.identity_error < 1e-9


SCHEMA = "vec_id long, embedding array<double>, label int, _key string, deviation long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 5) for r in rows], SCHEMA)


def test_edges(spark):
    dice = np.random.default_rng(2)
    plain = [(i, dice.normal(0, 0.2, 5).tolist()) for i in range(60)]
    odd = [(100, None), (101, [0.1, None, 0.2, 0.3, 0.4]), (102, [0.1, math.nan, 0.2, 0.3, 0.4]), (103, [math.inf] * 5), (104, []), (105, [1.0, 2.0]), (106, [1e300] * 5)]
    again = [(None, plain[3][1])] * 40 + [(7, plain[3][1])]
    rows = plain + odd + again
    df = frame(spark, rows)
    model = whitening.fit_whitening(df)
    got = whitening.whiten(df, model).collect()
    want, explained = by_hand(plain)
    assert (model.n, len(model.values)) == (want[0][0], 5)
    assert np.allclose(model.explained, explained, rtol=1e-10) and model.identity_error < 1e-10
    assert len(got) == 60 + 41 and sum(r.vec_id is None for r in got) == 40
    for r in got:
        if r.vec_id is not None and r.vec_id != 7:
            assert r.deviation == want[r.vec_id][1]
            assert np.allclose(np.abs(r.whitened), np.abs(want[r.vec_id][2]), atol=1e-8)
    assert {tuple(r.whitened) for r in got if r.vec_id is None} == {tuple(r.whitened) for r in got if r.vec_id == 3}


def test_few_directions(spark):
    """Empty table, one distinct vector, and vectors that vary in two of three directions."""
    assert whitening.fit_whitening(frame(spark, [(1, None)])) is None
    none = whitening.whiten(frame(spark, [(1, [1.0])]), None)
    assert none.columns == ["vec_id", "deviation", "whitened"] and none.count() == 0
    same = frame(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])
    model = whitening.fit_whitening(same)
    assert (model.n, len(model.values)) == (1, 0)
    assert [(r.deviation, r.whitened) for r in whitening.whiten(same, model).collect()] == [(0, []), (0, [])]
    flat = frame(spark, [(i, [i / 64, (i * i % 7) / 64, 3.0]) for i in range(20)])
    model = whitening.fit_whitening(flat)
    assert len(model.values) == 2 and model.identity_error < 1e-10


def test_large_deviations():
    """Exact at the edge of a long, None beyond it."""
    numbers = np.array([[3_037_000_499, 0], [3_037_000_500, 0], [2**61, 1], [5, 7]], dtype=np.int64)
    plain = [sum((2 * x - s) ** 2 for x, s in zip(row, (3_037_000_499, 1))) for row in numbers.tolist()]
    want = [p if p < 2**63 else None for p in plain]
    assert whitening.deviations(numbers, 2, (3_037_000_499, 1)) == want
    assert None in want and want[3] is not None


def test_packing_keeps_numbers_and_equality():
    numbers = np.array([[1, -128], [127, 128], [-32768, 0], [2**31, 5], [-(2**61), 9], [1, -128]], dtype=np.int64)
    keys = whitening.pack(numbers)
    assert [len(k) for k in keys] == [2, 4, 4, 16, 16, 2] and keys[0] == keys[5]
    assert (whitening.unpack(keys, 2) == numbers).all()
    assert whitening.exact_sums(numbers) == [sum(c) for c in zip(*numbers.tolist())]


@pytest.mark.parametrize(
    "spectrum",
    [[5.0] * 30, [9.0] * 20 + [1.0] * 44, [4, 3, 2] + [0.0] * 47, np.linspace(1, 1.2, 300).tolist(), [1e6, *np.linspace(1, 2, 63)], [7.0]],
)
def test_leading_against_eigh(spectrum):
    d = len(spectrum)
    turn = np.linalg.qr(np.random.default_rng(1).standard_normal((d, d)))[0]
    covariance = turn @ np.diag(spectrum) @ turn.T
    values, axes = whitening.leading(lambda q: covariance @ q, d, min(16, d))
    top = max(spectrum)
    assert np.abs(values - sorted(spectrum, reverse=True)[:16]).max() < 1e-11 * top
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12
    assert np.linalg.norm(covariance @ axes - axes * values, axis=0).max() < 1e-9 * top
