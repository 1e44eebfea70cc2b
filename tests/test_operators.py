import collections
import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airq import schemas
from airq.functions.geo import haversine_km
from airq.operators import clean, features, kpi, kpi_fit, model, quality, resample, scale, series, stations
from airq.operators.nearest import nearest_by_prefix, nearest_site

T0 = dt.datetime(2018, 1, 1)


def hours(n):
    return T0 + dt.timedelta(hours=n)


def series_df(spark, values, key=1):
    rows = [(key, hours(i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "sensor_id int, timestamp timestamp, value double")


# ---- scale ----

@pytest.mark.parametrize("how", ["left", "inner"])
def test_split_join_equals_plain_join(spark, how):
    rng = random.Random(1)
    keys = [rng.choice([None, 7, 7, 7, rng.randrange(50)]) for _ in range(2000)]
    fact = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k int")
    dim = spark.createDataFrame([(k, k * 2) for k in range(0, 50, 2)] + [(7, 14)], "k int, v int")
    expected = sorted(map(tuple, fact.join(dim, ["k"], how).select("i", "v").collect()))
    for found in (scale.split_join(fact, dim, ["k"], how, heavy_rows=100), scale.lookup_join(fact, dim, ["k"], how)):
        assert sorted(map(tuple, found.select("i", "v").collect())) == expected


def test_global_order_and_quantiles(spark):
    rng = random.Random(2)
    values = [rng.choice([5.0, round(rng.gauss(0, 10), 2)]) for _ in range(3000)] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").repartition(6)
    placed = scale.global_order(df.where("v is not null"), [F.col("v"), F.col("i")]).collect()
    expected = sorted((v, i) for i, v in enumerate(values) if v is not None)
    assert [(r.v, r.i) for r in sorted(placed, key=lambda r: r.position)] == expected
    assert sorted(r.position for r in placed) == list(range(1, 3001))
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    found = {r.probability: r.quantile for r in scale.exact_quantiles(df, "v", probabilities).collect()}
    known = np.array([v for v in values if v is not None])
    for p in probabilities:
        assert math.isclose(found[p], np.quantile(known, p), rel_tol=1e-12, abs_tol=1e-12)


def test_checkpoints_go_to_the_named_folder(spark):
    from airq.session import shared_dir

    assert shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())


# ---- nearest ----

def test_nearest_site_against_all_pairs(spark):
    rng = random.Random(3)
    sites = [(i, rng.choice(["a", "b"]), round(rng.uniform(-89, 89), 3), round(rng.uniform(-180, 180), 3)) for i in range(60)]
    sites += [(100 + i, "a", 48.0 + i * 1e-4, 9.0) for i in range(20)] + [(200, "a", 48.0, 9.0), (201, "c", 10.0, 179.99)]
    points = [(round(rng.uniform(-89, 89), 2), round(rng.uniform(-180, 180), 2)) for _ in range(60)]
    points += [(48.00055, 9.0), (48.0, 9.0), (10.0, -179.99), (None, 3.0)]
    s = spark.createDataFrame(sites, "id int, kind string, lat double, lon double")
    p = spark.createDataFrame(points, "lat double, lon double")
    found = {(r.lat, r.lon, r.kind): (r.km, r.id) for r in nearest_site(p, s, "id", group="kind").collect()}
    q = s.withColumnsRenamed({"lat": "slat", "lon": "slon"})
    pairs = p.dropna().distinct().crossJoin(q).withColumn("km", F.round(haversine_km("lat", "lon", "slat", "slon"), 6))
    best = pairs.groupBy("lat", "lon", "kind").agg(F.min(F.struct("km", "id")).alias("b")).collect()
    assert found == {(r.lat, r.lon, r.kind): (r.b.km, r.b.id) for r in best}


def test_nearest_other_place(spark):
    places = spark.createDataFrame([(1, 48.0, 9.0), (2, 48.0, 9.0), (3, 48.0, 9.1), (4, 50.0, 9.0)], "id int, lat double, lon double")
    found = {(r.lat, r.lon): r.id for r in nearest_site(places, places, "id", exclude_same_place=True).collect()}
    assert found == {(48.0, 9.0): 3, (48.0, 9.1): 1, (50.0, 9.0): 1}


def test_prefix_ties_and_no_match(spark):
    sites = spark.createDataFrame([("u0wt9",), ("u0wt3",), ("ezzzz",)], "site string")
    needles = spark.createDataFrame([("u0wt8",), ("zzzzz",), ("u0wt9",)], "hash string")
    found = {r.hash: (r.nearest, r.prefix_length) for r in nearest_by_prefix(needles, sites, "hash", "site").collect()}
    assert found == {"u0wt8": ("u0wt3", 4), "zzzzz": ("ezzzz", 0), "u0wt9": ("u0wt9", 5)}


def test_station_without_capability_is_null(spark):
    st = spark.createDataFrame(
        [(1, 48.0, 9.0, 1, 0, 0, 0, 1), (2, 48.1, 9.0, 0, 0, 0, 0, 1)],
        "STATIONS_ID int, geoBreite double, geoLaenge double, isWind int, isSun int, isCloud int, isPerc int, isTemp int",
    )
    sensors = spark.createDataFrame([(5, 48.05, 9.0), (6, 48.09, 9.0), (7, None, None)], "sensor_id int, lat double, lon double")
    rows = {r.sensor_id: r for r in stations.nearest_by_capability(sensors, st).collect()}
    assert (rows[5].closestTemp, rows[6].closestTemp, rows[6].closestWind, rows[6].closestSun) == (1, 2, 1, None)
    assert rows[7].closestTemp is None


# ---- resample ----

def test_day_grid_has_25_hours(spark):
    spans = spark.createDataFrame([(1, T0, hours(24))], "k int, first timestamp, last timestamp")
    assert resample.time_grid(spans, 3600).count() == 25


def test_grid_longer_than_a_block(spark):
    spans = spark.createDataFrame([(1, T0, hours(2500))], "k int, first timestamp, last timestamp")
    times = [r.timestamp for r in resample.time_grid(spans, 3600).orderBy("timestamp").collect()]
    assert times == [hours(i) for i in range(2501)]


def test_gap_fill_edges(spark):
    rows = [(1, hours(0), 1.0), (1, hours(3), 4.0), (1, hours(3), 5.0), (1, T0 + dt.timedelta(minutes=90), 9.0), (2, hours(7), None)]
    df = spark.createDataFrame(rows, "k int, timestamp timestamp, value double")
    found = sorted(((r.k, r.timestamp, r.value) for r in resample.gap_fill(df, ["k"]).collect()), key=str)
    expected = [(1, hours(0), 1.0), (1, hours(1), None), (1, hours(2), None), (1, hours(3), 4.0), (1, hours(3), 5.0), (2, hours(7), None)]
    assert found == sorted(expected, key=str)


def test_unpivot_then_pivot_is_identity(spark):
    df = spark.createDataFrame([(1, 1.5, None), (2, None, 3.0)], "id int, a double, b double")
    back = resample.pivot_mean(resample.unpivot_measures(df, ["id"], ["a", "b"]), ["id"], ["a", "b"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_exact_decimal_mean(spark):
    df = series_df(spark, [0.1, 0.2, 0.3]).withColumn("value", F.col("value").cast("decimal(18,2)"))
    assert resample.bin_means(df, ["sensor_id"], ["value"], 86400).first().value == 0.6 / 3


# ---- clean and quality ----

def test_usable_sensors(spark):
    day = "2018-01-01"
    good = [(1, hours(i % 24), float(i)) for i in range(10)]
    flat = [(2, hours(i), 1.0) for i in range(10)]
    old = [(3, hours(-48 + i), float(i)) for i in range(10)]
    df = spark.createDataFrame(good + flat + old + [(4, T0, 1.0)], "sensor_id int, timestamp timestamp, value double")
    assert [r.sensor_id for r in clean.usable_sensors(df, day, 5).collect()] == [1]


def test_scale_by_zero_maximum(spark):
    df = spark.createDataFrame([(1, 0.0), (1, -2.0), (2, -1.0), (2, -4.0)], "k int, value double")
    rows = sorted(((r.k, r.value) for r in clean.scale_by_maximum(df, ["k"]).collect()), key=str)
    assert rows == sorted([(1, None), (1, None), (2, 1.0), (2, 4.0)], key=str)


def test_rank_keeps_ties(spark):
    rows = [(1, v) for v in (1, 1, 2, 2, 2, 3)] + [(2, 5)]
    df = spark.createDataFrame(rows, "k int, v int")
    expected = sorted(
        tuple(r) for r in df.selectExpr("k", "v", "rank() over (partition by k order by v) AS rank").where("rank <= 3").collect()
    )
    assert sorted(map(tuple, quality.first_ranked(df, ["k"], "v", 3).select("k", "v", "rank").collect())) == expected


def test_squared_error_with_null(spark):
    df = spark.createDataFrame([(1, 1.0), (1, -2.0), (1, None), (1, 3.0)], "sensor_id int, diff double")
    row = quality.squared_error(df).first()
    assert math.isclose(row.mse, 14 / 3) and math.isclose(row.rmse, math.sqrt(14 / 3))


def test_best_and_worst_ties(spark):
    df = spark.createDataFrame([(i, float(i // 2)) for i in range(8)] + [(9, None)], "sensor_id int, mse double")
    found = {(r.sensor_id, r.side) for r in quality.best_and_worst(df, 3).collect()}
    assert found == {(0, "best"), (1, "best"), (2, "best"), (6, "worst"), (7, "worst"), (4, "worst")}


# ---- quality figures ----

def figure(df, name):
    return df.first()[name]


def test_crossing_points(spark):
    assert figure(kpi.crossing_points(series_df(spark, [1, 3, 1, 3]), ["sensor_id"]), "crossing_points") == 3
    assert figure(kpi.crossing_points(series_df(spark, [1, None, 3, None]), ["sensor_id"]), "crossing_points") == 0


def test_flat_spots(spark):
    assert figure(kpi.flat_spots(series_df(spark, [0, 0, 0, 10, 10]), ["sensor_id"]), "flat_spots") == 3
    assert figure(kpi.flat_spots(series_df(spark, [0, 0, None, 0, 10]), ["sensor_id"]), "flat_spots") == 2
    assert figure(kpi.flat_spots(series_df(spark, [4, 4, 4]), ["sensor_id"]), "flat_spots") == 3


def test_shifts_and_tiles_against_numpy(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate((rng.normal(0, 1, 120), rng.normal(5, 3, 80)))
    df = series_df(spark, x.tolist())
    width = 48
    row = kpi.largest_shifts(df, ["sensor_id"]).first()
    means = np.array([x[i : i + width].mean() for i in range(len(x) - width + 1)])
    jumps = np.abs(means[width:] - means[:-width])
    assert math.isclose(row.max_level_shift, jumps.max()) and row.max_level_index == jumps.argmax() + width
    variances = np.array([x[i : i + width].var(ddof=1) for i in range(len(x) - width + 1)])
    jumps = np.abs(variances[width:] - variances[:-width])
    assert math.isclose(row.max_var_shift, jumps.max(), rel_tol=1e-9) and row.max_var_index == jumps.argmax() + width
    tiles = x[: len(x) // width * width].reshape(-1, width)
    row = kpi.tile_variation(df, ["sensor_id"]).first()
    assert math.isclose(row.lumpiness, tiles.var(axis=1, ddof=1).var(ddof=1)) and math.isclose(row.stability, tiles.mean(axis=1).var(ddof=1))
    short = kpi.tile_variation(series_df(spark, x[:95].tolist()), ["sensor_id"]).first()
    assert (short.lumpiness, short.stability) == (0.0, 0.0)


def test_native_kpis_join_everything(spark):
    df = series_df(spark, range(100)).unionByName(series_df(spark, [None] * 5, key=2)).unionByName(series_df(spark, [3.0], key=3))
    rows = {r.sensor_id: r for r in kpi.native_kpis(df, ["sensor_id"]).collect()}
    assert set(rows) == {1, 2, 3} and rows[1].mw == 49.5 and rows[2].mw is None and rows[3].acf1 is None


def test_fitted_figures():
    rng = np.random.default_rng(5)
    noise = rng.normal(size=400)
    wave = np.sin(np.arange(400) / 5) + 0.01 * noise
    assert kpi_fit.spectral_entropy(noise) > 0.95 > kpi_fit.spectral_entropy(wave)
    assert math.isnan(kpi_fit.spectral_entropy(np.full(20, 3.0)))
    assert np.array_equal(kpi_fit.longest_stretch(np.array([1, np.nan, 2, 3, np.nan])), [2, 3])


def test_fitted_kpis_over_batches(spark):
    """Series cut by small batches give what the whole series give; null keys are a series too."""
    rng = np.random.default_rng(9)
    data = {k: rng.normal(size=60 + 10 * (k or 0)) for k in (1, 2, 3, None)}
    rows = [(k, hours(i), float(v)) for k, x in data.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "sensor_id int, timestamp timestamp, value double").repartition(5)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        found = {r.sensor_id: r for r in kpi_fit.spectral_entropies(df, ["sensor_id"]).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert set(found) == set(data)
    for k, x in data.items():
        assert math.isclose(found[k].entropy, kpi_fit.spectral_entropy(x))


def test_model_figures_against_numpy(spark):
    rng = np.random.default_rng(6)
    data = {1: rng.normal(size=120), 2: np.cumsum(rng.normal(size=90)), None: np.concatenate((rng.normal(0, 1, 60), rng.normal(6, 1, 60))), 4: np.full(30, 2.0)}
    data[1][[30, 31, 80]] = np.nan
    rows = [(k, hours(i), None if np.isnan(v) else float(v)) for k, x in data.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "sensor_id int, timestamp timestamp, value double")
    found = {r.sensor_id: r for r in kpi_fit.fitted_kpis(df, ["sensor_id"], width=10, lags=3).collect()}
    assert set(found) == set(data)
    for k, x in data.items():
        squares = (x - np.nanmean(x)) ** 2
        windows = np.lib.stride_tricks.sliding_window_view(squares, 4)
        windows = windows[~np.isnan(windows).any(axis=1)]
        if k == 4:
            assert found[k].arch_stat is None and found[k].holt_alpha is None and found[k].max_kl_shift is None
            continue
        design, target = np.column_stack((np.ones(len(windows)), windows[:, :-1])), windows[:, -1]
        residual = target - design @ np.linalg.lstsq(design, target, rcond=None)[0]
        assert math.isclose(found[k].arch_stat, 1 - (residual**2).sum() / ((target - target.mean()) ** 2).sum(), rel_tol=1e-6, abs_tol=1e-9)
        stretch = kpi_fit.longest_stretch(x)

        def sse(a, b):
            level, trend, total = stretch[0], stretch[1] - stretch[0], 0.0
            for v in stretch[1:]:
                e = v - level - trend
                total, level, trend = total + e * e, level + trend + a * e, trend + b * e
            return total

        grid = [(a / 20, b / 20) for a in range(1, 20) for b in range(1, a + 1)]
        assert (found[k].holt_alpha, found[k].holt_beta) == min(grid, key=lambda p: (sse(*p), p))
        known = x[~np.isnan(x)]
        points = np.linspace(known.min(), known.max(), 100)
        q75, q25 = np.percentile(known, [75, 25])
        h = 0.9 * min(known.std(ddof=1), (q75 - q25) / 1.34) * len(known) ** -0.2
        density = np.exp(-0.5 * ((points - x[:, None]) / h) ** 2) / (h * np.sqrt(2 * np.pi))
        density = np.where(np.isnan(x)[:, None], np.nan, np.maximum(density, np.exp(-0.5 * 38.0**2) / np.sqrt(2 * np.pi)))
        means = np.array([np.nanmean(density[i : i + 10], axis=0) for i in range(len(x) - 9)])
        divergence = (means[:-9] * (np.log(means[:-9]) - np.log(means[9:]))).sum(axis=1) * (points[1] - points[0])
        steps = np.diff(divergence)
        assert math.isclose(found[k].max_kl_shift, steps.max(), rel_tol=1e-6) and found[k].max_kl_index == steps.argmax() + 11


# ---- series and features ----

def test_series_keeps_nulls_in_place(spark):
    df = spark.createDataFrame([(1, hours(2), 3.0, None), (1, hours(0), None, 7.0), (1, hours(1), 2.0, 8.0)], "k int, timestamp timestamp, a double, b double")
    row = series.build_series(df, ["k"], ["a", "b"]).first()
    assert row.a == [None, 2.0, 3.0] and row.b == [7.0, 8.0, None] and row.n == 3
    parts = series.build_series(df, ["k"], ["a"], period="hour").orderBy("period").collect()
    assert [p.a for p in parts] == [[None], [2.0], [3.0]]


def test_series_of_two_years_keep_one_start(spark):
    day = [(y, 1, d, b) for y in (2017, 2018) for d in (1, 2) for b in (0, 1)]
    names = {m: "cast(null as double)" for m in schemas.SERIES_MEASURES}
    rows = spark.createDataFrame([(h, *d) for h in ("a", None) for d in day], "hash string, year int, month int, day int, time_bin int")
    got = series.geo_series(rows.selectExpr("*", *[f"{e} as {m}" for m, e in names.items() if m not in rows.columns])).collect()
    assert sorted((r.hash or "", r.year, r.start_year, len(r.times)) for r in got) == [
        ("", 2017, 2017, 4), ("", 2018, 2017, 4), ("a", 2017, 2017, 4), ("a", 2018, 2017, 4),
    ]


def test_tiles_keep_hash_and_year_apart(spark):
    rows = [(f"u0wt8{i:07d}", 2018 + i % 2, y, [float(i), None]) for i in range(4) for y in (2018, 2019)] + [("u0wx1aaaaaaa", 2017, 2017, [1.0])]
    df = spark.createDataFrame(rows, "hash string, start_year int, year int, P1 array<double>")
    got = series.tile_series(df, ["P1"]).collect()
    assert len(got) == len(rows)
    assert {(r.hash_bin, r.start_year) for r in got} == {("u0wt8", 2019), ("u0wx1", 2017)}


def test_positions_in_order_of_appearance(spark):
    rows = [(1, float(i % 7), 48.0, hours(i)) for i in range(30)] + [(2, 9.0, 48.0, T0), (None, 9.0, None, T0)]
    df = spark.createDataFrame(rows, "sensor_id int, lon double, lat double, timestamp timestamp")
    got = series.position_lists(df).orderBy("sensor_id", "rank").collect()
    assert [(r.sensor_id, r.rank, r.lon) for r in got] == [(None, 1, 9.0), *[(1, i + 1, float(i)) for i in range(7)], (2, 1, 9.0)]


def test_null_keys_are_a_group(spark):
    df = spark.createDataFrame([(None, 2.0), (None, 4.0), (1, None), (1, 5.0), (1, 5.0)], "k int, value double")
    scaled = sorted(map(tuple, clean.scale_by_maximum(df, ["k"]).collect()), key=str)
    assert scaled == sorted([(None, 0.5), (None, 1.0), (1, None), (1, 1.0), (1, 1.0)], key=str)
    least = clean.with_group_minimum(df, ["k"], "value", "least")
    assert {(r.k, r.least) for r in least.collect()} == {(None, 2.0), (1, 5.0)}
    expected = df.selectExpr("k", "value", "rank() over (partition by k order by value) as rank").where("rank <= 2")
    got = quality.first_ranked(df, ["k"], "value", 2)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_a_wide_gap_is_filled_in_blocks(spark):
    df = spark.createDataFrame([(1, dt.datetime(1900, 1, 1), 1.0), (1, dt.datetime(2024, 1, 1), 2.0)], "k int, timestamp timestamp, value double")
    filled = resample.gap_fill(df, ["k"], 900)
    row = filled.selectExpr("count(*) as n", "count(distinct timestamp) as d", "count(value) as v").first()
    days = (dt.datetime(2024, 1, 1) - dt.datetime(1900, 1, 1)).days
    assert (row.n, row.d, row.v) == (days * 96 + 1, days * 96 + 1, 2)


def test_wide_compressible_table_is_not_broadcast(spark, tmp_path):
    """The file is far below the broadcast limit, its rows are far above it."""
    fact = spark.range(1000).withColumnRenamed("id", "k").repartition(2)
    spark.range(40_000).selectExpr("id as k", "repeat('x', 2000) as wide").coalesce(1).write.parquet(str(tmp_path / "d"))
    dim = spark.read.parquet(str(tmp_path / "d")).groupBy("k").agg(F.max("wide").alias("wide"))
    joined = scale.lookup_join(fact, dim, ["k"])
    assert joined.agg(F.sum(F.length("wide"))).first()[0] == 1000 * 2000
    assert "broadcast" not in joined._jdf.queryExecution().logical().toString().lower()


def test_lags_before_scaling(spark):
    df = series_df(spark, [1, 2, None, 4, 10])
    out = features.feature_table(df, ["sensor_id"], ["timestamp"], ["value"], "value", (1,)).orderBy("timestamp").collect()
    assert [r.value_lag1 for r in out] == [None, 1.0, 2.0, None, 4.0]
    filled = np.array([1, 2, 4.25, 4, 10])
    q1, q2, q3 = np.percentile(filled, [25, 50, 75])
    assert np.allclose([r.value_feat for r in out], (filled - q2) / (q3 - q1))


def test_scaling_edge_cases(spark):
    flat = features.impute_and_scale(series_df(spark, [3, 3, None]), ["sensor_id"], ["value"], ["timestamp"]).collect()
    assert [r.value_feat for r in flat] == [0.0, 0.0, 0.0]
    empty = features.impute_and_scale(series_df(spark, [None, None]), ["sensor_id"], ["value"], ["timestamp"]).collect()
    assert [r.value_feat for r in empty] == [None, None]


def test_mutual_information(spark):
    rng = random.Random(7)
    rows = [(x := rng.random(), x * 2, rng.random()) for _ in range(2000)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    found = {r.feature: r.score for r in features.mutual_information(df, ["x", "z"], "y", 8).collect()}
    assert found["x"] > 1.9 and found["z"] < 0.1
    best = features.best_features(features.mutual_information(df, ["x", "z"], "y", 8), 1).collect()
    assert [r.feature for r in best] == ["x"]


def test_mutual_information_of_skewed_values(spark):
    rng = random.Random(9)
    rows = [(x := rng.random(), math.exp(20 * x), None if i % 5 else 1.0, None) for i in range(2000)]
    df = spark.createDataFrame(rows, "x double, y double, z double, none double")
    by_counts, by_widths = (
        {r.feature: r.score for r in features.mutual_information(df, ["x", "z", "none"], "y", 8, cuts).collect()} for cuts in ("quantile", "width")
    )
    assert math.isclose(by_counts["x"], math.log(8), rel_tol=1e-3) and by_widths["x"] < 0.6
    assert by_counts["z"] == 0 and "none" not in by_counts
    assert features.mutual_information(df.limit(0), ["x"], "y").collect() == []
    with pytest.raises(ValueError):
        features.mutual_information(df, ["x"], "y", cuts="other")


def test_random_sample_is_the_same_for_any_partitioning(spark):
    rows = [(i, f"k{i % 7}", None if i % 3 else "s") for i in range(4000)]
    df = spark.createDataFrame(rows, "i long, k string, n string")
    draws = [sorted(quality.random_sample(df.repartition(n), ["i", "n"], 1.5).collect(), key=str) for n in (1, 7)]
    assert draws[0] == draws[1]
    counts = collections.Counter(r.i for r in draws[0])
    shares = [sum(c == k for c in counts.values()) / 4000 for k in (1, 2, 3)]
    expected = [math.exp(-1.5) * 1.5**k / math.factorial(k) for k in (1, 2, 3)]
    assert all(abs(s - e) < 0.03 for s, e in zip(shares, expected))
    assert quality.random_sample(df, ["i"], 0).count() == 0
    assert abs(quality.random_sample(df, ["i"], 100).count() / 4000 - 100) < 1
    once = quality.random_sample(df, ["i"], 0.25, with_replacement=False)
    assert once.count() == once.distinct().count() and abs(once.count() / 4000 - 0.25) < 0.03
    other = quality.random_sample(df, ["i"], 0.25, with_replacement=False, seed=1)
    assert 100 < other.join(once, "i").count() < 400
    for fraction in (-0.1, 101):
        with pytest.raises(ValueError):
            quality.random_sample(df, ["i"], fraction)


def test_select_features():
    names = ["P1", "P1_feat", "P2_feat", "P1_lag48_feat", "humidity_feat"]
    assert features.select_features(names) == (["P1_lag48_feat", "humidity_feat"], "P1_feat")


def test_boosting(spark):
    rng = random.Random(8)
    rows = [(x := rng.uniform(0, 10), rng.random(), math.sin(x) * 5) for _ in range(400)]
    data = model.assemble(spark.createDataFrame(rows, "a_feat double, b_feat double, P1_feat double"), ["a_feat", "b_feat"], "P1_feat")
    boosted = model.fit_adaboost(data, depth=4, rounds=6)
    error = quality.rmse(boosted.transform(data), "prediction", "label").first().rmse
    assert error < 1.5 and boosted.importances()[0] > boosted.importances()[1]
    gradient = model.fit_gradient_boosting(data, depth=4, rounds=5)
    assert quality.rmse(gradient.transform(data), "prediction", "label").first().rmse < 1.5
    ranked = model.ranked_importance(data, ["a_feat", "b_feat"], boosted.importances()).collect()
    assert [r.feature for r in ranked] == ["a_feat", "b_feat"]
