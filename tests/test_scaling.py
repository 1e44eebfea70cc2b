"""The scaler of series as a stage: equal to the window form, saved and loaded alone and in a pipeline."""

import datetime as dt
import random

import pytest
from pyspark.ml import Pipeline, PipelineModel

from airq.operators.scaling import SeriesScaler, SeriesScalerModel
from airq.functions.transformers import CalendarTransformer
from airq.operators.features import impute_and_scale

T0 = dt.datetime(2018, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    found = []
    for sensor in ("a", "b", None, "constant", "nothing"):
        for i in range(60):
            x = {"constant": 2.0, "nothing": None}.get(sensor, rng.gauss(3, 2))
            found.append((sensor, T0 + dt.timedelta(hours=i), None if rng.random() < 0.3 else x, rng.random(), "extra"))
    return spark.createDataFrame(found, "sensor string, timestamp timestamp, P1 double, P2 double, figures string").repartition(3)


def by_row(df):
    return {(r.sensor, r.timestamp): (r.P1_feat, r.P2_feat) for r in df.collect()}


def test_equal_to_the_window_form(rows):
    model = SeriesScaler(keyCols=["sensor"], inputCols=["P1", "P2"]).fit(rows)
    found = by_row(model.transform(rows))
    expected = by_row(impute_and_scale(rows, ["sensor"], ["P1", "P2"], ["timestamp"]))
    assert found.keys() == expected.keys()
    for k, pair in expected.items():
        assert found[k] == pytest.approx(pair) if None not in pair else found[k][0] == pair[0]
    assert model.transform(rows).columns == [*rows.columns, "P1_feat", "P2_feat"]


def test_learned_rows_and_others(spark, rows):
    model = SeriesScaler(keyCols=["sensor"], inputCols=["P1", "P2"], suffix="s").fit(rows.where("sensor = 'a'"))
    later = spark.createDataFrame([("a", 3.0, None), ("unknown", 3.0, 1.0), (None, 3.0, 1.0)], "sensor string, P1 double, P2 double")
    found = {r.sensor: (r.P1_s, r.P2_s) for r in model.transform(later).collect()}
    assert found["unknown"] == found[None] == (None, None) and None not in found["a"]
    empty = SeriesScaler(keyCols=["sensor"], inputCols=["P1"]).fit(rows.limit(0))
    assert [r.P1_feat for r in empty.transform(later).collect()] == [None] * 3


def test_saved_and_loaded(rows, tmp_path):
    scaler = SeriesScaler(keyCols=["sensor"], inputCols=["P1", "P2"])
    scaler.save(str(tmp_path / "scaler"))
    assert SeriesScaler.load(str(tmp_path / "scaler")).getInputCols() == ["P1", "P2"]
    pipeline = Pipeline(stages=[CalendarTransformer(inputCol="timestamp", outputCol="datedim"), scaler])
    fitted = pipeline.fit(rows)
    fitted.save(str(tmp_path / "pipeline"))
    again = PipelineModel.load(str(tmp_path / "pipeline"))
    assert by_row(again.transform(rows)) == by_row(fitted.transform(rows))
    model = fitted.stages[1]
    model.save(str(tmp_path / "model"))
    loaded = SeriesScalerModel.load(str(tmp_path / "model"))
    assert loaded.uid == model.uid and by_row(loaded.transform(rows)) == by_row(model.transform(rows))
    model.write().overwrite().save(str(tmp_path / "model"))
