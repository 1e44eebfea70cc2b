"""Imputing and scaling of series as an estimator and a model that are saved, loaded and used in pipelines."""

from __future__ import annotations

import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airq.operators.scale import lookup_join

QUARTILES = (0.25, 0.5, 0.75)


class _SeriesParams(HasInputCols):
    keyCols: Param[list[str]] = Param(Params._dummy(), "keyCols", "columns that tell series apart", TypeConverters.toListString)
    suffix: Param[str] = Param(Params._dummy(), "suffix", "what the names of scaled columns end with", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(suffix="feat")


def series_figures(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``(keys, figures)``: per series and column the mean, and the quartiles of the column filled with it.

    Means come first, from one aggregate; the second one counts equal values before its shuffle. A column without
    any value has null figures; null keys are a series.
    """
    means = df.groupBy(*keys).agg(F.struct(*[F.avg(c).cast("double").alias(c) for c in columns]).alias("_means"))
    filled = lookup_join(df.select(*keys, *columns), means, keys, "inner", null_safe=True)
    shares = F.array(*[F.lit(p) for p in QUARTILES])
    figures = [
        F.struct(
            F.first(f"_means.{c}").alias("mean"),
            F.percentile(F.coalesce(F.col(c).cast("double"), F.col(f"_means.{c}")), shares).alias("quartiles"),
        ).alias(c)
        for c in columns
    ]
    return filled.groupBy(*keys).agg(F.struct(*figures).alias("figures"))


class SeriesScaler(Estimator, _SeriesParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns mean and quartiles of each series and column; see ``SeriesScalerModel``."""

    @keyword_only
    def __init__(self, *, keyCols: list[str] | None = None, inputCols: list[str] | None = None, suffix: str = "feat"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SeriesScalerModel:
        keys, columns = self.getOrDefault("keyCols"), self.getInputCols()
        model = SeriesScalerModel(series_figures(dataset, keys, columns))
        return self._copyValues(model)


class _ModelWriter(MLWriter):
    def __init__(self, instance: SeriesScalerModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.figures.write.parquet(os.path.join(path, "figures"))


class _ModelReader(MLReader):
    def load(self, path: str) -> SeriesScalerModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = SeriesScalerModel(spark.read.parquet(os.path.join(path, "figures")))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class SeriesScalerModel(Model, _SeriesParams, MLReadable, MLWritable):
    """Nulls to the series' learned mean, then minus the median over the interquartile range.

    A range of 0 divides by 1. Rows of a series that was not learned, and columns without any learned value, give
    null. The figures of a series are one row, met in one join.
    """

    def __init__(self, figures: DataFrame | None = None):
        super().__init__()
        self.figures = figures

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        keys, columns, suffix = self.getOrDefault("keyCols"), self.getInputCols(), self.getOrDefault("suffix")
        joined = lookup_join(dataset, self.figures.withColumnRenamed("figures", "_figures"), keys, "left", null_safe=True)

        def scaled(c: str) -> Column:
            figure = F.col("_figures")[c]
            low, middle, high = (figure["quartiles"][i] for i in range(3))
            x = F.coalesce(F.col(c).cast("double"), figure["mean"])
            return (x - middle) / F.when(high == low, F.lit(1.0)).otherwise(high - low)

        return joined.withColumns({f"{c}_{suffix}": scaled(c) for c in columns}).drop("_figures")
