"""The calendar and geohash expressions as ML pipeline stages."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from airq.functions.calendar import add_calendar
from airq.functions.geo import add_geohash


class CalendarTransformer(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the calendar struct of a timestamp column."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_calendar(dataset, self.getInputCol(), self.getOutputCol())


class GeohashTransformer(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the geohash struct of a latitude and a longitude column."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        lat, lon = self.getInputCols()
        return add_geohash(dataset, lat, lon, self.getOutputCol())
