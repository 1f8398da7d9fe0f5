"""Fitted feature steps: what training fits is what scoring applies.

A user's step is a Spark ML ``Estimator`` or ``Transformer``.  ``training.train`` fits them in
order on the training rows and keeps them in the model's own pipeline, so they are saved,
loaded and applied with it.  ``SymbolScaler`` is one such step, with its state in Parquet.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCols, HasOutputCols, Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.sqltext import q


class _ScalerParams(HasInputCols, HasOutputCols):
    groupCol = Param(Params._dummy(), "groupCol", "column whose values are scaled apart", TypeConverters.toString)

    def _stored(self) -> list[str]:
        return [x for i in range(len(self.getInputCols())) for x in (f"mean_{i}", f"std_{i}")]


class SymbolScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Distance from the training mean in training standard deviations, per symbol.

    Null and NaN count as missing.  A symbol without training rows, and a column that did not
    vary, give null.
    """

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None, groupCol: str = "symbol_id"):
        super().__init__()
        self._setDefault(groupCol="symbol_id")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> SymbolScalerModel:
        group = self.getOrDefault(self.groupCol)
        shown = []
        for i, c in enumerate(self.getInputCols()):
            x = f"nanvl(CAST({q(c)} AS DOUBLE), NULL)"
            shown += [F.expr(f"avg({x}) AS mean_{i}"), F.expr(f"stddev_samp({x}) AS std_{i}")]
        # A row per symbol, computed when it is first needed.
        state = dataset.groupBy(F.col(q(group)).cast("string").alias("symbol")).agg(*shown)
        return self._copyValues(SymbolScalerModel(state))


class SymbolScalerModel(Model, _ScalerParams, MLReadable, MLWritable):
    def __init__(self, state: DataFrame | None = None):
        super().__init__()
        self._setDefault(groupCol="symbol_id")
        self.state = state

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = self.state.withColumnsRenamed({c: f"_fitted_{c}" for c in self.state.columns})
        group = self.getOrDefault(self.groupCol)
        # A row per symbol: broadcast by Spark when it is small.
        joined = dataset.join(state, F.expr(f"CAST({q(group)} AS STRING) <=> _fitted_symbol"), "left")
        made = []
        for i, (c, out) in enumerate(zip(self.getInputCols(), self.getOutputCols())):
            x = f"nanvl(CAST({q(c)} AS DOUBLE), NULL)"
            made.append(f"({x} - _fitted_mean_{i}) / nullif(_fitted_std_{i}, 0D) AS {q(out)}")
        return joined.selectExpr(*[q(c) for c in dataset.columns if c not in self.getOutputCols()], *made)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: SymbolScalerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.state.write.mode("overwrite").parquet(f"{path}/state")


class _Reader(MLReader):
    def load(self, path: str) -> SymbolScalerModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark, SymbolScalerModel.__module__ + ".SymbolScalerModel")
        model = SymbolScalerModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        kinds = ", ".join(["symbol string", *[f"{c} double" for c in model._stored()]])
        model.state = spark.read.schema(kinds).parquet(f"{path}/state")
        return model
