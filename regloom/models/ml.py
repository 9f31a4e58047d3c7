"""``pyspark.ml`` adapter: any regloom regressor as an ``Estimator`` so it can
sit in a ``pyspark.ml.Pipeline`` next to built-in stages (L3)."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol, Param, Params, TypeConverters
from pyspark.sql import DataFrame

from .base import FittedModel, Regressor, ScaledRegressor


class _HasFeatureCols(Params):
    featureCols = Param(Params._dummy(), "featureCols", "input feature columns",
                        typeConverter=TypeConverters.toListString)

    def getFeatureCols(self) -> list[str]:
        return self.getOrDefault(self.featureCols)


class RegressorModel(Model, _HasFeatureCols, HasLabelCol, HasPredictionCol):
    """Fitted stage; ``transform`` appends the prediction column."""

    def __init__(self, fitted: FittedModel | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.transform(dataset, self.getPredictionCol())


class RegressorEstimator(Estimator, _HasFeatureCols, HasLabelCol, HasPredictionCol):
    """Wraps a regloom ``Regressor`` (standardised first when ``scale``)."""

    def __init__(self, regressor: Regressor | None = None, featureCols: list[str] | None = None,
                 labelCol: str = "label", predictionCol: str = "prediction", scale: bool = True):
        super().__init__()
        self.regressor = regressor
        self.scale = scale
        self._setDefault(labelCol="label", predictionCol="prediction")
        self._set(labelCol=labelCol, predictionCol=predictionCol)
        if featureCols is not None:
            self._set(featureCols=featureCols)

    def _fit(self, dataset: DataFrame) -> RegressorModel:
        reg = ScaledRegressor(self.regressor) if self.scale else self.regressor
        fitted = reg.fit(dataset, self.getFeatureCols(), self.getLabelCol())
        model = RegressorModel(fitted)
        model._set(featureCols=self.getFeatureCols(), labelCol=self.getLabelCol(),
                   predictionCol=self.getPredictionCol())
        return model
