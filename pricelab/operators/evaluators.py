"""SMAPE as a Spark ML ``Evaluator`` (one distributed aggregate per evaluation)."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import functions as F

from ..functions.errors import smape_term


class SmapeEvaluator(Evaluator):
    """SMAPE of ``predictionCol`` against ``labelCol``; ``logSpace`` back-transforms both first.

    ``isLargerBetter`` is False: model selection minimises it (equivalent to maximising the scorer)."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", typeConverter=TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", typeConverter=TypeConverters.toString)
    logSpace = Param(Params._dummy(), "logSpace", "inputs are log1p values", typeConverter=TypeConverters.toBoolean)

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction", logSpace: bool = False):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction", logSpace=False)
        self._set(labelCol=labelCol, predictionCol=predictionCol, logSpace=logSpace)

    def _evaluate(self, dataset) -> float:
        t = F.col(self.getOrDefault(self.labelCol)).cast("double")
        p = F.col(self.getOrDefault(self.predictionCol)).cast("double")
        if self.getOrDefault(self.logSpace):
            t, p = F.expm1(t), F.expm1(p)
        row = dataset.agg((100.0 * F.avg(smape_term(t, p))).alias("s")).collect()[0]
        return float(row["s"])

    def isLargerBetter(self) -> bool:
        return False
