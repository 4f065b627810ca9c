"""Utility and detectability of synthetic data."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["detectability", "tstr"]


def detectability(real: DataFrame, synth: DataFrame, numeric: Sequence[str], seed: int = 42, digits: int = 4) -> DataFrame:
    """T5: silhouette (times 100) of two clusters over the standardised union of both
    sides; rows with a null among the columns are left out."""
    u = real.select(*numeric).unionByName(synth.select(*numeric)).dropna()
    v = VectorAssembler(inputCols=list(numeric), outputCol="_v").transform(u)
    s = StandardScaler(inputCol="_v", outputCol="features", withMean=True, withStd=True).fit(v).transform(v)
    pred = KMeans(k=2, seed=seed, predictionCol="cluster").fit(s).transform(s)
    sil = ClusteringEvaluator(predictionCol="cluster").evaluate(pred)
    return real.sparkSession.range(1).select(F.lit(round(sil * 100, digits)).alias("detectability_score"))


def tstr(real: DataFrame, synth: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str,
         max_iter: int = 200, digits: int = 6) -> DataFrame:
    """Accuracy on the real side of a classifier trained on the synthetic side;
    categories unseen in training are one category of their own."""
    idx, vec = [f"_i_{c}" for c in categorical], [f"_v_{c}" for c in categorical]
    stages = [StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep"), OneHotEncoder(inputCols=idx, outputCols=vec)] if categorical else []
    pipe = Pipeline(stages=[*stages, VectorAssembler(inputCols=[*numeric, *vec], outputCol="features", handleInvalid="skip"),
                            LogisticRegression(labelCol=label, maxIter=max_iter)])
    model = pipe.fit(synth)
    acc = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy").evaluate(model.transform(real))
    return real.sparkSession.range(1).select(F.lit(round(acc, digits)).alias("tstr_accuracy"))
