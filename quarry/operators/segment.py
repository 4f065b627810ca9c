"""Segmentation and feature operators (M5-M13): Spark ML pipelines."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.predicates import SEGMENT_HOURS, time_bucket

__all__ = ["segment_features", "index_and_encode", "segment", "silhouette", "cluster_centres",
           "standardise"]


def segment_features(trips: DataFrame, location: str = "PULocationID", ts: str = "pickup_ts",
                     distance: str = "trip_distance", amount: str = "total_amount") -> DataFrame:
    """M5: average distance and amount per (location, time of day), null rows dropped."""
    t = trips.withColumn("time_of_day", time_bucket(ts, SEGMENT_HOURS))
    return (t.groupBy(location, "time_of_day")
            .agg(F.avg(distance).alias("avg_trip_distance"), F.avg(amount).alias("avg_total_amount"))
            .na.drop())


def index_and_encode(df: DataFrame, col: str, drop_last: bool = True) -> tuple[DataFrame, PipelineModel]:
    """M6 + M7: frequency-ordered string index (ties alphabetical) and one-hot vector."""
    p = Pipeline(stages=[
        StringIndexer(inputCol=col, outputCol=f"{col}_index", stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=[f"{col}_index"], outputCols=[f"{col}_vec"], dropLast=drop_last)])
    m = p.fit(df)
    return m.transform(df), m


def segment(features: DataFrame, numeric: Sequence[str], category: str, k: int = 3,
            seed: int = 42) -> tuple[DataFrame, PipelineModel]:
    """M8 + M9: index, one-hot, assemble, k-means (k=3, seed=42)."""
    p = Pipeline(stages=[
        StringIndexer(inputCol=category, outputCol=f"{category}_index", stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=[f"{category}_index"], outputCols=[f"{category}_vec"]),
        VectorAssembler(inputCols=[*numeric, f"{category}_vec"], outputCol="features"),
        KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster")])
    m = p.fit(features)
    return m.transform(features), m


def silhouette(pred: DataFrame, features: str = "features", prediction: str = "cluster") -> float:
    """Squared-Euclidean silhouette (a distributed evaluation job)."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=prediction).evaluate(pred)


def cluster_centres(model: PipelineModel, numeric: Sequence[str], category: str,
                    pred: DataFrame) -> DataFrame:
    """Centre per cluster with its typical time of day decoded by label
    (the modal category of the cluster's rows, not an arg-max over one-hot slots)."""
    km = model.stages[-1]
    spark = pred.sparkSession
    rows = [(i, *[float(v) for v in c[: len(numeric)]]) for i, c in enumerate(km.clusterCenters())]
    cent = spark.createDataFrame(rows, ["cluster", *numeric])
    mode = (pred.groupBy("cluster", category).agg(F.count(F.lit(1)).alias("_n"))
            .groupBy("cluster").agg(F.min_by(category, F.struct(-F.col("_n"), F.col(category))).alias(f"typical_{category}"),
                                    F.sum("_n").alias("n_rows")))
    return cent.join(mode, "cluster")


def standardise(df: DataFrame, cols: Sequence[str], out: str = "scaled") -> DataFrame:
    """Zero mean, unit (sample) variance; vector -> array column."""
    a = VectorAssembler(inputCols=list(cols), outputCol="_v").transform(df)
    s = StandardScaler(inputCol="_v", outputCol="_s", withMean=True, withStd=True).fit(a).transform(a)
    return s.withColumn(out, vector_to_array("_s")).drop("_v", "_s")
