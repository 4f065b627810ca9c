"""Frequent patterns (M1-M4): baskets, FP-growth itemsets, association rules."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["baskets", "fit_fpgrowth", "frequent_itemsets", "association_rules", "top_rules"]


def baskets(df: DataFrame, cols: Sequence[str], out: str = "items") -> DataFrame:
    """M1: unique non-null items per row (same pickup and dropoff zone -> one item)."""
    return df.select(F.array_compact(F.array_distinct(F.array(*[F.col(c) for c in cols]))).alias(out))


def fit_fpgrowth(b: DataFrame, min_support: float = 0.001, min_confidence: float = 0.2,
                 items: str = "items") -> FPGrowthModel:
    """Parallel FP-growth (item groups are mined in parallel after one shuffle)."""
    return FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=min_confidence,
                    numPartitions=b.sparkSession.sparkContext.defaultParallelism).fit(b)


def frequent_itemsets(model: FPGrowthModel, n_baskets=None, digits: int = 9) -> DataFrame:
    """M2: ``(items sorted, size, freq[, support])``."""
    f = model.freqItemsets.select(F.array_sort("items").alias("items"),
                                  F.size("items").alias("size"), F.col("freq").cast("bigint").alias("freq"))
    if n_baskets is not None:
        f = f.withColumn("support", F.round(F.col("freq") / n_baskets, digits))
    return f


def association_rules(model: FPGrowthModel, digits: int = 9) -> DataFrame:
    """M3: single-item consequent rules with support, confidence and lift."""
    r = model.associationRules
    return r.select(F.array_sort("antecedent").alias("antecedent"), F.col("consequent")[0].alias("consequent"),
                    F.round("support", digits).alias("support"), F.round("confidence", digits).alias("confidence"),
                    F.round("lift", digits).alias("lift"))


def top_rules(rules: DataFrame, by: str = "confidence", k: int = 10) -> DataFrame:
    """M4: top-k rules by ``by`` (ties -> antecedent, consequent)."""
    return rules.orderBy(F.desc(by), F.col("antecedent").cast("string"), "consequent").limit(k)
