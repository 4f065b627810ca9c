"""Reports over arriving parts, from stored partial aggregates.

Each part (a month, a day) is read once; what stays is a few numbers a key or
rule.  A part that arrives again replaces its own partial result, so a
repeated or retried load counts once.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.quality import Rule, rule_audit

__all__ = ["pair_part", "merge_pairs", "audit_part", "merge_audits", "store_part", "stored_parts"]


def pair_part(pairs: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """G6 of one part, mergeable: ``(key, s, n, n_values, lo, hi)``."""
    return pairs.groupBy(F.col(key).alias("key")).agg(F.sum(value).alias("s"), F.count(F.lit(1)).alias("n"), F.count(value).alias("n_values"),
                                                      F.min(value).alias("lo"), F.max(value).alias("hi"))


def merge_pairs(parts: DataFrame, key: str = "key") -> DataFrame:
    """:func:`quarry.operators.aggregate.reduce_pairs` of all parts, without their rows."""
    return parts.groupBy(F.col("key").alias(key)).agg(
        F.sum("s").alias("total_revenue"), F.sum("n").alias("trip_count"), F.try_divide(F.sum("s"), F.sum("n_values")).alias("avg_fare"),
        F.min("lo").alias("min_fare"), F.max("hi").alias("max_fare")).orderBy(F.desc("total_revenue"), key)


def audit_part(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Q1 of one part: its rule counts, which add up over parts."""
    return rule_audit(df, rules)


def merge_audits(parts: DataFrame) -> DataFrame:
    """Q1 of all parts."""
    return parts.groupBy("rule_order", "rule").agg(F.sum("removed").alias("removed"))


def store_part(partial: DataFrame, folder: str, part: str) -> None:
    """Keep a part's partial result, in place of an earlier one of the same part."""
    partial.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/part={part}")


def stored_parts(spark: SparkSession, folder: str) -> DataFrame:
    """All partial results kept, with their ``part``."""
    return spark.read.parquet(folder)
