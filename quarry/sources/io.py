"""Scans, sources and sinks.

All readers take explicit schemas (no ``inferSchema`` extra job); all
writers are distributed (single-file output is opt-in only).
"""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "ZONES_SCHEMA", "RATINGS_TSV_SCHEMA", "read_table", "read_csv", "read_delimited",
    "parse_pairs", "write_csv", "write_report", "read_report", "small",
    "labelled_text", "lines_count", "lines_containing", "distinct_field", "inspect",
    "schema_table",
]

ZONES_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

RATINGS_TSV_SCHEMA = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("timestamp", T.LongType()),
])


def read_table(spark: SparkSession, *paths: str) -> DataFrame:
    """One or many Parquet paths (pushdown + pruning happen in the scan)."""
    return spark.read.parquet(*paths)


def read_csv(spark: SparkSession, path, schema: T.StructType, header: bool = True,
             sep: str = ",") -> DataFrame:
    """CSV with header and a fixed schema (no inference pass)."""
    return spark.read.csv(path, schema=schema, header=header, sep=sep, quote='"', mode="PERMISSIVE")


def read_delimited(spark: SparkSession, path, sep: str = "\t",
                   schema: T.StructType = RATINGS_TSV_SCHEMA) -> DataFrame:
    """S3: headerless delimited text with supplied names and types."""
    return spark.read.csv(path, schema=schema, header=False, sep=sep)


NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity)$"


def parse_pairs(lines: DataFrame, sep: str = ",", default_key: str | None = "Unknown",
                skip_prefixes: Sequence[str] = (), line_col: str = "value",
                strip: bool = True) -> DataFrame:
    """Tolerant ``key<sep>amount`` parser -> ``(key string, value double)``.

    Lines with fewer than two fields, a non-numeric / NaN / non-positive
    amount, or a header prefix are skipped.  A blank key becomes
    ``default_key`` (``None`` keeps it blank).
    """
    raw = F.col(line_col)
    keep = raw.isNotNull()
    for p in skip_prefixes:
        keep = keep & ~raw.startswith(p)
    line = F.trim(raw) if strip else raw
    # split once; a generated column, so that the filters below are not pushed
    # under it with the whole line expression copied into each of them
    parts = lines.where(keep).select(F.explode_outer(F.array(F.split(line, re.escape(sep)))).alias("_p"))
    key = F.get(F.col("_p"), 0)
    if default_key is not None:
        key = F.when(key == "", F.lit(default_key)).otherwise(key)
    # the text must be a plain number: casts also take suffixes such as 12.5d
    text = F.trim(F.get(F.col("_p"), 1))
    amount = F.when(text.rlike(NUMBER), text.try_cast("double"))
    out = (parts.where(F.size("_p") >= 2)
           .select(key.alias("key"), amount.alias("value"))
           .where(F.col("value").isNotNull() & ~F.isnan("value") & (F.col("value") > 0)))
    return out


def write_csv(df: DataFrame, path: str, single_file: bool = False, header: bool = False) -> None:
    """Headerless CSV overwrite; one part file only when asked."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").csv(path, header=header)


def write_report(df: DataFrame, path: str) -> None:
    """Metadata / score tables as JSON lines."""
    df.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Reload a report written by :func:`write_report`."""
    r = spark.read
    return (r.schema(schema) if schema is not None else r).json(path)


def small(df: DataFrame, n: int = 20, order_by: Sequence | None = None) -> list:
    """Bounded fetch of an already aggregated result (at most ``n`` rows)."""
    d = df.orderBy(*order_by) if order_by else df
    return d.limit(n).collect()


def labelled_text(docs: DataFrame, labels: DataFrame, key: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality",
                  test_frac: float = 0.2, seed: int = 42) -> DataFrame:
    """``(id, text, label, split)``; split is a seeded md5 threshold on the id."""
    from quarry.operators.sampling import unit_hash
    j = docs.select(key, text_col).join(labels.select(key, label_col), key, "inner")
    u = unit_hash(F.col(key), seed)
    return j.select(key, F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"),
                    F.when(u < F.lit(test_frac), "test").otherwise("train").alias("split"))


def lines_count(lines: DataFrame) -> DataFrame:
    """S10 ``wc -l``."""
    return lines.agg(F.count(F.lit(1)).alias("n_lines"))


def lines_containing(lines: DataFrame, needle: str, n: int = 5, line_col: str = "value",
                     order_col: str | None = None) -> DataFrame:
    """S10 ``grep needle | head -n`` (ordered by ``order_col`` for determinism)."""
    f = lines.where(F.col(line_col).contains(needle))
    if order_col:
        f = f.orderBy(order_col)
    return f.limit(n)


def distinct_field(lines: DataFrame, i: int, sep: str = ",", line_col: str = "value") -> DataFrame:
    """S10 ``cut -d, -f(i+1) | sort | uniq``."""
    return (lines.select(F.get(F.split(F.col(line_col), re.escape(sep)), i).alias("field"))
            .where(F.col("field").isNotNull()).distinct())


def schema_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Schema as rows ``(position, column, type, n_values)``; ``n_values`` counts the
    non-null values, all in one scan."""
    fields = list(enumerate(df.schema.fields))
    n = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in fields])
    st = ", ".join(f"{i}, '{f.name}', '{f.dataType.simpleString()}', n{i}" for i, f in fields)
    return n.selectExpr(f"stack({len(fields)}, {st}) as (position, column, type, n_values)")


def inspect(df: DataFrame) -> DataFrame:
    """One-row shape summary ``(n_rows, n_columns)``; schema via :func:`schema_table`."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))
