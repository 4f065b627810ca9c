"""Sources that differ from file to file, or hold rows that do not parse."""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.io import NUMBER

__all__ = ["wider_type", "read_widened", "parse_pairs_checked", "read_csv_checked", "rejected_counts", "write_checked"]

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that takes both: whole numbers the wider one, decimals with
    room for both, any number beside a float or double a double, a date beside a
    timestamp the timestamp; what has nothing in common becomes text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    whole = [isinstance(x, _WHOLE) for x in (a, b)]
    if all(whole):
        return max(a, b, key=lambda x: _WHOLE.index(type(x)))
    if all(isinstance(x, (T.NumericType,)) for x in (a, b)):
        if any(isinstance(x, (T.FloatType, T.DoubleType)) for x in (a, b)):
            return T.DoubleType()
        a, b = (T.DecimalType(_DIGITS[type(x)], 0) if w else x for x, w in zip((a, b), whole))
        scale, whole_digits = max(a.scale, b.scale), max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole_digits + scale, scale) if whole_digits + scale <= 38 else T.DoubleType()
    if isinstance(a, T.DateType) and isinstance(b, (T.TimestampType, T.TimestampNTZType)):
        return b
    if isinstance(b, T.DateType) and isinstance(a, (T.TimestampType, T.TimestampNTZType)):
        return a
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider_type(a.elementType, b.elementType), True)
    return T.StringType()


def read_widened(spark: SparkSession, paths: Sequence[str], file_col: str | None = None) -> DataFrame:
    """S1 over Parquet files whose schemas differ, such as monthly files: one table with
    all their columns.

    Each path's schema comes from its footers; paths of one schema are one scan,
    so filters and column selection still reach every file.  Columns are matched
    by name, whatever their case (the first spelling stays), and widened by
    :func:`wider_type`; a column that a file lacks is null there.  ``file_col``
    keeps each row's source file."""
    if not paths:
        raise ValueError("no paths")
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for p in paths:
        schema = spark.read.parquet(p).schema
        groups.setdefault(schema.json(), (schema, []))[1].append(p)
    name: dict[str, str] = {}
    kind: dict[str, T.DataType] = {}
    for schema, _ in groups.values():
        for f in schema.fields:
            k = f.name.lower()
            name.setdefault(k, f.name)
            kind[k] = wider_type(kind.get(k, T.NullType()), f.dataType)
    out = None
    for schema, of in groups.values():
        own = {f.name.lower(): f.name for f in schema.fields}
        cols = [(F.col(f"`{own[k]}`") if k in own else F.lit(None)).cast(kind[k]).alias(name[k]) for k in name]
        if file_col:
            cols.append(F.col("_metadata.file_path").alias(file_col))
        part = spark.read.schema(schema).parquet(*of).select(*cols)
        out = part if out is None else out.unionByName(part)
    return out


def parse_pairs_checked(lines: DataFrame, sep: str = ",", default_key: str | None = "Unknown", skip_prefixes: Sequence[str] = (),
                        line_col: str = "value", strip: bool = True) -> DataFrame:
    """S4 with the lines it leaves out: ``(key, value, line, reason)``, one row a line.

    ``reason`` is null for the rows that :func:`quarry.sources.io.parse_pairs`
    gives; else the first that holds of ``null_line``, ``header``,
    ``too_few_fields``, ``not_a_number`` and ``not_positive``.  One pass, and kept
    and rejected rows together are all lines."""
    raw = F.col(line_col)
    line = F.trim(raw) if strip else raw
    parts = lines.select(raw.alias("line"), F.explode_outer(F.array(F.split(line, re.escape(sep)))).alias("_p"))
    text = F.trim(F.get(F.col("_p"), 1))
    amount = F.when(text.rlike(NUMBER), text.try_cast("double"))
    head = F.lit(False)
    for p in skip_prefixes:
        head = head | F.col("line").startswith(p)
    reason = F.when(F.col("line").isNull(), "null_line").when(head, "header").when(F.size("_p") < 2, "too_few_fields") \
        .when(amount.isNull(), "not_a_number").when(~(amount > 0), "not_positive")
    key = F.get(F.col("_p"), 0)
    if default_key is not None:
        key = F.when(key == "", F.lit(default_key)).otherwise(key)
    ok = F.col("reason").isNull()
    return parts.select(key.alias("key"), amount.alias("value"), "line", reason.alias("reason")) \
        .select(F.when(ok, F.col("key")).alias("key"), F.when(ok, F.col("value")).alias("value"), "line", "reason")


def read_csv_checked(spark: SparkSession, path, schema: T.StructType, header: bool = True, sep: str = ",") -> DataFrame:
    """S2/S3 with the records that do not fit: the columns of ``schema``, and ``reason``
    and ``record``, both null for rows that fit.

    ``reason`` is ``field_count``, or ``bad_<column>`` for the first column whose
    text is no value of its type; ``record`` is the record as it stands in the
    file.  Columns of a rejected record are null."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField("_record", T.StringType())])
    raw = spark.read.csv(path, schema=text, header=header, sep=sep, quote='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_record",
                         enforceSchema=True)
    cells = {f.name: F.col(f"`{f.name}`") for f in schema.fields}
    reason = F.when(F.col("_record").isNotNull(), "field_count")
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            reason = reason.when(cells[f.name].isNotNull() & F.trim(cells[f.name]).try_cast(f.dataType).isNull(), f"bad_{f.name}")
    line = F.coalesce("_record", F.to_csv(F.struct(*cells.values()), {"sep": sep}))
    r = raw.withColumn("_reason", reason)
    ok = F.col("_reason").isNull()
    value = lambda f: cells[f.name] if isinstance(f.dataType, T.StringType) else F.trim(cells[f.name]).try_cast(f.dataType)
    return r.select(*[F.when(ok, value(f)).alias(f.name) for f in schema.fields], F.col("_reason").alias("reason"), F.when(~ok, line).alias("record"))


def rejected_counts(checked: DataFrame) -> DataFrame:
    """``(reason, n)`` of a checked source; ``kept`` stands for the rows without a reason."""
    return checked.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def write_checked(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Kept and rejected rows of a checked source, written side by side by one job
    and read back: ``(kept, rejected)``."""
    checked.withColumn("kept", F.col("reason").isNull()).write.partitionBy("kept").mode("overwrite").parquet(path)
    back = checked.sparkSession.read.schema(T.StructType([*checked.schema.fields, T.StructField("kept", T.BooleanType())])).parquet(path)
    return back.where("kept").drop("kept", "reason"), back.where("NOT kept").drop("kept")
