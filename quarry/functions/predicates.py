"""Predicates, buckets, recoding and small scalar helpers (P*, F16-F20)."""
from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "DEFAULT_SENTINELS", "TIME_OF_DAY_LABELS", "BASKET_HOURS", "SEGMENT_HOURS",
    "col_", "is_present", "any_sentinel", "bucketize", "time_bucket", "recode",
    "binarise", "numeric_cols", "categorical_cols", "align", "pct", "fingerprint",
    "drop_matching", "persona", "ntz_epoch_seconds", "epoch_to_ntz",
]

# Fixed values (must equal the reference for identical results):
# strings that count as a missing borough / category.
DEFAULT_SENTINELS = ("Unknown", "N/A", "", "None")
# time-of-day labels and the two hour-edge schemes (start hours of
# morning, afternoon, evening, night; night wraps past midnight).
TIME_OF_DAY_LABELS = ("morning", "afternoon", "evening", "night")
BASKET_HOURS = (5, 12, 17, 22)
SEGMENT_HOURS = (6, 12, 17, 22)

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_present(c, sentinels: Sequence[str] = DEFAULT_SENTINELS) -> Column:
    """Not null and not one of the sentinel strings."""
    c = col_(c)
    return c.isNotNull() & ~c.isin(list(sentinels))


def any_sentinel(c, sentinels: Sequence[str] = DEFAULT_SENTINELS) -> Column:
    """Value is one of the sentinels (null is not a sentinel here)."""
    return col_(c).isin(list(sentinels))


def bucketize(c, edges: Sequence[float], labels: Sequence[str] | None = None,
              other: str | None = "other") -> Column:
    """P10: half-open ``[lo, hi)`` buckets; values outside every bucket -> ``other``."""
    c = col_(c)
    if labels is None:
        labels = [f"[{lo},{hi})" for lo, hi in zip(edges[:-1], edges[1:])]
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per pair of edges")
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c >= F.lit(lo)) & (c < F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(other))


def time_bucket(ts, edges: Sequence[int] = BASKET_HOURS,
                labels: Sequence[str] = TIME_OF_DAY_LABELS) -> Column:
    """Hour-of-day bucket; the last label takes every other hour."""
    h = F.hour(col_(ts))
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels[:-1]):
        cond = (h >= lo) & (h < hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def recode(c, mapping: Mapping, default=None) -> Column:
    """Value map through a literal map column (no join, no UDF)."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    looked = F.create_map(*kv)[col_(c)]
    return looked if default is None else F.coalesce(looked, F.lit(default))


def binarise(c, positive) -> Column:
    """``== positive`` -> 1 / 0 (null stays null)."""
    return (col_(c) == F.lit(positive)).cast("int")


def numeric_cols(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns (schema inspection, no job)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def categorical_cols(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Non-numeric scalar columns."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in exclude]


def align(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep the common columns, in the left frame's order."""
    common = [c for c in left.columns if c in set(right.columns)]
    return left.select(*common), right.select(*common)


def pct(num, den, digits: int | None = None) -> Column:
    """``num / den * 100`` with a zero / null guard (null instead of error)."""
    v = F.try_divide(col_(num).cast("double") * F.lit(100.0), col_(den).cast("double"))
    return v if digits is None else F.round(v, digits)


def fingerprint(*cols, sep: str = "\u001f") -> Column:
    """SHA-256 over the columns joined by a unit separator; a value is marked
    ``=``, a null ``-``, so rows that differ in where their nulls stand differ."""
    return F.sha2(F.concat_ws(sep, *[F.coalesce(F.concat(F.lit("="), col_(c).cast("string")), F.lit("-")) for c in cols]), 256)


def drop_matching(df: DataFrame, pattern: str = r"^Unnamed") -> DataFrame:
    """Drop columns whose name matches ``pattern``."""
    rx = re.compile(pattern)
    return df.select(*[c for c in df.columns if not rx.search(c)])


def persona(dist, amount) -> Column:
    """Rule-based rider persona from average distance and amount."""
    d, a = col_(dist), col_(amount)
    # Thresholds and labels of the persona rules.
    return (F.when((d < 5) & (a < 15), F.lit("short-trip commuters"))
             .when((d > 15) & (a > 50), F.lit("airport travelers"))
             .otherwise(F.lit("late-night riders")))


def ntz_epoch_seconds(c) -> Column:
    """Whole epoch seconds of a ``timestamp_ntz`` (wall clock read as UTC),
    independent of the session time zone."""
    c = col_(c)
    days = F.datediff(F.to_date(c), F.to_date(F.lit("1970-01-01")))
    return (days.cast("bigint") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
            + F.floor(F.second(c))).cast("bigint")


def epoch_to_ntz(c) -> Column:
    """epoch seconds -> ``timestamp_ntz`` (UTC wall clock), session-zone free."""
    return F.timestamp_add("SECOND", col_(c), F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")))
