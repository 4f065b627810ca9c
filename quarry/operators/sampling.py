"""Seeded sampling, splitting and column bootstrap.

Randomness is keyed on ``md5(seed || '-' || id)`` rather than ``rand()``:
results are reproducible across engines, partitionings and task retries
(an executor lost mid-job recomputes exactly the same rows).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.predicates import col_
from quarry.operators.windows import running_totals
from quarry.session import cut_lineage

__all__ = ["seed_key", "unit_hash", "hash_int", "sample_n", "sample_per_class", "split",
           "split_stratified", "order_stat_lookup", "bootstrap_columns", "fresh_ids"]


def seed_key(c, seed: int | str, salt: str | None = None) -> Column:
    """``md5('<seed>-[<salt>-]<value>')`` as hex text."""
    pre = f"{seed}-" + (f"{salt}-" if salt is not None else "")
    return F.md5(F.concat(F.lit(pre), col_(c).cast("string")))


def hash_int(c, seed: int | str, salt: str | None = None, hex_digits: int = 8) -> Column:
    """Leading ``hex_digits`` of the md5 key as a non-negative integer."""
    return F.conv(F.substring(seed_key(c, seed, salt), 1, hex_digits), 16, 10).cast("bigint")


def unit_hash(c, seed: int | str, salt: str | None = None) -> Column:
    """Uniform [0, 1) from the first 32 bits of the md5 key."""
    return hash_int(c, seed, salt) / F.lit(4294967296.0)


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement (seeded shuffle + head).
    ``orderBy + limit`` is a per-task top-n heap, never a global sort."""
    return df.orderBy(seed_key(id_col, seed), id_col).limit(n)


def sample_per_class(df: DataFrame, id_col: str, label: str, n: int, seed: int = 42) -> DataFrame:
    """Y2: ``n`` seeded examples per class (partial WindowGroupLimit before the shuffle)."""
    w = Window.partitionBy(label).orderBy(seed_key(id_col, seed), id_col)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def split(df: DataFrame, id_col: str, train_frac: float = 0.8, seed: int = 42,
          out: str = "split") -> DataFrame:
    """Seeded train/test tag from a hash threshold (no shuffle)."""
    return df.withColumn(out, F.when(unit_hash(id_col, seed) < F.lit(train_frac), "train").otherwise("test"))


def split_stratified(df: DataFrame, id_col: str, label: str, train_frac: float = 0.8,
                     seed: int = 42, out: str = "split", n_buckets: int | None = None) -> DataFrame:
    """Per class, the first ``round(frac * n_class)`` rows in seeded order are train.

    The in-class rank is a distributed prefix count (a class may hold a
    third of all rows, so it is never sorted in one task).  Rows without a
    label are a class of their own."""
    from quarry.operators.joins import join_null_safe, sized_broadcast
    cnt = cut_lineage(df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc")))
    k = df.withColumn("_hk", hash_int(id_col, seed, hex_digits=15))
    r = running_totals(k, "_hk", {"_rank": F.lit(1).cast("bigint")}, [label], [id_col], n_buckets)
    r = join_null_safe(r, sized_broadcast(cnt), [label])
    quota = F.floor(F.col("_nc") * F.lit(train_frac) + F.lit(0.5))
    return r.withColumn(out, F.when(F.col("_rank") <= quota, "train").otherwise("test")) \
        .drop("_hk", "_rank", "_nc")


def order_stat_lookup(df: DataFrame, col: str, draws: DataFrame, pos_col: str = "pos",
                      n_buckets: int | None = None, group_cols: Sequence[str] = ()) -> DataFrame:
    """For each draw row, the ``pos``-th smallest (0-based) non-null value of
    ``col`` (within its ``group_cols`` group when given).

    Distinct values get the start ``lo`` of their cumulative interval
    (distributed prefix sum).  Interval starts and draws are unioned on one
    position axis and every draw takes the value of the last interval
    starting at or before it (distributed forward fill).  A value holding a
    third of all rows is still one row here: no fan-out, no hot key."""
    g = list(group_cols)
    freq = cut_lineage(df.where(F.col(col).isNotNull()).groupBy(*g, F.col(col).alias("_v"))
                       .agg(F.count(F.lit(1)).alias("_c")))   # distinct values, read by several stages
    return lookup_in_frequencies(freq, col, draws, pos_col, n_buckets, g)


def lookup_in_frequencies(freq: DataFrame, col: str, draws: DataFrame, pos_col: str = "pos",
                          n_buckets: int | None = None, group_cols: Sequence[str] = ()) -> DataFrame:
    """:func:`order_stat_lookup` on a precomputed value-frequency table
    ``(group..., _v, _c)`` (lets callers reuse one pass over the data)."""
    from quarry.operators.windows import running_last
    g = list(group_cols)
    iv = running_totals(freq, "_v", {"_hi": F.col("_c")}, g, n_buckets=n_buckets)
    dcols = [c for c in draws.columns if c not in g]
    dstruct = F.struct(*[F.col(c) for c in dcols])
    dtype = draws.select(dstruct.alias("d")).schema["d"].dataType
    starts = iv.select(*g, (F.col("_hi") - F.col("_c")).cast("bigint").alias("_p"), F.lit(0).alias("_kind"),
                       F.col("_v"), F.lit(None).cast(dtype).alias("_d"))
    pts = draws.select(*g, F.col(pos_col).cast("bigint").alias("_p"), F.lit(1).alias("_kind"),
                       F.lit(None).cast(freq.schema["_v"].dataType).alias("_v"), dstruct.alias("_d"))
    u = starts.unionByName(pts)
    filled = running_last(u, "_p", ["_kind"], F.col("_kind") == 0, ["_v"], "_last", n_buckets,
                          partition_cols=g)
    return filled.where(F.col("_kind") == 1).select(*g, "_d.*", F.col("_last._v").alias(col))


def bootstrap_columns(spark: SparkSession, df: DataFrame, cols: Sequence[str], n: int,
                      seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """Each column resampled on its own with replacement (marginals kept,
    joint distribution dropped).  Draw ``i`` of column ``c`` takes position
    ``md5(seed-c-i)[:15] mod N_c`` (60 bits) in the sorted column."""
    base = spark.range(n).withColumnRenamed("id", id_col)
    out = base
    for c in cols:
        nc = df.select(F.count(c)).scalar()
        draws = base.select(id_col, F.pmod(hash_int(id_col, seed, c, hex_digits=15), nc).alias("pos"))
        got = order_stat_lookup(df, c, draws).select(id_col, c)
        out = out.join(got, id_col, "left")
    return out


def fresh_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Regenerate an id column with fresh unique keys (no shuffle)."""
    return df.withColumn(id_col, F.monotonically_increasing_id())
