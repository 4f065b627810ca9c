"""Window operators (W1-W5) and the distributed running-total primitive.

A global ``Window.orderBy`` moves every row into one task.  For ordered
running totals over large domains we use a two-level prefix sum instead:

1. range bounds per group from ``percentile_approx`` (one small aggregate,
   checkpointed so that every later step reads the same bounds),
2. every row gets a bucket = number of bounds below its order value,
3. per-(group, bucket) totals (small table) -> exclusive offsets with a
   window over that small table,
4. in-bucket running sums with ``Window.partitionBy(group, bucket)``,
   plus the bucket offset.

Buckets hold about ``1 / n_buckets`` of a group's distinct order values, so
no task ever holds a whole group.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.joins import DEFAULT_BROADCAST_BYTES, join_null_safe, measured, row_width, sized_broadcast
from quarry.session import cut_lineage

__all__ = ["running_totals", "mid_ranks", "index_ids", "rank_within", "top_n_per_group", "ecdf",
           "share_of_total"]

_G = "_grp_const"


def default_buckets(df: DataFrame) -> int:
    """Buckets per group: a few for each task of the session's shuffles."""
    spark = df.sparkSession
    return max(16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def _tag_buckets(df: DataFrame, order_col: str, partition_cols: Sequence[str], n_buckets: int | None,
                 accuracy: int):
    """Add an order-preserving ``_bucket`` per row (within groups; a null group
    is a group).  The assignment is frozen: totals and rows read the same
    checkpointed bounds, whatever the order in which a retry merges sketches.
    Also returns how many (group, bucket) pairs there can be and the bytes of
    their keys, where the bounds tell; else None."""
    n_buckets = n_buckets or default_buckets(df)
    parts = list(partition_cols)
    base = df
    if not parts:
        base = df.withColumn(_G, F.lit(0))
        parts = [_G]
    if _is_numeric(df, order_col):
        probs = [i / n_buckets for i in range(1, n_buckets)]
        bounds = cut_lineage(base.groupBy(*parts).agg(F.percentile_approx(F.col(order_col), probs, accuracy).alias("_bounds")))
        n, size = (1, 64 * n_buckets) if parts == [_G] else measured(bounds)
        room = n * n_buckets, size * n_buckets
        v = F.col(order_col)
        tagged = (join_null_safe(base, F.broadcast(bounds) if size <= DEFAULT_BROADCAST_BYTES else bounds, parts)
                  .withColumn("_bucket", _count_below("_bounds", v, n_buckets)).drop("_bounds"))
    else:
        # Strings: range-partition on (group, value); the partition id is an
        # order-preserving bucket, frozen with the rows.
        tagged = cut_lineage(base.repartitionByRange(n_buckets, *parts, order_col)
                             .withColumn("_bucket", F.spark_partition_id()))
        room = None
    return tagged, parts, room


def _bucket_side(small: DataFrame, room: tuple[int, int] | None, extra: int | None) -> DataFrame:
    """A table of one row per (group, bucket), broadcast if its size is proven:
    by ``room`` and ``extra`` bytes a row, else by checkpoint and measure."""
    if room is not None and extra is not None:
        return F.broadcast(small) if room[0] * extra + room[1] <= DEFAULT_BROADCAST_BYTES else small
    return sized_broadcast(cut_lineage(small))


def _count_below(sorted_array: str, v: Column, size: int) -> Column:
    """How many elements of a sorted array are below ``v`` (none, if it is null), by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in range(size.bit_length(), -1, -1)])
    a = F.col(sorted_array)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(a, at + step - 1) < v, at + step).otherwise(at))


def running_totals(df: DataFrame, order_col: str, sums: Mapping[str, Column],
                   partition_cols: Sequence[str] = (), tie_cols: Sequence[str] = (),
                   n_buckets: int | None = None, accuracy: int = 10000) -> DataFrame:
    """Append inclusive running sums of ``sums`` ordered by ``order_col`` (then ``tie_cols``)
    within ``partition_cols``.  ``order_col`` may be of any orderable type."""
    tagged, parts, room = _tag_buckets(df, order_col, partition_cols, n_buckets, accuracy)
    for name, c in sums.items():
        tagged = tagged.withColumn(f"_v_{name}", c)
    totals = tagged.groupBy(*parts, "_bucket").agg(
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    wo = Window.partitionBy(*parts).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*parts, "_bucket",
                            *[F.coalesce(F.sum(f"_t_{n}").over(wo), F.lit(0)).alias(f"_o_{n}")
                              for n in sums])
    wi = (Window.partitionBy(*parts, "_bucket").orderBy(order_col, *tie_cols)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = join_null_safe(tagged, _bucket_side(offsets, room, 16 * len(sums)), [*parts, "_bucket"])
    for n in sums:
        out = out.withColumn(n, F.col(f"_o_{n}") + F.sum(f"_v_{n}").over(wi))
    drop = ["_bucket"] + [f"_v_{n}" for n in sums] + [f"_o_{n}" for n in sums]
    if _G in out.columns:
        drop.append(_G)
    return out.drop(*drop)


def running_last(df: DataFrame, order_col: str, tie_cols: Sequence[str], flag: Column,
                 values: Sequence[str], out: str = "_last", n_buckets: int | None = None,
                 accuracy: int = 10000, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Forward fill: for every row, ``struct(values)`` of the last row at or
    before it (order ``order_col``, then ``tie_cols``) where ``flag`` holds.

    Same two-level shape as :func:`running_totals`: in-bucket ``last(...,
    ignorenulls)`` plus the last flagged struct carried in from earlier
    buckets (a table with one row per bucket).  No row fans out and no
    group is gathered in one task."""
    tagged, parts, room = _tag_buckets(df, order_col, partition_cols, n_buckets, accuracy)
    st = F.when(flag, F.struct(*[F.col(v) for v in values]))
    tagged = tagged.withColumn("_st", st)
    wi = (Window.partitionBy(*parts, "_bucket").orderBy(order_col, *tie_cols)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ordkey = F.struct(F.col(order_col), *[F.col(t) for t in tie_cols])
    # every bucket gets a row (a bucket holding only unflagged rows must still
    # receive the carry); max of (order key, struct) ignores unflagged rows
    per_bucket = tagged.groupBy(*parts, "_bucket").agg(
        F.max(F.when(F.col("_st").isNotNull(), F.struct(ordkey.alias("k"), F.col("_st").alias("s")))).alias("_m")) \
        .select(*parts, "_bucket", F.col("_m.s").alias("_bl"))
    wc = Window.partitionBy(*parts).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(*parts, "_bucket", F.last("_bl", ignorenulls=True).over(wc).alias("_carry"))
    out_df = join_null_safe(tagged.withColumn("_in", F.last("_st", ignorenulls=True).over(wi)),
                            _bucket_side(carry, room, row_width(df.select(*values))), [*parts, "_bucket"], "left")
    drop = ["_st", "_in", "_carry", "_bucket"] + ([_G] if _G in parts else [])
    return out_df.withColumn(out, F.coalesce("_in", "_carry")).drop(*drop)


def mid_ranks(df: DataFrame, cols: Sequence[str], n_buckets: int | None = None, most_heavy: int = 64,
              sample: int = 4096) -> DataFrame:
    """W4 for every row and several columns: ``df`` with ``_p_<col>``, the middle of the
    value's interval in the sorted column, ``(below + equal / 2) / n``; null for a null.

    Rows get their ranks where they are: a column's rows go to buckets of its
    range, are ranked there, and add the count of all lower buckets (one row a
    bucket).  No row is joined with its value.  Values that hold more than a
    bucket's share are found by a mergeable sketch (at most ``most_heavy``) and
    counted exactly; they need no ranking, so their rows, and nulls, are spread
    over all buckets.  Bounds come from about ``sample`` rows; they decide where
    rows go, not what ranks they get.  One shuffle of the rows a column."""
    k = n_buckets or default_buckets(df)
    cols = list(cols)
    # rows are told apart once, in a table that every later stage reads alike
    base = cut_lineage(df.withColumn("_salt", F.monotonically_increasing_id()))
    first = base.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    sketch = [F.expr(f"approx_top_k(`{c}`, {most_heavy}, {max(1000, 16 * k)})").alias(f"t{i}") for i, c in enumerate(cols)]
    tops = base.agg(*sketch).first()
    heavy = [sorted(x["item"] for x in (tops[f"t{i}"] or []) if x["item"] is not None and x["count"] * k > first[f"n{i}"]) for i in range(len(cols))]
    exact = [agg for i, c in enumerate(cols) for j, v in enumerate(heavy[i])
             for agg in (F.count_if(F.col(c) == F.lit(v)).alias(f"e{i}_{j}"), F.count_if(F.col(c) < F.lit(v)).alias(f"b{i}_{j}"))]
    counts = base.agg(*exact).first() if exact else {}
    some = base.where(F.pmod(F.xxhash64("_salt"), F.lit(max(1, first["rows"] // sample))) == 0).select(*cols).collect()
    out = base
    for i, c in enumerate(cols):
        kind, n = df.schema[c].dataType, first[f"n{i}"]
        seen = sorted(r[c] for r in some if r[c] is not None and r[c] not in set(heavy[i]))
        bounds = sorted({seen[len(seen) * j // k] for j in range(1, k)}) if seen else []
        literal = lambda values: F.array(*[F.lit(v).cast(kind) for v in values]) if values else F.array().cast(f"array<{kind.simpleString()}>")
        plain = F.col(c).isNotNull() & ~F.coalesce(F.array_contains(literal(heavy[i]), F.col(c)), F.lit(False))
        place = lambda d: d.withColumn("_bounds", literal(bounds)).withColumn("_bucket", F.when(plain, _count_below("_bounds", F.col(c), max(1, len(bounds))))
                                                                             .otherwise(-1 - F.pmod("_salt", F.lit(k)))).drop("_bounds")
        per = place(base.select(c, "_salt")).where("_bucket >= 0").groupBy("_bucket").agg(F.count(F.lit(1)).alias("_m"))
        lower = per.select("_bucket", F.coalesce(F.sum("_m").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_lower"))  # one row a bucket
        w = Window.partitionBy("_bucket")
        ranked = place(out).withColumn("_rank", F.rank().over(w.orderBy(c))).withColumn("_equal", F.count(F.lit(1)).over(Window.partitionBy("_bucket", c)))
        ranked = ranked.join(sized_broadcast(lower, rows_bound=k), "_bucket", "left")
        below, equal = F.col("_lower") + F.col("_rank") - 1, F.col("_equal")
        at = F.lit(None).cast("double")
        for j, v in enumerate(heavy[i]):
            e, b = counts[f"e{i}_{j}"], counts[f"b{i}_{j}"]
            below = below + F.when(F.col(c) > F.lit(v), F.lit(e)).otherwise(F.lit(0))
            at = F.when(F.col(c) == F.lit(v), F.lit((b + e / 2) / n)).otherwise(at)
        out = ranked.withColumn(f"_p_{c}", F.when(plain, (below + equal / 2) / F.lit(n or None).cast("double")).otherwise(at)).drop("_bucket", "_rank", "_equal", "_lower")
    return out.drop("_salt")


def _is_numeric(df: DataFrame, c: str) -> bool:
    from pyspark.sql import types as T
    return isinstance(df.schema[c].dataType, (
        T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
        T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType))


def index_ids(df: DataFrame, col: str, index_col: str | None = None,
              n_buckets: int | None = None) -> DataFrame:
    """Mapping ``(col, index)`` with a dense zero-based index in ``col`` order.

    Distinct ids first (one shuffle), then the two-level prefix count.
    """
    index_col = index_col or f"{col}_index"
    ids = cut_lineage(df.select(col).where(F.col(col).isNotNull()).distinct())  # read by every prefix stage
    r = running_totals(ids, col, {"_cnt": F.lit(1).cast("bigint")}, n_buckets=n_buckets)
    return r.select(col, (F.col("_cnt") - 1).cast("bigint").alias(index_col))


def rank_within(df: DataFrame, partition_cols: Sequence[str], order: Sequence[Column],
                rank_col: str = "rank") -> DataFrame:
    """1..N rank per group (ties broken by the caller's order list)."""
    w = Window.partitionBy(*partition_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w))


def top_n_per_group(df: DataFrame, partition_cols: Sequence[str], order: Sequence[Column],
                    n: int, rank_col: str = "rank") -> DataFrame:
    """Top-N per group.  ``row_number() <= n`` is planned as a partial
    ``WindowGroupLimit`` before the shuffle, so a hot group ships at most
    ``n`` rows per map task."""
    return rank_within(df, partition_cols, order, rank_col).where(F.col(rank_col) <= n)


def ecdf(df: DataFrame, col: str, partition_cols: Sequence[str] = (),
         n_buckets: int | None = None) -> DataFrame:
    """``(value, n, cum_n, cdf)`` over distinct values (per group)."""
    parts = list(partition_cols)
    freq = cut_lineage(df.where(F.col(col).isNotNull())
                       .groupBy(*parts, F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n")))
    r = running_totals(freq, "value", {"cum_n": F.col("n")}, parts, n_buckets=n_buckets)
    if not parts:
        total = freq.select(F.sum("n")).scalar()
        return r.select("value", "n", "cum_n", (F.col("cum_n") / total).alias("cdf"))
    tot = cut_lineage(freq.groupBy(*parts).agg(F.sum("n").alias("_tot")))
    return join_null_safe(r, sized_broadcast(tot), parts).select(
        *parts, "value", "n", "cum_n", (F.col("cum_n") / F.col("_tot")).alias("cdf"))


def share_of_total(df: DataFrame, col: str, out: str = "pct", digits: int | None = 2,
                   partition_cols: Sequence[str] = ()) -> DataFrame:
    """Percent of total.  Global totals come from a scalar subquery (no
    single-partition window); per-group totals from a grouped aggregate."""
    from quarry.functions.predicates import pct
    if not partition_cols:
        total = df.select(F.sum(col)).scalar()
        return df.withColumn(out, pct(col, total, digits))
    tot = df.groupBy(*partition_cols).agg(F.sum(col).alias("_tot"))
    return join_null_safe(df, tot, list(partition_cols)).withColumn(out, pct(col, "_tot", digits)).drop("_tot")
