"""Aggregations, sorts and set operations (G*, K*, U*).

Every multi-threshold report that the reference computes with one job per
threshold (fare buckets, cap sweeps, validation checks) is a single
aggregate here: conditional aggregates over one scan, then ``stack`` to
long form.  Global totals come from scalar subqueries, never from an
un-partitioned window.
"""
from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.predicates import pct
from quarry.operators.joins import join_null_safe, sized_broadcast
from quarry.operators.windows import running_totals
from quarry.session import cut_lineage

__all__ = [
    "reduce_pairs", "group_share", "group_profile", "bucket_share", "tail_share",
    "top_groups", "cap_impact", "cap_strategies", "clean_by_group_caps", "describe_long",
    "describe_numeric", "exact_quantiles", "discrete_quantiles", "group_quantile", "column_quantiles", "ranks_to_values", "describe_categorical", "value_counts", "sparsity",
    "dataset_summary", "activity_stats", "rating_distribution", "histogram",
    "grouped_histogram", "category_counts_by_source", "proportion_table", "corr_matrix",
    "density", "distinct_bitmaps", "distinct_counts", "sparsity_parts", "sparsity_from_parts", "collapse_pairs", "length_stats", "positive_rate", "union_tagged",
    "top_k", "arg_max_row",
]

PROFILE_PERCENTILES = (("q1", 0.25), ("median", 0.5), ("q3", 0.75),
                       ("p90", 0.9), ("p95", 0.95), ("p99", 0.99))


def reduce_pairs(pairs: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Per key total, count, avg, min, max; sorted by total desc.
    Partial + final hash aggregate (map-side combine); no value lists."""
    return (pairs.groupBy(key)
            .agg(F.sum(value).alias("total_revenue"), F.count(F.lit(1)).alias("trip_count"),
                 F.avg(value).alias("avg_fare"), F.min(value).alias("min_fare"),
                 F.max(value).alias("max_fare"))
            .orderBy(F.desc("total_revenue"), key))


def group_share(df: DataFrame, keys: Sequence[str], value: str, digits: int = 2) -> DataFrame:
    """Trips, average value and share of all rows per group."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("trip_count"), F.avg(value).alias("avg_value"))
    # total from the aggregated result: the subquery reuses g's shuffle (one scan)
    total = g.select(F.sum("trip_count")).scalar()
    return g.withColumn("pct_of_total", pct("trip_count", total, digits))


def group_profile(df: DataFrame, key: str, value: str,
                  percentiles: Sequence[tuple[str, float]] = PROFILE_PERCENTILES,
                  accuracy: int = 10000, small_sample: int = 100, exact: bool = False) -> DataFrame:
    """G8 + Q9: count, avg, min, max and percentiles per group.

    ``exact=False``: ``percentile_approx`` (one aggregate, bounded sketch).
    ``exact=True``: discrete percentiles (value at rank ceil(p*n)) from the
    distributed per-group order-statistic lookup, no per-group value buffer.
    ``n`` counts all rows of a group in both forms; a null key is a group."""
    probs = [p for _, p in percentiles]
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(value).alias("avg_value"),
            F.min(value).alias("min_value"), F.max(value).alias("max_value")]
    if not exact:
        g = df.groupBy(key).agg(*aggs, F.percentile_approx(value, probs, accuracy).alias("_q"))
        cols = [F.col("_q")[i].alias(f"{name}_value") for i, (name, _) in enumerate(percentiles)]
        return g.select(key, "n", "avg_value", "min_value", "max_value", *cols,
                        (F.col("n") < small_sample).alias("small_sample"))
    # ONE pass over the input: a per-group value-frequency table; counts,
    # moments and order statistics are all derived from it.
    v = F.col(value)
    # read by several stages below: checkpointed once
    freq = cut_lineage(df.groupBy(key, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    some = F.when(F.col("_v").isNotNull(), F.col("_c"))
    g = freq.groupBy(key).agg(F.sum("_c").alias("n"), F.sum(some).alias("_n"), (F.sum(F.col("_v") * F.col("_c")) / F.sum(some)).alias("avg_value"),
                              F.min("_v").alias("min_value"), F.max("_v").alias("max_value"))
    req = F.array(*[F.struct(F.lit(float(p)).alias("p"),
                             F.greatest(F.ceil(F.lit(float(p)) * F.col("_n")), F.lit(1)).cast("bigint").alias("r"))
                    for p in probs])
    got = ranks_to_values(freq.where("_v is not null"), [key], g.where("_n > 0").select(key, req.alias("_req")))
    wide = got.groupBy(key).pivot("p", [float(p) for p in probs]).agg(F.first("value"))
    wide = wide.select(key, *[F.col(f"`{float(p)}`").alias(f"{name}_value") for name, p in percentiles])
    return join_null_safe(g, wide, [key], "left").select(key, "n", "avg_value", "min_value", "max_value",
                                            *[f"{name}_value" for name, _ in percentiles],
                                            (F.col("n") < small_sample).alias("small_sample"))


def bucket_share(df: DataFrame, value: str, edges: Sequence[float], labels: Sequence[str],
                 other: str = "other", digits: int = 2) -> DataFrame:
    """Count and % per half-open bucket, every label kept, one scan.

    Values in no bucket (e.g. exactly the top edge) land in ``other``."""
    v = F.col(value)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        aggs.append(F.count_if((v >= lo) & (v < hi)).alias(f"b{i}"))
    aggs.append(F.count_if(~((v >= edges[0]) & (v < edges[-1])) | v.isNull()).alias(f"b{len(labels)}"))
    wide = df.agg(*aggs)
    names = list(labels) + [other]
    los = list(edges[:-1]) + [None]
    his = list(edges[1:]) + [None]
    parts = []
    for i, (n, lo, hi) in enumerate(zip(names, los, his)):
        lo_s = "CAST(NULL AS DOUBLE)" if lo is None else f"CAST({lo} AS DOUBLE)"
        hi_s = "CAST(NULL AS DOUBLE)" if hi is None else f"CAST({hi} AS DOUBLE)"
        parts.append(f"{i + 1}, '{n}', {lo_s}, {hi_s}, b{i}")
    return wide.selectExpr("_n", f"stack({len(names)}, {', '.join(parts)}) as (bucket_order, bucket, lo, hi, n)") \
        .select(F.col("bucket_order").cast("int"), "bucket", "lo", "hi", F.col("n").cast("bigint"),
                pct("n", "_n", digits).alias("pct"))


def tail_share(df: DataFrame, value: str, threshold: float = 80.0, base: float = 20.0,
               digits: int = 4) -> DataFrame:
    """Rows above ``threshold``: count, % of rows, average minus ``base``."""
    v = F.col(value)
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(v > threshold).alias("n_over"),
        F.avg(F.when(v > threshold, v)).alias("_avg")) \
        .select("n", "n_over", pct("n_over", "n", digits).alias("pct_over"),
                F.round(F.col("_avg") - F.lit(base), digits).alias("lift_over_base"))


def top_groups(df: DataFrame, key: str, value: str, min_rows: int = 10, k: int = 10) -> DataFrame:
    """Groups with more than ``min_rows`` rows, top ``k`` by average (tie -> key)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("trip_count"), F.avg(value).alias("avg_value"),
                                F.max(value).alias("max_value"))
            .where(F.col("trip_count") > min_rows)
            .orderBy(F.desc("avg_value"), key).limit(k))


def cap_impact(df: DataFrame, value: str, caps: Sequence[float], digits: int = 4) -> DataFrame:
    """Per cap ``(cap, avg, kept, pct_kept)`` from ONE scan (conditional aggregates)."""
    v = F.col(value)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(caps):
        aggs += [F.count_if(v <= c).alias(f"k{i}"), F.avg(F.when(v <= c, v)).alias(f"a{i}")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"CAST({c} AS DOUBLE), a{i}, k{i}" for i, c in enumerate(caps))
    return wide.selectExpr("_n", f"stack({len(caps)}, {parts}) as (cap, avg_value, kept)") \
        .select("cap", F.round("avg_value", digits).alias("avg_value"), F.col("kept").cast("bigint"),
                pct("kept", "_n", digits).alias("pct_kept"))


def cap_strategies(df: DataFrame, value: str, caps: Sequence[float] = (80.0, 70.0),
                   digits: int = 4) -> DataFrame:
    """Cap options: new average, kept, removed and their % of the group (one scan)."""
    v = F.col(value)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(caps):
        aggs += [F.count_if(v <= c).alias(f"k{i}"), F.avg(F.when(v <= c, v)).alias(f"a{i}")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"CAST({c} AS DOUBLE), a{i}, k{i}" for i, c in enumerate(caps))
    long = wide.selectExpr("_n", f"stack({len(caps)}, {parts}) as (cap, avg_value, kept)")
    return long.select("cap", F.round("avg_value", digits).alias("avg_value"), F.col("kept").cast("bigint"),
                       (F.col("_n") - F.col("kept")).cast("bigint").alias("removed"),
                       pct("kept", "_n", digits).alias("pct_kept"),
                       pct(F.col("_n") - F.col("kept"), "_n", digits).alias("pct_removed"))


def clean_by_group_caps(df: DataFrame, key: str, value: str, caps: Mapping[str, float],
                        default: float | None = None) -> DataFrame:
    """Keep rows with ``value <= cap[key]`` (literal map lookup, no join)."""
    kv = []
    for k, c in caps.items():
        kv += [F.lit(k), F.lit(float(c))]
    cap = F.create_map(*kv)[F.col(key)]
    if default is not None:
        cap = F.coalesce(cap, F.lit(float(default)))
    return df.where(F.col(value) <= cap)


def ranks_to_values(freq: DataFrame, group_cols: Sequence[str], ranks: DataFrame,
                    n_buckets: int | None = None) -> DataFrame:
    """Exact order statistics for a few requested ranks per group.

    ``freq`` is ``(group..., _v, _c)`` (distinct values and counts); ``ranks``
    is ``(group..., _req)`` with ``_req`` an array of ``struct(p, r)`` (1-based
    ranks).  After the distributed prefix sum each distinct value knows its
    rank interval ``(lo, hi]`` and keeps the requested ranks inside it, so the
    result has one row per requested rank and nothing is gathered."""
    g = list(group_cols)
    cum = running_totals(freq, "_v", {"_hi": F.col("_c")}, g, n_buckets=n_buckets)
    # without groups there is one row of ranks
    j = join_null_safe(cum, sized_broadcast(cut_lineage(ranks)), g) if g else cum.withColumn("_req", ranks.select("_req").scalar())
    lo, hi = F.col("_hi") - F.col("_c"), F.col("_hi")
    hit = F.filter("_req", lambda x: (x["r"] > lo) & (x["r"] <= hi))
    return j.select(*g, "_v", F.explode_outer(hit).alias("_q")).where(F.col("_q").isNotNull()) \
        .select(*g, F.col("_q.p").alias("p"), F.col("_q.r").alias("r"), F.col("_v").alias("value"))


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     interpolate: bool) -> DataFrame:
    """Exact quantiles ``(column_name, p, value)`` of several numeric columns from
    ONE scan: unpivot to ``(column_name, value)``, one frequency table grouped
    by column, per-column prefix sums, requested ranks per column.

    ``interpolate=True``: linear (pandas / ``quantile_cont``); otherwise
    discrete (value at rank ``ceil(p * n)``, ``quantile_disc``)."""
    cols = list(cols)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([], cols, "column_name", "_v").where(F.col("_v").isNotNull())
    freq = cut_lineage(long.groupBy("column_name", "_v").agg(F.count(F.lit(1)).alias("_c")))
    n = freq.groupBy("column_name").agg(F.sum("_c").alias("n"))
    items = []
    for p in probs:
        pl = F.lit(float(p))
        if interpolate:
            h = pl * (F.col("n") - 1)
            items.append(F.struct(pl.alias("p"), (F.floor(h) + 1).cast("bigint").alias("r")))
            items.append(F.struct(pl.alias("p"), (F.ceil(h) + 1).cast("bigint").alias("r")))
        else:
            items.append(F.struct(pl.alias("p"), F.greatest(F.ceil(pl * F.col("n")), F.lit(1)).cast("bigint").alias("r")))
    ranks = n.select("column_name", F.array(*items).alias("_req"))
    got = ranks_to_values(freq, ["column_name"], ranks)
    if not interpolate:
        return got.select("column_name", "p", "value")
    g = got.groupBy("column_name", "p").agg(F.min_by("value", "r").alias("lo"), F.max_by("value", "r").alias("hi"))
    g = g.join(F.broadcast(n), "column_name")
    h = F.col("p") * (F.col("n") - 1)
    return g.select("column_name", "p", (F.col("lo") + (F.col("hi") - F.col("lo")) * (h - F.floor(h))).alias("value"))


def group_quantile(df: DataFrame, key: str, col: str, p: float) -> DataFrame:
    """Exact linearly interpolated quantile ``(key, value)`` per group (a null key is a group)."""
    x = F.col(col).cast("double")
    freq = cut_lineage(df.where(x.isNotNull()).groupBy(key, x.alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    n = freq.groupBy(key).agg(F.sum("_c").alias("n"))
    h = F.lit(float(p)) * (F.col("n") - 1)
    ends = [F.struct(F.lit(float(p)).alias("p"), (f(h) + 1).cast("bigint").alias("r")) for f in (F.floor, F.ceil)]
    got = ranks_to_values(freq, [key], n.select(key, F.array(*ends).alias("_req")))
    g = got.groupBy(key).agg(F.min_by("value", "r").alias("lo"), F.max_by("value", "r").alias("hi"))
    return join_null_safe(g, n, [key]).select(key, (F.col("lo") + (F.col("hi") - F.col("lo")) * (h - F.floor(h))).alias("value"))


def discrete_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """Exact discrete quantiles ``(p, value)``: the value at rank ``ceil(p * n)``."""
    x = F.col(col).cast("double")
    freq = cut_lineage(df.where(x.isNotNull()).groupBy(x.alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    n = freq.select(F.sum("_c")).scalar()
    req = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.greatest(F.ceil(F.lit(float(p)) * n), F.lit(1)).cast("bigint").alias("r"))
                    for p in probs])
    ranks = df.sparkSession.range(1).select(req.alias("_req"))
    return ranks_to_values(freq, [], ranks).select("p", "value")


def describe_long(df: DataFrame, cols: Sequence[str], accuracy: int = 10000,
                  exact: bool = False) -> DataFrame:
    """Typed long-form ``summary()``: count, mean, stddev, min, 25/50/75 %, max.

    Quartiles are ``percentile_approx`` (Spark's ``summary()``), or with
    ``exact=True`` the exact discrete quantiles from :func:`discrete_quantiles`."""
    if exact:
        aggs = []
        for i, c in enumerate(cols):
            x = F.col(c).cast("double")
            aggs += [F.count(x).cast("double").alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                     F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        wide = df.agg(*aggs)
        stats = [("count", "n{i}"), ("mean", "m{i}"), ("stddev", "s{i}"), ("min", "lo{i}"), ("max", "hi{i}")]
        rows = [f"'{c}', '{s_}', {e.format(i=i)}" for i, c in enumerate(cols) for s_, e in stats]
        out = wide.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) as (column_name, statistic, value)")
        names = {0.25: "25%", 0.5: "50%", 0.75: "75%"}
        lab = F.create_map(*[x for p, nm in names.items() for x in (F.lit(p), F.lit(nm))])
        q = column_quantiles(df, cols, list(names), interpolate=False)
        return out.unionByName(q.select("column_name", lab[F.col("p")].alias("statistic"), "value"))
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy).alias(f"q{i}"),
                 F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    stats = [("count", "n{i}"), ("mean", "m{i}"), ("stddev", "s{i}"), ("min", "lo{i}"),
             ("25%", "q{i}[0]"), ("50%", "q{i}[1]"), ("75%", "q{i}[2]"), ("max", "hi{i}")]
    rows = []
    for i, c in enumerate(cols):
        for s, e in stats:
            rows.append(f"'{c}', '{s}', {e.format(i=i)}")
    return wide.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) as (column_name, statistic, value)")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """Exact linearly interpolated quantiles ``(p, value)`` (pandas / DuckDB
    ``quantile_cont``): the order statistics at ``floor`` and ``ceil`` of
    ``p * (n - 1)`` come from :func:`ranks_to_values` (no value buffer)."""
    x = F.col(col).cast("double")
    freq = cut_lineage(df.where(x.isNotNull()).groupBy(x.alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    n = freq.select(F.sum("_c")).scalar()
    items = []
    for p in probs:
        h = F.lit(float(p)) * (n - 1)
        items.append(F.struct(F.lit(float(p)).alias("p"), (F.floor(h) + 1).cast("bigint").alias("r")))
        items.append(F.struct(F.lit(float(p)).alias("p"), (F.ceil(h) + 1).cast("bigint").alias("r")))
    ranks = df.sparkSession.range(1).select(F.array(*items).alias("_req"))
    got = ranks_to_values(freq, [], ranks)
    g = got.groupBy("p").agg(F.min_by("value", "r").alias("lo"), F.max_by("value", "r").alias("hi"))
    h = F.col("p") * (n - 1)
    return g.select("p", (F.col("lo") + (F.col("hi") - F.col("lo")) * (h - F.floor(h))).alias("value"))


def describe_numeric(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pandas-style describe with exact interpolated quantiles, long form.

    Moments come from one aggregate; quartiles from :func:`exact_quantiles`
    (distributed, no per-group value buffer)."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    stats = [("count", "n{i}"), ("mean", "m{i}"), ("std", "s{i}"), ("min", "lo{i}"), ("max", "hi{i}")]
    rows = [f"'{c}', '{s}', {e.format(i=i)}" for i, c in enumerate(cols) for s, e in stats]
    out = wide.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) as (column_name, statistic, value)")
    names = {0.25: "25%", 0.5: "50%", 0.75: "75%"}
    lab = F.create_map(*[x for p, nm in names.items() for x in (F.lit(p), F.lit(nm))])
    q = column_quantiles(df, cols, list(names), interpolate=True)
    out = out.unionByName(q.select("column_name", lab[F.col("p")].alias("statistic"), "value"))
    return out.select("column_name", "statistic", F.round("value", digits).alias("value"))


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, unique, top (most frequent, ties -> smallest value), freq per column.

    All columns in ONE scan: unpivot to ``(column, value)``, one grouped
    frequency table, then a small aggregate per column; ``min_by`` on
    ``(-freq, value)`` picks the top value."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot([], list(cols), "column_name", "v").where(F.col("v").isNotNull())
    freq = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("f"))
    r = freq.groupBy("column_name").agg(
        F.sum("f").cast("bigint").alias("count"), F.count(F.lit(1)).cast("bigint").alias("unique"),
        F.min_by(F.struct(F.col("v").alias("top"), F.col("f").alias("freq")),
                 F.struct((-F.col("f")).alias("nf"), F.col("v").alias("v"))).alias("_t"))
    return r.select("column_name", "count", "unique", F.col("_t.top").alias("top"),
                    F.col("_t.freq").cast("bigint").alias("freq"))


def value_counts(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    """``(value, n, pct)``; ``pct`` rounded to ``digits``."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = g.select(F.sum("n")).scalar()  # reuses g's shuffle: one scan
    return g.withColumn("pct", pct("n", total, digits))


def sparsity(ratings: DataFrame, user: str = "user", item: str = "item", digits: int = 4) -> DataFrame:
    """Interactions, distinct users/items and sparsity % (1 - n / (u*i))."""
    a = ratings.agg(F.count(F.lit(1)).alias("n_interactions"),
                    F.count_distinct(user).alias("n_users"), F.count_distinct(item).alias("n_items"))
    return a.withColumn("sparsity_pct", F.round(
        (F.lit(1.0) - F.col("n_interactions") / (F.col("n_users").cast("double") * F.col("n_items"))) * 100,
        digits))


def sparsity_parts(ratings: DataFrame, keys: Sequence[str], user: str = "user", item: str = "item") -> DataFrame:
    """G21 as partial results that can be kept and merged: ``(keys..., entity, bucket,
    bits, n)``, bitmaps of users and items (whole, non-negative ids) and rows per
    group of ``keys``, such as a day.  One scan; one entry an id and row, no
    Expand over distinct columns."""
    e = F.array(F.struct(F.lit("user").alias("entity"), F.col(user).cast("bigint").alias("id")),
                F.struct(F.lit("item").alias("entity"), F.col(item).cast("bigint").alias("id")))
    long = ratings.select(*keys, F.explode(e).alias("e")).select(*keys, "e.*")
    i = F.col("id")
    return cut_lineage(long.groupBy(*keys, "entity", F.bitmap_bucket_number(i).alias("bucket"))
                       .agg(F.bitmap_construct_agg(F.bitmap_bit_position(i)).alias("bits"), F.count(F.lit(1)).alias("n")))


def sparsity_from_parts(parts: DataFrame, digits: int = 4) -> DataFrame:
    """:func:`sparsity` from any union of :func:`sparsity_parts`."""
    m = parts.groupBy("entity", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("n").alias("n"))
    count = lambda e: F.coalesce(F.sum(F.when((F.col("entity") == e) & F.col("bucket").isNotNull(), F.bitmap_count("bits"))), F.lit(0))
    a = m.agg(F.coalesce(F.sum(F.when(F.col("entity") == "user", F.col("n"))), F.lit(0)).alias("n_interactions"),
              count("user").alias("n_users"), count("item").alias("n_items"))
    return a.withColumn("sparsity_pct", F.round((F.lit(1.0) - F.col("n_interactions") / (F.col("n_users").cast("double") * F.col("n_items"))) * 100, digits))


def dataset_summary(ratings: DataFrame, user: str = "user", item: str = "item",
                    rating: str = "rating", digits: int = 4) -> DataFrame:
    """Six named metrics as ``(metric, value double)``."""
    a = ratings.agg(F.count(F.lit(1)).cast("double").alias("n"),
                    F.count_distinct(user).cast("double").alias("u"),
                    F.count_distinct(item).cast("double").alias("i"),
                    F.avg(rating).alias("m"))
    a = a.withColumn("med", exact_quantiles(ratings, rating, [0.5]).select("value").scalar())
    a = a.withColumn("sp", (F.lit(1.0) - F.col("n") / (F.col("u") * F.col("i"))) * 100)
    return a.selectExpr(
        "stack(6, 'total_ratings', n, 'unique_users', u, 'unique_items', i, "
        "'mean_rating', m, 'median_rating', med, 'sparsity_pct', sp) as (metric, value)") \
        .select("metric", F.round("value", digits).alias("value"))


def activity_stats(df: DataFrame, key: str, digits: int = 4) -> DataFrame:
    """Mean, median, min, max, std of rows per entity (two-level aggregate)."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    med = exact_quantiles(per, "_c", [0.5]).select(F.round("value", digits).alias("median"))
    a = per.agg(F.round(F.avg("_c"), digits).alias("mean"),
                   F.min("_c").cast("bigint").alias("min"), F.max("_c").cast("bigint").alias("max"),
                   F.round(F.stddev_samp("_c"), digits).alias("std"),
                   F.count(F.lit(1)).alias("n_entities"))
    return a.select("mean", med.scalar().alias("median"), "min", "max", "std", "n_entities")


def rating_distribution(df: DataFrame, rating: str = "rating") -> DataFrame:
    """Rating, count, % (2 digits), ordered by rating."""
    return value_counts(df, rating, 2).orderBy(rating)


def _bin_expr(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    width = (hi - lo) / F.lit(bins)
    b = F.floor((x - lo) / width)
    return F.when(hi == lo, F.lit(0)).otherwise(F.least(b, F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 10, digits: int = 6) -> DataFrame:
    """Equi-width histogram, last bin closed; edges from min/max scalar subqueries."""
    x = F.col(col).cast("double")
    src = df.where(F.col(col).isNotNull())
    lo = src.select(F.min(x)).scalar()
    hi = src.select(F.max(x)).scalar()
    g = src.groupBy(_bin_expr(x, lo, hi, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / F.lit(bins)
    return g.select("bin", F.round(lo + F.col("bin") * width, digits).alias("lo"),
                    F.round(lo + (F.col("bin") + 1) * width, digits).alias("hi"), "n")


def grouped_histogram(df: DataFrame, col: str, group: str, bins: int = 10,
                      digits: int = 6) -> DataFrame:
    """Shared edges over all groups, counts per (group, bin)."""
    x = F.col(col).cast("double")
    src = df.where(F.col(col).isNotNull())
    lo = src.select(F.min(x)).scalar()
    hi = src.select(F.max(x)).scalar()
    g = src.groupBy(group, _bin_expr(x, lo, hi, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / F.lit(bins)
    return g.select(group, "bin", F.round(lo + F.col("bin") * width, digits).alias("lo"),
                    F.round(lo + (F.col("bin") + 1) * width, digits).alias("hi"), "n")


def union_tagged(frames: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """Union by name with a source tag column."""
    out = None
    for name, d in frames.items():
        t = d.withColumn(tag, F.lit(name))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def category_counts_by_source(frames: Mapping[str, DataFrame], col: str) -> DataFrame:
    """``(source, category, n)``."""
    u = union_tagged({k: v.select(col) for k, v in frames.items()})
    return u.groupBy("source", F.col(col).alias("category")).agg(F.count(F.lit(1)).alias("n"))


def proportion_table(frames: Mapping[str, DataFrame], col: str, digits: int = 6) -> DataFrame:
    """Category x source proportions (pivot with an explicit value list)."""
    c = category_counts_by_source(frames, col)
    tot = c.groupBy("source").agg(F.sum("n").alias("_t"))
    p = c.join(F.broadcast(tot), "source").withColumn("p", F.round(F.col("n") / F.col("_t"), digits))
    return (p.groupBy("category").pivot("source", list(frames)).agg(F.first("p"))
            .na.fill(0.0, subset=list(frames)))


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 9) -> DataFrame:
    """Long-form Pearson matrix ``(col_a, col_b, r)`` from one aggregate."""
    pairs = [(a, b) for a in cols for b in cols]
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
            for i, (a, b) in enumerate(pairs)]
    wide = df.agg(*aggs)
    st = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {st}) as (col_a, col_b, r)") \
        .select("col_a", "col_b", F.round("r", digits).alias("r"))


def density(df: DataFrame, col: str, grid: int = 200, digits: int = 12, terms: int = 24) -> DataFrame:
    """Gaussian KDE (Scott bandwidth ``h = std * n^(-1/5)``) on ``grid`` points
    between min and max, by a fast Gauss transform.

    The axis is cut into cells one bandwidth wide.  A row adds ``terms`` moments
    ``s^p / p!`` to its cell, s being its distance from the cell's centre in
    bandwidths (at most 1/2); a grid point at distance t takes
    ``exp(-t^2 / 2) * sum_p He_p(t) * moment_p`` from the cells within ten
    bandwidths.  Truncation is below 1e-16 of a kernel.  Two aggregates over the
    rows, whatever the grid; what is shuffled is one row a cell and task.

    Nulls are left out; a column of one value (no bandwidth) gives null
    densities, an empty one null grid points."""
    x = F.col(col).cast("double")
    src = df.where(F.col(col).isNotNull())
    stats = src.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"), F.min(x).alias("lo"), F.max(x).alias("hi")) \
        .select(F.struct("n", "lo", "hi", F.nullif(F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)), F.lit(0.0)).alias("h")).alias("s"))
    spark = df.sparkSession
    one = stats.scalar()
    n, lo, hi, h = (one[k] for k in ("n", "lo", "hi", "h"))
    cell = F.floor((x - lo) / h)
    at = src.select(cell.alias("cell"), ((x - lo) / h - cell - F.lit(0.5)).alias("s")).where("cell IS NOT NULL")
    moments = at.groupBy("cell").agg(*[F.sum(F.pow("s", F.lit(float(p))) / F.lit(float(math.factorial(p)))).alias(f"m{p}") for p in range(terms)]) \
        .select("cell", F.array(*[F.col(f"m{p}") for p in range(terms)]).alias("m"))
    points = spark.range(grid).select(F.col("id").cast("int").alias("grid_index"), (lo + (hi - lo) * F.col("id") / F.lit(grid - 1)).alias("x"))
    here = F.floor((F.col("x") - lo) / h)
    near = points.withColumn("cell", F.explode_outer(F.sequence(here - 10, here + 10)))
    t = (F.col("x") - lo) / h - F.col("cell") - F.lit(0.5)
    # He_(p+1)(t) = t He_p(t) - p He_(p-1)(t)
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("he"), F.lit(0.0).alias("was"), F.lit(0.0).alias("p"), F.col("t").alias("t"))
    series = F.aggregate("m", start, lambda a, m: F.struct((a["sum"] + a["he"] * m).alias("sum"), (a["t"] * a["he"] - a["p"] * a["was"]).alias("he"),
                                                          a["he"].alias("was"), (a["p"] + 1).alias("p"), a["t"].alias("t")))
    part = near.withColumn("t", t).join(moments, "cell", "left").withColumn("part", F.exp(F.lit(-0.5) * F.col("t") * F.col("t")) * series["sum"])
    dens = part.groupBy("grid_index", "x").agg(F.sum("part").alias("_s"))
    norm = F.lit(1.0) / (n * h * F.lit((2 * math.pi) ** 0.5))
    return dens.select("grid_index", F.round("x", 9).alias("x"), F.round(F.coalesce("_s", F.lit(0.0)) * norm, digits).alias("density"))


def distinct_bitmaps(df: DataFrame, id_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """G19/G21/G22 at scale: ``(keys..., bucket, bits)``, the ids of each group as
    bitmaps of 32,768 ids a bucket.  ``id_col`` is a non-negative whole number,
    densest if from :func:`quarry.operators.windows.index_ids`; null ids are left
    out.  Partial bitmaps merge map-side; kept as a table, parts of days or
    sources are merged by :func:`distinct_counts` without reading rows again."""
    i = F.col(id_col).cast("bigint")
    return df.where(i.isNotNull()).groupBy(*keys, F.bitmap_bucket_number(i).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(i)).alias("bits"))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str] = (), out: str = "n_distinct") -> DataFrame:
    """Exact ``count(DISTINCT id)`` per ``keys`` (any of the table's own, or none) from
    bitmaps, however many parts they come from: united by bucket, then counted."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(out))


def collapse_pairs(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Duplicate (user, item) pairs summed (what a CSR constructor does)."""
    return df.groupBy(*keys).agg(F.sum(value).alias(out or value))


def length_stats(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """mean/median/min/max/std per length column, long form."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}"), F.stddev_samp(x).alias(f"s{i}")]
    wide = df.agg(*aggs)
    st = ", ".join(f"'{c}', m{i}, lo{i}, hi{i}, s{i}" for i, c in enumerate(cols))
    r = wide.selectExpr(f"stack({len(cols)}, {st}) as (measure, mean, min, max, std)")
    med = column_quantiles(df, cols, [0.5], interpolate=True).select(F.col("column_name").alias("measure"), F.col("value").alias("median"))
    r = r.join(med, "measure", "left")
    return r.select("measure", *[F.round(c, digits).alias(c) for c in ("mean", "median", "min", "max", "std")])


def positive_rate(df: DataFrame, split: str, label: str, digits: int = 4) -> DataFrame:
    """% positive per split."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"),
                                 F.round(F.avg(F.col(label).cast("double")) * 100, digits).alias("pct_positive"))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """K1-K3: ``orderBy(...).limit(k)`` -> TakeOrderedAndProject (per-task top-k heap)."""
    return df.orderBy(*order).limit(k)


def arg_max_row(df: DataFrame, by: str, tie: str) -> DataFrame:
    """K6: the row with the largest ``by`` (ties -> smallest ``tie``)."""
    return df.orderBy(F.desc(by), tie).limit(1)
