"""Real-vs-synthetic similarity, utility and privacy metrics.

All metrics are long-form DataFrames built from grouped aggregates; the
empirical CDFs behind KS use the distributed running-total primitive, so
no column is ever sorted inside one task.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.predicates import fingerprint
from quarry.operators.aggregate import corr_matrix
from quarry.operators.joins import sized_broadcast
from quarry.operators.windows import running_totals
from quarry.session import cut_lineage

__all__ = ["corr_gap", "mean_corr_gap", "ks", "tvd", "pair_tvd", "normalise_rows", "row_overlap",
           "diagnostic", "quality", "report_rows", "evaluate", "unpivot_numeric",
           "unpivot_categorical"]


def unpivot_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([], list(cols), "column_name", "value").where(F.col("value").isNotNull())


def unpivot_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot([], list(cols), "column_name", "value").where(F.col("value").isNotNull())


def _name_row(cols: Sequence[str]) -> int:
    """Bytes of a row of a column's name and a few numbers."""
    return 96 + max(4 * len(c) for c in cols)


def corr_gap(a: DataFrame, b: DataFrame, cols: Sequence[str], digits: int = 9) -> DataFrame:
    """``|r_a - r_b|`` per column pair (upper triangle, i < j)."""
    ra = corr_matrix(a, cols, 15).withColumnRenamed("r", "r_a")
    rb = corr_matrix(b, cols, 15).withColumnRenamed("r", "r_b")
    order = {c: i for i, c in enumerate(cols)}
    pos = F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(i))])
    j = ra.join(rb, ["col_a", "col_b"]).where(pos[F.col("col_a")] < pos[F.col("col_b")])
    return j.select("col_a", "col_b", F.round("r_a", digits).alias("r_a"), F.round("r_b", digits).alias("r_b"),
                    F.round(F.abs(F.col("r_a") - F.col("r_b")), digits).alias("gap"))


def mean_corr_gap(a: DataFrame, b: DataFrame, cols: Sequence[str], digits: int = 9) -> DataFrame:
    g = corr_gap(a, b, cols, 15)
    return g.agg(F.round(F.avg("gap"), digits).alias("mean_gap"), F.count(F.lit(1)).alias("n_pairs"))


def ks(a: DataFrame, b: DataFrame, cols: Sequence[str], digits: int = 9,
       n_buckets: int | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per numeric column."""
    la = unpivot_numeric(a, cols).withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0))
    lb = unpivot_numeric(b, cols).withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1))
    # distinct values per column: read by the totals and every prefix-sum stage
    freq = cut_lineage(la.unionByName(lb).groupBy("column_name", "value").agg(
        F.sum("_a").cast("bigint").alias("na"), F.sum("_b").cast("bigint").alias("nb")))
    tot = freq.groupBy("column_name").agg(F.sum("na").alias("tot_a"), F.sum("nb").alias("tot_b"))
    cum = running_totals(freq, "value", {"ca": F.col("na"), "cb": F.col("nb")}, ["column_name"],
                         n_buckets=n_buckets)
    j = cum.join(sized_broadcast(tot, rows_bound=len(cols), row_bytes=_name_row(cols)), "column_name")
    diff = F.abs(F.col("ca") / F.col("tot_a") - F.col("cb") / F.col("tot_b"))
    return j.groupBy("column_name").agg(F.round(F.max(diff), digits).alias("ks"))


def tvd(a: DataFrame, b: DataFrame, cols: Sequence[str], digits: int = 9) -> DataFrame:
    """T4: total variation distance ``0.5 * sum |p - q|`` per categorical column;
    categories present on one side only count with probability 0 on the other;
    nulls are no category."""
    def probs(df, name):
        f = unpivot_categorical(df, cols).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("_n"))
        t = f.groupBy("column_name").agg(F.sum("_n").alias("_t"))
        return f.join(sized_broadcast(t, rows_bound=len(cols), row_bytes=_name_row(cols)), "column_name").select(
            "column_name", "value", (F.col("_n") / F.col("_t")).alias(name))
    j = probs(a, "p").join(probs(b, "q"), ["column_name", "value"], "full_outer")
    d = F.abs(F.coalesce("p", F.lit(0.0)) - F.coalesce("q", F.lit(0.0)))
    return j.groupBy("column_name").agg(F.round(F.sum(d) * 0.5, digits).alias("tvd"))


def normalise_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Strings stripped and lower-cased, numbers rounded half-even to integers."""
    out = []
    for c in cols:
        t = df.schema[c].dataType
        if isinstance(t, T.StringType):
            out.append(F.lower(F.trim(F.col(c))).alias(c))
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            out.append(F.bround(F.col(c), 0).cast("bigint").alias(c))
        else:
            out.append(F.col(c).alias(c))
    return df.select(*out)


def row_overlap(real: DataFrame, synth: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Share of distinct real row fingerprints that also occur in synth."""
    hr = normalise_rows(real, cols).select(fingerprint(*cols).alias("h")).distinct()
    hs = normalise_rows(synth, cols).select(fingerprint(*cols).alias("h")).distinct()
    n_real = hr.select(F.count(F.lit(1))).scalar()
    both = hr.intersect(hs).agg(F.count(F.lit(1)).alias("n_overlap"))
    return both.select(n_real.alias("n_real_distinct"), "n_overlap",
                       F.round(F.col("n_overlap") * 100.0 / n_real, digits).alias("overlap_pct"))


def diagnostic(real: DataFrame, synth: DataFrame, numeric: Sequence[str],
               categorical: Sequence[str], ids: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Data validity per column (range / category adherence, key uniqueness)
    and data structure (column-set agreement) -> ``(property, column_name, score)``."""
    parts = []
    if numeric:
        # one aggregate over real (ranges) and one over synth (all columns)
        rng = real.agg(*[F.min(c).alias(f"lo_{c}") for c in numeric], *[F.max(c).alias(f"hi_{c}") for c in numeric])
        aggs = []
        for i, c in enumerate(numeric):
            lo, hi = rng.select(f"lo_{c}").scalar(), rng.select(f"hi_{c}").scalar()
            aggs += [F.count_if((F.col(c) >= lo) & (F.col(c) <= hi)).alias(f"in{i}"), F.count(c).alias(f"nn{i}")]
        wide = synth.agg(*aggs)
        st = ", ".join(f"'{c}', in{i} / nn{i}" for i, c in enumerate(numeric))
        parts.append(wide.selectExpr(f"stack({len(numeric)}, {st}) as (column_name, score)")
                     .select(F.lit("data_validity").alias("property"), "column_name", "score"))
    if categorical:
        # one scan a side: which of synth's values occur in real, weighted by their counts
        cats = unpivot_categorical(real, categorical).distinct().withColumn("_in", F.lit(1))
        sv = unpivot_categorical(synth, categorical).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("_n"))
        ok = sv.join(cats, ["column_name", "value"], "left").groupBy("column_name") \
            .agg((F.sum(F.when(F.col("_in") == 1, F.col("_n")).otherwise(0)) / F.sum("_n")).alias("score"))
        parts.append(ok.select(F.lit("data_validity").alias("property"), "column_name", "score"))
    if ids:
        u = synth.agg(*[(F.count_distinct(c) / F.count(F.lit(1))).alias(f"u{i}") for i, c in enumerate(ids)])
        st = ", ".join(f"'{c}', u{i}" for i, c in enumerate(ids))
        parts.append(u.selectExpr(f"stack({len(ids)}, {st}) as (column_name, score)")
                     .select(F.lit("data_validity").alias("property"), "column_name", "score"))
    rc, sc = set(real.columns), set(synth.columns)
    struct = len(rc & sc) / len(rc | sc)
    spark = real.sparkSession
    parts.append(spark.range(1).select(F.lit("data_structure").alias("property"),
                                       F.lit("(table)").alias("column_name"), F.lit(struct).alias("score")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("property", "column_name", F.round(F.col("score").cast("double"), digits).alias("score"))


def pair_tvd(a: DataFrame, b: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """TVD of the contingency tables of several column pairs, ONE scan per side:
    each row emits one ``(pair, x, y)`` entry per pair (bounded fan-out), then a
    single grouped count."""
    def probs(df, name):
        entries = F.array(*[F.struct(F.lit(i).alias("pid"), F.col(x).cast("string").alias("x"),
                                     F.col(y).cast("string").alias("y")) for i, (x, y) in enumerate(pairs)])
        e = df.select(F.explode(entries).alias("e")).select("e.*").where("x is not null and y is not null")
        f = e.groupBy("pid", "x", "y").agg(F.count(F.lit(1)).alias("_n"))
        t = f.groupBy("pid").agg(F.sum("_n").alias("_t"))
        return f.join(sized_broadcast(t, rows_bound=len(pairs)), "pid").select(
            "pid", "x", "y", (F.col("_n") / F.col("_t")).alias(name))
    j = probs(a, "p").join(probs(b, "q"), ["pid", "x", "y"], "full_outer")
    d = F.abs(F.coalesce("p", F.lit(0.0)) - F.coalesce("q", F.lit(0.0)))
    names = F.create_map(*[v for i, (x, y) in enumerate(pairs) for v in (F.lit(i), F.lit(f"{x}|{y}"))])
    return j.groupBy("pid").agg((F.sum(d) * 0.5).alias("tvd")).select(names[F.col("pid")].alias("column_name"), "tvd")


def range_bins(real: DataFrame, numeric: Sequence[str], n: int = 10) -> dict:
    """Bin number of each numeric column over the real side's range: 1..n inside,
    0 below, n + 1 from the maximum on; null stays null."""
    r = real.agg(*[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in numeric],
                 *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in numeric]).first()
    out = {}
    for c in numeric:
        x, lo, hi = F.col(c).cast("double"), r[f"lo_{c}"], r[f"hi_{c}"]
        if lo is None:
            out[c] = F.lit(None).cast("bigint")
            continue
        inside = F.floor((x - F.lit(lo)) / F.lit((hi - lo) / n if hi > lo else 1.0)) + 1
        out[c] = F.when(x < F.lit(lo), 0).when(x >= F.lit(hi), n + 1).when(x.isNotNull(), inside).cast("bigint")
    return out


def quality(real: DataFrame, synth: DataFrame, numeric: Sequence[str],
            categorical: Sequence[str], digits: int = 6) -> DataFrame:
    """Column shapes (1 - KS, 1 - TVD) and column-pair trends
    (1 - |dr|/2 for numeric pairs, 1 - TVD of the contingency table for
    categorical and mixed pairs) -> ``(property, column_name, score)``.

    In a mixed pair the numeric column stands as ten equal-width bins over the
    real side's range, with one bin below and one from its maximum on (the
    published contingency similarity for discretised columns)."""
    parts = []
    if numeric:
        parts.append(ks(real, synth, numeric, 15).select(
            F.lit("column_shapes").alias("property"), "column_name", (1 - F.col("ks")).alias("score")))
    if categorical:
        parts.append(tvd(real, synth, categorical, 15).select(
            F.lit("column_shapes").alias("property"), "column_name", (1 - F.col("tvd")).alias("score")))
    if len(numeric) > 1:
        g = corr_gap(real, synth, numeric, 15)
        parts.append(g.select(F.lit("column_pair_trends").alias("property"),
                              F.concat_ws("|", "col_a", "col_b").alias("column_name"),
                              (1 - F.col("gap") / 2).alias("score")))
    cat_pairs = [(c1, c2) for i, c1 in enumerate(categorical) for c2 in categorical[i + 1:]]
    mixed = [(x, c) for x in numeric for c in categorical]
    if cat_pairs or mixed:
        bins = range_bins(real, numeric) if mixed else {}
        a, b = (s.withColumns({f"_bin_{x}": e for x, e in bins.items()}) if bins else s for s in (real, synth))
        t = pair_tvd(a, b, cat_pairs + [(f"_bin_{x}", c) for x, c in mixed])
        parts.append(t.select(F.lit("column_pair_trends").alias("property"), F.regexp_replace("column_name", "^_bin_", "").alias("column_name"),
                              (1 - F.col("tvd")).alias("score")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("property", "column_name", F.round("score", digits).alias("score"))


def report_rows(scores: DataFrame, digits: int = 6) -> DataFrame:
    """Property-level averages appended to the per-column rows."""
    prop = scores.groupBy("property").agg(F.round(F.avg("score"), digits).alias("score")) \
        .withColumn("column_name", F.lit("(average)"))
    return scores.unionByName(prop.select("property", "column_name", "score"))


def evaluate(real: DataFrame, synths: Mapping[str, DataFrame], numeric: Sequence[str],
             categorical: Sequence[str], digits: int = 6) -> DataFrame:
    """Overall quality and diagnostic score per synthetic dataset.  Each side
    is kept once for all the scores that read it."""
    out = None
    real = cut_lineage(real)
    for name, s in synths.items():
        s = cut_lineage(s)
        q = quality(real, s, numeric, categorical, 15).groupBy("property").agg(F.avg("score").alias("p"))
        dg = diagnostic(real, s, numeric, categorical, (), 15).groupBy("property").agg(F.avg("score").alias("p"))
        qs = q.select(F.avg("p")).scalar()
        ds = dg.select(F.avg("p")).scalar()
        r = real.sparkSession.range(1).select(F.lit(name).alias("model"),
                                              F.round(qs, digits).alias("quality_score"),
                                              F.round(ds, digits).alias("diagnostic_score"))
        out = r if out is None else out.unionByName(r)
    return out
