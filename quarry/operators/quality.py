"""Data-quality operators (Q1-Q11).

Q1-Q3 are one operator with different rule lists.  The reference runs two
full jobs per rule; here every rule is a predicate, the audit is a single
scan that tags each row with its *first* failing rule, and the clean set
is the conjunction of all rules (pushed into the Parquet scan).
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quarry.functions.predicates import DEFAULT_SENTINELS, is_present, pct

__all__ = [
    "Rule", "trip_rules", "clean", "first_failing_rule", "rule_audit", "retention",
    "removal_breakdown", "validate", "missing", "class_balance", "infer_metadata",
    "rows_preserved", "unique_key",
]


@dataclass(frozen=True)
class Rule:
    """A row passes when ``keep`` is true; null counts as failing."""
    name: str
    keep: Column


def trip_rules(amount="total_amount", distance="trip_distance", borough=("PU_Borough",),
               passengers: str | None = None, max_amount: float = 200.0,
               max_distance: float = 100.0, max_passengers: float | None = 9,
               sentinels: Sequence[str] = DEFAULT_SENTINELS,
               passengers_last: bool = False) -> list[Rule]:
    """Q1 (6 rules), Q2 (+ passenger bounds, 8 rules), Q3 (both trip ends)."""
    a, d = F.col(amount), F.col(distance)
    rules = [
        Rule("null_amount", a.isNotNull()),
        Rule("non_positive_amount", a > 0),
        Rule("extreme_amount", a <= F.lit(max_amount)),
        Rule("non_positive_distance", d > 0),
        Rule("extreme_distance", d <= F.lit(max_distance)),
    ]
    pax = []
    if passengers is not None:
        p = F.col(passengers)
        pax.append(Rule("non_positive_passengers", p > 0))
        if max_passengers is not None:
            pax.append(Rule("excess_passengers", p <= F.lit(max_passengers)))
    bor = [Rule(f"missing_{b}", is_present(b, sentinels)) for b in borough]
    return rules + (bor + pax if passengers_last else pax + bor)


def first_failing_rule(rules: Sequence[Rule]) -> Column:
    """Name of the first rule a row fails (null when it passes all)."""
    expr = None
    for r in rules:
        bad = ~F.coalesce(r.keep, F.lit(False))
        expr = F.when(bad, F.lit(r.name)) if expr is None else expr.when(bad, F.lit(r.name))
    return expr


def clean(df: DataFrame, rules: Sequence[Rule], observation: Observation | None = None) -> DataFrame:
    """Rows passing every rule.

    With an ``Observation`` the per-rule removal counts are collected as
    observed metrics of the *same* job that consumes the clean rows.
    Spark 4.1 caveat: after a session has used an ``Observation`` its ML
    classification summaries are no longer serializable, so build observed
    jobs on ``spark.newSession()`` when the session also trains models.
    """
    src = df
    if observation is not None:
        ff = first_failing_rule(rules)
        metrics = [F.count(F.lit(1)).alias("original")]
        metrics += [F.count_if(ff == F.lit(r.name)).alias(r.name) for r in rules]
        src = df.observe(observation, *metrics)
    cond = None
    for r in rules:
        cond = r.keep if cond is None else cond & r.keep
    return src.where(cond)


def rule_audit(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Audit ``(rule_order, rule, removed)`` plus a final ``kept`` row, one scan.

    ``removed`` counts rows failing the rule after all earlier rules, i.e.
    rows whose first failing rule it is.  One global aggregate with partial
    aggregation per task; no shuffle of rows.
    """
    ff = first_failing_rule(rules)
    aggs = [F.count_if(ff == F.lit(r.name)).alias(f"r{i}") for i, r in enumerate(rules)]
    aggs.append(F.count_if(ff.isNull()).alias(f"r{len(rules)}"))
    wide = df.agg(*aggs)
    names = [r.name for r in rules] + ["kept"]
    stack = ", ".join(f"{i + 1}, '{n}', r{i}" for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {stack}) as (rule_order, rule, removed)") \
        .select(F.col("rule_order").cast("int"), "rule", F.col("removed").cast("bigint"))


def retention(audit: DataFrame) -> DataFrame:
    """Q4: original, final, removed, removal % and retention % (2 digits)."""
    a = audit.agg(F.sum("removed").alias("original"),
                  F.sum(F.when(F.col("rule") == "kept", F.col("removed"))).alias("final"))
    return a.select(
        F.col("original").cast("bigint").alias("original"),
        F.col("final").cast("bigint").alias("final"),
        (F.col("original") - F.col("final")).cast("bigint").alias("removed"),
        pct(F.col("original") - F.col("final"), "original", 2).alias("removal_pct"),
        pct("final", "original", 2).alias("retention_pct"))


def removal_breakdown(audit: DataFrame) -> DataFrame:
    """Q5: rule, removed, % of original (2 digits); the ``kept`` row excluded."""
    from pyspark.sql import Window
    total = F.sum("removed").over(Window.partitionBy())  # one row per rule: bounded
    return (audit.select("rule_order", "rule", "removed", total.alias("_t"))
            .where(F.col("rule") != "kept")
            .select("rule_order", "rule", "removed", pct("removed", "_t", 2).alias("pct_of_original")))


def validate(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """Q6: ``(check, violations, status, all_passed)`` from one aggregate.

    Each check is ``(name, violation predicate)``.
    """
    wide = df.agg(*[F.count_if(F.coalesce(v, F.lit(False))).alias(f"c{i}")
                    for i, (_, v) in enumerate(checks)])
    stack = ", ".join(f"{i + 1}, '{n}', c{i}" for i, (n, _) in enumerate(checks))
    long = wide.selectExpr(f"stack({len(checks)}, {stack}) as (check_order, check_name, violations)")
    # the stacked result has one row per check: a window over it is bounded
    from pyspark.sql import Window
    allok = F.max("violations").over(Window.partitionBy()) == 0
    return long.select(F.col("check_order").cast("int"), "check_name",
                       F.col("violations").cast("bigint"),
                       F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("status"),
                       allok.alias("all_passed"))


def missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q7: per column null count and % of rows (2 digits), one scan."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', m{i}" for i, c in enumerate(cols))
    return wide.selectExpr("_n", f"stack({len(cols)}, {stack}) as (column_name, n_missing)") \
        .select("column_name", F.col("n_missing").cast("bigint"),
                pct("n_missing", "_n", 2).alias("pct_missing"))


def class_balance(df: DataFrame, label: str, threshold: float = 2.0) -> DataFrame:
    """Q8: count and % per class, majority/minority ratio and imbalance flag."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    most, least, total = (g.select(f("n")).scalar() for f in (F.max, F.min, F.sum))
    ratio = F.try_divide(most.cast("double"), least.cast("double"))
    return g.select(label, "n", pct("n", total, 2).alias("pct"),
                    F.round(ratio, 2).alias("imbalance_ratio"),
                    (ratio > F.lit(threshold)).alias("imbalanced"))


def infer_metadata(df: DataFrame, overrides: dict[str, str] | None = None,
                   id_pattern: str = r"(id|key)$") -> DataFrame:
    """Q10: ``(column_name, dtype, sdtype)``.

    numeric -> numerical, string/boolean -> categorical, timestamps ->
    datetime; a column whose name looks like an id *and* whose values are
    unique -> id.  Only the id candidates pay an exact distinct count.
    """
    import re
    from pyspark.sql import types as T
    overrides = overrides or {}
    rx = re.compile(id_pattern, re.IGNORECASE)
    cands = [f.name for f in df.schema.fields
             if rx.search(f.name) and not isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    unique = {}
    if cands:
        row = df.agg(F.count(F.lit(1)).alias("_n"),
                     *[F.count_distinct(c).alias(f"d{i}") for i, c in enumerate(cands)]).first()
        unique = {c: row[f"d{i}"] == row["_n"] for i, c in enumerate(cands)}
    rows = []
    for f in df.schema.fields:
        t = f.dataType
        if unique.get(f.name):
            s = "id"
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            s = "datetime"
        elif isinstance(t, (T.BooleanType, T.StringType)):
            s = "categorical"
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                            T.FloatType, T.DoubleType, T.DecimalType)):
            s = "numerical"
        else:
            s = "unknown"
        rows.append((f.name, t.simpleString(), overrides.get(f.name, s)))
    return df.sparkSession.createDataFrame(rows, "column_name string, dtype string, sdtype string")


def rows_preserved(before: DataFrame, after: DataFrame) -> DataFrame:
    """Q11: joined count equals input count (two global aggregates)."""
    b = before.select(F.count(F.lit(1))).scalar()
    a = after.select(F.count(F.lit(1))).scalar()
    one = before.sparkSession.range(1)
    return one.select(b.alias("before_count"), a.alias("after_count"), (a == b).alias("preserved"))


def unique_key(dim: DataFrame, key: str) -> DataFrame:
    """Q11: does ``key`` identify dimension rows uniquely (so a left join cannot fan out)?"""
    return dim.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys")) \
        .withColumn("unique", F.col("n_rows") == F.col("n_keys"))
