"""Real-vs-synthetic evaluation.

Fixture: orders x customer x nation split into two natural populations,
regions 0-1 ("real") and regions 2-4 ("synthetic").  ``n_name`` takes
disjoint values on the two sides (TVD = 1 edge case).
"""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import aggregate as G
from quarry.operators import similarity as T
from quarry.operators.membership import row_overlap_filtered
from quarry.plans import standins as S
from quarry.plans.registry import register, with_

NUM = ["o_totalprice", "c_acctbal", "c_nationkey"]
CAT = ["o_orderpriority", "o_orderstatus", "c_mktsegment", "n_name"]
OVERLAP_COLS = ["o_orderpriority", "o_orderstatus", "c_mktsegment", "c_acctbal"]

OCN_SQL = """ocn AS (SELECT o_orderkey, o_totalprice, c_acctbal, c_nationkey, o_orderpriority, o_orderstatus, c_mktsegment,
  n_name, n_regionkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
SIDES = (OCN_SQL, "ra AS (SELECT * FROM ocn WHERE n_regionkey IN (0, 1))",
         "sy AS (SELECT * FROM ocn WHERE n_regionkey IN (2, 3, 4))")


def ocn(spark, d):
    o, c, n = S.table(spark, d, "orders"), S.table(spark, d, "customer"), S.table(spark, d, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.select("o_orderkey", "o_totalprice", "c_acctbal", "c_nationkey", "o_orderpriority",
                    "o_orderstatus", "c_mktsegment", "n_name", "n_regionkey")


def sides(spark, d):
    x = ocn(spark, d)
    return x.where(F.col("n_regionkey").isin(0, 1)), x.where(F.col("n_regionkey").isin(2, 3, 4))


def ks_sql(cols, digits=9, a="ra", b="sy"):
    lv = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value, 1 AS a, 0 AS b FROM {a} "
                            f"UNION ALL SELECT '{c}', CAST({c} AS DOUBLE), 0, 1 FROM {b}" for c in cols)
    return f"""(SELECT column_name, round(max(abs(ca / Na - cb / Nb)), {digits}) AS ks FROM (
  SELECT column_name, value, sum(na) OVER w AS ca, sum(nb) OVER w AS cb,
         sum(na) OVER (PARTITION BY column_name) AS Na, sum(nb) OVER (PARTITION BY column_name) AS Nb
  FROM (SELECT column_name, value, sum(a) AS na, sum(b) AS nb FROM ({lv}) WHERE value IS NOT NULL GROUP BY column_name, value)
  WINDOW w AS (PARTITION BY column_name ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  GROUP BY column_name)"""


def tvd_sql(cols, digits=9, a="ra", b="sy"):
    def side(src):
        u = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {src}" for c in cols)
        return f"""(SELECT column_name, value, count(*) / sum(count(*)) OVER (PARTITION BY column_name) AS p
  FROM ({u}) GROUP BY column_name, value)"""
    return f"""(SELECT column_name, round(0.5 * sum(abs(coalesce(pa.p, 0) - coalesce(pb.p, 0))), {digits}) AS tvd
  FROM {side(a)} pa FULL OUTER JOIN {side(b)} pb USING (column_name, value) GROUP BY column_name)"""


def gap_sql(cols, digits=9, a="ra", b="sy"):
    parts = []
    for i, x in enumerate(cols):
        for y in cols[i + 1:]:
            parts.append(f"SELECT '{x}' AS col_a, '{y}' AS col_b, (SELECT corr({x}, {y}) FROM {a}) AS r_a, "
                         f"(SELECT corr({x}, {y}) FROM {b}) AS r_b")
    inner = " UNION ALL ".join(parts)
    return f"""(SELECT col_a, col_b, round(r_a, {digits}) AS r_a, round(r_b, {digits}) AS r_b,
  round(abs(r_a - r_b), {digits}) AS gap FROM ({inner}))"""


@register("T1_describe_real_vs_synthetic", with_(*SIDES) + " UNION ALL ".join(
    f"""SELECT '{src}' AS source, column_name, statistic, round(value, 6) AS value FROM (
  SELECT '{c}' AS column_name, unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']) AS statistic,
         unnest([count({c})::DOUBLE, avg({c}), stddev_samp({c}), min({c})::DOUBLE, quantile_cont({c}, 0.25),
                 quantile_cont({c}, 0.5), quantile_cont({c}, 0.75), max({c})::DOUBLE]) AS value FROM {tab})"""
    for src, tab in (("real", "ra"), ("synthetic", "sy")) for c in NUM[:2]))
def t1(spark, d):
    a, b = sides(spark, d)
    return G.union_tagged({"real": G.describe_numeric(a, NUM[:2]), "synthetic": G.describe_numeric(b, NUM[:2])})


@register("T2_correlation_gap", with_(*SIDES) + "SELECT * FROM " + gap_sql(NUM))
def t2(spark, d):
    return T.corr_gap(*sides(spark, d), NUM)


@register("T2_mean_correlation_gap", with_(*SIDES) + f"""
SELECT round(avg(abs(r_a - r_b)), 9) AS mean_gap, count(*) AS n_pairs FROM ({gap_sql(NUM, 15)})""")
def t2b(spark, d):
    return T.mean_corr_gap(*sides(spark, d), NUM)


@register("T3_kolmogorov_smirnov", with_(*SIDES) + "SELECT * FROM " + ks_sql(NUM))
def t3(spark, d):
    return T.ks(*sides(spark, d), NUM)


@register("T4_total_variation_distance", with_(*SIDES) + "SELECT * FROM " + tvd_sql(CAT))
def t4(spark, d):
    return T.tvd(*sides(spark, d), CAT)


FP = ("sha256(concat_ws(chr(31), coalesce('=' || lower(trim(o_orderpriority)), '-'), coalesce('=' || lower(trim(o_orderstatus)), '-'), "
      "coalesce('=' || lower(trim(c_mktsegment)), '-'), coalesce('=' || CAST(CAST(round_even(c_acctbal, 0) AS BIGINT) AS VARCHAR), '-')))")


OVERLAP_SQL = with_(*SIDES, f"hr AS (SELECT DISTINCT {FP} AS h FROM ra)",
                    f"hs AS (SELECT DISTINCT {FP} AS h FROM sy)") + """
SELECT (SELECT count(*) FROM hr) AS n_real_distinct, count(*) AS n_overlap,
       round(count(*) * 100.0 / (SELECT count(*) FROM hr), 6) AS overlap_pct
FROM (SELECT h FROM hr INTERSECT SELECT h FROM hs)"""


@register("T7_T8_row_overlap", OVERLAP_SQL)
def t8(spark, d):
    a, b = sides(spark, d)
    return T.row_overlap(a, b, OVERLAP_COLS)


@register("T7_T8_row_overlap_behind_bloom_filter", OVERLAP_SQL)
def t8b(spark, d):
    a, b = sides(spark, d)
    return row_overlap_filtered(a, b, OVERLAP_COLS)


def diag_sql(num, cat, ids, a="ra", b="sy", digits=6):
    parts = [f"""SELECT 'data_validity' AS property, '{c}' AS column_name,
  (SELECT count(*) FILTER (WHERE {c} >= (SELECT min({c}) FROM {a}) AND {c} <= (SELECT max({c}) FROM {a})) / count(*)
   FROM {b} WHERE {c} IS NOT NULL) AS score""" for c in num]
    parts += [f"""SELECT 'data_validity', '{c}', (SELECT count(*) FILTER (WHERE {c} IN (SELECT {c} FROM {a})) / count(*)
   FROM {b} WHERE {c} IS NOT NULL)""" for c in cat]
    parts += [f"SELECT 'data_validity', '{c}', (SELECT count(DISTINCT {c}) / count(*) FROM {b})" for c in ids]
    parts.append("SELECT 'data_structure', '(table)', 1.0")
    return (f"(SELECT property, column_name, round(CAST(score AS DOUBLE), {digits}) AS score FROM ("
            + " UNION ALL ".join(parts) + "))")


@register("T9_diagnostic_scores", with_(*SIDES) + "SELECT * FROM " + diag_sql(NUM[:2], CAT, ["o_orderkey"]))
def t9(spark, d):
    a, b = sides(spark, d)
    return T.diagnostic(a, b, NUM[:2], CAT, ["o_orderkey"])


def pair_tvd_sql(x, y, a="ra", b="sy"):
    def side(src):
        return (f"(SELECT CAST({x} AS VARCHAR) AS vx, CAST({y} AS VARCHAR) AS vy, count(*) / (SELECT count(*) FROM {src}) AS p "
                f"FROM {src} GROUP BY vx, vy)")
    return (f"SELECT 0.5 * sum(abs(coalesce(pa.p, 0) - coalesce(pb.p, 0))) FROM {side(a)} pa FULL OUTER JOIN {side(b)} pb "
            f"USING (vx, vy)")


def quality_sql(num, cat, a="ra", b="sy", digits=6):
    parts = [f"SELECT 'column_shapes' AS property, column_name, 1 - ks AS score FROM {ks_sql(num, 15, a, b)}",
             f"SELECT 'column_shapes', column_name, 1 - tvd FROM {tvd_sql(cat, 15, a, b)}",
             f"SELECT 'column_pair_trends', col_a || '|' || col_b, 1 - gap / 2 FROM {gap_sql(num, 15, a, b)}"]
    for i, x in enumerate(cat):
        for y in cat[i + 1:]:
            parts.append(f"SELECT 'column_pair_trends', '{x}|{y}', 1 - ({pair_tvd_sql(x, y, a, b)})")
    for x in num:
        lo, hi = f"(SELECT min({x}) FROM {a})", f"(SELECT max({x}) FROM {a})"
        binned = f"CASE WHEN {x} < {lo} THEN 0 WHEN {x} >= {hi} THEN 11 ELSE floor(({x} - {lo}) / (({hi} - {lo}) / 10)) + 1 END"
        for y in cat:
            parts.append(f"SELECT 'column_pair_trends', '{x}|{y}', 1 - ({pair_tvd_sql(binned, y, a, b)})")
    # "+ 0.0" folds a negative zero from rounding into 0.0 (Spark's round never yields -0.0)
    return (f"(SELECT property, column_name, round(score, {digits}) + 0.0 AS score FROM ("
            + " UNION ALL ".join(parts) + "))")


@register("T10_quality_scores", with_(*SIDES) + "SELECT * FROM " + quality_sql(NUM, CAT))
def t10(spark, d):
    a, b = sides(spark, d)
    return T.quality(a, b, NUM, CAT)


@register("T11_report_rows", with_(*SIDES, "q AS (SELECT * FROM " + quality_sql(NUM, CAT) + ")") + """
SELECT property, column_name, score FROM q
UNION ALL SELECT property, '(average)', round(avg(score), 6) FROM q GROUP BY property""")
def t11(spark, d):
    a, b = sides(spark, d)
    return T.report_rows(T.quality(a, b, NUM, CAT))


def _eval_sql(name, b):
    q = quality_sql(NUM, CAT, "ra", b, 15)
    dg = diag_sql(NUM, CAT, [], "ra", b, 15)
    return (f"SELECT '{name}' AS model, round((SELECT avg(p) FROM (SELECT avg(score) AS p FROM {q} GROUP BY property)), 6) AS quality_score, "
            f"round((SELECT avg(p) FROM (SELECT avg(score) AS p FROM {dg} GROUP BY property)), 6) AS diagnostic_score")


@register("T12_side_by_side_evaluation", with_(*SIDES, "sy2 AS (SELECT * FROM sy WHERE n_regionkey = 2)")
          + _eval_sql("regions_2_4", "sy") + " UNION ALL " + _eval_sql("region_2", "sy2"))
def t12(spark, d):
    a, b = sides(spark, d)
    b2 = b.where(F.col("n_regionkey") == 2)
    return T.evaluate(a, {"regions_2_4": b, "region_2": b2}, NUM, CAT)
