"""Profiling, windows, sorts, sets, scalar functions and sampling (G15-G33, W, K, U, F, Y1-Y5)."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.functions import vectors as V
from quarry.functions.predicates import fingerprint, persona, pct
from quarry.operators import aggregate as G
from quarry.operators import sampling as Y
from quarry.operators.membership import intersect_filtered
from quarry.operators import windows as W
from quarry.plans import standins as S
from quarry.session import cut_lineage
from quarry.sources.io import NUMBER
from quarry.plans.registry import register, with_
from quarry.plans.trip_queries import BASE, CLEAN6_SQL, cleaned

CN_SQL = """cn AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment, n_name, n_regionkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
REAL_SQL = "real AS (SELECT * FROM cn WHERE n_regionkey IN (0, 1))"
SYNTH_SQL = "synth AS (SELECT * FROM cn WHERE n_regionkey IN (2, 3, 4))"
RS = (CN_SQL, REAL_SQL, SYNTH_SQL)


def cn(spark, d):
    c, n = S.table(spark, d, "customer"), S.table(spark, d, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment", "n_name", "n_regionkey")


def real(spark, d):
    return cn(spark, d).where(F.col("n_regionkey").isin(0, 1))


def synth(spark, d):
    return cn(spark, d).where(F.col("n_regionkey").isin(2, 3, 4))


# ---------------------------------------------------------------- G15-G33

@register("G15_summary_long", with_(*BASE, CLEAN6_SQL) + """
SELECT column_name, statistic, round(value, 6) AS value FROM (
  SELECT 'total_amount' AS column_name, unnest(['count', 'mean', 'stddev', 'min', '25%', '50%', '75%', 'max']) AS statistic,
         unnest([count(total_amount)::DOUBLE, avg(total_amount), stddev_samp(total_amount), min(total_amount),
                 quantile_disc(total_amount, 0.25), quantile_disc(total_amount, 0.5), quantile_disc(total_amount, 0.75),
                 max(total_amount)]) AS value FROM clean
  UNION ALL
  SELECT 'trip_distance', unnest(['count', 'mean', 'stddev', 'min', '25%', '50%', '75%', 'max']),
         unnest([count(trip_distance)::DOUBLE, avg(trip_distance), stddev_samp(trip_distance), min(trip_distance),
                 quantile_disc(trip_distance, 0.25), quantile_disc(trip_distance, 0.5), quantile_disc(trip_distance, 0.75),
                 max(trip_distance)]) FROM clean)""")
def g15(spark, d):
    r = G.describe_long(cleaned(spark, d), ["total_amount", "trip_distance"], exact=True)
    return r.select("column_name", "statistic", F.round("value", 6).alias("value"))


@register("G16_describe_numeric_exact", with_(*RS) + """
SELECT column_name, statistic, round(value, 6) AS value FROM (
  SELECT 'c_acctbal' AS column_name, unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']) AS statistic,
         unnest([count(c_acctbal)::DOUBLE, avg(c_acctbal), stddev_samp(c_acctbal), min(c_acctbal),
                 quantile_cont(c_acctbal, 0.25), quantile_cont(c_acctbal, 0.5), quantile_cont(c_acctbal, 0.75),
                 max(c_acctbal)]) AS value FROM real
  UNION ALL
  SELECT 'c_custkey', unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']),
         unnest([count(c_custkey)::DOUBLE, avg(c_custkey), stddev_samp(c_custkey), min(c_custkey)::DOUBLE,
                 quantile_cont(c_custkey, 0.25), quantile_cont(c_custkey, 0.5), quantile_cont(c_custkey, 0.75),
                 max(c_custkey)::DOUBLE]) FROM real)""")
def g16(spark, d):
    return G.describe_numeric(real(spark, d), ["c_acctbal", "c_custkey"])


@register("G17_describe_categorical", with_(*RS) + """
SELECT column_name, CAST(sum(f) AS BIGINT) AS "count", CAST(count(*) AS BIGINT) AS "unique",
       arg_min(v, (-f, v)) AS top, CAST(max(f) AS BIGINT) AS freq FROM (
  SELECT 'c_mktsegment' AS column_name, c_mktsegment AS v, count(*) AS f FROM real GROUP BY c_mktsegment
  UNION ALL SELECT 'n_name', n_name, count(*) FROM real GROUP BY n_name) GROUP BY column_name""")
def g17(spark, d):
    return G.describe_categorical(real(spark, d), ["c_mktsegment", "n_name"])


@register("G18_value_counts_normalised", """
SELECT c_mktsegment, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM customer), 2) AS pct
FROM customer GROUP BY c_mktsegment""")
def g18(spark, d):
    return G.value_counts(S.table(spark, d, "customer"), "c_mktsegment")


@register("G19_G20_distinct_mean_median", with_(S.RATINGS_SQL) + """
SELECT count(DISTINCT "user") AS n_users, count(DISTINCT item) AS n_items,
       round(avg(rating), 6) AS mean_rating, CAST(median(rating) AS DOUBLE) AS median_rating FROM ratings""")
def g19(spark, d):
    r = S.ratings(spark, d)
    med = G.exact_quantiles(r, "rating", [0.5]).select("value")
    return r.agg(F.count_distinct("user").alias("n_users"), F.count_distinct("item").alias("n_items"),
                 F.round(F.avg("rating"), 6).alias("mean_rating")).withColumn("median_rating", med.scalar())


@register("G19_distinct_by_bitmaps", with_(S.RATINGS_SQL) + """
SELECT 'user' AS entity, rating, count(DISTINCT "user") AS n_distinct FROM ratings GROUP BY rating
UNION ALL SELECT 'user', NULL, count(DISTINCT "user") FROM ratings
UNION ALL SELECT 'item', rating, count(DISTINCT item) FROM ratings GROUP BY rating
UNION ALL SELECT 'item', NULL, count(DISTINCT item) FROM ratings""")
def g19_bitmaps(spark, d):
    """Distinct users and items a rating and over all: one table of bitmaps each, merged, rows read once."""
    r = S.ratings(spark, d)
    out = None
    for c in ("user", "item"):
        parts = cut_lineage(G.distinct_bitmaps(r.select(c, "rating"), c, ["rating"]))
        both = G.distinct_counts(parts, ["rating"]).unionByName(G.distinct_counts(parts), allowMissingColumns=True) \
            .select(F.lit(c).alias("entity"), "rating", "n_distinct")
        out = both if out is None else out.unionByName(both)
    return out


@register("G21_sparsity_by_bitmaps", with_(S.RATINGS_SQL) + """
SELECT count(*) AS n_interactions, count(DISTINCT "user") AS n_users, count(DISTINCT item) AS n_items,
       round((1.0 - count(*) / (count(DISTINCT "user")::DOUBLE * count(DISTINCT item))) * 100, 4) AS sparsity_pct
FROM ratings""")
def g21_bitmaps(spark, d):
    """G21 from stored day parts: bitmaps and row counts of each day are merged, rows are not read again."""
    return G.sparsity_from_parts(G.sparsity_parts(S.ratings(spark, d), ["ts"]))


@register("G21_sparsity", with_(S.RATINGS_SQL) + """
SELECT count(*) AS n_interactions, count(DISTINCT "user") AS n_users, count(DISTINCT item) AS n_items,
       round((1.0 - count(*) / (count(DISTINCT "user")::DOUBLE * count(DISTINCT item))) * 100, 4) AS sparsity_pct
FROM ratings""")
def g21(spark, d):
    return G.sparsity(S.ratings(spark, d))


@register("G22_dataset_summary", with_(S.RATINGS_SQL) + """
SELECT metric, round(value, 4) AS value FROM (
  SELECT unnest(['total_ratings', 'unique_users', 'unique_items', 'mean_rating', 'median_rating', 'sparsity_pct']) AS metric,
         unnest([count(*)::DOUBLE, count(DISTINCT "user")::DOUBLE, count(DISTINCT item)::DOUBLE, avg(rating),
                 median(rating)::DOUBLE,
                 (1.0 - count(*) / (count(DISTINCT "user")::DOUBLE * count(DISTINCT item))) * 100]) AS value
  FROM ratings)""")
def g22(spark, d):
    return G.dataset_summary(S.ratings(spark, d))


ACT_SQL = """SELECT round(avg(c), 4) AS mean, round(median(c)::DOUBLE, 4) AS median, CAST(min(c) AS BIGINT) AS "min",
       CAST(max(c) AS BIGINT) AS "max", round(stddev_samp(c), 4) AS std, count(*) AS n_entities
FROM (SELECT {k}, count(*) AS c FROM ratings GROUP BY {k})"""


@register("G23_activity_per_user", with_(S.RATINGS_SQL) + ACT_SQL.format(k='"user"'))
def g23u(spark, d):
    return G.activity_stats(S.ratings(spark, d), "user")


@register("G23_activity_per_item", with_(S.RATINGS_SQL) + ACT_SQL.format(k="item"))
def g23i(spark, d):
    return G.activity_stats(S.ratings(spark, d), "item")


@register("G24_K4_rating_distribution", with_(S.RATINGS_SQL) + """
SELECT rating, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM ratings), 2) AS pct
FROM ratings GROUP BY rating ORDER BY rating""")
def g24(spark, d):
    return G.rating_distribution(S.ratings(spark, d))


HIST_SQL = """h AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)"""


@register("G25_equi_width_histogram", with_(HIST_SQL) + """
SELECT CAST(b AS INTEGER) AS bin, round(lo + b * (hi - lo) / 15, 6) AS lo, round(lo + (b + 1) * (hi - lo) / 15, 6) AS hi,
       count(*) AS n
FROM (SELECT least(floor((c_acctbal - lo) / ((hi - lo) / 15)), 14) AS b, lo, hi FROM customer, h)
GROUP BY b, lo, hi""")
def g25(spark, d):
    return G.histogram(S.table(spark, d, "customer"), "c_acctbal", 15)


@register("G26_grouped_histogram", with_(HIST_SQL) + """
SELECT c_mktsegment, CAST(b AS INTEGER) AS bin, round(lo + b * (hi - lo) / 10, 6) AS lo,
       round(lo + (b + 1) * (hi - lo) / 10, 6) AS hi, count(*) AS n
FROM (SELECT c_mktsegment, least(floor((c_acctbal - lo) / ((hi - lo) / 10)), 9) AS b, lo, hi FROM customer, h)
GROUP BY c_mktsegment, b, lo, hi""")
def g26(spark, d):
    return G.grouped_histogram(S.table(spark, d, "customer"), "c_acctbal", "c_mktsegment", 10)


@register("G27_U2_category_counts_by_source", with_(*RS) + """
SELECT 'real' AS source, c_mktsegment AS category, count(*) AS n FROM real GROUP BY c_mktsegment
UNION ALL SELECT 'synth', c_mktsegment, count(*) FROM synth GROUP BY c_mktsegment""")
def g27(spark, d):
    return G.category_counts_by_source({"real": real(spark, d), "synth": synth(spark, d)}, "c_mktsegment")


@register("G28_J9_proportion_table", with_(*RS, """a AS (SELECT n_name AS category, count(*) / (SELECT count(*) FROM real) AS p FROM real GROUP BY n_name)""",
          """b AS (SELECT n_name AS category, count(*) / (SELECT count(*) FROM synth) AS p FROM synth GROUP BY n_name)""") + """
SELECT coalesce(a.category, b.category) AS category, coalesce(round(a.p, 6), 0.0) AS "real",
       coalesce(round(b.p, 6), 0.0) AS synth
FROM a FULL OUTER JOIN b ON a.category = b.category""")
def g28(spark, d):
    return G.proportion_table({"real": real(spark, d), "synth": synth(spark, d)}, "n_name")


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("G29_correlation_matrix", "SELECT col_a, col_b, round(r, 9) AS r FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM lineitem" for a in CORR_COLS for b in CORR_COLS) + ")")
def g29(spark, d):
    return G.corr_matrix(S.table(spark, d, "lineitem"), CORR_COLS)


@register("G30_kernel_density", with_(*RS, """st AS (SELECT count(*) AS n, stddev_samp(c_acctbal) AS sd,
  min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM real)""", """fr AS (SELECT c_acctbal AS v, count(*) AS c FROM real GROUP BY c_acctbal)""",
          """g AS (SELECT range AS gi FROM range(0, 200))""") + """
SELECT CAST(gi AS INTEGER) AS grid_index, round(lo + (hi - lo) * gi / 199, 9) AS x,
       round(sum(c * exp(-0.5 * ((lo + (hi - lo) * gi / 199 - v) / (sd * pow(n, -0.2))) ** 2))
             / (n * sd * pow(n, -0.2) * sqrt(2 * pi())), 12) AS density
FROM g, fr, st GROUP BY gi, lo, hi, n, sd""")
def g30(spark, d):
    return G.density(real(spark, d), "c_acctbal", 200)


@register("G31_collapse_duplicate_pairs", with_(S.RATINGS_SQL) + """
SELECT "user", item, CAST(sum(rating) AS BIGINT) AS rating FROM ratings GROUP BY "user", item""")
def g31(spark, d):
    r = G.collapse_pairs(S.ratings(spark, d), ["user", "item"], "rating")
    return r.withColumn("rating", F.col("rating").cast("bigint"))


LEN_SQL = """ln AS (SELECT doc_id, length(text) AS n_chars,
  len(list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda x: x <> '')) AS n_words FROM documents)"""


@register("G32_N2_length_stats", with_(LEN_SQL) + """
SELECT 'n_chars' AS measure, round(avg(n_chars), 4) AS mean, round(median(n_chars)::DOUBLE, 4) AS median,
       round(min(n_chars)::DOUBLE, 4) AS "min", round(max(n_chars)::DOUBLE, 4) AS "max", round(stddev_samp(n_chars), 4) AS std FROM ln
UNION ALL
SELECT 'n_words', round(avg(n_words), 4), round(median(n_words)::DOUBLE, 4), round(min(n_words)::DOUBLE, 4),
       round(max(n_words)::DOUBLE, 4), round(stddev_samp(n_words), 4) FROM ln""")
def g32(spark, d):
    docs = S.table(spark, d, "documents").select(X.char_length("text").alias("n_chars"),
                                                 X.word_count("text").alias("n_words"))
    return G.length_stats(docs, ["n_chars", "n_words"])


LABELLED_SQL = """lab AS (
SELECT d.doc_id, d.text, CAST(l.quality AS INTEGER) AS label,
       CASE WHEN CAST(('0x' || substr(md5('42-' || CAST(d.doc_id AS VARCHAR)), 1, 8)) AS UBIGINT) / 4294967296.0 < 0.2
            THEN 'test' ELSE 'train' END AS split
FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def labelled(spark, d):
    from quarry.sources.io import labelled_text
    return labelled_text(S.table(spark, d, "documents"), S.table(spark, d, "labels"))


@register("G33_positive_rate_per_split", with_(LABELLED_SQL) + """
SELECT split, count(*) AS n, round(avg(label::DOUBLE) * 100, 4) AS pct_positive FROM lab GROUP BY split""")
def g33(spark, d):
    return G.positive_rate(labelled(spark, d), "split", "label")


# ---------------------------------------------------------------- W, K, U

@register("W1_J10_dense_index", with_(S.RATINGS_SQL) + """
SELECT "user", row_number() OVER (ORDER BY "user") - 1 AS user_index FROM (SELECT DISTINCT "user" FROM ratings)""")
def w1(spark, d):
    return W.index_ids(S.ratings(spark, d), "user", "user_index")


@register("J10_index_lookup_join", with_(S.RATINGS_SQL, """ui AS (SELECT "user", row_number() OVER (ORDER BY "user") - 1 AS user_index FROM (SELECT DISTINCT "user" FROM ratings))""",
          """ii AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS item_index FROM (SELECT DISTINCT item FROM ratings))""") + """
SELECT ui.user_index, ii.item_index, CAST(sum(r.rating) AS BIGINT) AS rating
FROM ratings r JOIN ui ON r."user" = ui."user" JOIN ii ON r.item = ii.item GROUP BY ui.user_index, ii.item_index""")
def j10(spark, d):
    r = S.ratings(spark, d)
    ui = W.index_ids(r, "user", "user_index")
    ii = W.index_ids(r, "item", "item_index")
    j = r.join(ui, "user").join(ii, "item")
    return j.groupBy("user_index", "item_index").agg(F.sum("rating").cast("bigint").alias("rating"))


@register("W2_W3_top3_items_per_user", with_(S.RATINGS_SQL) + """
SELECT "user", item, rating, CAST("rank" AS INTEGER) AS "rank" FROM (
  SELECT "user", item, rating, row_number() OVER (PARTITION BY "user" ORDER BY rating DESC, item) AS "rank"
  FROM (SELECT "user", item, CAST(sum(rating) AS BIGINT) AS rating FROM ratings GROUP BY "user", item))
WHERE "rank" <= 3""")
def w23(spark, d):
    r = G.collapse_pairs(S.ratings(spark, d), ["user", "item"], "rating").withColumn("rating", F.col("rating").cast("bigint"))
    return W.top_n_per_group(r, ["user"], [F.desc("rating"), F.col("item")], 3).withColumn("rank", F.col("rank").cast("int"))


@register("W4_empirical_cdf", with_(*RS) + """
SELECT value, n, cum_n, round(cum_n / (SELECT count(*) FROM real), 9) AS cdf FROM (
  SELECT c_acctbal AS value, count(*) AS n, CAST(sum(count(*)) OVER (ORDER BY c_acctbal) AS BIGINT) AS cum_n
  FROM real GROUP BY c_acctbal)""")
def w4(spark, d):
    e = W.ecdf(real(spark, d), "c_acctbal")
    return e.select("value", "n", F.col("cum_n").cast("bigint"), F.round("cdf", 9).alias("cdf"))


@register("W5_percent_of_total_per_group", """
SELECT c_nationkey, c_mktsegment, count(*) AS n,
       round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY c_nationkey), 2) AS pct
FROM customer GROUP BY c_nationkey, c_mktsegment""")
def w5(spark, d):
    g = S.table(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return W.share_of_total(g, "n", "pct", 2, ["c_nationkey"])


@register("K2_sort_by_aggregate", with_(*BASE, CLEAN6_SQL) + """
SELECT PU_Borough, count(*) AS trips, round(avg(total_amount), 4) AS avg_fare FROM clean GROUP BY PU_Borough ORDER BY avg_fare DESC""")
def k2(spark, d):
    return (cleaned(spark, d).groupBy("PU_Borough")
            .agg(F.count(F.lit(1)).alias("trips"), F.round(F.avg("total_amount"), 4).alias("avg_fare"))
            .orderBy(F.desc("avg_fare")))


@register("K3_top20_items_by_frequency", with_(S.RATINGS_SQL) + """
SELECT item, count(*) AS n FROM ratings GROUP BY item ORDER BY n DESC, item LIMIT 20""")
def k3(spark, d):
    g = S.ratings(spark, d).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return G.top_k(g, [F.desc("n"), "item"], 20)


@register("K5_head_with_order_key", with_(S.TRIPS_SQL) + """
SELECT trip_id, total_amount, trip_distance FROM trips ORDER BY trip_id LIMIT 5""")
def k5(spark, d):
    return G.top_k(S.trips(spark, d).select("trip_id", "total_amount", "trip_distance"), [F.col("trip_id")], 5)


@register("K6_arg_max_row", """
SELECT c_nationkey, round(avg(c_acctbal), 4) AS avg_acctbal FROM customer GROUP BY c_nationkey
ORDER BY avg(c_acctbal) DESC, c_nationkey LIMIT 1""")
def k6(spark, d):
    g = S.table(spark, d, "customer").groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("_a"))
    return G.arg_max_row(g, "_a", "c_nationkey").select("c_nationkey", F.round("_a", 4).alias("avg_acctbal"))


@register("U1_union_all", with_(*RS) + "SELECT c_custkey, c_acctbal FROM real UNION ALL SELECT c_custkey, c_acctbal FROM synth")
def u1(spark, d):
    return real(spark, d).select("c_custkey", "c_acctbal").unionByName(synth(spark, d).select("c_custkey", "c_acctbal"))


@register("U2_union_tagged", with_(*RS) + """
SELECT c_custkey, n_name, 'real' AS source FROM real UNION ALL SELECT c_custkey, n_name, 'synth' FROM synth""")
def u2(spark, d):
    return G.union_tagged({"real": real(spark, d).select("c_custkey", "n_name"),
                           "synth": synth(spark, d).select("c_custkey", "n_name")})


@register("U3_set_union_of_keys", with_(*RS) + """
SELECT c_mktsegment AS category FROM real UNION SELECT c_mktsegment FROM synth""")
def u3(spark, d):
    return real(spark, d).select(F.col("c_mktsegment").alias("category")).union(
        synth(spark, d).select("c_mktsegment")).distinct()


@register("U4_intersect", """
SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'""")
def u4(spark, d):
    o = S.table(spark, d, "orders")
    return o.where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey").intersect(
        o.where(F.col("o_orderpriority") == "5-LOW").select("o_custkey"))


@register("U4_intersect_behind_bloom_filter", """
SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'""")
def u4b(spark, d):
    li = S.table(spark, d, "lineitem")
    side = lambda f: li.where(F.col("l_returnflag") == f).select("l_partkey", "l_suppkey")
    return intersect_filtered(side("R"), side("A"))


@register("U5_distinct", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def u5(spark, d):
    return S.table(spark, d, "orders").select("o_orderpriority", "o_orderstatus").distinct()


# ---------------------------------------------------------------- F: scalar functions

@register("F1_F2_F3_text_basics", with_(LEN_SQL) + """
SELECT d.doc_id, md5(lower(trim(d.text))) AS lower_trim_md5, ln.n_chars, ln.n_words
FROM documents d JOIN ln ON d.doc_id = ln.doc_id""")
def f123(spark, d):
    docs = S.table(spark, d, "documents")
    return docs.select("doc_id", F.md5(F.lower(F.trim("text"))).alias("lower_trim_md5"),
                       X.char_length("text").alias("n_chars"), X.word_count("text").alias("n_words"))


CLEAN_TEXT_SQL = r"""trim(regexp_replace(regexp_replace(translate(regexp_replace(regexp_replace(lower(text),
    'http\S+|www\S+', '', 'g'), '@[\p{L}\p{N}_]+|#[\p{L}\p{N}_]+', '', 'g'),
    '!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~', ''), '\d+', '', 'g'), '\s+', ' ', 'g'))"""


@register("F4_F9_N1_clean_text", f"""
SELECT doc_id, md5(ct) AS clean_md5, length(ct) AS clean_chars,
       CASE WHEN length(ct) > 300 THEN substr(ct, 1, 300) || '...' ELSE ct END AS preview
FROM (SELECT doc_id, {CLEAN_TEXT_SQL} AS ct FROM documents)""")
def f4(spark, d):
    t = S.table(spark, d, "documents").select("doc_id", X.clean_text("text").alias("ct"))
    return t.select("doc_id", F.md5("ct").alias("clean_md5"), X.char_length("ct").alias("clean_chars"),
                    X.preview("ct", 300).alias("preview"))


@register("F10_F20_split_prefix_contains_cast", with_(*BASE, S.LINES_SQL) + """
SELECT value, split_part(value, ',', 1) AS first_field, starts_with(value, 'ASIA') AS starts_asia,
       contains(value, '.') AS has_dot, TRY_CAST(split_part(value, ',', 2) AS DOUBLE) AS amount
FROM lines""")
def f10(spark, d):
    ln = S.lines(spark, d)
    return ln.select("value", X.field("value", ",", 0).alias("first_field"),
                     F.col("value").startswith("ASIA").alias("starts_asia"),
                     F.col("value").contains(".").alias("has_dot"),
                     F.when(X.field("value", ",", 1).rlike(NUMBER), X.field("value", ",", 1).try_cast("double")).alias("amount"))


@register("F14_vector_slice_argmax_size", """
SELECT vec_id, list_transform(embedding[1:3], lambda x: CAST(x AS DOUBLE)) AS head3,
       CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS argmax, CAST(len(embedding) AS INTEGER) AS dim
FROM embeddings""")
def f14(spark, d):
    e = S.table(spark, d, "embeddings")
    return e.select("vec_id", F.transform(V.vec_slice("embedding", 0, 3), lambda x: x.cast("double")).alias("head3"),
                    V.argmax("embedding").alias("argmax"), F.size("embedding").alias("dim"))


ANCHOR_SQL = """anc AS (SELECT label, embedding AS a FROM embeddings
  WHERE vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label))"""


@register("F15_dot_and_cosine", with_(ANCHOR_SQL) + """
SELECT e.vec_id, round(list_dot_product(e.embedding::DOUBLE[], anc.a::DOUBLE[]), 6) AS dot,
       round(list_cosine_similarity(e.embedding::DOUBLE[], anc.a::DOUBLE[]), 6) AS cosine
FROM embeddings e JOIN anc ON e.label = anc.label""")
def f15(spark, d):
    e = S.table(spark, d, "embeddings")
    first = e.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
    anc = e.join(first, ["label", "vec_id"], "left_semi").select("label", F.col("embedding").alias("a"))
    j = e.join(anc, "label")
    return j.select("vec_id", F.round(V.dot("embedding", "a"), 6).alias("dot"),
                    F.round(V.cosine("embedding", "a"), 6).alias("cosine"))


@register("F16_abs_round_cast", """
SELECT c_custkey, abs(c_acctbal) AS abs_bal, round_even(c_acctbal, 0) AS bround_bal,
       CAST(trunc(c_acctbal) AS INTEGER) AS int_bal FROM customer""")
def f16(spark, d):
    c = S.table(spark, d, "customer")
    return c.select("c_custkey", F.abs("c_acctbal").alias("abs_bal"), F.bround("c_acctbal", 0).alias("bround_bal"),
                    F.col("c_acctbal").cast("int").alias("int_bal"))


@register("F17_percent_with_zero_guard", """
SELECT c_nationkey, CASE WHEN count(*) FILTER (WHERE c_acctbal > 9900) = 0 THEN NULL
  ELSE round(count(*) FILTER (WHERE c_acctbal < 0) * 100.0 / count(*) FILTER (WHERE c_acctbal > 9900), 4) END AS neg_per_rich_pct
FROM customer GROUP BY c_nationkey""")
def f17(spark, d):
    c = S.table(spark, d, "customer")
    g = c.groupBy("c_nationkey").agg(F.count_if(F.col("c_acctbal") < 0).alias("neg"),
                                     F.count_if(F.col("c_acctbal") > 9900).alias("rich"))
    return g.select("c_nationkey", pct("neg", "rich", 4).alias("neg_per_rich_pct"))


@register("F18_sha256_row_fingerprint", """
SELECT c_custkey, sha256(concat_ws(chr(31), coalesce('=' || lower(trim(c_name)), '-'), coalesce('=' || c_mktsegment, '-'), coalesce('=' || CAST(CAST(round_even(c_acctbal, 0) AS BIGINT) AS VARCHAR), '-'))) AS fp
FROM customer""")
def f18(spark, d):
    c = S.table(spark, d, "customer")
    return c.select("c_custkey", fingerprint(F.lower(F.trim("c_name")), "c_mktsegment",
                                             F.bround("c_acctbal", 0).cast("bigint")).alias("fp"))


@register("F19_M12_persona_rules", with_(*BASE, CLEAN6_SQL) + """
SELECT PULocationID, round(avg(trip_distance), 4) AS avg_distance, round(avg(total_amount), 4) AS avg_amount,
       CASE WHEN avg(trip_distance) < 5 AND avg(total_amount) < 15 THEN 'short-trip commuters'
            WHEN avg(trip_distance) > 15 AND avg(total_amount) > 50 THEN 'airport travelers'
            ELSE 'late-night riders' END AS persona
FROM clean GROUP BY PULocationID""")
def f19(spark, d):
    g = cleaned(spark, d).groupBy("PULocationID").agg(F.avg("trip_distance").alias("_d"), F.avg("total_amount").alias("_a"))
    return g.select("PULocationID", F.round("_d", 4).alias("avg_distance"), F.round("_a", 4).alias("avg_amount"),
                    persona("_d", "_a").alias("persona"))


# ---------------------------------------------------------------- Y1-Y5 sampling

@register("Y1_seeded_sample_n", """
SELECT doc_id, lang FROM documents ORDER BY md5('42-' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100""")
def y1(spark, d):
    return Y.sample_n(S.table(spark, d, "documents").select("doc_id", "lang"), "doc_id", 100, 42)


@register("Y2_n_per_class", """
SELECT doc_id, quality FROM (SELECT doc_id, quality,
  row_number() OVER (PARTITION BY quality ORDER BY md5('42-' || CAST(doc_id AS VARCHAR)), doc_id) AS rn FROM labels)
WHERE rn <= 5""")
def y2(spark, d):
    return Y.sample_per_class(S.table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "quality", 5)


@register("Y3_random_split_sizes", with_(S.RATINGS_SQL) + """
SELECT split, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM ratings), 2) AS pct FROM (
  SELECT CASE WHEN CAST(('0x' || substr(md5('42-' || CAST("user" AS VARCHAR) || ':' || CAST(item AS VARCHAR)), 1, 8)) AS UBIGINT) / 4294967296.0 < 0.8
              THEN 'train' ELSE 'test' END AS split FROM ratings) GROUP BY split""")
def y3(spark, d):
    r = S.ratings(spark, d).withColumn("pair_id", F.concat_ws(":", F.col("user").cast("string"), F.col("item").cast("string")))
    s = Y.split(r, "pair_id", 0.8, 42)
    return G.value_counts(s, "split")


@register("Y4_stratified_split", """
WITH k AS (SELECT doc_id, quality,
  row_number() OVER (PARTITION BY quality ORDER BY CAST(('0x' || substr(md5('42-' || CAST(doc_id AS VARCHAR)), 1, 15)) AS UBIGINT), doc_id) AS rk,
  count(*) OVER (PARTITION BY quality) AS nc FROM labels)
SELECT doc_id, quality, CASE WHEN rk <= floor(nc * 0.8 + 0.5) THEN 'train' ELSE 'test' END AS split FROM k""")
def y4(spark, d):
    return Y.split_stratified(S.table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "quality", 0.8)


BOOT_COLS = ["c_acctbal", "c_mktsegment", "n_name"]


def _boot_sql():
    parts = []
    for c in BOOT_COLS:
        parts.append(f"""b_{c} AS (SELECT i, v AS {c} FROM (
  SELECT range AS i, CAST(('0x' || substr(md5('42-{c}-' || CAST(range AS VARCHAR)), 1, 15)) AS UBIGINT) % (SELECT count({c}) FROM real) AS pos
  FROM range(0, (SELECT count(*) FROM real))) dr
  JOIN (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS p FROM real WHERE {c} IS NOT NULL) s ON s.p = dr.pos)""")
    return parts


@register("Y5_independent_column_bootstrap", with_(*RS, *_boot_sql()) + """
SELECT b_c_acctbal.i AS row_id, c_acctbal, c_mktsegment, n_name
FROM b_c_acctbal JOIN b_c_mktsegment USING (i) JOIN b_n_name USING (i)""")
def y5(spark, d):
    r = real(spark, d)
    n = r.count()
    return Y.bootstrap_columns(spark, r, BOOT_COLS, n, seed=42)


@register("N2_G26_length_by_class", with_(LABELLED_SQL, """ll AS (SELECT label, length(text) AS n_chars,
  len(list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda x: x <> '')) AS n_words FROM lab)""") + """
SELECT label, count(*) AS n, round(avg(n_chars), 4) AS mean_chars, round(avg(n_words), 4) AS mean_words,
       round(median(n_words)::DOUBLE, 4) AS median_words, min(n_words) AS min_words, max(n_words) AS max_words
FROM ll GROUP BY label""")
def n2(spark, d):
    lab = labelled(spark, d).select("label", X.char_length("text").alias("n_chars"), X.word_count("text").alias("n_words"))
    med = G.group_quantile(lab, "label", "n_words", 0.5).select("label", F.round("value", 4).alias("median_words"))
    g = lab.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 4).alias("mean_chars"),
        F.round(F.avg("n_words"), 4).alias("mean_words"),
        F.min("n_words").alias("min_words"), F.max("n_words").alias("max_words"))
    from quarry.operators.joins import join_null_safe
    return join_null_safe(g, med, ["label"], "left").select("label", "n", "mean_chars", "mean_words", "median_words", "min_words", "max_words")


@register("F12_epoch_seconds_to_timestamp", with_(S.RATINGS_SQL) + """
SELECT DISTINCT ts, to_timestamp(ts)::TIMESTAMP AS rated_at FROM ratings""")
def f12(spark, d):
    r = S.ratings(spark, d).select("ts").distinct()
    from quarry.functions.predicates import epoch_to_ntz
    return r.select("ts", epoch_to_ntz("ts").alias("rated_at"))


@register("J9_align_frequency_tables", with_(*RS) + """
SELECT coalesce(a.n_name, b.n_name) AS n_name, coalesce(a.n, 0) AS "real", coalesce(b.n, 0) AS synth
FROM (SELECT n_name, count(*) AS n FROM real GROUP BY n_name) a
FULL OUTER JOIN (SELECT n_name, count(*) AS n FROM synth GROUP BY n_name) b ON a.n_name = b.n_name""")
def j9(spark, d):
    from quarry.operators.joins import align_freq
    a = real(spark, d).groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))
    b = synth(spark, d).groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))
    return align_freq(a, b, "n_name", "n", "n", "real", "synth")
@register("S11_schema_listing", """
SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name AS "column",
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                      WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS "type", n AS n_values
FROM information_schema.columns JOIN (UNPIVOT (SELECT count(COLUMNS(*)) FROM orders) ON COLUMNS(*) INTO NAME name VALUE n) ON name = column_name
WHERE table_name = 'orders'""")
def s11b(spark, d):
    from quarry.sources.io import schema_table
    return schema_table(spark, S.table(spark, d, "orders"))
