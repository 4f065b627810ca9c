"""Fitted-model operators (rows-only checks): k-means segments, ALS,
random forest, grid search, pipeline persistence, detectability, TSTR,
copula sampling, streaming map-reduce."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import classify as C
from quarry.operators import copula as Y6
from quarry.operators import recommend as R
from quarry.operators import sampling as Y
from quarry.operators import segment as SG
from quarry.operators import textmining as N
from quarry.operators import utility as UT
from quarry.operators import neighbours as K
from quarry.operators.joins import score_pairs
from quarry.plans import standins as S
from quarry.plans.pattern_queries import seg_features
from quarry.plans.fitted import fitted
from quarry.plans.reco_queries import CHAIN_SQL, triples
from quarry.plans.registry import register
from quarry.plans.stats_queries import LABELLED_SQL, RS, labelled, real
from quarry.plans.synth_queries import sides
from quarry.plans.trip_queries import PARSE_SQL, _scratch
from quarry.plans.trip_queries import BASE as TBASE
from quarry.plans.registry import with_
from quarry.session import cut_lineage

ALS_RANK, ALS_ITERS = 50, 15


@register("M8_M9_M10_M11_kmeans_segments")
def m8(spark, d):
    f = seg_features(spark, d)
    pred, model = SG.segment(f, ["avg_trip_distance", "avg_total_amount"], "time_of_day", k=3, seed=42)
    sil = SG.silhouette(pred)
    return SG.cluster_centres(model, ["avg_trip_distance", "avg_total_amount"], "time_of_day", pred) \
        .withColumn("silhouette", F.lit(round(sil, 6)))


@register("T5_cluster_detectability")
def t5(spark, d):
    a, b = sides(spark, d)
    return UT.detectability(a, b, ["o_totalprice", "c_acctbal"])


@register("T6_train_synthetic_test_real")
def t6(spark, d):
    a, b = sides(spark, d)
    lab = lambda x: x.withColumn("label", (F.col("o_orderstatus") == "F").cast("double"))
    return UT.tstr(lab(a), lab(b), ["o_totalprice", "c_acctbal"], ["c_mktsegment"], "label")


def als_triples(spark, d):
    """The indexed positives, stored once for the models of every rank."""
    return fitted(spark, d, "als_triples", ("lineitem", "orders"), lambda: cut_lineage(triples(spark, d).select(
        F.col("user_index").cast("int").alias("user"), F.col("item_index").cast("int").alias("item"),
        F.col("rating").cast("float").alias("rating"), "split", F.col("user").alias("user_id"), F.col("item").alias("item_id"))))


def als_model(spark, d, rank=ALS_RANK):
    """Model on the train part of the indexed positives, and all of them; one fit for
    the queries that read it."""
    def fit():
        t = als_triples(spark, d)
        train = t.where("split = 'train'").select("user", "item", "rating")
        return R.fit_als(train, rank=rank, reg=0.01, iters=ALS_ITERS, alpha=1.0, seed=42), t
    return fitted(spark, d, ("als", rank), ("lineitem", "orders"), fit)


def with_ids(recs, t):
    """Matrix indices back to the users' and items' own ids."""
    u, i = t.select("user", "user_id").distinct(), t.select("item", "item_id").distinct()
    return recs.join(u, "user").join(i, "item").select(F.col("user_id").alias("user"), F.col("item_id").alias("item"), "score", "rank")


@register("R2_R7_implicit_als_report", with_(*CHAIN_SQL) + f"""
SELECT {ALS_RANK} AS rank, u AS n_user_factors, i AS n_item_factors, (u + i) * {ALS_RANK} AS total_parameters
FROM (SELECT count(DISTINCT "user") AS u, count(DISTINCT item) AS i FROM triples WHERE split = 'train')""")
def r2(spark, d):
    return R.als_report(als_model(spark, d)[0])


@register("R3_recommend_unseen_top5")
def r3(spark, d):
    m, r = als_model(spark, d)
    return with_ids(R.recommend(m, r, 5), r)


@register("R3_recommend_all_users_pruned_top5")
def r3_pruned(spark, d):
    """The same by the norm bound instead of ALS's blockwise product of all with all."""
    m, r = als_model(spark, d)
    return with_ids(K.recommend_pruned(m.userFactors, m.itemFactors, r, 5), r)


@register("R5_similar_users_bulk_top10")
def r5_bulk(spark, d):
    m, _ = als_model(spark, d)
    return K.similar_all(m.userFactors, 10)


@register("R3_recommend_for_users_top10")
def r3_users(spark, d):
    """Items for a stated list of users: all that have an interaction."""
    m, r = als_model(spark, d)
    users = r.select("user").distinct()
    return with_ids(R.recommend(m, r, 10, users=users), r)


@register("J11_score_user_item_pairs")
def j11(spark, d):
    m, r = als_model(spark, d)
    return score_pairs(r.select("user", "item"), m.userFactors, m.itemFactors)


@register("J11_score_pairs_fixed_vectors", """
SELECT e.vec_id AS "user", a.vec_id AS item, round(list_dot_product(e.embedding::DOUBLE[], a.embedding::DOUBLE[]), 6) AS score
FROM embeddings e JOIN (SELECT label, max(vec_id) AS vec_id FROM embeddings GROUP BY label) m ON e.label = m.label
JOIN embeddings a ON a.vec_id = m.vec_id""")
def j11_fixed(spark, d):
    """J11 on fixed factor vectors: each vector scored against its label's last vector."""
    e = S.table(spark, d, "embeddings")
    fac = e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
    last = e.groupBy("label").agg(F.max("vec_id").alias("item"))
    pairs = e.select(F.col("vec_id").alias("user"), "label").join(last, "label").select("user", "item")
    return score_pairs(pairs, fac, fac).select("user", "item", F.round("score", 6).alias("score"))


@register("R8_parameter_comparison")
def r8(spark, d):
    m1, r = als_model(spark, d, ALS_RANK)
    m2, _ = als_model(spark, d, 2 * ALS_RANK)
    # users similar to the 100 with most interactions: a stated query set
    q = r.where("split = 'train'").groupBy("user").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "user").limit(100)
    a = R.similar(m1.userFactors, q.select(F.col("user").alias("id")), 5) \
        .groupBy("query").agg(F.collect_set("neighbour").alias("a"))
    b = R.similar(m2.userFactors, q.select(F.col("user").alias("id")), 5) \
        .groupBy("query").agg(F.collect_set("neighbour").alias("b"))
    return a.join(b, "query").select("query", F.size(F.array_intersect("a", "b")).alias("overlap_top5"))


def _split(spark, d):
    lab = labelled(spark, d)
    return lab.where(F.col("split") == "train"), lab.where(F.col("split") == "test")


@register("N8_random_forest_report")
def n8(spark, d):
    train, test = _split(spark, d)
    model = C.fit_forest(train)
    pred = model.transform(N.with_terms(test, "text"))
    return N.classification_report(pred.withColumn("prediction", F.col("prediction").cast("int")))


@register("N9_grid_search_cv")
def n9(spark, d):
    train, _ = _split(spark, d)
    # every setting of the reference's grid that Spark's forest can express (depth 30 at most)
    cv = C.tune_forest(train, {"numTrees": [100, 200], "maxDepth": [20, 30], "minInstancesPerNode": [1, 2],
                               "featureSubsetStrategy": ["sqrt", "log2"]}, folds=3)
    best = cv.bestModel
    return spark.range(1).select(F.lit(best.getNumTrees).alias("num_trees"),
                                 F.lit(best.getOrDefault("maxDepth")).alias("max_depth"),
                                 F.lit(round(max(cv.avgMetrics), 6)).alias("best_f1"))


@register("N15_save_load_fitted_model", with_(LABELLED_SQL) + "SELECT count(*) AS n, count(*) AS n_same FROM lab WHERE split = 'test'")
def n15(spark, d):
    train, test = _split(spark, d)
    model = C.fit_forest(train)
    p = _scratch(spark, "rf_model")
    C.save_model(model, p)
    loaded = C.load_model(p)
    t = N.with_terms(test, "text")
    a = model.transform(t).select("doc_id", F.col("prediction").alias("a"))
    b = loaded.transform(t).select("doc_id", F.col("prediction").alias("b"))
    return a.join(b, "doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") == F.col("b")).alias("n_same"))


@register("Y6_gaussian_copula_sample")
def y6(spark, d):
    r = real(spark, d)
    model = Y6.fit_copula(r, ["c_acctbal", "c_mktsegment", "n_name"])
    n = r.count()
    return Y6.sample_copula(spark, model, n, seed=42)


@register("Y7_fresh_ids")
def y7(spark, d):
    return Y.fresh_ids(real(spark, d).select("c_custkey", "c_acctbal"), "c_custkey")


@register("Y7_fresh_ids_are_unique", with_(*RS) + """
SELECT count(*) AS n, count(*) AS n_ids, round(sum(c_acctbal), 2) AS total FROM real""")
def y7_unique(spark, d):
    ids = Y.fresh_ids(real(spark, d).select("c_custkey", "c_acctbal"), "c_custkey")
    return ids.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c_custkey").alias("n_ids"), F.round(F.sum("c_acctbal"), 2).alias("total"))


@register("G7_streaming_map_reduce", with_(*TBASE, S.LINES_SQL, PARSE_SQL) + """
SELECT "key", round(sum(value), 2) AS total_revenue, count(*) AS trip_count,
       round(avg(value), 4) AS avg_fare, min(value) AS min_fare, max(value) AS max_fare
FROM pairs GROUP BY "key" """)
def g7s(spark, d):
    from quarry.streaming import stream_reduce_pairs
    src, out, ck = _scratch(spark, "stream_src"), _scratch(spark, "stream_out"), _scratch(spark, "stream_ckpt")
    S.lines(spark, d).write.mode("overwrite").text(src)
    q = stream_reduce_pairs(spark, src, out, ck)
    q.awaitTermination()
    r = spark.read.parquet(out)
    return r.select("key", F.round("total_revenue", 2).alias("total_revenue"), "trip_count",
                    F.round("avg_fare", 4).alias("avg_fare"), "min_fare", "max_fare")
