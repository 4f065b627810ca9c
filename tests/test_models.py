"""Rows-only queries (fitted / random models): run them and check invariants."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q():
    return E.queries()


def test_kmeans_segments(spark, q):
    r = q["M8_M9_M10_M11_kmeans_segments"](spark, SF).collect()
    assert sorted(x.cluster for x in r) == [0, 1, 2]
    assert all(-1.0 <= x.silhouette <= 1.0 for x in r)
    assert all(x.typical_time_of_day in ("morning", "afternoon", "evening", "night") for x in r)


def test_detectability_and_tstr(spark, q):
    d = q["T5_cluster_detectability"](spark, SF).first().detectability_score
    assert -100.0 <= d <= 100.0
    a = q["T6_train_synthetic_test_real"](spark, SF).first().tstr_accuracy
    assert 0.0 <= a <= 1.0


def test_als_report_and_recommendations(spark, q):
    rep = q["R2_R7_implicit_als_report"](spark, SF).first()
    assert rep.rank == 50 and rep.total_parameters == (rep.n_user_factors + rep.n_item_factors) * 50
    rec = q["R3_recommend_unseen_top5"](spark, SF)
    per = rec.groupBy("user").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi"))
    assert per.where((F.col("n") != 5) | (F.col("lo") != 1) | (F.col("hi") != 5)).count() == 0
    from quarry.plans import standins as S
    seen = S.ratings(spark, SF).where("rating >= 4").select("user", "item")  # the positives are what a user has seen
    assert rec.join(seen.select("user").distinct(), "user", "left_anti").count() == 0
    assert rec.join(seen, ["user", "item"], "left_semi").count() == 0
    ov = [x.overlap_top5 for x in q["R8_parameter_comparison"](spark, SF).collect()]
    assert ov and all(0 <= o <= 5 for o in ov)


def test_forest_cv_and_persistence(spark, q):
    rep = {x.row: x for x in q["N8_random_forest_report"](spark, SF).collect()}
    assert set(rep) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert 0.0 <= rep["accuracy"].f1 <= 1.0
    best = q["N9_grid_search_cv"](spark, SF).first()
    assert best.num_trees in (100, 200) and best.max_depth in (20, 30)
    p = q["N15_save_load_fitted_model"](spark, SF).first()
    assert p.n > 0 and p.n == p.n_same


def test_copula_and_fresh_ids(spark, q):
    from quarry.plans.stats_queries import real
    r = real(spark, SF)
    s = q["Y6_gaussian_copula_sample"](spark, SF)
    assert s.count() == r.count()
    assert s.join(r.select("c_mktsegment").distinct(), "c_mktsegment", "left_anti").count() == 0
    ids = q["Y7_fresh_ids"](spark, SF)
    assert ids.select("c_custkey").distinct().count() == ids.count()


def test_observed_audit_does_not_break_later_model_training(spark, q):
    # Spark 4.1: a session that used an Observation cannot serialize ML
    # classification summaries; the observed job runs in a sibling session.
    audit = q["Q1_S5_clean_export_with_observed_audit"](spark, SF).collect()
    assert sum(r.removed for r in audit) > 0
    assert 0.0 <= q["T6_train_synthetic_test_real"](spark, SF).first().tstr_accuracy <= 1.0


def test_approximate_profile_is_ordered_and_in_range(spark, q):
    rows = q["G8_group_profile_approx"](spark, SF).collect()
    assert rows
    for r in rows:
        qs = [r.q1_value, r.median_value, r.q3_value, r.p90_value, r.p95_value, r.p99_value]
        assert r.min_value <= qs[0] and qs == sorted(qs) and qs[-1] <= r.max_value


def test_models_get_stored_rows_in_bounded_partitions(spark):
    from quarry.session import bounded_parts, cut_lineage
    d = cut_lineage(spark.range(1000).coalesce(2))
    got = bounded_parts(d, 100)
    assert got.rdd.getNumPartitions() == 10 and max(got.rdd.glom().map(len).collect()) < 200
    assert got.count() == 1000 and bounded_parts(d, 1000) is d


def test_forest_partitions_are_bounded_by_features(spark, monkeypatch):
    from quarry.operators import classify as C
    monkeypatch.setattr(C, "_FOREST_BYTES", 4 * 40)
    monkeypatch.setattr(C, "_TEXT_BYTES", 500)
    train = spark.createDataFrame([(f"word{i % 4} other{i % 3} all", i % 2) for i in range(200)], "text string, label int").coalesce(1)
    model, d = C._prep(train, "text", "label")
    most = 4 * 40 // (4 * len(model.stages[0].vocabulary))
    assert d.rdd.getNumPartitions() >= -(-200 // most) and d.count() == 200
    assert max(d.rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).collect()) <= 2 * most


def test_als_equals_sparks_and_writes_each_factor_once(spark, monkeypatch):
    import glob
    import os

    import numpy as np
    from pyspark.ml.recommendation import ALS
    from quarry.operators import recommend as R
    from quarry.session import ensure_checkpoint_dir
    rows = [(u, i, 1.0 + (u * i) % 4) for u in range(60) for i in range(45) if (u * 7 + i * 3) % 5 < 2 and (u % 3 or i % 9 == u % 9)]
    rows += [(u, 700 + u % 2, 5.0) for u in range(0, 60, 2)] + [(3, 12, 2.0)] * 2  # pairs may repeat
    size = lambda folder: sum(os.path.getsize(f) for f in glob.glob(f"{folder}/*.parquet"))
    for odd in ([], [(5, 11, 0.0), (6, 11, -2.0), (90, 5, -1.0), (91, 901, 0.0)]):  # no preference, and dislikes
        r = spark.createDataFrame(rows + odd, "user int, item int, rating float")
        als = ALS(implicitPrefs=True, rank=8, regParam=0.01, maxIter=2, alpha=1.0, seed=42, userCol="user", itemCol="item",
                  ratingCol="rating", numUserBlocks=3, numItemBlocks=3).fit(r)
        written, real = [], R._stored_factors
        monkeypatch.setattr(R, "_stored_factors", lambda df: (written.append(real(df)), written[-1])[1])
        root = ensure_checkpoint_dir(spark).replace("file:", "")
        before = set(glob.glob(f"{root}/quarry-factors-*"))
        m = R.fit_als(r, rank=8, iters=2, n_blocks=3, block_ratings=100)
        monkeypatch.undo()
        for got, want in ((m.userFactors, als.userFactors), (m.itemFactors, als.itemFactors)):
            got, want = ({x["id"]: np.array(x["features"]) for x in f.collect()} for f in (got, want))
            assert got.keys() == want.keys() and got[3].dtype == float
            assert max(np.abs(got[k] - want[k]).max() for k in want) < 1e-5
        assert len(written) == 2 + 2 * 2  # the first factors, then users and items once an iteration
        left = set(glob.glob(f"{root}/quarry-factors-*")) - before
        assert {os.path.basename(f) for f in left} == {os.path.basename(f) for f in written[-2:]}  # the last ones
        assert all(size(f) > 0 for f in left)


def test_grid_search_joins_the_partitions_of_large_inputs_only(spark, monkeypatch):
    """Every partition counts all nodes: five took 112 CPU seconds a forest, two 65."""
    from quarry.operators import classify as C
    rows = [(" ".join(f"w{(k * j) % 40}" for j in range(1, 9)), k % 2) for k in range(400)]
    df = spark.createDataFrame(rows, "text string, label int").repartition(8)
    monkeypatch.setattr(C.CrossValidator, "fit", lambda self, d: (d.count(), d.rdd.getNumPartitions()))
    small = C.tune_forest(df, {"numTrees": [2]})
    vocabulary = len(C._prep(df, "text", "label")[0].stages[0].vocabulary)
    monkeypatch.setattr(C, "_FOREST_BYTES", 4 * vocabulary * 40)
    monkeypatch.setattr(C, "_GRID_BYTES", 4 * vocabulary * 150)
    dealt = C._prep(df, "text", "label")[1].rdd.getNumPartitions()
    assert dealt >= 10 and C.tune_forest(df, {"numTrees": [2]}) == (400, 3) and small[0] == 400
