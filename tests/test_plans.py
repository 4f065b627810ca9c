"""Physical-plan properties that matter at scale."""
from quarry.plans import standins as S
from quarry.plans import trip_queries as TQ
from quarry.operators import aggregate as G

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_pushes_filters_and_prunes_columns(spark):
    p = plan(TQ.revenue_by_zone(spark, SF))
    assert "PushedFilters" in p
    scan = [x for x in p.splitlines() if "FileScan parquet" in x and "l_extendedprice" in x]
    assert scan and all("l_discount" not in x and "ReadSchema" in x for x in scan)
    assert "TakeOrderedAndProject" in p


def test_cap_sweep_is_one_scan_no_shuffle_of_rows(spark):
    df = G.cap_impact(S.trips(spark, SF), "total_amount", TQ.CAPS)
    p = plan(df)
    assert p.count("FileScan parquet") == 1
    assert "struct<l_extendedprice:double,l_tax:double>" in p  # column pruning


def test_top_n_uses_partial_window_group_limit(spark):
    from pyspark.sql import functions as F
    from quarry.operators.windows import top_n_per_group
    r = S.ratings(spark, SF)
    df = top_n_per_group(r, ["user"], [F.desc("rating"), F.col("item")], 3)
    df._jdf.queryExecution().executedPlan()
    s = df._jdf.queryExecution().optimizedPlan().toString() + plan(df)
    assert "WindowGroupLimit" in s


def test_python_runs_in_the_batch_scorer_only(spark):
    import __spark_entry__ as E
    python = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups")
    for name in ["G4_revenue_by_zone_top10", "N3_terms_unigram_bigram_tf", "T3_kolmogorov_smirnov", "Q1_clean_audit_6_rules",
                 "G7_map_reduce_revenue", "W1_J10_dense_index", "R4_similar_items_cosine_top5", "J7_exclude_seen_popular_in_nation"]:
        p = plan(E.queries()[name](spark, SF))
        assert not any(x in p for x in python), name
    assert "MapInPandas" in plan(E.queries()["N14_batch_scoring_word_list"](spark, SF))


def test_recommendations_for_users_score_those_users_only(spark):
    from pyspark.sql import functions as F
    from quarry.operators import recommend as R
    r = spark.createDataFrame([(u, i, 1.0) for u in range(40) for i in range(12) if (u + i) % 3], "user int, item int, rating float")
    m = R.fit_als(r, rank=3, iters=2)
    got = R.recommend(m, r, 2, users=spark.createDataFrame([(7,)], "user int"))
    assert {x.user for x in got.select("user").collect()} == {7}
    assert got.where(F.col("rank") > 2).count() == 0


def test_flagship_broadcasts_the_dimension_not_the_facts(spark):
    df = TQ.revenue_by_zone(spark, SF)
    df.collect()
    p = plan(df)
    line = [x for x in p.splitlines() if "BroadcastHashJoin [PULocationID" in x]
    assert line and "BuildRight" in line[0]
