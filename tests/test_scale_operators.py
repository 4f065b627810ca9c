"""Operators for large inputs: bulk neighbours, pruned top-N, heavy join keys, bitmaps, Gauss transform, unmeasured sides."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import aggregate as G
from quarry.operators import joins as J
from quarry.operators import neighbours as K
from quarry.operators import recommend as R
from quarry.operators.windows import top_n_per_group
from quarry.operators import textmining as N
from quarry.operators import windows as W

SF = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], "id long, features array<double>")


def clustered(n, dim, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((20, dim))[rng.integers(0, 20, n)] + spread * rng.standard_normal((n, dim))


# --- R4 / R5 in bulk ---------------------------------------------------------------
@pytest.mark.parametrize("x", [clustered(600, 16, 1), np.random.default_rng(2).standard_normal((500, 32))], ids=["clustered", "random"])
def test_bulk_neighbours_reach_the_recall(spark, x):
    f = frame(spark, range(len(x)), x)
    got = K.recall(K.similar_all(f, 5, bucket_rows=64), R.similar(f, f, 5)).first()
    print("recall", got)
    assert got["n_exact"] == 5 * len(x) and got["recall"] >= 0.9


def test_bulk_neighbours_in_one_bucket_or_many_parts_are_exact(spark):
    x = clustered(300, 8, 3)
    f = frame(spark, range(300), x)
    want = rows(R.similar(f, f, 4).orderBy("query", "rank"))
    for size in (dict(part_rows=1000), dict(part_rows=37)):  # a hot bucket, dealt as pairs of parts
        assert rows(K.similar_all(f, 4, bits=1, tables=12, **size).orderBy("query", "rank"))[:len(want)] == want


def test_bulk_neighbours_of_odd_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (None, [1.0, 0.0]), (6, [1.0, None]),
                                (7, [float("nan"), 1.0]), (8, [1.0, 0.0, 0.0]), (3, [1.0, 0.0])], "id long, features array<double>")
    got = {(q, r): (o, s) for q, o, s, r in rows(K.similar_all(df, 2))}
    assert {q for q, _ in got} == {1, 2, 3, 8}
    assert got[3, 1] == (1, 1.0) and got[3, 2] == (2, 1.0) and got[8, 1] == (8, 1.0) and (8, 2) not in got  # ties to the smaller id
    assert rows(K.similar_all(df.limit(0), 2)) == []


def test_bulk_neighbours_read_the_table_once_for_all_queries(spark):
    f = spark.read.parquet(f"{SF}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
    plan = K.similar_all(f, 3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "FileScan" not in plan  # the checkpoint stands for the scan


# --- R3 by the norm bound -----------------------------------------------------------
def brute_top(users, items, seen, n):
    out = {}
    for u, x in users:
        s = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in items if (u, i) not in seen)[:n]
        out[u] = [i for _, i in s]
    return out


@pytest.mark.parametrize("size", [dict(), dict(block=4), dict(block=3, band_bytes=500), dict(block=2, band_bytes=1)])
def test_pruned_top_n_equals_brute_force(spark, size):
    rng = np.random.default_rng(4)
    u, i = rng.standard_normal((40, 6)), rng.standard_normal((70, 6)) * np.exp(rng.standard_normal((70, 1)))
    i[10:30] /= np.linalg.norm(i[10:30], axis=1, keepdims=True)  # equal norms fall into bounded bands, too
    seen = {(int(a), int(b)) for a, b in zip(rng.integers(0, 40, 300), rng.integers(0, 70, 300))}
    got = K.recommend_pruned(frame(spark, range(40), u), frame(spark, range(70), i), spark.createDataFrame(sorted(seen), "user long, item long"), 5, **size)
    by = {}
    for a, b, _, r in sorted(rows(got), key=lambda t: (t[0], t[3])):
        by.setdefault(a, []).append(b)
    assert by == brute_top(list(enumerate(u)), list(enumerate(i)), seen, 5)


def test_pruned_top_n_computes_few_scores_where_norms_differ(spark):
    rng = np.random.default_rng(5)
    u, i = rng.standard_normal((200, 8)), rng.standard_normal((2000, 8)) * (np.arange(1, 2001)[:, None] ** -1.0)
    count = spark.sparkContext.accumulator(0)
    got = K.recommend_pruned(frame(spark, range(200), u), frame(spark, range(2000), i), None, 3, block=50, stats=count)
    assert got.count() == 600 and count.value < 200 * 2000 / 4


def test_pruned_top_n_of_odd_rows(spark):
    u = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (None, [1.0, 1.0]), (3, [0.0, 0.0]), (4, [1.0])], "id long, features array<double>")
    i = spark.createDataFrame([(10, [1.0, 0.0]), (11, [1.0, 0.0]), (12, [5.0, None]), (None, [9.0, 9.0]), (13, [-1.0, 0.0])], "id long, features array<double>")
    seen = spark.createDataFrame([(1, 10), (1, 99), (None, 11), (1, None)], "user long, item long")
    assert sorted(rows(K.recommend_pruned(u, i, seen, 2))) == [(1, 11, 1.0, 1), (1, 13, -1.0, 2), (3, 10, 0.0, 1), (3, 11, 0.0, 2)]
    assert rows(K.recommend_pruned(u, i.limit(0), seen, 2)) == [] and rows(K.recommend_pruned(u.limit(0), i, None, 2)) == []


def test_pruned_top_n_equals_als_on_fitted_factors(spark):
    r = spark.createDataFrame([(u, i, 1.0 + (u * i) % 4) for u in range(40) for i in range(25) if (u * 7 + i * 3) % 5 < 2], "user int, item int, rating float")
    m = R.fit_als(r, rank=4, iters=3)
    want = {(a, d): round(c, 4) for a, _, c, d in rows(R.recommend(m, r, 3).select("user", "item", "score", "rank"))}
    assert {(a, d): round(c, 4) for a, _, c, d in rows(K.recommend_pruned(m.userFactors, m.itemFactors, r, 3))} == want


# --- joins with heavy keys -----------------------------------------------------------
def hot_rows(spark, n=20000):
    return spark.range(n).select("id", F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 11 == 1, F.lit(None)).otherwise(F.col("id") % 500).cast("long").alias("k"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_heavy_key_join_equals_the_plain_join(spark, how):
    df, dim = hot_rows(spark), spark.createDataFrame([(i, f"d{i}") for i in range(400)] + [(7, "again"), (None, "none")], "k long, name string")
    got = J.join_heavy(df, dim, "k", ["id"], how)
    assert got.columns == df.join(dim, "k", how).columns
    assert sorted(rows(got), key=repr) == sorted(rows(df.join(dim, "k", how)), key=repr)


def test_heavy_keys_are_found_and_dealt_evenly(spark):
    df = hot_rows(spark)
    assert J.heavy_keys(df, "k", 16) == {7: 9}  # half of all rows, a little more of those with a key
    dim = spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(keep, ("false", "-1", "16")):
            spark.conf.set(k, v)
        sizes = lambda d: sorted(r["count"] for r in d.groupBy(F.spark_partition_id()).count().collect())
        plain, dealt = sizes(df.join(dim, "k", "left")), sizes(J.join_heavy(df, dim, "k", ["id"], parts=64))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert plain[-1] > 5 * plain[len(plain) // 2]
    assert len(dealt) == 16 and dealt[-1] <= 2 * dealt[len(dealt) // 2]


def test_heavy_key_join_of_small_and_empty_tables(spark):
    df, dim = spark.createDataFrame([(1, 1), (2, None)], "id long, k long"), spark.createDataFrame([(1, "a")], "k long, _h string")
    assert sorted(rows(J.join_heavy(df, dim, "k", ["id"])), key=repr) == sorted(rows(df.join(dim, "k", "left")), key=repr)
    assert rows(J.join_heavy(df.limit(0), dim, "k", ["id"])) == []
    with pytest.raises(ValueError):
        J.join_heavy(df, dim, "k", ["id"], "full")


# --- distinct counts by bitmaps --------------------------------------------------------
def test_bitmaps_merge_to_exact_distinct_counts(spark):
    rng = random.Random(6)
    data = [(rng.randrange(5), rng.choice([None, 0, 32767, 32768, rng.randrange(200_000), rng.randrange(50)])) for _ in range(3000)]
    df = spark.createDataFrame(data, "day int, id long")
    parts = None
    for day in range(5):  # arriving one by one
        p = G.distinct_bitmaps(df.where(F.col("day") == day), "id", ["day"])
        parts = p if parts is None else parts.unionByName(p)
    want = {d: len({i for x, i in data if x == d and i is not None}) for d in range(5)}
    assert {r["day"]: r["n_distinct"] for r in G.distinct_counts(parts, ["day"]).collect()} == want
    assert G.distinct_counts(parts).first()[0] == len({i for _, i in data if i is not None})
    assert G.distinct_counts(parts.limit(0)).first()[0] == 0
    assert "Expand" not in G.distinct_counts(parts)._jdf.queryExecution().executedPlan().toString()


def test_sparsity_from_stored_parts(spark):
    r = spark.createDataFrame([(1, 10, 1), (1, 11, 1), (2, 10, 2), (2, None, 2), (None, 12, 3)], "user long, item long, day int")
    assert rows(G.sparsity_from_parts(G.sparsity_parts(r, ["day"]))) == rows(G.sparsity(r))


# --- density -----------------------------------------------------------------------
@pytest.mark.parametrize("values", [np.random.default_rng(7).standard_normal(500).tolist(), [0.0] * 300 + [1.0, 2.0, 1000.0], [float(i % 7) for i in range(200)]],
                         ids=["normal", "hot value and far tail", "ties"])
def test_density_equals_the_sum_of_kernels(spark, values):
    got = {r["grid_index"]: (r["x"], r["density"]) for r in G.density(spark.createDataFrame([(v,) for v in [*values, None]], "v double"), "v", 50).collect()}
    v = np.array(values)
    h = v.std(ddof=1) * len(v) ** -0.2
    for i in range(50):
        x = v.min() + (v.max() - v.min()) * i / 49
        want = np.exp(-0.5 * ((x - v) / h) ** 2).sum() / (len(v) * h * math.sqrt(2 * math.pi))
        assert abs(got[i][1] - want) <= 1e-11 * max(1.0, want) and abs(got[i][0] - x) < 1e-8


def test_density_groups_rows_by_cell_only(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("v"))
    plan = G.density(df, "v")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1  # the grid's neighbouring cells; rows reach their cell's aggregate unmultiplied
    assert all(r["density"] is None for r in G.density(df.select(F.lit(1.0).alias("v")), "v", 3).collect())


# --- ranks where the rows are --------------------------------------------------------------
@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_mid_ranks_equal_brute_force(spark, buckets):
    rng = random.Random(8)
    data = [(rng.choice([None, 5.0, 5.0, 5.0, rng.gauss(0, 3)]), rng.choice(["b", "b", None, f"k{rng.randrange(300)}"]), rng.randrange(4)) for _ in range(700)]
    df = spark.createDataFrame(data, "x double, s string, i int").repartition(5)

    def mid(values, v):
        own = [y for y in values if y is not None]
        return None if v is None else (sum(y < v for y in own) + sum(y == v for y in own) / 2) / len(own)
    xs, ss, js = zip(*data)
    want = sorted(((x, s, j, mid(xs, x), mid(ss, s), mid(js, j)) for x, s, j in data), key=repr)
    got = sorted(rows(W.mid_ranks(df, ["x", "s", "i"], buckets, sample=64).select("x", "s", "i", "_p_x", "_p_s", "_p_i")), key=repr)
    assert len(got) == len(want) and all(a[:3] == b[:3] and all((x is None) == (y is None) and (x is None or abs(x - y) < 1e-12) for x, y in zip(a[3:], b[3:]))
                                         for a, b in zip(got, want))
    assert rows(W.mid_ranks(df.limit(0), ["x", "s"])) == []


def test_a_value_of_half_the_rows_spreads_over_all_tasks(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 2 == 0, 1.0).otherwise(F.col("id").cast("double")).alias("x"))
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        r = W.mid_ranks(df, ["x"], 64)
        sizes = sorted(x["count"] for x in r.groupBy(F.spark_partition_id()).count().collect())
        plan = r._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
    assert "SortMergeJoin" not in plan


# --- sides are not run to be measured ------------------------------------------------------
NO_MEASURE = ["T4_total_variation_distance", "J7_exclude_seen_popular_in_nation", "W1_J10_dense_index", "T3_kolmogorov_smirnov", "Y4_stratified_split",
              "G8_Q9_group_profile_percentiles", "T10_quality_scores"]


@pytest.mark.parametrize("name", NO_MEASURE)
def test_only_stored_sides_are_measured(spark, name, monkeypatch):
    import __spark_entry__ as E
    from quarry.operators import windows
    real, seen = J.measured, []

    def checked(df):
        seen.append(J.is_stored(df))
        return real(df)
    monkeypatch.setattr(J, "measured", checked)
    monkeypatch.setattr(windows, "measured", checked)
    E.queries()[name](spark, "/root/testdata/sf0.001")
    assert all(seen)


def test_stored_sides_are_told_apart(spark):
    t = spark.read.parquet(f"{SF}/orders.parquet")
    assert J.is_stored(t.select("o_orderkey").where("o_orderkey > 3")) and J.is_stored(t.checkpoint())
    for d in (t.groupBy("o_custkey").count(), t.join(t.select("o_orderkey"), "o_orderkey"), t.distinct(), t.orderBy("o_orderkey")):
        assert not J.is_stored(d)


def test_class_weights_leave_rows_without_a_label_out_of_the_classes(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None), (4, 1)], "id int, label int")
    assert sorted(rows(N.class_weights(df, "label").select("id", "weight")), key=repr) == [(1, 1.5), (2, 0.75), (3, None), (4, 0.75)]


def test_exact_neighbours_are_scored_in_parts_of_bounded_size(spark):
    """Against the plain expression, with vectors of undefined cosine, repeated ids and copies."""
    rng = random.Random(5)
    vec = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(60)]
    data = [(i, vec[i % 50]) for i in range(120)] + [(7, vec[55]), (200, None), (201, [0.0] * 6), (202, [float("nan")] * 6), (203, [1.0, 2.0]), (None, vec[3])]
    f = spark.createDataFrame(data, "id long, features array<double>")
    q = f.where("id % 3 = 0 or id > 199 or id = 7")
    c = f.select("id", F.col("features").alias("held"))
    plain = top_n_per_group(R._similar_plain(c, c.join(q.select("id").distinct(), "id", "left_semi"), 5, 1024), ["query"], [F.desc("score"), F.col("neighbour")], 5) \
        .select("query", "neighbour", F.round("score", 6).alias("score"), F.col("rank").cast("int"))
    assert sorted(map(str, rows(R.similar(f, q, 5, block=16, part_rows=16)))) == sorted(map(str, rows(plain)))
    plan = R.similar(f.where("id < 100"), q, 5, block=16, part_rows=16)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan and "zip_with" not in plan


def test_recommendations_are_not_made_by_the_product_of_all_blocks(spark):
    r = spark.createDataFrame([(u, i, 1.0 + (u * i) % 3) for u in range(12) for i in range(30) if (u + i) % 4], "user int, item int, rating float")
    m = R.fit_als(r, rank=3, iters=2)
    got = R.recommend(m, r, 4)
    assert "FlatMap" not in got._jdf.queryExecution().optimizedPlan().toString() and [f.dataType.simpleString() for f in got.schema] == ["int", "int", "float", "int"]
    u, i = ({x["id"]: x["features"] for x in t.collect()} for t in (m.userFactors, m.itemFactors))
    had = {(x["user"], x["item"]) for x in r.collect()}
    for a in u:
        mine = sorted(x["score"] for x in got.where(F.col("user") == a).collect())
        want = sorted(sum(p * w for p, w in zip(u[a], i[b])) for b in i if (a, b) not in had)[-4:]
        assert mine == pytest.approx(want, abs=1e-5)


def test_seen_groups_equal_their_pairs(spark):
    rng = random.Random(8)
    u = spark.createDataFrame([(k, [rng.gauss(0, 1) for _ in range(4)], k % 3 if k % 5 else None) for k in range(40)], "id long, features array<double>, g long")
    i = spark.createDataFrame([(k, [rng.gauss(0, 1) for _ in range(4)], k % 3 if k % 7 else None) for k in range(90)], "id long, features array<double>, g long")
    seen = u.select(F.col("id").alias("user"), "g").join(i.select(F.col("id").alias("item"), "g"), "g").select("user", "item")
    assert sorted(rows(K.recommend_pruned(u, i, None, 5, group="g", block=8, band_bytes=1))) == sorted(rows(K.recommend_pruned(u, i, seen, 5)))


def test_bulk_neighbours_send_bounded_tables(spark):
    """Without structure, buckets of 256 rows would need hundreds of tables."""
    rng = random.Random(3)
    v = spark.createDataFrame([(k, [rng.gauss(0, 1) for _ in range(16)]) for k in range(3000)], "id long, v array<double>")
    assert K.plan_tables(v, 5, 600_000, 256)[1] > 100
    bits, tables = K.plan_tables(v, 5, 600_000)
    parts = -(-600_000 // 2 ** bits // 8192)
    assert tables * parts <= 100
    assert K.plan_tables(v, 5, 3000) == (0, 1)  # few rows: all pairs


def test_bulk_neighbours_of_repeated_rows_are_n_different_ids(spark):
    rng = random.Random(9)
    f = spark.createDataFrame([(k // 3, [rng.gauss(0, 1) for _ in range(4)] if k % 3 == 2 else [1.0, float(k // 3), 0.5, 2.0]) for k in range(90)], "id long, features array<double>")
    got = rows(K.similar_all(f, 5).groupBy("query").agg(F.count(F.lit(1)), F.count_distinct("neighbour")))
    assert sorted(got) == [(k, 5, 5) for k in range(30)]


def test_pruned_top_n_keeps_no_state_of_the_users_from_band_to_band(spark, monkeypatch):
    """A checkpoint of all users, their vectors and seen items a band filled the disks."""
    rng, kept = random.Random(10), []
    u, i = (spark.createDataFrame([(k, [rng.gauss(0, 1) for _ in range(4)]) for k in range(m)], "id int, features array<float>") for m in (30, 60))
    own = K.cut_lineage
    monkeypatch.setattr(K, "cut_lineage", lambda df: kept.append(set(df.columns)) or own(df))
    got = rows(K.recommend_pruned(u, i, None, 3, block=2, band_bytes=1))  # 30 bands
    assert len(kept) <= 1 and not any("user" in c for c in kept)
    v, w = ([np.array(x["features"], dtype=np.float64) for x in sorted(t.collect())] for t in (u, i))
    assert sorted((a, r, b) for a, b, _, r in got) == [(a, r + 1, b) for a in range(30) for r, b in enumerate(np.argsort(-np.array([v[a] @ x for x in w]), kind="stable")[:3])]


def test_shuffle_files_that_nothing_refers_to_go_while_a_model_is_fitted(spark):
    import gc
    import time
    sc = spark.sparkContext
    files = lambda: {f.getName() for f in sc._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        sc._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    before = files()
    sc.parallelize(range(1000), 4).map(lambda x: (x % 7, x)).groupByKey().count()
    own = files() - before
    gc.collect()
    with R._unused_files_removed(spark, 0.3):
        for _ in range(100):
            if not own & files():
                break
            time.sleep(0.3)
    assert own and not own & files()


def test_recommendations_for_a_list_of_users_serve_all_users(spark, tmp_path, monkeypatch):
    """The list held the 100 users with most interactions."""
    from quarry.plans import model_queries as M
    monkeypatch.setattr(M, "ALS_RANK", 4)
    monkeypatch.setattr(M.als_model, "__defaults__", (4,))
    monkeypatch.setattr(M, "ALS_ITERS", 1)
    pairs = [(u, i) for u in range(130) for i in range(30) if (u + i) % 3]
    spark.createDataFrame([(k, u, "1996-01-02") for k, (u, _) in enumerate(pairs)], "o_orderkey long, o_custkey long, o_orderdate string") \
        .withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, i, 40.0) for k, (_, i) in enumerate(pairs)], "l_orderkey long, l_partkey long, l_quantity double") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    got = rows(M.r3_users(spark, str(tmp_path)).groupBy("user").agg(F.max("rank"), F.count(F.lit(1))))
    assert sorted(got) == [(u, 10, 10) for u in range(130)]


def test_als_reads_its_ratings_from_stored_blocks(spark, monkeypatch):
    """Each half of an iteration sent all ratings row by row from a checkpoint to Python."""
    import glob
    from quarry.session import ensure_checkpoint_dir
    rng, plans, real = random.Random(12), [], R._stored_factors
    r = spark.createDataFrame([(rng.randrange(50), rng.randrange(40), 1.0 + k % 4) for k in range(900)], "user int, item int, rating float").groupBy("user", "item").agg(F.max("rating").alias("rating"))
    monkeypatch.setattr(R, "_stored_factors", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), real(df))[1])
    m = R.fit_als(r, rank=4, iters=3, n_blocks=2, block_ratings=100)
    monkeypatch.undo()
    assert len(plans) == 8 and all("Range (" in p and "LogicalRDD" not in p for p in plans[2:])
    assert m.userFactors.count() == 50 and {len(x["features"]) for x in m.itemFactors.collect()} == {4}
    assert not glob.glob(f"{ensure_checkpoint_dir(spark).replace('file:', '')}/quarry-ratings-*")


def test_bulk_neighbours_without_buckets_send_nothing_and_are_exact(spark):
    """Without structure, 123 tables of 900,000 rows were sent."""
    rng = random.Random(13)
    v = spark.createDataFrame([(k, [rng.gauss(0, 1) for _ in range(16)]) for k in range(3000)], "id long, v array<double>")
    for m in (100_000, 900_000, 5_400_000):
        bits, tables = K.plan_tables(v, 10, m)
        assert bits == 0 or tables * -(-m // 2 ** bits // 8192) <= 4
    vec = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(70)]
    data = [(f"{i % 110:03d}", vec[i % 70]) for i in range(140)] + [("900", [1e-200, 2e-200, 0.0, 0.0, 0.0, 0.0]), ("901", [1.0, 2.0])]
    for kind in ("array<double>", "array<float>"):
        f = spark.createDataFrame(data, "id string, features array<double>").withColumn("features", F.col("features").cast(kind))
        found = K.similar_all(f, 6, part_rows=16)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        unit = lambda x: np.array(x) / np.linalg.norm(np.array(x) / np.abs(x).max()) / np.abs(x).max()
        mine = [(i, unit(np.array(x, dtype=np.float32 if kind == "array<float>" else np.float64).astype(float))) for i, x in data if kind == "array<double>" or i != "900"]
        best = {}
        for a, x in mine:
            for b, y in mine:
                if len(x) == len(y):
                    best[a, b] = max(best.get((a, b), -2), round(float(x @ y), 12))
        want = [(a, b, round(s, 6), k + 1) for a in {a for a, _ in mine} for k, (b, s) in enumerate(sorted(((b, s) for (q, b), s in best.items() if q == a), key=lambda t: (-t[1], t[0]))[:6])]
        assert {(q, k): s for q, _, s, k in rows(found)} == pytest.approx({(q, k): s for q, _, s, k in want}, abs=2e-6)
        assert len({(q, b) for q, b, _, _ in rows(found)}) == len(want) and {(q, b) for q, b, _, _ in rows(found)} == {(q, b) for q, b, _, _ in want}


def test_few_queries_over_many_candidates_are_not_scored_by_expressions(spark):
    """100 queries over 900,000 factors took minutes, a lambda call a component."""
    rng = random.Random(14)
    vec = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(90)]
    data = [(i, vec[i % 80]) for i in range(150)] + [(7, vec[85]), (200, None), (201, [0.0] * 6), (202, [float("nan")] * 6), (203, [1.0, 2.0]), (None, vec[3])]
    f = spark.createDataFrame(data, "id long, features array<double>").repartition(3)
    q = f.where("id % 30 = 0 or id > 199 or id = 7")
    many = R.similar(f, q, 5, plain_pairs=100)
    assert sorted(map(str, rows(many))) == sorted(map(str, rows(R.similar(f, q, 5))))
    plan = R.similar(f.where("id < 150"), q.where("id < 150"), 5, plain_pairs=100)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "zip_with" not in plan and "FlatMapGroups" not in plan


def test_bulk_neighbours_of_many_equal_vectors(spark):
    """All of them tie: those of the smallest ids are the neighbours."""
    rng = random.Random(15)
    data = [((k * 7) % 330, [1.0, 2.0, 0.5] if k % 10 else [rng.gauss(0, 1) for _ in range(3)]) for k in range(330)] + [(7, [1.0, 2.0, 0.5])]
    got = rows(K.similar_all(spark.createDataFrame(data, "id long, v array<double>"), 4, vec_col="v", part_rows=100))
    equal = sorted({i for i, v in data if v == [1.0, 2.0, 0.5]})
    assert sorted(x for x in got if x[0] in set(equal) - {7}) == [(q, b, 1.0, k + 1) for q in equal if q != 7 for k, b in enumerate(equal[:4])]
    assert len(got) == 330 * 4
