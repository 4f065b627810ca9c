"""Hand-made edge-case tables (FIXTURES.md section 3) and brute-force checks."""
import math
import random

import numpy as np
from pyspark.sql import functions as F

from quarry.functions import predicates as P
from quarry.functions import text as X
from quarry.operators import aggregate as G
from quarry.operators import patterns as M
from quarry.operators import quality as Q
from quarry.operators import recommend as R
from quarry.operators import sampling as Y
from quarry.operators import similarity as T
from quarry.operators import windows as W
from quarry.sources import io


def test_parse_pairs_malformed_lines(spark):
    lines = ["", "onlyone", "Queens,abc", "Queens,nan", "Queens,0", "Queens,-5", ",12.5",
             "borough,total_amount", "Bronx,3.5,extra", "  Manhattan,7.25  ", "EWR,inf", None]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = sorted((r.key, r.value) for r in io.parse_pairs(df).collect())
    assert got == sorted([("Unknown", 12.5), ("Bronx", 3.5), ("Manhattan", 7.25), ("EWR", math.inf)])
    kept_blank = io.parse_pairs(df, default_key=None, skip_prefixes=("borough",)).collect()
    assert ("", 12.5) in [(r.key, r.value) for r in kept_blank]


def test_rule_audit_counts_first_failing_rule(spark):
    rows = [(None, 1.0, 1.0, "Queens"), (0.0, 1.0, 1.0, "Queens"), (-1.0, 1.0, 1.0, "Queens"),
            (200.0, 1.0, 1.0, "Queens"), (200.01, 1.0, 1.0, "Queens"), (10.0, 0.0, 1.0, "Queens"),
            (10.0, 100.0, 1.0, "Queens"), (10.0, 100.01, 1.0, "Queens"), (10.0, 5.0, None, "Queens"),
            (10.0, 5.0, 0.0, "Queens"), (10.0, 5.0, 10.0, "Queens"), (10.0, 5.0, 1.0, None),
            (10.0, 5.0, 1.0, ""), (10.0, 5.0, 1.0, "N/A"), (10.0, 5.0, 1.0, "Unknown"), (10.0, 5.0, 1.0, "None"),
            (-3.0, -1.0, None, None)]
    df = spark.createDataFrame(rows, "total_amount double, trip_distance double, passenger_count double, PU_Borough string")
    rules = Q.trip_rules(passengers="passenger_count")
    audit = {r.rule: r.removed for r in Q.rule_audit(df, rules).collect()}
    assert audit == {"null_amount": 1, "non_positive_amount": 3, "extreme_amount": 1,
                     "non_positive_distance": 1, "extreme_distance": 1, "non_positive_passengers": 2,
                     "excess_passengers": 1, "missing_PU_Borough": 5, "kept": 2}
    assert sum(audit.values()) == len(rows)
    assert Q.clean(df, rules).count() == audit["kept"]


def test_bucket_edges_and_other(spark):
    vals = [0.0, 19.99, 20.0, 40.0, 60.0, 80.0, 100.0, 150.0, 199.99, 200.0, -1.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r.bucket: r.n for r in G.bucket_share(df, "x", [0, 20, 40, 60, 80, 100, 150, 200],
                                                 ["a", "b", "c", "d", "e", "f", "g"]).collect()}
    assert got == {"a": 2, "b": 1, "c": 1, "d": 1, "e": 1, "f": 1, "g": 2, "other": 2}


def test_time_buckets_both_schemes(spark):
    import datetime as dt
    hours = [4, 5, 6, 11, 12, 16, 17, 21, 22]
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h, 30),) for h in hours], "ts timestamp_ntz")
    a = [r[0] for r in df.select(P.time_bucket("ts", P.BASKET_HOURS)).collect()]
    b = [r[0] for r in df.select(P.time_bucket("ts", P.SEGMENT_HOURS)).collect()]
    assert a == ["night", "morning", "morning", "morning", "afternoon", "afternoon", "evening", "evening", "night"]
    assert b == ["night", "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", "night"]


def test_ks_and_tvd_limits(spark):
    a = spark.createDataFrame([(float(i), "x") for i in range(50)], "v double, c string")
    same = T.ks(a, a, ["v"]).first().ks
    b = spark.createDataFrame([(float(i + 1000), "y") for i in range(30)], "v double, c string")
    assert same == 0.0
    assert T.ks(a, b, ["v"]).first().ks == 1.0
    assert T.tvd(a, b, ["c"]).first().tvd == 1.0
    assert T.tvd(a, a, ["c"]).first().tvd == 0.0


def test_ks_matches_brute_force(spark):
    rnd = random.Random(7)
    xa = [round(rnd.gauss(0, 1), 2) for _ in range(400)]
    xb = [round(rnd.gauss(0.3, 1.2), 2) for _ in range(300)]
    a = spark.createDataFrame([(x,) for x in xa], "v double")
    b = spark.createDataFrame([(x,) for x in xb], "v double")
    grid = sorted(set(xa) | set(xb))
    brute = max(abs(sum(x <= g for x in xa) / len(xa) - sum(x <= g for x in xb) / len(xb)) for g in grid)
    assert abs(T.ks(a, b, ["v"], n_buckets=7).first().ks - brute) < 1e-9


def test_running_totals_and_dense_index(spark):
    rnd = random.Random(3)
    vals = rnd.sample(range(100000), 2000)
    df = spark.createDataFrame([(v, v % 3) for v in vals], "v long, g long")
    r = W.running_totals(df, "v", {"c": F.col("v")}, ["g"], n_buckets=9).collect()
    by = {}
    for g in range(3):
        s = 0
        for v in sorted(x for x in vals if x % 3 == g):
            s += v
            by[(g, v)] = s
    assert all(by[(x.g, x.v)] == x.c for x in r)
    idx = W.index_ids(df, "v", n_buckets=11).collect()
    assert sorted(x.v_index for x in idx) == list(range(len(vals)))
    assert all(x.v_index == sorted(vals).index(x.v) for x in idx[:50])


def test_running_totals_string_order(spark):
    words = ["pear", "apple", "fig", "kiwi", "banana", "cherry", "date", "grape"]
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "w string, n long")
    r = {x.w: x.c for x in W.running_totals(df, "w", {"c": F.col("n")}, n_buckets=3).collect()}
    s, want = 0, {}
    for w in sorted(words):
        s += words.index(w) + 1
        want[w] = s
    assert r == want


def test_order_stat_lookup_and_bootstrap(spark):
    vals = [5.0] * 40 + [1.0, 2.0, 3.0] + [9.0] * 7
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    draws = spark.createDataFrame([(i, i) for i in range(len(vals))], "i long, pos long")
    got = sorted((r.i, r.x) for r in Y.order_stat_lookup(df, "x", draws, n_buckets=3).collect())
    assert [x for _, x in got] == sorted(vals)
    boot = Y.bootstrap_columns(spark, df, ["x"], 200, seed=1)
    assert boot.count() == 200 and set(r.x for r in boot.collect()) <= set(vals)


def test_stratified_split_keeps_ratio(spark):
    rows = [(i, 1 if i < 300 else 0) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, y int")
    s = Y.split_stratified(df, "id", "y", 0.8, n_buckets=5)
    c = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert c == {(1, "train"): 240, (1, "test"): 60, (0, "train"): 80, (0, "test"): 20}


def test_baskets_repeated_and_null_items(spark):
    df = spark.createDataFrame([("a", "a", "night"), ("a", None, "day")], "p string, d string, t string")
    got = [sorted(r.items) for r in M.baskets(df, ["p", "d", "t"]).collect()]
    assert got == [["a", "night"], ["a", "day"]]


def test_text_cleaning_cases(spark):
    cases = ["Visit http://x.com now", "hi @bob #fun!", "Price 123 dollars", "   ", "", "Ünïcode Wörds_ok",
             "a" * 301]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r[0] for r in df.select(X.clean_text("t")).collect()]
    assert got[:6] == ["visit now", "hi", "price dollars", "", "", "ünïcode wördsok"]
    pv = df.select(X.preview("t", 300)).collect()[6][0]
    assert pv.endswith("...") and len(pv) == 303
    wc = [r[0] for r in df.select(X.word_count("t")).collect()]
    assert wc[:5] == [3, 3, 3, 0, 0]


def test_top_k_ties_are_deterministic(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 5), ("d", 1)], "k string, n long")
    assert [r.k for r in G.top_k(df, [F.desc("n"), "k"], 2).collect()] == ["a", "b"]


def test_similar_matches_numpy(spark):
    rnd = np.random.default_rng(0)
    vecs = rnd.normal(size=(60, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, features array<float>")
    q = spark.createDataFrame([(3,), (17,)], "id long")
    got = R.similar(df, q, 4).orderBy("query", "rank").collect()
    v = vecs.astype(np.float64)
    nrm = v / np.linalg.norm(v, axis=1, keepdims=True)
    for qi in (3, 17):
        sims = nrm @ nrm[qi]
        want = list(np.argsort(-sims, kind="stable")[:4])
        assert [r.neighbour for r in got if r.query == qi] == want
        assert [r.neighbour for r in got if r.query == qi][0] == qi


def test_validate_and_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (-2.0, None)], "x double, s string")
    v = {r.check_name: (r.violations, r.status, r.all_passed)
         for r in Q.validate(df, [("neg", F.col("x") < 0), ("null_s", F.col("s").isNull())]).collect()}
    assert v == {"neg": (1, "FAIL", False), "null_s": (1, "FAIL", False)}
    m = {r.column_name: r.n_missing for r in Q.missing(df).collect()}
    assert m == {"x": 1, "s": 1}


def test_copula_sample_keeps_marginal_support(spark):
    from quarry.operators import copula as Y6
    rnd = random.Random(5)
    rows = [(float(round(rnd.gauss(100, 15), 1)), rnd.choice(["a", "b", "c"])) for _ in range(300)]
    df = spark.createDataFrame(rows, "x double, c string")
    model = Y6.fit_copula(df, ["x", "c"], n_buckets=5)
    s = Y6.sample_copula(spark, model, 300, seed=1)
    got = s.collect()
    assert len(got) == 300 and len({r.row_id for r in got}) == 300
    assert {r.x for r in got} <= {r[0] for r in rows} and {r.c for r in got} <= {"a", "b", "c"}
    assert T.ks(df.select("x"), s.select("x"), ["x"]).first().ks < 0.2


def test_normal_cdf_and_probit(spark):
    from quarry.operators import copula as Y6
    df = spark.createDataFrame([(p,) for p in (0.001, 0.02, 0.3, 0.5, 0.9, 0.999)], "p double")
    r = df.select("p", Y6.probit(F.col("p")).alias("z")).select("p", "z", Y6.normal_cdf(F.col("z")).alias("back")).collect()
    for x in r:
        assert abs(x.back - x.p) < 1e-6
    assert abs([x.z for x in r if x.p == 0.5][0]) < 1e-12


def test_streaming_reduce_matches_batch(spark, tmp_path):
    from quarry.streaming import stream_reduce_pairs
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.txt").write_text("Queens,10\nQueens,5\nBronx,abc\n,7\nEWR,-1\n")
    q = stream_reduce_pairs(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    got = {r.key: (r.total_revenue, r.trip_count) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"Queens": (15.0, 2), "Unknown": (7.0, 1)}


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(11)
    xs = [rnd.choice([1.0, 2.0, 2.0, 3.5]) if i % 3 == 0 else round(rnd.uniform(-5, 5), 3) for i in range(333)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = {r.p: r.value for r in G.exact_quantiles(df, "x", [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]).collect()}
    for p, v in got.items():
        assert abs(v - float(np.percentile(xs, p * 100))) < 1e-9


def test_recommend_excludes_seen_and_returns_n(spark):
    rows = [(u, i, 1.0) for u in range(30) for i in range(40) if (u * 7 + i) % 3 == 0]
    rows += [(99, i, 1.0) for i in range(35)]  # a heavy user
    r = spark.createDataFrame(rows, "user int, item int, rating float")
    m = R.fit_als(r, rank=4, iters=3)
    rec = R.recommend(m, r, 3).collect()
    seen = {(u, i) for u, i, _ in rows}
    assert all((x.user, x.item) not in seen for x in rec)
    per = {}
    for x in rec:
        per.setdefault(x.user, []).append(x.item)
    assert all(len(v) == 3 for v in per.values()) and 99 in per
    some = R.recommend(m, r, 3, users=spark.createDataFrame([(99,), (3,), (12345,)], "user int")).collect()
    assert {x.user for x in some} == {3, 99} and {(x.user, x.item) for x in some} <= {(x.user, x.item) for x in rec}


def test_grouped_discrete_percentiles_match_brute_force(spark):
    rnd = random.Random(13)
    rows = [(k, float(rnd.randint(0, 40))) for k in ("a", "b", "c") for _ in range({"a": 97, "b": 10, "c": 3}[k])]
    rows += [("a", 7.0)] * 60  # a hot value inside one group
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in G.group_profile(df, "k", "v", exact=True).collect()}
    for k in ("a", "b", "c"):
        xs = sorted(v for kk, v in rows if kk == k)
        for name, p in G.PROFILE_PERCENTILES:
            assert got[k][f"{name}_value"] == xs[math.ceil(p * len(xs)) - 1]


def test_column_quantiles_one_scan_match_numpy(spark):
    rnd = random.Random(21)
    rows = [(float(rnd.randint(0, 9)), round(rnd.uniform(0, 1), 4)) for _ in range(101)]
    df = spark.createDataFrame(rows, "a double, b double")
    cont = {(r.column_name, r.p): r.value for r in G.column_quantiles(df, ["a", "b"], [0.1, 0.5, 0.9], True).collect()}
    disc = {(r.column_name, r.p): r.value for r in G.column_quantiles(df, ["a", "b"], [0.1, 0.5, 0.9], False).collect()}
    for i, c in enumerate(["a", "b"]):
        xs = sorted(r[i] for r in rows)
        for p in (0.1, 0.5, 0.9):
            assert abs(cont[(c, p)] - float(np.percentile(xs, p * 100))) < 1e-9
            assert disc[(c, p)] == xs[math.ceil(p * len(xs)) - 1]


def _hinted(df):
    return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower() or \
        "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()


def test_sized_broadcast_proof_paths(spark):
    from quarry.operators.joins import sized_broadcast
    small = spark.createDataFrame([(i, str(i)) for i in range(10)], "k long, v string")
    assert _hinted(sized_broadcast(small))                       # estimate under the bound
    big = spark.range(0, 200000).withColumn("v", F.lit("x"))
    assert not _hinted(sized_broadcast(big, max_bytes=1024))     # bounded count fails -> no hint
    assert _hinted(sized_broadcast(big, max_bytes=1 << 30, rows_bound=100))  # known bound


def test_spread_only_when_under_parallel(spark):
    from quarry.operators.textmining import spread
    par = spark.sparkContext.defaultParallelism
    one = spark.range(0, 100, numPartitions=1)
    assert spread(one).rdd.getNumPartitions() == par
    many = spark.range(0, 100, numPartitions=par)
    assert spread(many) is many


def test_infer_metadata_and_class_balance(spark):
    df = spark.createDataFrame([(1, "a", 2.5, 7), (2, "b", 3.5, 7), (3, "a", None, 8)],
                               "user_id long, cat string, x double, group_key long")
    meta = {r.column_name: r.sdtype for r in Q.infer_metadata(df, {"x": "numerical"}).collect()}
    assert meta == {"user_id": "id", "cat": "categorical", "x": "numerical", "group_key": "numerical"}
    cb = {r.cat: (r.n, r.imbalanced) for r in Q.class_balance(df, "cat").collect()}
    assert cb == {"a": (2, False), "b": (1, False)}
