"""Null keys, labels and values: no row is lost and no null is taken for something else."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.predicates import fingerprint
from quarry.operators import aggregate as G
from quarry.operators import sampling as Y
from quarry.operators import similarity as T
from quarry.operators import windows as W
from quarry.operators.joins import align_freq
from quarry.sources import io


def test_stratified_split_keeps_rows_without_a_label(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else "ab"[i % 2]) for i in range(60)], "id long, label string")
    got = Y.split_stratified(df, "id", "label", 0.8).collect()
    assert sorted(r.id for r in got) == list(range(60))
    assert sum(r.split == "train" for r in got if r.label is None) == 16


def test_ecdf_and_running_totals_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", 1), ("a", None)], "g string, v int")
    got = {(r.g, r.value): (r.n, r.cum_n, r.cdf) for r in W.ecdf(df, "v", ["g"]).collect()}
    assert got == {(None, 1): (1, 1, 0.5), (None, 2): (1, 2, 1.0), ("a", 1): (2, 2, 1.0)}
    assert W.running_totals(df, "v", {"c": F.lit(1)}, ["g"]).count() == 5


def test_group_profile_null_group_and_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0), ("a", None), ("b", None)], "k string, v double")
    got = {r.k: r for r in G.group_profile(df, "k", "v", exact=True).collect()}
    assert (got[None].n, got[None].median_value, got[None].p99_value) == (2, 1.0, 3.0)
    assert (got["a"].n, got["a"].median_value) == (2, 2.0) and (got["b"].n, got["b"].median_value) == (1, None)
    assert {r.k: r.n for r in G.group_profile(df, "k", "v").collect()} == {k: r.n for k, r in got.items()}
    q = {r.k: r.value for r in G.group_quantile(df, "k", "v", 0.5).collect()}
    assert q == {None: 2.0, "a": 2.0}


def test_distance_of_a_table_to_itself_is_zero(spark):
    df = spark.createDataFrame([("a", "x"), (None, "y"), (None, None)], "p string, q string")
    assert [r.tvd for r in T.tvd(df, df, ["p", "q"]).collect()] == [0.0, 0.0]
    assert [r.tvd for r in T.pair_tvd(df, df, [("p", "q")]).collect()] == [0.0]
    c = df.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    assert sorted((str(r.p), r.a, r.b) for r in align_freq(c, c, "p", "n", "n").collect()) == [("None", 2, 2), ("a", 1, 1)]


def test_fingerprint_tells_where_nulls_stand(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "", "b"), ("a", "-", "b")], "x string, y string, z string")
    assert len({r.f for r in df.select(fingerprint("x", "y", "z").alias("f")).collect()}) == 4


@pytest.mark.parametrize("text,value", [("12.5", 12.5), (" 7 ", 7.0), ("1e2", 100.0), (".5", 0.5), ("3.", 3.0), ("+4", 4.0),
                                        ("12.5d", None), ("3F", None), ("0x1p3", None), ("1_0", None), ("", None), ("-2", None), ("nan", None)])
def test_pair_parser_takes_plain_numbers_only(spark, text, value):
    got = io.parse_pairs(spark.createDataFrame([("k," + text,)], "value string")).collect()
    assert [r.value for r in got] == ([] if value is None else [value])


def test_bootstrap_positions_are_wide(spark):
    x = spark.range(1000).select(Y.hash_int("id", 42, "c", hex_digits=15).alias("h")).agg(F.max("h")).first()[0]
    assert x > 2 ** 55


def test_running_totals_do_not_depend_on_row_order(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.randrange(200)) for _ in range(3000)]
    want = {}
    for g, v in sorted(rows):
        want[g, v] = want.get((g, v), 0) + 1
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "g string, v int").repartition(7)
        got = {(r.g, r.value): r.cum_n for r in W.ecdf(df, "v", ["g"], n_buckets=13).collect()}
        for g in "ab":
            ks = sorted(v for h, v in want if h == g)
            assert [got[g, v] for v in ks] == list(np.cumsum([want[g, v] for v in ks]))


def test_bucket_bounds_are_computed_once(spark):
    df = spark.createDataFrame([(i % 5, float(i)) for i in range(200)], "g int, v double")
    plan = W.running_totals(df, "v", {"c": F.lit(1)}, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile_approx" not in plan  # frozen in a checkpoint, not part of the plan that reads it
