"""Bloom-filtered membership and the most frequent terms by heavy buckets."""
import collections
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import frequent as H
from quarry.operators import joins as J
from quarry.operators import membership as M
from quarry.operators import similarity as T
from quarry.operators import textmining as N

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def shuffled_records(df):
    """Rows that the plan of ``df`` writes to shuffles, each exchange once (adaptive execution off)."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    total, todo = 0, [plan]
    while todo:
        p = todo.pop()
        m = p.metrics().get("shuffleRecordsWritten")
        if m.isDefined():
            total += m.get().value()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return total


@pytest.fixture()
def plain(spark):
    """No adaptive execution and no automatic broadcast: the plan stands as it is written."""
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "false")
    spark.conf.set(keys[1], "-1")
    yield spark
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


def test_filter_never_loses_a_key_and_drops_most_others(spark):
    a = spark.range(200_000).select(F.col("id").alias("k"), F.concat(F.lit("x"), F.col("id")).alias("s"))
    b = a.where("k % 100 = 0")
    for cols in (["k"], ["s"], ["k", "s"]):
        built = M.bloom(b, cols, words=1 << 12)
        got = M.may_contain(a, cols, built, words=1 << 12)
        assert got.where("k % 100 = 0").count() == 2_000
        assert got.count() < 2_000 + 0.02 * 198_000
        assert built.count() <= 1 << 12


def test_semi_join_shuffles_fewer_rows_and_gives_the_same(plain):
    a = plain.range(100_000).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    b = plain.range(0, 100_000, 50).select(F.col("id").alias("k"))
    want, got = J.members(a, b, ["k"]), M.members_filtered(a, b, ["k"], words=1 << 14)
    assert rows(want) == rows(got)
    n_plain, n_filtered = shuffled_records(want), shuffled_records(got)
    print("rows shuffled", n_plain, n_filtered)
    assert n_plain >= 100_000 and n_filtered < 10_000


def test_full_filter_is_not_applied(spark):
    a = spark.range(5_000).select(F.col("id").alias("k"))
    built = M.bloom(a, ["k"], words=64)
    assert M.bloom_fill(built, 64) > 0.8
    assert M.may_contain(a, ["k"], built, words=64) is a
    assert M.members_filtered(a, a.where("k < 10"), ["k"], words=64).count() == 10
    assert M.members_filtered(a, a, ["k"], words=64).count() == 5_000


def test_nulls_types_empty_sides_and_repeated_rows(spark):
    a = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "c"), (None, None), (3, "d")], "k long, s string")
    b = spark.createDataFrame([(1, "a"), (None, "c"), (None, None), (2, None), (2, None), (9, "z")], "k long, s string")
    assert rows(M.members_filtered(a, b, ["k"])) == rows(J.members(a, b, ["k"]))
    assert rows(M.members_filtered(a, b, ["k", "s"])) == rows(J.members(a, b, ["k", "s"]))
    assert rows(M.intersect_filtered(a, b)) == rows(a.intersect(b)) and (None, None) in rows(M.intersect_filtered(a, b))
    narrow = b.select(F.col("k").cast("int").alias("k"), "s")
    assert rows(M.members_filtered(a, narrow, ["k"])) == rows(J.members(a, narrow, ["k"]))
    zero = spark.createDataFrame([(0.0,), (float("nan"),)], "x double"), spark.createDataFrame([(-0.0,), (float("nan"),)], "x double")
    assert M.members_filtered(*zero, ["x"]).count() == 2
    none = a.where("false")
    assert rows(M.members_filtered(a, none, ["k"])) == [] == rows(M.members_filtered(none, b, ["k"]))
    nested = a.select(F.array("k").alias("k"))
    assert rows(M.members_filtered(nested, nested, ["k"])) == rows(nested)
    clash = a.withColumn("_w", F.lit(1)).withColumn("word", F.lit(2)).withColumn("bits", F.lit(3))
    assert M.members_filtered(clash, b, ["k"]).columns == clash.columns
    with pytest.raises(ValueError):
        M.bloom(a, ["k"], words=100)


def test_row_overlap_is_the_plain_one(spark):
    c = spark.read.parquet(f"{SF}/customer.parquet")
    real, synth = c.where("c_nationkey < 10"), c.where("c_nationkey >= 8")
    for cols in (["c_mktsegment", "c_nationkey"], ["c_custkey", "c_name"], ["c_mktsegment", "c_acctbal"]):
        assert rows(M.row_overlap_filtered(real, synth, cols)) == rows(T.row_overlap(real, synth, cols))
    assert rows(M.row_overlap_filtered(real, synth.where("false"), cols))[0][1:] == (0, 0.0)


# --- N4 / N6 -----------------------------------------------------------------------
def words(spark, seed, n, vocabulary, flat):
    rng = random.Random(seed)
    w = [f"w{i}" for i in range(vocabulary)]
    got = rng.choices(w, k=n) if flat else rng.choices(w, weights=[1 / (i + 1) for i in range(vocabulary)], k=n)
    return got, spark.createDataFrame([(x, 1) for x in got], "term string, cf int")


@pytest.mark.parametrize("flat", [False, True])
@pytest.mark.parametrize("buckets", [1, 7, 256, 1 << 20])
def test_frequent_terms_are_exact_at_every_number_of_buckets(spark, flat, buckets):
    """Flat counts are full of ties and of buckets as heavy as the found terms: the third pass."""
    got, df = words(spark, 3, 5_000, 900, flat)
    want = sorted(collections.Counter(got).items(), key=lambda x: (-x[1], x[0]))[:20]
    assert [tuple(r) for r in H.frequent_terms(df, 20, buckets=buckets).collect()] == want


def test_light_terms_in_heavy_buckets_do_not_hide_a_heavy_one(spark):
    """Most of the heaviest buckets hold many rare terms; the frequent ones lie alone in lighter buckets."""
    b = 64
    bucket = lambda w: spark.range(1).select(F.pmod(F.xxhash64(F.lit(w)), F.lit(b))).first()[0]
    alone = {bucket(w): w for w in ("heavy0", "heavy1", "heavy2")}
    many = [r["w"] for r in spark.range(4_000).select(F.concat(F.lit("r"), "id").alias("w")).where(
        ~F.pmod(F.xxhash64("w"), F.lit(b)).isin(list(alone))).collect()]
    got = many + [w for w in alone.values() for _ in range(30)]
    df = spark.createDataFrame([(x, 1) for x in got], "term string, cf int")
    want = sorted(((w, 30) for w in alone.values()))
    assert [tuple(r) for r in H.frequent_terms(df, len(want), buckets=b).collect()] == want


def test_fewer_terms_than_asked_for_empty_and_null(spark):
    _, df = words(spark, 5, 300, 40, True)
    n = df.select("term").distinct().count()
    assert H.frequent_terms(df, 1_000, buckets=16).count() == n == H.frequent_terms(df, 2, buckets=1 << 20).count() + n - 2
    assert H.frequent_terms(df.where("false"), 5).count() == 0
    nul = spark.createDataFrame([(None, 1), ("a", 1)], "term string, cf int")
    assert rows(H.frequent_terms(nul, 5)) == [("a", 1)]
    texts = spark.createDataFrame([(1, None), (2, ""), (3, "the"), (4, "Blue sky blue")], "doc_id long, text string")
    assert [tuple(r) for r in H.top_words_frequent(texts, "text", 5).collect()] == [("blue", 2, 1.0), ("sky", 1, 0.5)]
    assert H.top_words_frequent(texts.where("doc_id < 4"), "text", 5).count() == 0


@pytest.mark.parametrize("buckets", [32, 1 << 20])
@pytest.mark.parametrize("most,min_df,max_df", [(50, 5, 0.8), (50, 2, 0.1), (100_000, 3, 1.0)])
def test_vocabulary_is_the_plain_one(spark, buckets, most, min_df, max_df):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    n = docs.count()
    want = N.vocabulary(N.term_counts(docs, "doc_id", "text"), "doc_id", n, most, min_df, max_df).select("term", "df", "cf")
    got = H.vocabulary_frequent(docs, "doc_id", "text", n, most, min_df, max_df, buckets=buckets)
    assert rows(got) == rows(want)


def test_terms_are_counted_within_their_rows(spark):
    docs = spark.createDataFrame([(1, "red fox red fox"), (2, "the fox"), (3, None), (3, "red red"), (3, "red"), (None, "owl"), (None, "owl hoot")], "doc_id long, text string")
    want = {(1, "red", 2), (1, "fox", 2), (1, "red fox", 2), (1, "fox red", 1), (2, "fox", 1), (3, "red", 3), (3, "red red", 1),
            (None, "owl", 2), (None, "hoot", 1), (None, "owl hoot", 1)}
    got = [tuple(r) for r in N.term_counts(docs, "doc_id", "text").collect()]
    assert len(got) == len(want) and set(got) == want
    plan = N.term_counts(docs.where("doc_id < 3").repartition(spark.sparkContext.defaultParallelism), "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "hashpartitioning" not in plan  # no term is shuffled
