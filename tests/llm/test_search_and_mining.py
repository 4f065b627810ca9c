"""Lexical search, hard negatives and the chosen-path join against brute force, on small tables."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import hardneg, lexical, pathjoin
from tests.conftest import SF_SMALL

DOC = "doc_id long, text string"


def rows(df):
    return [r.asDict() for r in df.collect()]


# --- 11 lexical search -------------------------------------------------------------
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def fold(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_ranking(docs, items, k=10):
    """docs: (id, text); items: (id, text); in plain integers."""
    terms = [(i, TERM.findall(fold(t))) for i, t in docs]
    n_docs, total = sum(bool(x) for _, x in terms), sum(len(x) for _, x in terms)
    df = Counter(t for _, x in terms for t in set(x))
    asked = {}
    for i, t in sorted({x for x in items if x[0] is not None}, key=repr):
        asked.setdefault(i, Counter()).update(TERM.findall(fold(t)))
    out = {}
    for item, q in asked.items():
        best = []
        for i, x in terms:
            if not x or i is None:
                continue
            tf, m = Counter(x), 100 - 75 + (75 * len(x) * n_docs) // total
            s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
                    for t, n in q.items() if tf[t])
            if s > 0:
                best.append((-s, i))
        for r, (s, i) in enumerate(sorted(best)[:k], 1):
            out[item, r] = (i, -s)
    return out


def ranking(df):
    return {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in rows(df)}


ODD_DOCS = [(1, None), (2, ""), (3, "!!! --"), (4, "Ä ä É"), (5, "a b c"), (6, "A-B_c 42"), (7, "a b c"), (5, "a b c"), (None, "a a a b"),
            (8, "x " * 20000 + "needle"), (9, "needle a"), (10, "Straße 東京 a")]
ODD_ITEMS = [(1, "a B"), (1, "a B"), (1, "c"), (2, None), (3, ""), (None, "a"), (4, "needle needle NEEDLE"), (5, "absent"), (6, "東京 straße ä É")]


@pytest.mark.parametrize("size", [dict(), dict(tile_docs=2, tile_items=1, tile_terms=1), dict(round_entries=2, tile_docs=3)])
def test_lexical_search_of_odd_rows_equals_brute_force(spark, size):
    docs, items = spark.createDataFrame(ODD_DOCS, DOC), spark.createDataFrame(ODD_ITEMS, "item_id long, text string")
    assert ranking(lexical.rank_documents(docs, items, k=3, **size)) == brute_ranking(ODD_DOCS, ODD_ITEMS, 3)


def test_lexical_search_on_whole_tables_equals_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute_ranking([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert ranking(lexical.rank_documents(docs, items)) == want
    assert ranking(lexical.rank_documents(docs.repartition(7), items, tile_docs=16, tile_items=3, tile_terms=8)) == want


def test_lexical_search_ties_go_to_smaller_ids_over_all_tasks(spark):
    docs = spark.range(300).select((F.lit(1000) - F.col("id")).alias("doc_id"), F.lit("same words").alias("text")).repartition(9)
    got = ranking(lexical.rank_documents(docs, spark.createDataFrame([("q", "same words")], "item_id string, text string"), tile_docs=8))
    assert [got["q", r][0] for r in range(1, 11)] == list(range(701, 711))


def test_lexical_search_keeps_ids_of_any_kind_and_ignores_clashing_columns(spark):
    docs = spark.createDataFrame([("d2", "a", 1, "t"), ("d1", "a", 2, "u")], "doc_id string, text string, n int, term string")
    items = spark.createDataFrame([(7, "a", 0)], "item_id long, text string, score int")
    got = lexical.rank_documents(docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert [r["doc_id"] for r in got.orderBy("rank").collect()] == ["d1", "d2"]


def test_lexical_search_of_empty_tables(spark):
    none, some = spark.createDataFrame([], DOC), spark.createDataFrame([(1, "a")], DOC)
    item = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rows(lexical.rank_documents(none, item)) == []
    assert rows(lexical.rank_documents(some, item.limit(0))) == []


def test_lexical_partial_sums_stay_exact():
    """Weights far beyond 2^53 in sum are cut into tiles and even into addends."""
    limit = (lexical.EXACT - 1) // lexical.IMPACT_BOUND
    weight = np.array([limit, limit, 3 * limit + 5, 7], dtype=np.int64)
    tiles = lexical.build_tiles(np.array([0, 0, 1, 1]), np.array([0, 1, 0, 2]), weight, 2, 16)
    for _, _, parts in tiles:
        for _, r, c, w in parts:
            assert all(w[c == j].sum() <= limit for j in range(2))
    impact = np.array([999_999.0, 999_998.0, 3.0])
    got = sum(lexical.score_tile(1, np.zeros(3, dtype=int), np.arange(3), impact, t, np.full(3, -1)) for t in tiles)
    assert got.tolist() == [[limit * 999_999 + limit * 999_998, (3 * limit + 5) * 999_999 + 21]]


# --- 12 hard negatives ---------------------------------------------------------------
@pytest.mark.parametrize("size", [1, 9, 300, 1 << 20, 1 << 28])
def test_rns_product_is_exact(size):
    rng = np.random.default_rng(size)
    a, b = (rng.integers(-size, size + 1, (n, 150)) for n in (7, 11))
    got = hardneg.rns_product(hardneg._Matrix(a), hardneg._Matrix(b), slice(2, 7), slice(0, 11))
    assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a[2:]]


def test_rns_product_refuses_what_64_bits_cannot_hold():
    x = hardneg._Matrix(np.full((1, 4), 1 << 31))
    with pytest.raises(OverflowError):
        hardneg.rns_product(x, x, slice(0, 1), slice(0, 1))


def brute_negatives(vectors, anchor, k_pos=5, k_neg=10):
    """vectors: (id, label, vector)."""
    use = {}
    for i, lab, v in sorted((r for r in vectors if None not in r and all(x is not None and math.isfinite(x) for x in r[2])), key=lambda r: (r[0], r[1], r[2])):
        use.setdefault(i, (lab, [math.floor(256 * x) for x in v]))
    out = set()
    for a, (lab, v) in use.items():
        if not anchor(a):
            continue
        s = sorted((-sum(x * y for x, y in zip(v, w)), i, other == lab) for i, (other, w) in use.items() if i != a and len(w) == len(v))
        for p, i, _ in [x for x in s if x[2]][:k_pos]:
            fit = [x for x in s if not x[2] and 30 * -p <= 100 * -x[0] <= 90 * -p][:k_neg]
            out |= {(a, i, r, j, -p, -n) for r, (n, j, _) in enumerate(fit, 1)}
    return out


def mined(df):
    return [tuple(r) for r in df.select("anchor", "positive", "rank", "negative", "positive_score", "negative_score").collect()]


def random_vectors(n, dim, seed):
    rng = random.Random(seed)
    out = [(i, rng.randrange(3), [rng.choice([0.0, rng.uniform(-1, 1), 0.25]) for _ in range(dim)]) for i in range(n)]
    out += [(n + i, i % 2, out[0][2]) for i in range(40)]  # a vector that many rows share
    return out


@pytest.mark.parametrize("dim,components", [(3, 1 << 22), (3, 64), (70, 4000)])
def test_hard_negatives_equal_brute_force(spark, dim, components):
    v = random_vectors(150, dim, dim)
    df = spark.createDataFrame(v, "vec_id long, label int, embedding array<double>")
    got = mined(hardneg.mine(df, "vec_id", "embedding", F.col("label"), F.col("vec_id") % 10 == 0, shard_components=components))
    assert len(got) == len(set(got)) and set(got) == brute_negatives(v, lambda i: i % 10 == 0)


def test_hard_negatives_of_odd_rows(spark):
    v = random_vectors(40, 4, 1) + [(None, 1, [1.0] * 4), (500, None, [1.0] * 4), (510, 1, None), (520, 1, [1.0, None, 0.0, 0.0]), (530, 1, [float("nan")] * 4),
                                    (540, 1, [float("inf"), 0.0, 0.0, 0.0]), (550, 1, []), (551, 2, []), (560, 1, [1.0, 1.0]), (561, 1, [0.5, 1.0]), (562, 2, [0.4, 0.4]),
                                    (10, 2, [9.0] * 4), (10, 2, [9.0] * 4), (570, 0, [0.0] * 4), (571, 0, [-1.0, -1.0, 0.0, 0.0])]
    df = spark.createDataFrame(v, "vec_id long, label int, embedding array<double>").withColumn("id", F.lit("x")).withColumn("rank", F.lit(1))
    got = mined(hardneg.mine(df, "vec_id", "embedding", F.col("label"), F.col("vec_id") % 10 == 0))
    assert len(got) == len(set(got)) and set(got) == brute_negatives(v, lambda i: i % 10 == 0)
    words = df.withColumn("label", F.concat(F.lit("l"), "label"))
    assert set(mined(hardneg.mine(words, "vec_id", "embedding", F.col("label"), F.col("vec_id") % 10 == 0))) == set(got)


def test_hard_negatives_of_empty_tables(spark):
    df = spark.createDataFrame([(1, 1, [1.0])], "vec_id long, label int, embedding array<float>")
    for d, asks in ((df.limit(0), F.lit(True)), (df, F.lit(False)), (df, F.lit(None).cast("boolean")), (df, F.lit(True))):
        assert mined(hardneg.mine(d, "vec_id", "embedding", F.col("label"), asks)) == []


# --- 13 chosen-path join --------------------------------------------------------------
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(texts):
    out = []
    for t in texts:
        w = WORD.findall(fold(t))
        out.append({tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set())
    return out


def brute_components(ids, texts, share=85):
    s = brute_sets(texts)
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if s[i] and 100 * len(s[i] & s[j]) >= share * len(s[i] | s[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {g: min((i for i, h in zip(ids, group) if h == g and i is not None), default=None) for g in group}
    return sorted(((i, len(x), least[g], i == least[g]) for i, x, g in zip(ids, s, group)), key=repr)


def joined(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def near_copies(n_groups, copies, seed, words=60):
    rng = random.Random(seed)
    out = []
    for _ in range(n_groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randrange(4)):
                t[rng.randrange(words)] = f"w{rng.randrange(5000)}"
            out.append(" ".join(t))
    return out


@pytest.mark.parametrize("size", [dict(), dict(node_rows=4, levels=2, part_rows=3), dict(node_rows=3, levels=3, unit_shingles=150, part_rows=5)])
def test_chosen_path_join_equals_brute_force(spark, size):
    """Small limits lead through parts with common members, several levels, and pairs of parts."""
    texts = near_copies(12, 9, 4) + near_copies(1, 40, 5) + [t + " and a tail of words" for t in near_copies(3, 2, 6, 20)]
    ids = random.Random(1).sample(range(10_000), len(texts))
    got = pathjoin.near_duplicates(spark.createDataFrame(list(zip(ids, texts)), DOC), **size)
    assert joined(got) == brute_components(ids, texts)


def test_chosen_path_join_of_the_fixture_equals_brute_force(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    at = [(r["doc_id"], r["text"]) for r in d.collect()]
    assert joined(pathjoin.near_duplicates(d)) == brute_components(*zip(*at))


def test_chosen_path_join_of_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(30000))
    texts = [None, "", " \n", "one", "ONE", "one two", "two one", "a b c", "A b\tC", "a b c d", long, long + " more", "É b c", "é b c", "same text here", "same text here"]
    ids = [None, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, None, None]
    df = spark.createDataFrame(list(zip(ids, texts)), DOC).withColumn("key", F.lit("k")).withColumn("comp", F.lit(0))
    got = joined(pathjoin.near_duplicates(df))
    assert got == brute_components(ids, texts)
    twice = joined(pathjoin.near_duplicates(df.unionByName(df)))
    assert twice == sorted(got * 2, key=repr)
    assert joined(pathjoin.near_duplicates(df.limit(0))) == []


def test_chosen_path_join_rows_that_share_an_id_are_rows_of_their_own(spark):
    ids, texts = [1, 1, 2, 3], ["a b c d e f", "p q r s t u", "p q r s t u", "x y z"]
    assert joined(pathjoin.near_duplicates(spark.createDataFrame(list(zip(ids, texts)), DOC))) == brute_components(ids, texts)


def test_chosen_path_trees_alone_reach_the_recall(spark):
    """Links found by the trees, without the help of components: pairs near the threshold."""
    texts = near_copies(300, 2, 9, 100)
    s = brute_sets(texts)
    want = {(i, i + 1) for i in range(0, 600, 2) if 100 * len(s[i] & s[i + 1]) >= 85 * len(s[i] | s[i + 1])}
    got = pathjoin.near_duplicates(spark.createDataFrame(list(enumerate(texts)), DOC), trees=8)
    assert {(r["component_id"], r["doc_id"]) for r in rows(got) if not r["kept"]} == want


def test_queries_have_the_columns_of_their_contracts(spark):
    from quarry.llm import queries as Q
    want = {"op11_lexical_search": "item_id bigint, rank int, doc_id bigint, score bigint",
            "op12_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
            "op13_minhash": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean"}
    for name, columns in want.items():
        assert ", ".join(" ".join(x) for x in Q.QUERIES[name](spark, SF_SMALL).dtypes) == columns
