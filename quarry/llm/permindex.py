"""Approximate nearest neighbours by a permutation index."""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import parallelism, saved

__all__ = ["usable_vectors", "choose_pivots", "search", "exact_search"]


def usable_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v array<double>)`` of the rows that take part: an id, and a vector that
    is neither null, empty nor zero, without null or non-finite components, and
    of the table's most frequent length (of equally frequent ones, the longest)."""
    v = F.col("v")
    ok = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    d = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")) \
        .where(F.col("id").isNotNull() & F.coalesce(ok, F.lit(False)))
    top = d.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return d.where(F.size("v") == (top["n"] if top else 0))


def _directions(classes: DataFrame, sample: int) -> np.ndarray:
    """At most ``sample`` distinct vectors, those with the smallest hash of their id, scaled to unit length."""
    rows = classes.orderBy(F.xxhash64("rep", F.lit(17)), "rep").limit(sample).select("v").collect()
    u = np.array([r["v"] for r in rows], dtype=np.float64).reshape(len(rows), -1 if rows else 1)
    return u / np.linalg.norm(u, axis=1, keepdims=True)


def choose_pivots(classes: DataFrame, n_pivots: int = 256, sample: int = 2048, near: float = 0.7) -> np.ndarray:
    """Unit pivots from a sample of at most ``sample`` distinct vectors (those with
    the smallest hash of their id): in hash order, those less than ``near``
    cosine to all chosen before; if too few, the rest in order."""
    u = _directions(classes, sample)
    if not len(u):
        return np.zeros((0, 1))
    pick: list[int] = []
    for i in range(len(u)):
        if len(pick) < n_pivots and (not pick or float(np.max(u[pick] @ u[i])) < near):
            pick.append(i)
    rest = [i for i in range(len(u)) if i not in set(pick)]
    return u[(pick + rest)[:n_pivots]]


def _prefixes(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each row, nearest first."""
    c = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ pivots.T
    return np.argsort(-c, axis=1, kind="stable")[:, :prefix]


class _InvertedFiles:
    """For each pivot, which rows have it among their nearest, and at what place."""

    def __init__(self, order: np.ndarray, n_pivots: int):
        n, self.l = order.shape
        flat = order.ravel()
        by = np.argsort(flat, kind="stable")
        row, place = by // self.l, (by % self.l).astype(np.int16)
        at = np.searchsorted(flat[by], np.arange(n_pivots + 1))
        self.post = [(row[a:b], place[a:b]) for a, b in zip(at[:-1], at[1:])]
        self.n, self.most = n, self.l * (self.l + 1) // 2

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Sum of |place there - place here| over the query's pivots; a pivot that
        a row lacks counts as its place ``prefix``."""
        l, lists = self.l, [self.post[p] for p in order]
        here = np.repeat(np.arange(l, dtype=np.int16), [len(r) for r, _ in lists])
        near = np.concatenate([p for _, p in lists])
        near -= here
        np.abs(near, out=near)
        gain = l - here - near  # against a row that lacks the pivot
        return self.most - np.bincount(np.concatenate([r for r, _ in lists]), weights=gain, minlength=self.n)


def _calibrate(u: np.ndarray, pivots: np.ndarray, prefix: int) -> tuple[float, float]:
    """``(a, b)`` such that ``a - b * footrule`` is two standard deviations above the
    cosine that the footrule of two vectors lets expect: a line through all pairs
    of the unit vectors ``u``.  Where these tell nothing, cosine 1 at footrule 0."""
    l = min(prefix, len(pivots))
    plain = (1.0, 1.0 / max(1, l * (l + 1) // 2))
    if len(u) < 3:
        return plain
    order = _prefixes(u, pivots, l)
    files, other = _InvertedFiles(order, len(pivots)), ~np.eye(len(u), dtype=bool)
    f = np.stack([files.footrule(o) for o in order])[other]
    c = (u @ u.T)[other]
    if not f.std() > 0:
        return plain
    slope = ((f - f.mean()) * (c - c.mean())).mean() / f.var()
    if not slope < 0:
        return plain
    return float(c.mean() - slope * f.mean() + 2 * np.std(c - slope * f)), float(-slope)


def _classes(valid: DataFrame, k: int) -> DataFrame:
    """Equal vectors as one class ``(rep, ids, v)``: its smallest id and its k + 1
    smallest ids, which are all that any answer can hold."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    return valid.withColumn("_r", rank).where(F.col("_r") <= k + 1).groupBy("v") \
        .agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids")).select("rep", "ids", "v")


def _blocks(vectors: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int, shard_rows: int, query_rows: int, fit, answer) -> DataFrame:
    """Queries against all rows in blocks of bounded size; ``answer`` picks and
    scores within a block, the rest is the exact merge of its answers."""
    spark = vectors.sparkSession
    valid = saved(usable_vectors(vectors.select(id_col, vec_col), id_col, vec_col), "ann-vectors")
    classes = saved(_classes(valid, k), "ann-classes")
    n = classes.count()
    arg = fit(classes)
    asked = valid.join(vectors.where(is_query).select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi")
    of = saved(asked.distinct().join(classes, "v").select(F.col("id").alias("query_id"), "rep"), "ann-queries")
    wanted = classes.join(of.select("rep").distinct(), "rep", "left_semi")
    shards, parts = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(of.select("rep").distinct().count() / query_rows))
    at = lambda seed, m: F.pmod(F.xxhash64("rep", F.lit(seed)), F.lit(m)).cast("int")
    left = classes.withColumn("s", at(3, shards)).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = wanted.select(F.col("rep").alias("query"), F.col("v").alias("y"), at(5, parts).alias("b")).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    units = parallelism(spark)
    left, right = left.repartition(units, "s", "b"), right.repartition(units, "s", "b")

    def solve(idx: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(idx) or not len(q):
            return pd.DataFrame({"query": [], "rep": [], "ids": [], "score": []}).astype({"query": "int64", "rep": "int64", "score": "float64"})
        idx = idx.sort_values("rep")
        x, y, rep = np.stack(idx["v"].to_list()), np.stack(q["y"].to_list()), idx["rep"].to_numpy()
        who, what, score = [], [], []
        for i, cand in answer(arg, x, y):
            rough = x[cand] @ y[i]
            if len(cand) > 4 * k + 4:  # well beyond k + 1; the margin covers what rounding can change
                low = np.partition(rough, len(cand) - k - 1)[len(cand) - k - 1]
                cand = cand[rough >= low - 1e-9 * (1 + abs(low))]
            s = (x[cand] * y[i]).sum(axis=1)
            best = np.lexsort((rep[cand], -s))[: k + 1]
            who.append(np.full(len(best), q["query"].iloc[i]))
            what.append(cand[best])
            score.append(s[best])
        what = np.concatenate(what)
        return pd.DataFrame({"query": np.concatenate(who), "rep": rep[what], "ids": idx["ids"].to_numpy()[what], "score": np.concatenate(score)})
    found = left.groupBy("s", "b").cogroup(right.groupBy("s", "b")).applyInPandas(solve, "query long, rep long, ids array<long>, score double")
    by = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    top = found.withColumnRenamed("rep", "class").withColumn("_r", F.row_number().over(by)).where(F.col("_r") <= k + 1) \
        .select("query", "score", F.explode("ids").alias("vec_id"))
    by = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = top.withColumn("_r", F.row_number().over(by)).where(F.col("_r") <= k + 1).drop("_r")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return of.withColumnRenamed("rep", "query").join(top, "query").where("vec_id != query_id") \
        .withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int = 20, n_pivots: int = 256,
           prefix: int = 64, depth: float = 0.4, shard_rows: int = 4096, query_rows: int = 2048) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of largest inner product
    found for every row that ``is_query`` names, itself excluded.

    Each vector is the list of its ``prefix`` nearest pivots in order.  The
    index is dealt over shards of ``shard_rows``; each keeps inverted files by
    pivot.  Those files give a query Spearman's footrule to a shard's rows, which
    tells directions only: a row's norm times the cosine that its footrule lets
    expect (plus two standard deviations, from a sample of pairs) bounds its inner
    product.  The ``depth`` rows of the largest bounds (and all ties; at least 4k
    rows) are reranked by the exact inner product; among rows of one norm these
    are the nearest by footrule.  Equal vectors are indexed once.

    See :func:`usable_vectors` for the rows that take part; repeated ids count
    once for equal vectors; fewer candidates give fewer rows; ties go to the
    smaller id; an empty table gives no rows."""
    def fit(classes):
        pivots = choose_pivots(classes, n_pivots)
        return pivots, _calibrate(_directions(classes, 256), pivots, prefix)

    def answer(fitted, x, y):
        pivots, (a, b) = fitted
        files = _InvertedFiles(_prefixes(x, pivots, min(prefix, len(pivots))), len(pivots))
        asked = _prefixes(y, pivots, min(prefix, len(pivots)))
        m, norm = max(math.ceil(depth * len(x)), 4 * k), np.linalg.norm(x, axis=1)
        for i in range(len(y)):
            far = norm * (b * files.footrule(asked[i]) - a)
            yield i, np.flatnonzero(far <= np.partition(far, m - 1)[m - 1]) if m < len(far) else np.arange(len(far))
    return _blocks(vectors, id_col, vec_col, is_query, k, shard_rows, query_rows, fit, answer)


def exact_search(vectors: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int = 20,
                 shard_rows: int = 4096, query_rows: int = 512) -> DataFrame:
    """The same by scoring every row: the measure of the index's recall."""
    def answer(_, x, y):
        for i in range(len(y)):
            yield i, np.arange(len(x))
    return _blocks(vectors, id_col, vec_col, is_query, k, shard_rows, query_rows, lambda c: None, answer)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact answers' rows that were found."""
    hit = exact.join(found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count()
    return hit / max(1, exact.count())
