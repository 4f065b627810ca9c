"""Hard-negative mining with exact scores from residue-number-system products."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import parallelism, saved, ship_package

__all__ = ["small_primes", "rns_product", "mine"]

_CELLS = 1 << 21  # scores held at a time


def small_primes(below: int = 1024) -> list[int]:
    """The primes below ``below``, largest first."""
    sieve = np.ones(below, dtype=bool)
    sieve[:2] = False
    for i in range(2, int(below ** 0.5) + 1):
        sieve[i * i::i] = False
    return [int(p) for p in np.flatnonzero(sieve)[::-1]]


_PRIMES = small_primes()


def _moduli(bound: int) -> list[int]:
    """As many primes as it takes for their product to exceed ``2 * bound + 1``."""
    out, product = [], 1
    for p in _PRIMES:
        out.append(p)
        product *= p
        if product > 2 * bound + 1:
            return out
    raise OverflowError(f"no moduli for a bound of {bound}")


class _Matrix:
    """Integer rows with their residues, computed once for each modulus."""

    def __init__(self, x: np.ndarray):
        self.x, self.res = x, {}
        self.norm = float(np.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0))) if len(x) else 0.0

    def mod(self, p: int) -> np.ndarray:
        """Residues nearest zero, as float32."""
        if p not in self.res:
            r = self.x % p
            self.res[p] = np.where(r > p // 2, r - p, r).astype(np.float32)
        return self.res[p]


def rns_product(a: _Matrix, b: _Matrix, rows: slice, cols: slice) -> np.ndarray:
    """``a[rows] @ b[cols].T`` exactly, as int64.

    By Cauchy-Schwarz no score exceeds the product of the largest norms, so
    primes whose product is over twice that tell all scores apart.  For each
    prime, the residues are multiplied in float32 over slices of components so
    short that no sum can reach 2^24; the scores follow by Chinese remaindering
    in balanced mixed radix, which gives their signs directly."""
    bound = int(a.norm * b.norm * (1 + 1e-9)) + 2
    if bound >= 1 << 62:
        raise OverflowError("scores of these vectors may not fit into 64 bits")
    value, product = None, 1
    for p in _moduli(bound):
        ra, rb, step = a.mod(p)[rows], b.mod(p)[cols], max(1, ((1 << 24) - 1) // (p // 2) ** 2)
        r = np.zeros((len(ra), len(rb)), dtype=np.int64)
        for k in range(0, ra.shape[1], step):
            r += (ra[:, k:k + step] @ rb[:, k:k + step].T).astype(np.int64)
        if value is None:
            digit = r % p
        else:
            digit = (r - value) % p * pow(product, -1, p) % p
        digit[digit > p // 2] -= p
        value = digit if value is None else value + digit * product
        product *= p
    return value


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    at = np.arange(len(score))
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((ids[at], -score[at]))[:k]]


class _Shard:
    """A shard's candidates of one vector length, ordered by label, then id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        names, code = np.unique(labels, return_inverse=True)
        order = np.lexsort((ids, code))
        self.ids, self.m = ids[order], _Matrix(x[order])
        at = np.searchsorted(code[order], np.arange(len(names) + 1))
        self.of = {n: slice(int(a), int(b)) for n, a, b in zip(names.tolist(), at[:-1], at[1:])}


def _integers(values: np.ndarray, length: int, scale: int) -> np.ndarray:
    x = np.floor(scale * values.astype(np.float64))
    if len(x) and np.abs(x).max() >= 2.0 ** 62:
        raise OverflowError("a component does not fit into 64 bits")
    return x.astype(np.int64).reshape(-1, length) if length else np.zeros((0, 0), dtype=np.int64)


def _by_length(batches: list[pa.RecordBatch], scale: int):
    """``(length, places, matrix)`` of the vectors of some batches, by their length."""
    v = pa.concat_arrays([b.column("v") for b in batches])
    size = np.diff(v.offsets.to_numpy())
    start, flat = np.cumsum(size) - size, v.flatten().to_numpy(zero_copy_only=False)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        take = (start[at][:, None] + np.arange(n)[None, :]).ravel()
        x = _integers(flat[take], int(n), scale) if n else np.zeros((len(at), 0), dtype=np.int64)
        yield int(n), at, x


def _column(batches: list[pa.RecordBatch], name: str) -> np.ndarray:
    return np.concatenate([b.column(name).to_numpy(zero_copy_only=False) for b in batches])


def _solve(batches: Iterator[pa.RecordBatch], scale: int, answer) -> Iterator[pa.RecordBatch]:
    """Candidates of one shard come first, each id's first row counting; then the
    anchors stream by, a batch at a time."""
    held, shards = [], None
    for b in batches:
        kind = b.column("kind").to_numpy()
        n = int(np.searchsorted(kind, 1))
        if n:
            held.append(b.slice(0, n))
        if n == b.num_rows:
            continue
        if shards is None:
            shards = {}
            if held:
                ids, labels = _column(held, "id"), _column(held, "label")
                first = np.ones(len(ids), dtype=bool)
                first[1:] = ids[1:] != ids[:-1]
                for size, at, x in _by_length(held, scale):
                    own = first[at]
                    shards[size] = _Shard(ids[at][own], labels[at][own], x[own])
                held = []
        a = b.slice(n)
        ids, labels, marks = _column([a], "id"), _column([a], "label"), a.column("marks").to_pylist()
        for size, at, x in _by_length([a], scale):
            if size in shards:
                yield from answer(shards[size], ids[at], labels[at], [marks[i] for i in at], x)


def _positives(k: int):
    def answer(s: _Shard, ids, labels, marks, x):
        out: list[tuple] = []
        for name in np.unique(labels).tolist():
            own = s.of.get(name)
            if own is None:
                continue
            at, other = np.flatnonzero(labels == name), s.ids[own]
            a, step = _Matrix(x[at]), max(1, _CELLS // len(other))
            for lo in range(0, len(at), step):
                scores = rns_product(a, s.m, slice(lo, lo + step), own)
                for i, row in zip(at[lo:lo + step], scores):
                    rest = np.flatnonzero(other != ids[i])
                    best = rest[_best(row[rest], other[rest], k)]
                    out += [(int(ids[i]), int(other[j]), int(row[j])) for j in best]
        yield pa.table(list(zip(*out)) or [[]] * 3, schema=pa.schema([(c, pa.int64()) for c in ("anchor", "other", "score")])).combine_chunks().to_batches()[0] if out else None
    return answer


def _negatives(k: int, low: tuple[int, int], high: tuple[int, int]):
    def answer(s: _Shard, ids, labels, marks, x):
        out: list[tuple] = []
        a, step = _Matrix(x), max(1, _CELLS // max(1, len(s.ids)))
        for lo in range(0, len(ids), step):
            scores = rns_product(a, s.m, slice(lo, lo + step), slice(0, len(s.ids)))
            for i, row in zip(range(lo, lo + step), scores):
                # low[0] * positive <= low[1] * score and high[1] * score <= high[0] * positive, in whole numbers
                span = [(m["positive"], m["score"], -((-low[0] * m["score"]) // low[1]), (high[0] * m["score"]) // high[1]) for m in marks[i]]
                span = [m for m in span if m[2] <= m[3]]
                if not span:
                    continue
                fit = (row >= min(m[2] for m in span)) & (row <= max(m[3] for m in span))
                own = s.of.get(labels[i])
                if own is not None:
                    fit[own] = False
                at = np.flatnonzero(fit)
                got, other = row[at], s.ids[at]
                for positive, of, least, most in span:
                    inside = np.flatnonzero((got >= least) & (got <= most))
                    out += [(int(ids[i]), positive, of, int(other[j]), int(got[j])) for j in inside[_best(got[inside], other[inside], k)]]
        yield pa.table(list(zip(*out)), schema=pa.schema([(c, pa.int64()) for c in ("anchor", "positive", "positive_score", "negative", "negative_score")])).combine_chunks().to_batches()[0] if out else None
    return answer


def _top(df: DataFrame, keys: list[str], score: str, other: str, k: int) -> DataFrame:
    by = Window.partitionBy(*keys).orderBy(F.desc(score), other)
    return df.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, id_col: str, vec_col: str, label: Column, is_anchor: Column, positives: int = 5, negatives: int = 10,
         low: tuple[int, int] = (30, 100), high: tuple[int, int] = (90, 100), scale: int = 256, shard_components: int = 1 << 22) -> DataFrame:
    """``(anchor, positive, rank, negative, positive_score, negative_score)``: for each
    anchor and each of its ``positives`` best rows of the same label, the
    ``negatives`` best rows of other labels whose score lies between ``low`` and
    ``high`` (fractions) of the positive's.  Higher scores first, ties to the
    smaller id.

    A component x counts as floor(scale * x); scores are exact integer inner
    products (:func:`rns_product`).  Candidates are dealt once into shards of about
    ``shard_components`` components by the hash of their id, whatever their
    label; the anchors, a stated query set, pass by every shard in batches.
    Each shard sends its best rows only, and the best of those are the answer.
    The first pass multiplies anchors with rows of their label, the second with
    all rows, where the windows are known.

    Rows with a null id, label or vector, or with a null or non-finite component
    take no part.  An id counts once: of rows that share one, the row of the
    smallest label, then vector.  Vectors of different lengths have no score
    with each other; empty vectors score 0 among themselves.  A positive with a
    negative score has no window, hence no rows.  Scores that might not fit into
    64 bits raise an error.  An empty table, or no anchors, gives no rows."""
    spark = vectors.sparkSession
    ship_package(spark)
    kind = vectors.schema[vec_col].dataType
    floats = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    v = F.col(vec_col) if floats else F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), v.alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asks")) \
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()) \
        .where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    anchors = saved(rows.where("asks").groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v"), "negatives-anchors")
    total = rows.agg(F.sum(F.size("v") + 1)).first()[0] or 0
    shards = max(parallelism(spark), -(-total // shard_components))
    cand = rows.select(F.lit(0).alias("kind"), "id", "label", "v", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("s"))
    mark = "array<struct<positive:long,score:long>>"

    def passed(asked: DataFrame, answer, schema: str) -> DataFrame:
        a = asked.select(F.lit(1).alias("kind"), "id", "label", "v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("s"), "marks")
        both = cand.withColumn("marks", F.lit(None).cast(mark)).unionByName(a)

        def run(batches):
            for b in _solve(batches, scale, answer):
                if b is not None:
                    yield b
        return both.repartitionById(shards, F.col("s")).sortWithinPartitions("kind", "id", "label", "v").drop("s").mapInArrow(run, schema)
    found = passed(anchors.withColumn("marks", F.lit(None).cast(mark)), _positives(positives), "anchor long, other long, score long")
    best = _top(found, ["anchor"], "score", "other", positives)
    marks = best.groupBy("anchor").agg(F.collect_list(F.struct(F.col("other").alias("positive"), "score")).alias("marks"))
    asked = saved(anchors.join(marks, F.col("id") == F.col("anchor")).select("id", "label", "v", F.col("marks").cast(mark)), "negatives-positives")
    found = passed(asked, _negatives(negatives, low, high), "anchor long, positive long, positive_score long, negative long, negative_score long")
    return _top(found, ["anchor", "positive", "positive_score"], "negative_score", "negative", negatives) \
        .select("anchor", "positive", F.col("rank").cast("int").alias("rank"), "negative", "positive_score", "negative_score")
