"""Ranked lexical search: dense blocked products of item tiles and document impact tiles."""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import arrow_rows, saved, ship_package

__all__ = ["terms_of", "term_weight", "impacts", "build_tiles", "score_tile", "rank_documents"]

#: ASCII letters (folded) and digits and all bytes beyond ASCII belong to terms; the rest parts them.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
#: 10^9 * tf div (1000 * tf + 8 * m) stays below this.
IMPACT_BOUND = 1_000_000
EXACT = 2 ** 53


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order, repeats included; null has none."""
    return text.translate(_FOLD).split() if text else []


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """Integer impact of a term that a document of ``length`` terms holds ``tf`` times."""
    m = 100 - 75 + (75 * length * n_docs) // total
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _vocabulary_tiles(w: np.ndarray, terms: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cut the weights ``w`` (terms x items) into tiles of at most ``most`` terms in
    which every item's sum of weight times impact stays below 2^53.  A single
    weight too large for that is split into addends of its own tiles."""
    limit = (EXACT - 1) // IMPACT_BOUND
    if len(terms) > most or (len(terms) > 1 and int(w.sum(axis=0).max(initial=0)) > limit):
        h = min(most, -(-len(terms) // 2))
        yield from _vocabulary_tiles(w[:h], terms[:h], most)
        yield from _vocabulary_tiles(w[h:], terms[h:], most)
        return
    while len(terms) and int(w.max(initial=0)) > limit:
        part = np.minimum(w, limit)
        yield part, terms
        w = w - part
    if len(terms):
        yield w, terms


def build_tiles(item: np.ndarray, term: np.ndarray, weight: np.ndarray, tile_items: int, tile_terms: int) -> list:
    """``(first item, n items, [(terms, rows, columns, weights)])`` of each item tile.
    Entries are sorted by item; a tile has its own compact vocabulary, and its
    matrices are kept as their entries."""
    out = []
    for first in range(0, int(item.max(initial=-1)) + 1, tile_items):
        lo, hi = np.searchsorted(item, [first, first + tile_items])
        own, col = np.unique(term[lo:hi], return_inverse=True)
        at = item[lo:hi] - first
        order, parts = np.argsort(col, kind="stable"), []
        for s in range(0, len(own), tile_terms):  # dense only a vocabulary tile at a time
            a, b = np.searchsorted(col[order], [s, s + tile_terms])
            e = order[a:b]
            w = np.zeros((min(tile_terms, len(own) - s), tile_items), dtype=np.int64)
            w[col[e] - s, at[e]] = weight[lo:hi][e]
            for p, t in _vocabulary_tiles(w, own[s:s + tile_terms], tile_terms):
                r, c = np.nonzero(p)
                parts.append((t, r, c, p[r, c].astype(np.float64)))
        out.append((first, tile_items, parts))
    return out


def score_tile(n: int, row: np.ndarray, term: np.ndarray, impact: np.ndarray, tile, look: np.ndarray) -> np.ndarray:
    """Exact scores (documents x items of the tile).  Each float64 product sums to
    less than 2^53 in any order; the tiles' sums are added as integers.
    ``look`` is scratch over the vocabulary, all -1."""
    _, width, parts = tile
    total = np.zeros((n, width), dtype=np.int64)
    for terms, r, c, w in parts:
        look[terms] = np.arange(len(terms), dtype=look.dtype)
        at = look[term]
        keep = at >= 0
        look[terms] = -1
        if not keep.any():
            continue
        left, right = np.zeros((n, len(terms))), np.zeros((len(terms), width))
        left[row[keep], at[keep]] = impact[keep]
        right[r, c] = w
        total += (left @ right).astype(np.int64)
    return total


class _Best:
    """The k highest-scoring documents of each item so far, ties to the smaller id."""

    def __init__(self, n_items: int, k: int):
        self.k, self.low = k, np.ones(n_items, dtype=np.int64)  # a document enters from this score on
        self.rows: list[list] = [[] for _ in range(n_items)]

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """``ids`` ascending."""
        low = self.low[first:first + scores.shape[1]]
        for j in np.flatnonzero((scores >= low[:scores.shape[1]]).any(axis=0)) if len(low) else ():
            x = scores[:, j]
            at = np.flatnonzero(x >= low[j])
            at = at[np.lexsort((at, -x[at]))[:self.k]]
            best = sorted(self.rows[first + j] + [(-int(x[i]), ids[i]) for i in at])[:self.k]
            self.rows[first + j] = best
            if len(best) == self.k:
                self.low[first + j] = -best[-1][0]


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``(item, term, q)``: how often an item holds a term, over all its distinct texts."""
    src = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item"), F.col(text_col).cast("string").cast("binary").alias("t")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in zip(b.column("item"), b.column("t")):
                c = Counter(terms_of(t.as_py()))
                if c:
                    yield pa.record_batch({"item": pa.array([i.as_py()] * len(c), b.schema.field("item").type), "term": pa.array(list(c), pa.binary()), "q": pa.array(list(c.values()), pa.int64())})
    kind = src.schema["item"].dataType.simpleString()
    return src.mapInArrow(run, f"item {kind}, term binary, q long").groupBy("item", "term").agg(F.sum("q").alias("q"))


def _postings(docs: DataFrame, id_col: str, text_col: str, vocabulary) -> DataFrame:
    """``(id, n, term, tf)`` of every document with a term: its number of terms, and
    the numbers and counts of those that ``vocabulary`` (a broadcast) has."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("t")).where(F.length("t") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.value.get
        for b in batches:
            keep, n, term, tf = [], [], [], []
            for i, t in enumerate(b.column("t")):
                words = terms_of(t.as_buffer().to_pybytes())
                if not words:
                    continue
                c = Counter(map(get, words))
                c.pop(None, None)
                keep.append(i)
                n.append(len(words))
                term.append(np.fromiter(c.keys(), np.int32, len(c)))
                tf.append(np.fromiter(c.values(), np.int32, len(c)))
            if keep:
                ends = np.cumsum([0] + [len(x) for x in term]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(x))) for x in (term, tf)]
                yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(keep)), pa.array(n, pa.int64()), *lists], ["id", "n", "term", "tf"])
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n long, term array<int>, tf array<int>")


def _best_of_tasks(postings: DataFrame, fitted, kind: str, k: int, tile_docs: int) -> DataFrame:
    """``(item, id, score)``: each task's ``k`` best documents of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs, total, tiles, n_items, n_terms = fitted.value
        best, look, type_ = _Best(n_items, k), np.full(n_terms, -1, dtype=np.int32), None
        for whole in batches:
            type_ = whole.schema.field("id").type
            for lo in range(0, whole.num_rows, tile_docs):
                b = whole.slice(lo, tile_docs)
                b = b.take(pa.array(np.argsort(b.column("id").to_numpy(zero_copy_only=False), kind="stable")))
                ids, length = b.column("id").to_pylist(), b.column("n").to_numpy()
                count = np.diff(b.column("term").offsets.to_numpy())
                row, term = np.repeat(np.arange(len(count)), count), b.column("term").flatten().to_numpy()
                tf = b.column("tf").flatten().to_numpy().astype(np.int64)
                impact = impacts(tf, np.repeat(length, count), n_docs, total).astype(np.float64)
                for tile in tiles:
                    best.add(tile[0], score_tile(len(ids), row, term, impact, tile, look)[:, :n_items - tile[0]], ids)
        if type_ is not None:
            at = [(i, -s, x) for i, found in enumerate(best.rows) for s, x in found]
            yield pa.record_batch({"item": pa.array([x[0] for x in at], pa.int32()), "id": pa.array([x[2] for x in at], type_), "score": pa.array([x[1] for x in at], pa.int64())})
    return postings.mapInArrow(run, f"item int, id {kind}, score long")


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", k: int = 10, tile_docs: int = 512, tile_items: int = 64, tile_terms: int = 4096,
                   round_entries: int = 1 << 20) -> DataFrame:
    """``(item, rank, document, score)`` under the columns' own names: the ``k``
    highest-scoring documents (score above 0) of every item, ties to the smaller id.

    One pass over the texts counts their terms and keeps, for the items' terms
    only, a compact table of counts; lengths and document frequencies come from
    it.  The second pass lays ``tile_docs`` documents' impacts and
    ``tile_items`` items' weights over the item tile's own vocabulary (in
    vocabulary tiles of ``tile_terms``) and multiplies the dense tiles in
    float64.  Every tile's sums stay below 2^53 and are added as integers, so
    scores are exact.  A task keeps ``k`` documents an item; the rest is a
    top-k of those.

    Items are worked off in rounds that hold at most ``round_entries`` different
    (item, term) pairs, or one item if it alone holds more: this bounds what is
    broadcast.  Each round reads all documents.

    Null texts and texts without a term have no terms: such documents count
    nowhere, such items get no rows.  Every document row counts as a document,
    repeated rows too; one with a null id counts in the statistics and is not
    ranked.  Items with a null id take no part; repeated item rows count once,
    and different texts under one item id are one item with the terms of all.
    Empty tables give no rows."""
    spark = docs.sparkSession
    ship_package(spark)
    entries = saved(_item_terms(items, item_col, item_text_col), "lexical-items")
    kind, id_kind = (t.schema[c].dataType.simpleString() for t, c in ((items, item_col), (docs, id_col)))
    sizes = entries.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    n_items, n_entries, largest = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    rounds, deal = max(1, -(-n_entries // round_entries)), lambda m: F.pmod(F.xxhash64("item"), F.lit(m))
    while rounds > 1 and rounds < n_items and sizes.groupBy(deal(rounds).alias("r")).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] > max(round_entries, largest):
        rounds *= 2
    found = []
    for r in range(rounds if n_items else 0):
        mine = [(x["item"], bytes(x["term"]), x["q"]) for x in entries.where(deal(rounds) == r).collect()]
        if not mine:
            continue
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, t, _ in mine}))}
        names = {x: i for i, x in enumerate(sorted({x for x, _, _ in mine}))}
        with arrow_rows(spark, 512):
            postings = saved(_postings(docs, id_col, text_col, spark.sparkContext.broadcast(vocabulary)), "lexical-postings")
        n_docs, total = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        df = {x["t"]: x["count"] for x in postings.select(F.explode("term").alias("t")).groupBy("t").count().collect()}
        e = np.array(sorted((names[x], vocabulary[t], q * term_weight(n_docs, df.get(vocabulary[t], 0))) for x, t, q in mine), dtype=np.int64)
        tiles = build_tiles(e[:, 0], e[:, 1], e[:, 2], tile_items, tile_terms)
        fitted = spark.sparkContext.broadcast((n_docs, total, tiles, len(names), len(vocabulary)))
        best = _best_of_tasks(postings.where(F.col("id").isNotNull()), fitted, id_kind, k, tile_docs)
        by = Window.partitionBy("item").orderBy(F.desc("score"), "id")
        top = best.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
        named = spark.createDataFrame([(i, x) for x, i in names.items()], f"n int, name {kind}")
        top = top.join(F.broadcast(named), F.col("item") == F.col("n")).select("name", "rank", "id", "score")
        found.append(saved(top, "lexical-top") if rounds > 1 else top)
    out = found[0] if found else spark.createDataFrame([], f"name {kind}, rank int, id {id_kind}, score long")
    for f in found[1:]:
        out = out.unionByName(f)
    return out.select(F.col("name").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
