"""SimHash near-duplicates: fingerprints, tiled exact comparison, components."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import min_labels, own_prefix, parallelism, saved
from quarry.llm.components import connected_components

__all__ = ["fingerprints", "link_classes", "near_duplicates", "keep_one_of_each"]

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SLICE = 1 << 15  # shingles whose bits are unpacked at a time


def _shingle_hashes(text: bytes, n: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of each n-word shingle, in slices of bounded size."""
    from xxhash import xxh64_intdigest
    w = text.translate(_LOWER).split()  # bytes.split() parts exactly at 0x20 and 0x09-0x0D
    if not w:
        return
    if len(w) <= n:
        yield np.array([xxh64_intdigest(b" ".join(w), 42)], dtype=np.uint64)
        return
    m = len(w) - n + 1
    for at in range(0, m, _SLICE):
        part = w[at:min(at + _SLICE, m) + n - 1]
        grams = map(b" ".join, zip(*[part[i:] for i in range(n)]))
        yield np.fromiter((xxh64_intdigest(g, 42) for g in grams), dtype=np.uint64)


def _votes(h: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(len(h), 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def _fingerprint(text: bytes | None, n: int) -> int:
    votes, total = np.zeros(64, dtype=np.int64), 0
    for h in _shingle_hashes(text or b"", n):
        votes += _votes(h)
        total += len(h)
    bits = (2 * votes > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id_col, fingerprint long)`` of every row: a bit is 1 if it is set in more
    than half of the shingles' hashes, repeats included.  A text of fewer words
    is one shingle; a null, empty or blank text has fingerprint zero."""
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(np.fromiter((_fingerprint(t, shingle) for t in b), dtype=np.int64, count=len(b)))
    return docs.select(F.col(id_col), run(F.col(text_col).cast("string").cast("binary")).alias("fingerprint"))


def _tile_links(fp: np.ndarray, pc: np.ndarray, side: np.ndarray | None, radius: int, tile: int):
    """Linked index pairs of one run, ordered by population count: tile by tile,
    tiles too far apart in population count are skipped.  ``side``: with two
    sides, only pairs across them."""
    n = len(fp)
    for i in range(0, n, tile):
        a = slice(i, min(i + tile, n))
        for j in range(i, n, tile):
            if pc[j] - pc[a.stop - 1] > radius:
                break
            b = slice(j, min(j + tile, n))
            near = np.bitwise_count(fp[a, None] ^ fp[None, b]) <= radius
            if side is not None:
                near &= side[a, None] != side[None, b]
            x, y = np.nonzero(near)
            if i == j:
                x, y = x[x < y], y[x < y]
            yield x + i, y + j


def _short_run_links(run: np.ndarray, fp: np.ndarray, pc: np.ndarray, radius: int):
    """The same for many short runs at once: each row against the d-th row after it."""
    d, at = 1, np.arange(len(run) - 1)
    while len(at):
        at = at[at + d < len(run)]
        at = at[(run[at] == run[at + d]) & (pc[at + d] - pc[at] <= radius)]
        hit = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= radius]
        yield hit, hit + d
        d += 1


def link_classes(classes: DataFrame, radius: int = 3, tile: int = 1024, bucket_rows: int = 8192) -> DataFrame:
    """Links ``(u, v)`` that join every two fingerprint classes within ``radius``
    bits, directly or over links within their bucket.  ``classes``: ``(node,
    fingerprint)``, each fingerprint once.

    Two fingerprints within r bits agree in one of r + 1 blocks of their bits,
    so only tiles of one block value meet; within such a bucket, rows are
    ordered by population count and tile pairs farther apart than the radius
    are skipped.  A bucket of more than ``bucket_rows`` is dealt over several
    tasks, as pairs of parts.  Each task sends one link a row at most (a
    spanning forest of what it found), never all pairs."""
    blocks = radius + 1
    edge = [round(i * 64 / blocks) for i in range(blocks + 1)]
    cut = F.array(*[F.struct(F.lit(i).alias("j"), F.shiftrightunsigned("fingerprint", edge[i])
                             .bitwiseAND(F.lit((1 << (edge[i + 1] - edge[i])) - 1)).alias("v")) for i in range(blocks)]) \
        if blocks <= 64 else None
    rows = classes.select("node", "fingerprint", F.bit_count("fingerprint").alias("pc"), F.explode(cut).alias("k")) \
        .select("node", "fingerprint", "pc", "k.*")
    big = rows.groupBy("j", "v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows) \
        .select("j", "v", F.ceil(F.col("n") / bucket_rows).cast("int").alias("m"))
    r = rows.join(big, ["j", "v"], "left").withColumn("m", F.coalesce("m", F.lit(1)))
    r = r.withColumn("s", F.pmod(F.xxhash64("fingerprint"), F.col("m")).cast("int"))
    r = r.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("m") - 1))) \
        .select("node", "fingerprint", "pc", "j", "v", "s", F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b"))
    key = ["j", "v", "a", "b"]
    r = r.repartition(parallelism(classes.sparkSession), *key).sortWithinPartitions(*key, "pc", "fingerprint")

    def solve(p: pd.DataFrame) -> pd.DataFrame:
        fp = p["fingerprint"].to_numpy().view(np.uint64)
        pc = p["pc"].to_numpy().astype(np.int64)
        node = p["node"].to_numpy()
        new = np.zeros(len(p), dtype=bool)
        new[0] = True
        for c in key:
            x = p[c].to_numpy()
            new[1:] |= x[1:] != x[:-1]
        run = np.cumsum(new)
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(p)))
        long = size > 64
        li, lj = [], []
        small = np.flatnonzero(~np.repeat(long, size))
        if len(small) > 1:
            for i, j in _short_run_links(run[small], fp[small], pc[small], radius):
                li.append(small[i])
                lj.append(small[j])
        a, b, s = (p[c].to_numpy() for c in ("a", "b", "s"))
        for at, n in zip(start[long], size[long]):
            part = slice(at, at + n)
            for i, j in _tile_links(fp[part], pc[part], s[part] if a[at] != b[at] else None, radius, tile):
                if len(i):
                    x = min_labels(n, i, j)  # what a tile pair found, as a forest
                    k = np.flatnonzero(x != np.arange(n))
                    li.append(k + at)
                    lj.append(x[k] + at)
        if not li:
            return pd.DataFrame({"u": node[:0], "v": node[:0]})
        x = min_labels(len(p), np.concatenate(li), np.concatenate(lj))
        k = np.flatnonzero(x != np.arange(len(p)))
        return pd.DataFrame({"u": node[k], "v": node[x[k]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for b in batches:
            if not len(b):
                continue
            p = b if held is None else pd.concat([held, b], ignore_index=True)
            same = np.ones(len(p), dtype=bool)
            for c in key:
                same &= p[c].to_numpy() == p[c].iloc[-1]
            cut_at = int(np.argmax(same))  # the last run may go on in the next batch
            if cut_at:
                yield solve(p.iloc[:cut_at].reset_index(drop=True))
            held = p.iloc[cut_at:].reset_index(drop=True)
        if held is not None and len(held):
            yield solve(held)
    return r.mapInPandas(run, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """Per row ``(id_col, fingerprint long, component_id)``: the smallest id that
    links of ``radius`` or fewer differing bits reach, itself included.

    Rows of one fingerprint are one class, compared once, so copies cost
    nothing beyond their aggregate.  Rows with a null id take part in no
    comparison of their own: they get the component of their fingerprint (null
    if only null ids have it).  Repeated rows give repeated results; an empty
    table gives no rows."""
    fps = saved(fingerprints(docs, id_col, text_col, shingle), "simhash")
    classes = saved(fps.where(F.col(id_col).isNotNull()).groupBy("fingerprint").agg(F.min(id_col).cast("long").alias("node")), "simhash-classes")
    links = link_classes(classes, radius)
    cc = connected_components(links, "u", "v")
    named = classes.join(cc, "node", "left").select("fingerprint", F.coalesce("component", "node").alias("component_id"))
    return fps.join(named, "fingerprint", "left").select(id_col, "fingerprint", "component_id")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                     radius: int = 3) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, all columns
    kept.  Of rows that repeat an id, one stays (smallest text).  Rows with a
    null id, which no component can name, stay, once for each text."""
    from pyspark.sql import Window
    near = near_duplicates(docs, id_col, text_col, shingle, radius)
    p = own_prefix(docs)
    kept = near.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias(f"{p}kept")).distinct()
    # the window reads the join's own partitions: the texts move once
    named = docs.where(F.col(id_col).isNotNull()).join(kept, F.col(id_col) == F.col(f"{p}kept"), "left_semi") \
        .withColumn(f"{p}first", F.row_number().over(Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_last())))
    nameless = docs.where(F.col(id_col).isNull()) \
        .withColumn(f"{p}first", F.row_number().over(Window.partitionBy(F.sha2(F.col(text_col).cast("string"), 256)).orderBy(F.lit(1))))
    return named.unionByName(nameless).where(f"{p}first = 1").drop(f"{p}first")
