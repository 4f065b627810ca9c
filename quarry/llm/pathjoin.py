"""MinHash near-dedup: a chosen-path set similarity join, and components of its links."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_rows, min_labels, parallelism, saved, ship_package
from quarry.llm.components import connected_components

__all__ = ["COORDINATES", "shingle_set", "signature", "set_profiles", "near_duplicates"]

COORDINATES = 64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_M1, _M2, _K = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_A, _B = (np.frombuffer(hashlib.shake_256(f"minwise-{x}".encode()).digest(8 * COORDINATES), "<u8") | np.uint64(1) for x in "ab")
_SLICE = 512


class _WordHashes(dict):
    """64-bit hash of a word, kept for the words met first."""

    def __missing__(self, w: bytes) -> int:
        from xxhash import xxh64_intdigest
        h = xxh64_intdigest(w, 13)
        if len(self) < 1 << 19:
            self[w] = h
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(33))) * _M2
    return h ^ (h >> np.uint64(33))


def shingle_set(text: bytes | None, n: int, known: _WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles; of fewer words, of their whole sequence."""
    words = (text or b"").translate(_LOWER).split()  # bytes.split() parts exactly at 0x20 and 0x09-0x0D
    if not words:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    m = min(n, len(w))
    h = np.full(len(w) - m + 1, m, dtype=np.uint64)
    for j in range(m):
        h = _mix(h * _K + w[j:len(w) - m + 1 + j])
    return np.unique(h)


def signature(h: np.ndarray) -> np.ndarray:
    """For each coordinate the smallest of the shingles' values under its own hash, 32 bits."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(h), _SLICE):
        x = h[at:at + _SLICE, None] * _A
        x += _B
        np.minimum(low, x.min(axis=0), out=low)
    return (low >> np.uint64(32)).astype("<u4")


def set_profiles(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(id, n, key, sig)`` of every row: the size of its shingle set, 128 bits that
    name the set, and its minwise signature; without words 0, null, null."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for b in batches:
            n, key, sig = [], [], []
            for t in b.column("t"):
                h = shingle_set(t.as_py(), shingle, known)
                n.append(len(h))
                key.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                sig.append(signature(h).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary())], ["id", "n", "key", "sig"])
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n long, key binary, sig binary")


# --- the tree ------------------------------------------------------------------------
def _value(c: Column | int) -> Column:
    """A coordinate's value in ``sig``."""
    return F.substring("sig", c * 4 + 1, F.lit(4)) if isinstance(c, Column) else F.substring("sig", c * 4 + 1, 4)


def _coordinates(tree: int, branches: float) -> list[int]:
    """The root's coordinates: one, and further ones with the fraction of ``branches``
    beyond it, dealt evenly over the trees; each of nine trees has its own."""
    n = int((tree + 1) * branches) - int(tree * branches)
    return [(5 * tree + 45 * i) % COORDINATES for i in range(n)]


def _roots(classes: DataFrame, trees: range, branches: float) -> DataFrame:
    """``(node, cid, comp, up)``: every class in the nodes of the first level of each
    tree; ``up`` is the size of the node above (of no bound here)."""
    nodes = [F.xxhash64(F.lit(t), F.lit(c), _value(c)) for t in trees for c in _coordinates(t, branches)]
    return classes.select("cid", "comp", F.lit((1 << 63) - 1).alias("up"), F.explode(F.array(*nodes)).alias("node"))


def _branch(members: DataFrame, classes: DataFrame, branches: float) -> DataFrame:
    """The next level: a node picks its coordinates by its own hash, for all its
    members alike, and a member goes to the child of its value."""
    pick = lambda k: F.pmod(F.xxhash64("node", F.lit(k)), F.lit(COORDINATES)).cast("int")
    more = F.pmod(F.xxhash64("node", F.lit(-1)), F.lit(1 << 20)) < F.lit(int((branches - int(branches)) * (1 << 20)))
    ks = F.when(more, F.sequence(F.lit(0), F.lit(int(branches)))).otherwise(F.sequence(F.lit(0), F.lit(int(branches) - 1)))
    rows = members.select("node", "cid", F.col("size").alias("up")).join(classes.select("cid", "sig", "comp"), "cid") \
        .withColumn("c", F.explode(F.array_distinct(F.transform(ks, pick))))
    return rows.select("cid", "comp", "up", F.xxhash64("node", "c", _value(F.col("c"))).alias("node"))


def _members(rows: DataFrame) -> DataFrame:
    """``(node, cid, comp, size, up, first, last)`` of the nodes that hold more than
    one component; ``first`` and ``last`` are two of the node's members.  Nodes
    without work are dropped by an aggregate, before any member moves."""
    stat = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                    F.min("cid").alias("first"), F.max("cid").alias("last")).where("size > 1 AND lo != hi")
    return saved(rows.join(stat.drop("lo", "hi"), "node"), "path-members")


def _dealt(members: DataFrame, part_rows: int) -> DataFrame:
    """Large nodes, compared whole: ``(unit, cid, side)``.  Members of the node's
    largest component need no comparison among themselves, so parts of the others
    meet each other and every part of it: as many rows as members where the
    others are one part."""
    per = members.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("k"))
    top = per.groupBy("node").agg(F.max_by("comp", F.struct("k", "comp")).alias("top"), F.max("k").alias("k"))
    cut = lambda n: F.greatest(F.ceil(n / part_rows), F.lit(1)).cast("int")
    m = members.join(top, "node").withColumn("mx", cut(F.col("size") - F.col("k"))).withColumn("mg", cut(F.col("k")))
    m = m.withColumn("big", F.col("comp") == F.col("top")).withColumn("s", F.pmod(F.xxhash64("cid", F.lit(5)), F.when(F.col("big"), F.col("mg")).otherwise(F.col("mx"))).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    unit = lambda kind, x, y, side: F.struct(F.xxhash64("node", F.lit(kind), x, y).alias("unit"), side.cast("int").alias("side"))
    s = F.col("s")
    others = F.transform(upto(F.col("mx")), lambda t: unit(0, F.least(s, t), F.greatest(s, t), s > t))
    to_big = F.transform(upto(F.col("mg")), lambda t: unit(1, s, t, F.lit(0)))
    as_big = F.transform(upto(F.col("mx")), lambda t: unit(1, t, s, F.lit(1)))
    return m.select("cid", F.explode(F.when(F.col("big"), as_big).otherwise(F.concat(others, to_big))).alias("x")).select("x.unit", "cid", "x.side")


# --- comparison ------------------------------------------------------------------------
def _runs(p: pd.DataFrame, key: str) -> np.ndarray:
    x = p[key].to_numpy()
    return np.cumsum(np.append([False], x[1:] != x[:-1])) if len(x) else np.zeros(0, dtype=np.int64)


def _whole_runs(batches: Iterator[pd.DataFrame], key: str, solve) -> Iterator[pd.DataFrame]:
    """``solve`` over frames that hold every run of ``key`` whole."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        x = b[key].to_numpy()
        cut = int(np.argmax(x == x[-1])) if x[0] != x[-1] or (held and held[-1][key].iloc[-1] != x[0]) else None
        if cut is None:
            held.append(b)
            continue
        yield solve(pd.concat([*held, b.iloc[:cut]], ignore_index=True) if held else b.iloc[:cut].reset_index(drop=True))
        held = [b.iloc[cut:]]
    if held:
        yield solve(pd.concat(held, ignore_index=True))


def _alike(run, sig, n, comp, side, cutoff: int, share: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one run, of different components, that the signatures and set sizes
    let be similar: each row against the d-th row after it, for all runs at once.
    Rows of a run are in order of size."""
    mixed = np.zeros(int(run.max(initial=-1)) + 1, dtype=bool)
    mixed[run[side > 0]] = True
    d, at = 1, np.arange(len(run) - 1)
    while len(at):
        at = at[at + d < len(run)]
        at = at[(run[at] == run[at + d]) & (100 * n[at] >= share * n[at + d])]
        ok = at[(comp[at] != comp[at + d]) & ((side[at] != side[at + d]) | ~mixed[run[at]])]
        for k in range(0, len(ok), 1 << 14):
            i = ok[k:k + (1 << 14)]
            hit = i[(sig[i] == sig[i + d]).sum(axis=1) >= cutoff]
            if len(hit):
                yield hit, hit + d
        d += 1


def _matrix(sig) -> np.ndarray:
    return np.frombuffer(b"".join(sig), dtype="<u4").reshape(-1, COORDINATES)


def _candidates(units: DataFrame, classes: DataFrame, cutoff: int, share: int, most: int) -> DataFrame:
    """``(group, cid, side)``: members of each unit that signatures connect.  Equal
    groups from different nodes and trees are one.  A group whose sets hold over
    ``most`` shingles is split into pairs of parts."""
    rows = units.join(classes.select("cid", "n", "sig", "comp"), "cid")
    rows = rows.repartition(parallelism(units.sparkSession), "unit").sortWithinPartitions("unit", "n", "cid")

    def solve(p: pd.DataFrame) -> pd.DataFrame:
        run, n, cid, side = _runs(p, "unit"), p["n"].to_numpy(), p["cid"].to_numpy(), p["side"].to_numpy()
        pairs = list(_alike(run, _matrix(p["sig"]), n, p["comp"].to_numpy(), side, cutoff, share))
        out: list[tuple[int, int, int]] = []
        if pairs:
            lab = min_labels(len(p), *(np.concatenate(x) for x in zip(*pairs)))
            size = np.bincount(lab, minlength=len(lab))
            order = np.argsort(lab, kind="stable")
            order = order[size[lab[order]] > 1]
            for own in np.split(order, np.flatnonzero(np.diff(lab[order])) + 1):
                cross, part = bool(side[own].any()), np.cumsum(n[own]) // most
                names = np.unique(part)
                name = cid[own].tobytes() + (side[own].tobytes() if cross else b"")
                for x in names:
                    for y in names[names >= x]:
                        g = int.from_bytes(hashlib.blake2b(name + b"%d,%d" % (x, y), digest_size=8).digest(), "little", signed=True)
                        pick = (part == x) | (part == y)
                        s = side[own] if cross else part == max(y, x + 1)  # across the parts only, where there are two
                        out += [(g, int(c), int(t)) for c, t in zip(cid[own][pick], s[pick])]
        return pd.DataFrame(out, columns=["grp", "cid", "side"]).astype({"grp": "int64", "cid": "int64", "side": "int32"})
    return rows.mapInPandas(lambda bs: _whole_runs(bs, "unit", solve), "grp long, cid long, side int").distinct()


def _similar(a: np.ndarray, b: np.ndarray, share: int) -> bool:
    """100 * intersection >= share * union, on the full sets."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= share * (len(a) + len(b) - both)


def _confirmed(groups: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, cutoff: int, share: int) -> DataFrame:
    """``(u, v)``: links between classes of a group, confirmed on their full sets; as a
    spanning forest of the group, beyond the components known."""
    spark = docs.sparkSession
    wanted = saved(classes.join(groups.select("cid").distinct(), "cid", "left_semi").select("cid", "key", "rep"), "path-wanted")
    few = wanted.count() * 64 <= 64 << 20
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("t")) \
        .join(F.broadcast(wanted) if few else wanted, F.col("id").eqNullSafe(F.col("rep"))).select("cid", "key", "t")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for b in batches:
            cid, out = [], []
            for c, k, t in zip(b.column("cid"), b.column("key"), b.column("t")):
                h = shingle_set(t.as_py(), shingle, known).tobytes()
                if hashlib.blake2b(h, digest_size=16).digest() == k.as_py():  # ids may repeat with other texts
                    cid.append(c.as_py())
                    out.append(h)
            if cid:
                yield pa.record_batch({"cid": pa.array(cid, pa.int64()), "h": pa.array(out, pa.binary())})
    with arrow_rows(spark, 256):
        full = saved(src.mapInArrow(sets, "cid long, h binary").groupBy("cid").agg(F.first("h").alias("h")), "path-sets")
        rows = groups.join(full, "cid").join(classes.select("cid", "sig", "comp"), "cid").withColumn("n", F.length("h")) \
            .repartition(parallelism(spark), "grp").sortWithinPartitions("grp", "n", "cid", "side")

        def solve(p: pd.DataFrame) -> pd.DataFrame:
            run, cid, side = _runs(p, "grp"), p["cid"].to_numpy(), p["side"].to_numpy()
            sig, comp, n = _matrix(p["sig"]), p["comp"].to_numpy(), p["n"].to_numpy()
            pairs = [np.concatenate(x) for x in zip(*_alike(run, sig, n, comp, side, cutoff, share))]
            if not pairs:
                return pd.DataFrame({"u": cid[:0], "v": cid[:0]})
            i, j = pairs
            full = [np.frombuffer(h, dtype=np.uint64) for h in p["h"]]
            up: dict = {}  # components known, and those found here

            def find(x):
                while x in up:
                    x = up[x]
                return x
            u, v = [], []
            for k in np.argsort(-(sig[i] == sig[j]).sum(axis=1), kind="stable"):
                x, y = find((run[i[k]], comp[i[k]])), find((run[j[k]], comp[j[k]]))
                if x != y and _similar(full[i[k]], full[j[k]], share):
                    up[x] = y
                    u.append(cid[i[k]])
                    v.append(cid[j[k]])
            return pd.DataFrame({"u": np.array(u, dtype=np.int64), "v": np.array(v, dtype=np.int64)})
        return saved(rows.mapInPandas(lambda bs: _whole_runs(bs, "grp", solve), "u long, v long").distinct(), "path-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, share: int = 85,
                    trees: int = 8, branches: float = 1.25, node_rows: int = 128, levels: int = 8, part_rows: int = 512,
                    unit_shingles: int = 1 << 22) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` per row: the smallest id that links of
    similar shingle sets (``100 * intersection >= share * union``) reach, itself
    included, and whether that is the row's own.

    Equal sets are one class.  A chosen-path tree branches the classes by minwise
    tokens: a node picks one coordinate of the signature, with the fraction of
    ``branches`` another, and its members go to the child of their token there.
    Two sets of similarity s meet in a child with probability s for each
    coordinate, so pairs above the threshold meet ``branches * s`` > 1 times a
    level, others die out.  Nodes of at most ``node_rows`` are compared
    exhaustively: set sizes and signatures (at most about five standard
    deviations below the threshold) first, then the full sets.  ``trees``
    independent trees bring the chance to miss a pair at the very threshold
    below 1e-6 where two or three levels suffice.

    Components need no more than a spanning forest.  So one further tree goes
    first, whose large nodes are compared in parts, each part along with two
    members common to all parts; this joins a large group of near copies, and
    the trees behind it drop every node that lies in one component, and every
    pair of one.  Large nodes that keep over half of the node above them, or are
    at the last of ``levels``, are compared whole, in parts.

    A text of fewer words is one shingle; a null or blank one has none and links
    to nothing.  Rows that share an id are rows of their own; a null id names no
    component (its row gets the smallest id reachable, null if there is none,
    and is kept in that case alone).  An empty table gives no rows."""
    spark = docs.sparkSession
    ship_package(spark)
    cutoff = int(COORDINATES * (share / 100 - 5 * (share / 100 * (1 - share / 100) / COORDINATES) ** 0.5))
    with arrow_rows(spark, 512):
        rows = saved(set_profiles(docs, id_col, text_col, shingle), "path-profiles")
    classes = rows.where("n > 0").groupBy("key").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    classes = saved(classes.withColumn("cid", F.monotonically_increasing_id()), "path-classes").withColumn("comp", F.col("cid"))

    # one tree, large nodes in parts that share two members
    m = _members(_roots(classes, range(1), 2.0))
    parts = m.where(F.col("size") > node_rows).withColumn("m", F.ceil(F.col("size") / node_rows).cast("int"))
    own = parts.select(F.xxhash64("node", F.pmod(F.xxhash64("cid"), F.col("m")).cast("int")).alias("unit"), "cid")
    ends = parts.select("node", "m", F.explode(F.array("first", "last")).alias("cid")).distinct() \
        .select("cid", F.explode(F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda i: F.xxhash64("node", i))).alias("unit"))
    units = m.where(F.col("size") <= node_rows).select(F.col("node").alias("unit"), "cid").unionByName(own).unionByName(ends).distinct()
    groups = saved(_candidates(units.withColumn("side", F.lit(0)), classes, cutoff, share, unit_shingles), "path-groups")
    links = _confirmed(groups, classes, docs, id_col, text_col, shingle, cutoff, share)
    found = connected_components(links, "u", "v")
    classes = saved(classes.drop("comp").join(found, F.col("cid") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "cid")).drop("node", "component"), "path-classes")

    # the trees, over what is not yet one component
    at, units = _roots(classes, range(1, 1 + trees), branches), []
    for level in range(levels):
        m = _members(at)
        units.append(m.where(F.col("size") <= node_rows).select(F.col("node").alias("unit"), "cid", F.lit(0).alias("side")))
        large = m.where(F.col("size") > node_rows)
        alike = F.lit(level == levels - 1) | (2 * F.col("size") > F.col("up"))  # branching does not part these
        units.append(_dealt(large.where(alike), part_rows))
        at = _branch(large.where(~alike), classes, branches)
        if not large.where(~alike).take(1):
            break
    groups = saved(_candidates(reduce(DataFrame.unionByName, units), classes, cutoff, share, unit_shingles), "path-groups")
    more = _confirmed(groups, classes, docs, id_col, text_col, shingle, cutoff, share)
    found = connected_components(links.unionByName(more), "u", "v")
    named = classes.join(found, F.col("cid") == F.col("node"), "left").select("key", "rep", F.coalesce("component", "cid").alias("c"))
    least = named.groupBy("c").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "c").select("key", "component_id")
    out = rows.where("n > 0").join(named, "key").select("id", "n", "component_id").unionByName(rows.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
