"""Repeated-passage removal by a depth-limited most-significant-digit suffix sort.

Every window of ``length`` bytes is assigned to one suffix start inside it (its
anchor: the position whose short gram has the smallest hash, the leftmost of
equals), a choice that depends on the window's bytes alone, so that equal
windows have equal anchors at equal places.  Only anchors are sorted, about one
in ``length / 2`` positions, and only through ``length`` bytes:

1. first digit: the whole span of an anchor's windows (96 bits of a hash).  Anchors that share it
   with another repeat with all their windows.
2. second digit: the half-length string right or left of the anchor, which all
   windows on that side contain.  Spans alone with theirs are done.
3. last digits: what is left is ordered window by window, place by place;
   equal neighbours are exactly the repeated windows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import merge_spans, parallelism, saved
from quarry.operators.joins import sized_broadcast

__all__ = ["anchors", "repeated_spans", "remove_repeats"]

_GRAM = 16
_BLOCK = 1 << 18
_SPREAD = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.random.default_rng(7).integers(1, 1 << 63, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _gram_hash(x: np.ndarray) -> np.ndarray:
    """Hash of the 16 bytes from each position, by doubling."""
    h = _SPREAD[x]
    for i, step in enumerate((1, 2, 4, 8)):
        h = h[:-step] * _MIX[i] + h[step:]
        h ^= h >> np.uint64(29)
    return h


def _anchor_ranges(x: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor, first, last)``: the windows ``first..last`` have this anchor."""
    n = len(x)
    if n < length:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    width = length - _GRAM + 1  # gram starts in a window
    found = []
    for at in range(0, n - length + 1, _BLOCK):
        windows = min(_BLOCK, n - length + 1 - at)
        h = _gram_hash(x[at:at + windows + length - 1])
        # the hash above, the place below: the smallest is the leftmost of equals
        v = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
        m, have = v, 1
        while have < width:  # running minimum by doubling
            step = min(have, width - have)
            m = np.minimum(m[:-step], m[step:])
            have += step
        found.append((m & np.uint64((1 << 20) - 1)).astype(np.int64) + at)
    a = np.concatenate(found)
    new = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    return a[new], new, np.append(new[1:], len(a)) - 1


def anchors(docs: DataFrame, id_col: str, text_col: str, length: int, unique: bool = False) -> DataFrame:
    """One row an anchor: the row's key ``(id, th)``, ``a``, its windows ``a - lo ..
    a + hi`` (``lo``, ``hi`` relative), the span digit ``f`` (96 bits) and the half
    digits ``kr`` and ``kl`` (64 bits; null where no window is on that side)."""
    half = length // 2
    src = _keyed(docs, id_col, text_col, unique)
    schema = f"id {src.schema['id'].dataType.simpleString()}, th long, a long, lo int, hi int, f binary, kr long, kl long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest, xxh3_128_digest
        for b in batches:
            rows, cols, size = [], [[] for _ in range(6)], 0

            def flush() -> pa.RecordBatch:
                row = pa.array(np.concatenate(rows))
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
                return pa.RecordBatch.from_arrays([b.column("id").take(row), b.column("th").take(row)] + [
                    pa.array(np.concatenate(c) if k < 3 else [x for part in c for x in part], kinds[k]) for k, c in enumerate(cols)],
                    names=["id", "th", "a", "lo", "hi", "f", "kr", "kl"])
            for at, t in enumerate(b.column("t")):
                t = t.as_py()
                a, first, last = _anchor_ranges(np.frombuffer(t, dtype=np.uint8), length)
                if not len(a):
                    continue
                view, pos = memoryview(t), a.tolist()
                # a window that starts d before the anchor has d bytes left of it and length - d from it on
                right, left = ((a - last) <= half).tolist(), ((a - first) > half).tolist()
                rows.append(np.full(len(a), at))
                for c, x in zip(cols, (
                        a, first - a, last - a,
                        [xxh3_128_digest(view[s:e])[:12] for s, e in zip(first.tolist(), (last + length).tolist())],
                        [_signed(xxh3_64_intdigest(view[p:p + half])) if r else None for p, r in zip(pos, right)],
                        [_signed(xxh3_64_intdigest(view[p - half:p], 1)) if r else None for p, r in zip(pos, left)])):
                    c.append(x)
                size += len(a)
                if size > 50_000:
                    yield flush()
                    rows, cols, size = [], [[] for _ in range(6)], 0
            if rows:
                yield flush()
    return src.mapInArrow(run, schema)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _keyed(docs: DataFrame, id_col: str, text_col: str, unique: bool) -> DataFrame:
    """Rows by id and, where ids repeat, a hash of id and text (rows alike in both
    are one key); where they do not, the hash is a constant that costs nothing."""
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    th = F.lit(0).cast("long") if unique else F.xxhash64(F.col(id_col), t)
    return docs.select(F.col(id_col).alias("id"), th.alias("th"), t.cast("binary").alias("t"))


def _unique(docs: DataFrame, id_col: str) -> bool:
    return docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def _window_repeats(p: dict, length: int, half: int) -> np.ndarray:
    """For members of whole groups (equal ``side, k, s, t``): which of their windows
    on that side equal a window of another member; bool, members x places.

    Place d is the window that starts d bytes before the anchor.  All members'
    windows of one place are hashed by a rolling update and sorted."""
    right, lo, hi, text = p["side"] == 0, p["lo"], p["hi"], p["bytes"]
    n, places = len(text), max(half, length - half) + 1
    off = np.zeros(n + 1, dtype=np.int64)
    np.cumsum([len(t) for t in text], out=off[1:])
    buf = np.frombuffer(b"".join(text), dtype=np.uint8)
    # two polynomial prefix sums (64 bits each) give the hash of any window
    out = np.zeros((n, places), dtype=bool)
    group = (p["k"].view(np.uint64) * _MIX[2]) ^ ((p["s"] * 65536 + p["t"]).astype(np.uint64) * _MIX[3])
    pow_, inv = _powers(int(max(np.diff(off), default=0)) + 1)
    sums = []
    for r in range(2):
        c = _SPREAD[buf] if r == 0 else _SPREAD[buf ^ 0xA5] * _MIX[1]
        s = np.zeros(len(buf) + 1, dtype=np.uint64)
        rel = np.arange(len(buf)) - np.repeat(off[:-1], np.diff(off))
        np.cumsum(c * pow_[rel], out=s[1:])
        sums.append(s)
    for d in range(places):
        dist = np.where(right, d, d + half + 1)  # bytes before the anchor
        k = np.flatnonzero((-dist >= lo) & (-dist <= hi))
        if len(k) < 2:
            continue
        at = (-dist[k] - lo[k])  # the member's bytes begin at its first window
        i = off[k] + at
        h0 = (sums[0][i + length] - sums[0][i]) * inv[at] ^ group[k]
        h1 = (sums[1][i + length] - sums[1][i]) * inv[at]
        o = np.lexsort((h1, h0, right[k]))
        eq = (h0[o][1:] == h0[o][:-1]) & (h1[o][1:] == h1[o][:-1]) & (right[k][o][1:] == right[k][o][:-1])
        dup = np.zeros(len(k), dtype=bool)
        dup[o[1:][eq]] = True
        dup[o[:-1][eq]] = True
        out[k, d] = dup
    return out


_POWERS: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("p", ())) < n:
        inv = np.uint64(pow(int(_BASE), -1, 1 << 64))
        p, q = np.ones(2 * n, dtype=np.uint64), np.ones(2 * n, dtype=np.uint64)
        np.multiply.accumulate(np.full(2 * n - 1, _BASE), out=p[1:])
        np.multiply.accumulate(np.full(2 * n - 1, inv), out=q[1:])
        _POWERS.update(p=p, q=q)
    return _POWERS["p"], _POWERS["q"]


def _places_to_spans(hit: np.ndarray, right: bool, a: int, length: int, half: int) -> list[tuple[int, int]]:
    d = np.flatnonzero(hit) + (0 if right else half + 1)
    return merge_spans((int(a - x), int(a - x + length)) for x in d)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                   group_rows: int = 512, most_parts: int = 64, unique: bool | None = None) -> DataFrame:
    """``(id, th, spans array<struct<s,e>>)``: per row key the byte spans that a
    window of ``length`` bytes found elsewhere covers (unmerged).

    A group of up to ``group_rows`` different spans that share a half digit is
    ordered in one place.  A larger one is dealt into parts of that size, and
    each pair of parts is ordered by itself; beyond ``most_parts`` parts its
    windows are counted one by one by an aggregate, which grows in proportion."""
    half = length // 2
    unique = _unique(docs, id_col) if unique is None else unique
    a = saved(anchors(docs, id_col, text_col, length, unique), "suffix-anchors")
    spans = saved(a.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "th", "a", "lo", "hi", "kr", "kl")).alias("x"))
                  .select("f", "n", "x.*"), "suffix-spans")
    whole = a.join(spans.where("n > 1").select("f"), "f", "left_semi") \
        .select("id", "th", F.struct((F.col("a") + F.col("lo")).alias("s"), (F.col("a") + F.col("hi") + length).alias("e")).alias("sp"))
    # second digit: sides that another span shares and on which one span is still alone
    sides = spans.select("f", "n", "id", "th", "a", "lo", "hi", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("kr").alias("k")), F.struct(F.lit(1).alias("side"), F.col("kl").alias("k")))).alias("y")) \
        .select("n", "id", "th", "a", "lo", "hi", "y.side", "y.k").where("k is not null")
    open_ = sides.groupBy("side", "k").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).where("m > 1 and least = 1") \
        .select("side", "k", "m")
    cand = sides.join(open_, ["side", "k"])
    want = cand.groupBy("id", "th").agg(F.collect_list(F.struct("side", "k", "m", "n", "a", "lo", "hi")).alias("c"))
    want = saved(want, "suffix-wanted")  # few documents have any; broadcast only if its measured size allows
    text = _keyed(docs, id_col, text_col, unique).alias("l")
    got = text.join(sized_broadcast(want).alias("r"), (F.col("l.th") == F.col("r.th")) & F.col("l.id").eqNullSafe(F.col("r.id"))) \
        .select("l.id", "l.th", F.explode("r.c").alias("c"), "l.t") \
        .select("id", "th", "c.*", F.expr(f"substring(t, cast(c.a + c.lo + 1 as int), c.hi - c.lo + {length})").alias("bytes"))
    got = saved(got, "suffix-open")
    parts = F.ceil(F.col("m") / group_rows)
    few = got.where(parts <= most_parts).withColumn("p", F.pmod(F.xxhash64("id", "th", "a"), parts)) \
        .withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))) \
        .withColumn("s", F.least("p", "q")).withColumn("t", F.greatest("p", "q")).drop("p", "q", "m")
    group = ["side", "k", "s", "t"]
    few = few.repartition(parallelism(docs.sparkSession), *group).sortWithinPartitions(*group)
    key = f"id {got.schema['id'].dataType.simpleString()}, th long"

    def solve(t: pa.Table) -> pa.RecordBatch | None:
        p = {c: t.column(c).to_numpy().astype(np.int64) for c in ("side", "k", "s", "t", "n", "a", "lo", "hi")}
        p["bytes"] = t.column("bytes").to_pylist()
        hit = _window_repeats(p, length, half)
        keep = np.flatnonzero((p["n"] == 1) & hit.any(axis=1))
        spans = [[{"s": s, "e": e} for s, e in _places_to_spans(hit[i], p["side"][i] == 0, p["a"][i], length, half)] for i in keep]
        row = pa.array(keep)
        return pa.RecordBatch.from_arrays([t.column("id").combine_chunks().take(row), t.column("th").combine_chunks().take(row), pa.array(
            spans, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))], names=["id", "th", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            if not t.num_rows:
                continue
            new = np.zeros(max(t.num_rows - 1, 0), dtype=bool)
            for c in group:
                x = t.column(c).to_numpy()
                new |= x[1:] != x[:-1]
            ends = np.flatnonzero(new) + 1  # whole groups; the last may go on
            at = 0
            for e in ends:
                if e - at >= 2048 or e == ends[-1]:
                    yield solve(t.slice(at, e - at))
                    at = int(e)
            held = t.slice(at)
        if held is not None and held.num_rows:
            yield solve(held)
    solved = few.mapInArrow(run, f"{key}, spans array<struct<s:long,e:long>>")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                c = part.to_pydict()
                row, starts, w = [], [], []
                for i, (side, a, lo, hi, t) in enumerate(zip(c["side"], c["a"], c["lo"], c["hi"], c["bytes"])):
                    d = [x for x in range(max(-hi, 0), -lo + 1) if (x <= half) == (side == 0)]
                    row += [i] * len(d)
                    starts += [a - x for x in d]
                    w += [xxh3_128_digest(t[-x - lo:-x - lo + length], x) for x in d]
                i = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("id").take(i), part.column("th").take(i), part.column("n").take(i),
                                                  pa.array(starts, pa.int64()), pa.array(w, pa.binary())], names=["id", "th", "n", "s", "w"])
    many = got.where(parts > most_parts).mapInArrow(windows, f"{key}, n long, s long, w binary")
    twice = many.groupBy("w").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("w")
    single = many.where("n = 1").join(twice, "w", "left_semi") \
        .select("id", "th", F.struct("s", (F.col("s") + length).alias("e")).alias("sp"))
    parts = whole.unionByName(single).groupBy("id", "th").agg(F.collect_list("sp").alias("spans")) \
        .unionByName(solved.select("id", "th", "spans"))
    return parts.groupBy("id", "th").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """Per row ``(id_col, n_bytes, spans, kept binary)``: the text's bytes without
    those that a string of ``length`` bytes covers which also starts anywhere
    else in the table, the same text included; judged on the input.  ``spans``
    are the maximal removed runs.

    A null text is empty; texts shorter than ``length`` stay whole; repeated
    rows repeat each other, so all their windows go; an empty table gives no
    rows."""
    unique = _unique(docs, id_col)
    spans = repeated_spans(docs, id_col, text_col, length, unique=unique).alias("r")
    j = _keyed(docs, id_col, text_col, unique).alias("l").join(spans, (F.col("l.th") == F.col("r.th")) & F.col("l.id").eqNullSafe(F.col("r.id")), "left") \
        .select("l.id", "l.t", "r.spans")
    idt = j.schema["id"].dataType.simpleString()
    spans_type = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first in range(0, b.num_rows, 256):
                part = b.slice(first, 256)
                sp, kept, size = [], [], []
                for t, s in zip(part.column("t"), part.column("spans")):
                    t, s = t.as_py(), s.as_py()
                    m = merge_spans((x["s"], x["e"]) for x in s or [])
                    at, out = 0, []
                    for x, y in m:
                        out.append(t[at:x])
                        at = y
                    kept.append(b"".join([*out, t[at:]]))
                    sp.append([{"s": x, "e": y} for x, y in m])
                    size.append(len(t))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(size, pa.int64()), pa.array(sp, spans_type), pa.array(kept, pa.binary())],
                                                 names=["id", "n_bytes", "spans", "kept"])
    return j.mapInArrow(run, f"id {idt}, n_bytes long, spans array<struct<s:long,e:long>>, kept binary").withColumnRenamed("id", id_col)


def removal_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """The counts and the digest of :func:`remove_repeats`."""
    r = remove_repeats(docs, id_col, text_col, length)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["e"] - x["s"])
    return r.select(id_col, "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                    F.sha2("kept", 256).alias("kept_sha256"))
