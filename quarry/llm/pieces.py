"""SentencePiece encoding and decoding with a max-plus scan over giant documents.

A segmentation of a text is a path over nodes ``(end, piece)``.  The model of
this library's files merges by rank (BPE), for which the weight of a step from
one piece to the next is 0 if the two stand side by side in the encoding of
their concatenation, and minus infinity if they do not: the one path of weight
0 is the encoding.  (Any part of an encoding between two of its cuts is the
encoding of that part, and pieces whose neighbours all agree admit no merge
across a cut.)

A chunk of a giant document is a max-plus matrix from the nodes that can end
just before or across its start to those that can end before or across its
end; with weights 0 and minus infinity it is the set of entries of weight 0.
Matrices are combined associatively; with the entry node known, each chunk is
traced back by itself.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import own_prefix, parallelism, saved

__all__ = ["PieceModel", "load", "encode", "chunk_matrix", "combine", "trace"]

_LOADED: dict = {}


class PieceModel:
    """A SentencePiece BPE model: the library for whole texts, and the weights
    between pieces for the scan."""

    def __init__(self, path: str):
        import sentencepiece
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            # a second normalizer message merges into the model's: no blank in front, none removed
            self.raw = sentencepiece.SentencePieceProcessor(model_proto=f.read() + b"\x1a\x04\x18\x00\x20\x00")
        lib = self.lib
        plain = [i for i in range(lib.get_piece_size()) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.ids = {lib.id_to_piece(i): i for i in plain}
        self.longest = max(map(len, self.ids))
        # where no piece has a blank after another character, each blank after one is a cut
        self.blank_cuts = all("▁" not in p.lstrip("▁") for p in self.ids)
        self.memo: dict[tuple[str, str], bool] = {}

    def normal(self, text: str) -> str:
        """The text as pieces see it: normalised, blanks as U+2581, one in front."""
        return self.lib.normalize(text)

    def encode_raw(self, normal: str) -> list[int]:
        """Ids of a stretch of normalised text that begins and ends at cuts."""
        return self.raw.encode(normal) if normal else []

    def pieces_ending(self, s: str, end: int) -> list[str]:
        out = [s[end - n:end] for n in range(1, min(self.longest, end) + 1) if s[end - n:end] in self.ids]
        if s[end - 1] not in self.ids:  # an unknown character stands alone, as bytes
            out.append(s[end - 1])
        return out

    def agrees(self, a: str, b: str) -> bool:
        """Whether the weight of the step from ``a`` to ``b`` is 0."""
        key = (a, b)
        hit = self.memo.get(key)
        if hit is None:
            if len(self.memo) > 500_000:
                self.memo.clear()
            hit = self.memo[key] = self.encode_raw(a + b) == self.encode_raw(a) + self.encode_raw(b) \
                and (a in self.ids or len(a) == 1) and (b in self.ids or len(b) == 1)
        return hit


def load(path: str) -> PieceModel:
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = PieceModel(path)
    return _LOADED[path]


# A node is (end, piece) with end absolute in the normalised text; START stands before it.
START = (0, "")


def _steps(m: PieceModel, s: str, off: int, sources: dict, lo: int, hi: int) -> dict:
    """Forward over ends ``lo < end <= hi``: which of the sources reach each node
    with weight 0.  ``s`` begins at ``off``; sources: node -> set of labels."""
    at: dict[int, dict[str, frozenset]] = {}
    for (end, p), labels in sources.items():
        at.setdefault(end, {})[p] = frozenset(labels)
    for end in range(lo + 1, hi + 1):
        here: dict[str, frozenset] = {}
        for p in m.pieces_ending(s, end - off):
            reach: frozenset = frozenset()
            for q, labels in at.get(end - len(p), {}).items():
                if not labels <= reach and (q == "" or m.agrees(q, p)):
                    reach |= labels
            if reach:
                here[p] = reach
        if here:
            old = at.get(end, {})
            at[end] = {**old, **here}
    return at


def _cuts(m: PieceModel, s: str, off: int, lo: int, hi: int) -> tuple[int, int] | None:
    """First and last certain cut of a chunk that no piece across ``lo`` or ``hi``
    can hide: before a blank that follows another character."""
    if not m.blank_cuts:
        return None
    cut = [x for x in (_next_cut(s, off, lo + 1, hi - m.longest + 1, 1), _next_cut(s, off, hi - m.longest, lo, -1)) if x is not None]
    return (cut[0], cut[1]) if cut else None


def _next_cut(s: str, off: int, start: int, stop: int, step: int) -> int | None:
    return next((x for x in range(start, stop, step) if s[x - off] == "▁" and s[x - off - 1] != "▁"), None)


def boundary_nodes(m: PieceModel, s: str, off: int, at: int) -> list[tuple[int, str]]:
    """Nodes a path can hold last before a boundary: it ends at ``end <= at`` and the
    next piece ends beyond ``at``, so ``end > at - longest``."""
    if at == 0:
        return [START]
    out = []
    for end in range(max(at - m.longest + 1, 1), at + 1):
        out += [(end, p) for p in m.pieces_ending(s, end - off)]
    return out + ([START] if at < m.longest else [])


def chunk_matrix(m: PieceModel, s: str, off: int, lo: int, hi: int) -> dict:
    """Entries of weight 0 of the chunk ``(lo, hi]``: exit node -> entry nodes.

    A path leaves the chunk with its last piece ending at or before ``hi``.  If
    certain cuts lie inside, only the stretches before the first and after the
    last are walked: all paths pass the cuts."""
    entry = {n: {n} for n in boundary_nodes(m, s, off, lo)}
    cuts = _cuts(m, s, off, lo, hi)
    if cuts is None:
        return _exits(m, _steps(m, s, off, entry, lo, hi), hi)
    first, last = cuts
    through = frozenset().union(*_steps(m, s, off, entry, lo, first).get(first, {}).values())
    return _exits(m, _steps(m, s, off, {(last, ""): through}, last, hi), hi)


def _exits(m: PieceModel, walked: dict, hi: int) -> dict:
    return {(end, p): labels for end in range(max(hi - m.longest + 1, 0), hi + 1) for p, labels in walked.get(end, {}).items()}


def combine(a: dict, b: dict) -> dict:
    """Max-plus product of two adjacent chunks' matrices (exit -> entries)."""
    out = {}
    for exit_, mids in b.items():
        reach = frozenset().union(*[a.get(mid, frozenset()) for mid in mids])
        if reach:
            out[exit_] = reach
    return out


def trace(m: PieceModel, s: str, off: int, lo: int, hi: int, entry: tuple[int, str], exit_: tuple[int, str]) -> list[int]:
    """Ids of the pieces of the chunk's path from ``entry`` (excluded) to ``exit_``
    (included)."""
    if exit_ == entry:
        return []
    cuts = _cuts(m, s, off, lo, hi)
    if cuts is None:
        return _path(m, s, off, entry, exit_[0], exit_[1])
    first, last = cuts
    return _path(m, s, off, entry, first, None) + m.encode_raw(s[first - off:last - off]) + _path(m, s, off, (last, ""), exit_[0], exit_[1])


def _path(m: PieceModel, s: str, off: int, entry: tuple[int, str], end: int, piece: str | None) -> list[int]:
    at = _steps(m, s, off, {entry: {0}}, entry[0], end)
    out: list[str] = []
    while end > entry[0]:
        # one entry: at most one node of weight 0 at each place, the end of the one encoding so far
        here = list(at.get(end, {})) if piece is None else [piece]
        if len(here) != 1 or here[0] not in at.get(end, {}):
            raise AssertionError(f"{len(here)} paths of weight 0 at {end}")
        out.append(here[0])
        end, piece = end - len(here[0]), None
    return [i for p in reversed(out) for i in ([m.ids[p]] if p in m.ids else m.encode_raw(p))]


_STEP = 128  # rows whose ids are Python integers at a time


def _finish(part: pa.RecordBatch, keep: list[str], ids: list, back: list, packed: bool) -> pa.RecordBatch:
    """Rows with their ids (packed, or as an array) and the text they decode to."""
    if packed:
        col = pa.array([None if x is None else np.asarray(x, dtype="<u4").tobytes() for x in ids], pa.binary())
    else:
        col = pa.array([None if x is None else np.asarray(x, dtype=np.int32) for x in ids], pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], col, pa.array(back, pa.string())], names=[*keep, "ids", "decoded"])


def encode(docs: DataFrame, model_path: str, text_col: str = "text", giant: int = 32_768, chunk: int = 16_384, packed: bool = False) -> DataFrame:
    """``docs`` with ``ids array<int>`` (SentencePiece ids of the whole text, as the
    library gives them; with ``packed`` as little-endian unsigned 32-bit bytes)
    and ``decoded string`` (the text those ids decode to).

    Texts of up to ``giant`` characters are encoded by one library call each.
    A longer text is cut into chunks of ``chunk`` characters at any place; the
    chunks' matrices are computed in parallel, combined along the document,
    and each chunk is traced by itself, so no task walks a giant document.

    A null text has null ids and a null decoded text, an empty text no ids.
    Columns that are named ``ids`` or ``decoded`` are replaced; repeated rows
    give repeated results.  U+2581 in a text decodes as a blank."""
    keep = [c for c in docs.columns if c.lower() not in ("ids", "decoded")]
    rows = docs.select(*keep)
    p = own_prefix(rows)
    text = text_col if isinstance(docs.schema[text_col].dataType, T.StringType) and text_col in keep else f"{p}t"
    t = F.col(text_col).cast("string")
    if text != text_col:
        rows = docs.select(*keep, t.alias(text))
        t = F.col(text)
    ids_type = T.BinaryType() if packed else T.ArrayType(T.IntegerType())
    out = T.StructType([*[docs.schema[c] for c in keep], T.StructField("ids", ids_type), T.StructField("decoded", T.StringType())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model_path)
        for b in batches:
            for at in range(0, b.num_rows, _STEP):
                part = b.slice(at, _STEP)
                texts = part.column(text).to_pylist()
                some = [x for x in texts if x is not None]
                ids = m.lib.encode(some, num_threads=1) if some else []
                back = m.lib.decode(ids, num_threads=1) if ids else []
                i, j = iter(ids), iter(back)
                yield _finish(part, keep, [None if x is None else next(i) for x in texts], [None if x is None else next(j) for x in texts], packed)
    small = rows.where(F.coalesce(F.char_length(t) <= giant, F.lit(True))).mapInArrow(whole, out)
    large = rows.where(F.char_length(t) > giant)
    texts = large.select(t.alias("t")).distinct().select(F.sha2("t", 256).alias("k"), "t")
    chunks = saved(_chunks(texts, model_path, chunk), "piece-chunks")
    ids = _scan(chunks, model_path, packed).withColumnRenamed("k", f"{p}k")
    return small.unionByName(large.withColumn(f"{p}h", F.sha2(t, 256)).join(ids, F.col(f"{p}h") == F.col(f"{p}k")).select(*keep, "ids", "decoded"))


def _chunks(texts: DataFrame, model_path: str, chunk: int) -> DataFrame:
    """``(k, i, n, lo, hi, off, s)``: chunk i of n of a text; ``s`` is the normalised
    text from ``off`` on, with the characters before that a piece across the
    boundary can reach."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = load(model_path)
        for b in batches:
            for k, t in zip(b["k"], b["t"]):
                s = m.normal(t)
                cuts = [*range(0, max(len(s) - chunk // 2, 1), chunk), len(s)]
                for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    off = max(0, lo - 2 * m.longest)
                    yield pd.DataFrame([(k, i, len(cuts) - 1, lo, hi, off, s[off:hi])], columns=["k", "i", "n", "lo", "hi", "off", "s"])
    out = texts.mapInPandas(run, "k string, i long, n long, lo long, hi long, off long, s string")
    return out.repartition(parallelism(texts.sparkSession), "k", "i")


_NODE = "struct<end:long,piece:string>"


def _scan(chunks: DataFrame, model_path: str, packed: bool) -> DataFrame:
    """``(k, ids, decoded)`` from chunk rows: matrices, their scan, and the traces."""
    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = load(model_path)
        for b in batches:
            out = []
            for k, i, n, lo, hi, off, s in b[["k", "i", "n", "lo", "hi", "off", "s"]].itertuples(index=False):
                x = chunk_matrix(m, s, off, lo, hi)
                blocks: dict = {}  # exits of equal entries together: an outer product is stored as its sides
                for node, labels in x.items():
                    blocks.setdefault(labels, []).append(node)
                as_rows = lambda nodes: [{"end": e, "piece": p} for e, p in sorted(nodes)]
                out.append((k, i, n, hi, [{"exits": as_rows(v), "entries": as_rows(labels)} for labels, v in blocks.items()]))
            yield pd.DataFrame(out, columns=["k", "i", "n", "hi", "m"])
    mat = chunks.mapInPandas(matrices, f"k string, i long, n long, hi long, m array<struct<exits:array<{_NODE}>,entries:array<{_NODE}>>>")

    def scan(p: pd.DataFrame) -> pd.DataFrame:
        """Boundary nodes of one document: the prefix products forward, then the
        one exit node of weight 0 of each chunk backward from the end."""
        p = p.sort_values("i")
        ms = []
        for row in p["m"]:
            ms.append({})
            for x in row:
                labels = frozenset((y["end"], y["piece"]) for y in x["entries"])
                ms[-1].update({(y["end"], y["piece"]): labels for y in x["exits"]})
        prefix = [ms[0]]
        for x in ms[1:]:
            prefix.append(combine(prefix[-1], x))
        end = int(p["hi"].iloc[-1])
        nodes, want = [], [n for n in prefix[-1] if n[0] == end]
        for i in range(len(ms) - 1, -1, -1):
            ok = [n for n in want if n in prefix[i]]
            if len(ok) != 1:
                raise AssertionError(f"{len(ok)} paths of weight 0")
            nodes.append(ok[0])
            want = list(ms[i][ok[0]])
        nodes = [START, *reversed(nodes)]
        return pd.DataFrame({"k": p["k"], "i": p["i"], "entry_end": [n[0] for n in nodes[:-1]], "entry_piece": [n[1] for n in nodes[:-1]],
                             "exit_end": [n[0] for n in nodes[1:]], "exit_piece": [n[1] for n in nodes[1:]]})
    bounds = mat.groupBy("k").applyInPandas(scan, "k string, i long, entry_end long, entry_piece string, exit_end long, exit_piece string")

    def traces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = load(model_path)
        for b in batches:
            for at in range(0, len(b), _STEP):
                part = b.iloc[at:at + _STEP]
                ids = [np.asarray(trace(m, r.s, r.off, r.lo, r.hi, (r.entry_end, r.entry_piece), (r.exit_end, r.exit_piece)), dtype=np.int32)
                       for r in part.itertuples(index=False)]
                yield pd.DataFrame({"k": part["k"].to_numpy(), "i": part["i"].to_numpy(), "ids": ids})
    traced = chunks.join(bounds, ["k", "i"]).mapInPandas(traces, "k string, i long, ids array<int>")
    whole = traced.groupBy("k").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("i", "ids"))), lambda x: x["ids"])).alias("ids"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model_path)
        for b in batches:
            for at in range(b.num_rows):  # giant documents: one at a time
                part = b.slice(at, 1)
                ids = part.column("ids").to_pylist()
                yield _finish(part, ["k"], ids, [m.lib.decode(x) for x in ids], packed)
    return whole.mapInArrow(decode, f"k string, ids {'binary' if packed else 'array<int>'}, decoded string")


def piece_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``(id_col, n_chars, n_tokens, ids_crc32, round_trip)`` of every document."""
    e = encode(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_t")), model_path, "_t", packed=True, **kw)
    packed = F.coalesce("ids", F.lit(b""))
    return e.select(id_col, F.coalesce(F.char_length("_t"), F.lit(0)).cast("long").alias("n_chars"),
                    (F.octet_length(packed) / 4).cast("long").alias("n_tokens"), F.crc32(packed).alias("ids_crc32"),
                    F.col("decoded").eqNullSafe(F.translate("_t", "▁", " ")).alias("round_trip"))
