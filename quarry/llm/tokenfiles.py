"""Token-id files: a concatenated id array with Elias-Fano document boundaries."""
from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import arrow_rows, filesystem, parallelism, scratch, write_atomic

__all__ = ["EliasFano", "byte_bpe_encoder", "encode_block", "decode_block", "write_token_files", "read_token_files", "file_bases", "token_digests"]

_EVERY = 256  # ones between two entries of the select directory


class EliasFano:
    """Non-decreasing integers below ``bound``: the low bits side by side, the
    high bits as unary gaps, and a sampled directory for select."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, directory: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.directory = n, low_bits, low, high, directory

    @classmethod
    def of(cls, values: np.ndarray, bound: int) -> EliasFano:
        v = np.asarray(values, dtype=np.int64)
        n = len(v)
        l = max(0, (max(bound, 1) // max(n, 1)).bit_length() - 1)
        bits = ((v[:, None] >> np.arange(l)) & 1).astype(np.uint8)
        low = np.packbits(bits.ravel(), bitorder="little")
        ones = (v >> l) + np.arange(n)
        high = np.zeros((int(ones[-1]) + 1 if n else 0), dtype=np.uint8)
        high[ones] = 1
        return cls(n, l, low, np.packbits(high, bitorder="little"), ones[::_EVERY].astype("<u4" if not n or ones[-1] < 1 << 32 else "<u8"))

    def _lows(self, a: int, b: int) -> np.ndarray:
        l = self.low_bits
        first, last = a * l // 8, (b * l + 7) // 8
        bits = np.unpackbits(self.low[first:last], bitorder="little")[a * l - first * 8:][: (b - a) * l]
        return bits.reshape(b - a, l).astype(np.int64) @ (np.int64(1) << np.arange(l)) if l else np.zeros(b - a, dtype=np.int64)

    def select(self, i: int) -> int:
        """The i-th value, reading one directory entry and a short run of bits."""
        at = int(self.directory[i // _EVERY])
        left, byte = i % _EVERY, at // 8
        bits = np.unpackbits(self.high[byte:byte + 1], bitorder="little")
        bits[: at % 8] = 0
        while (found := int(bits.sum())) <= left:
            left -= found
            byte += 1
            bits = np.unpackbits(self.high[byte:byte + 1], bitorder="little")
        pos = byte * 8 + int(np.flatnonzero(bits)[left])
        return ((pos - i) << self.low_bits) | int(self._lows(i, i + 1)[0])

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        return ((ones - np.arange(self.n)) << self.low_bits) | self._lows(0, self.n)

    def pack(self) -> bytes:
        wide = self.directory.dtype.itemsize
        return struct.pack("<QBBQQQ", self.n, self.low_bits, wide, len(self.low), len(self.high), len(self.directory)) \
            + self.low.tobytes() + self.high.tobytes() + self.directory.tobytes()

    @classmethod
    def unpack(cls, data: memoryview) -> tuple[EliasFano, int]:
        n, l, wide, a, b, c = struct.unpack_from("<QBBQQQ", data)
        at = struct.calcsize("<QBBQQQ")
        low = np.frombuffer(data, np.uint8, a, at)
        high = np.frombuffer(data, np.uint8, b, at + a)
        d = np.frombuffer(data, f"<u{wide}", c, at + a + b)
        return cls(n, l, low, high, d), at + a + b + c * wide


# --- one block (file) -----------------------------------------------------------
_MAGIC = b"EFTK0001"


def encode_block(doc_ids: list, lengths: np.ndarray, ids: list[bytes], width: int) -> list[bytes]:
    """File contents: magic, id width, documents and ids; the documents' ids (a
    null one has its flag set); the Elias-Fano coded ends; the id array."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    null = np.packbits(np.array([d is None for d in doc_ids], dtype=np.uint8), bitorder="little").tobytes()
    plain = np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes()
    ef = EliasFano.of(ends, total + 1).pack()
    return [_MAGIC, struct.pack("<BQQQ", width, len(doc_ids), total, len(ef)), null, plain, ef, *ids]


def decode_block(data: bytes) -> tuple[list, EliasFano, np.ndarray]:
    """``(document ids, ends, id array)`` of a file's contents."""
    view = memoryview(data)
    if bytes(view[:8]) != _MAGIC:
        raise ValueError("not a token file")
    width, n, total, n_ef = struct.unpack_from("<BQQQ", view, 8)
    at = 8 + struct.calcsize("<BQQQ")
    null = np.unpackbits(np.frombuffer(view, np.uint8, (n + 7) // 8, at), bitorder="little")[:n]
    at += (n + 7) // 8
    plain = np.frombuffer(view, "<i8", n, at)
    at += 8 * n
    ef, size = EliasFano.unpack(view[at:at + n_ef])
    if size != n_ef:
        raise ValueError("damaged token file")
    ids = np.frombuffer(view, f"<u{width}", total, at + n_ef)
    return [None if z else int(d) for d, z in zip(plain, null)], ef, ids


# --- encoding -------------------------------------------------------------------
# every white space but the four of _BLANK, as a class for Arrow's patterns
_ODD_SPACE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in map(chr, range(0x3001)) if c.isspace() and c not in " \t\n\r") + "]"
_BLANK = " \t\n\r"
_IS_BLANK = np.isin(np.arange(256), [ord(c) for c in _BLANK])
_ENCODERS: dict = {}


class _ByteBpe:
    """Ids of texts by the tokenizers library, as little-endian bytes.

    Where the tokenizer parts texts by the usual byte-level pattern, a token
    never spans a blank after a non-blank, so all texts of a batch are cut
    there, on their bytes, and each distinct piece is encoded once: the pieces
    go to the library side by side in long strings, whose ids are parted again
    where a token begins with a blank after one that does not end with one.
    Texts with rarer kinds of blank, and other tokenizers, go to the library
    whole; so do texts that hold an added token, which with ``added_tokens``
    gets its own id, as by the library's plain call, and else is ordinary text
    where it is a special one."""

    def __init__(self, path: str, end_id: int, added_tokens: bool = False):
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = not added_tokens
        self.added = sorted({x.content for x in self.lib.get_added_tokens_decoder().values() if x.content and (added_tokens or not x.special)})
        pre = self.lib.pre_tokenizer
        self.cut = type(pre).__name__ == "ByteLevel" and pre.use_regex and not pre.add_prefix_space \
            and self.lib.normalizer is None and type(self.lib.model).__name__ == "BPE"
        size = self.lib.get_vocab_size()
        self.width = 2 if max(size, end_id + 1) <= 1 << 16 else 4
        self.end = end_id.to_bytes(self.width, "little")
        blank = {"Ġ", "ĉ", "Ċ", "č"}  # blank, tab, line feed, carriage return as byte-level symbols
        self.begins, self.ends = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        for t, i in self.lib.get_vocab().items():
            self.begins[i], self.ends[i] = t[:1] in blank, t[-1:] in blank

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Concatenated ids of the texts, and where each text's begin."""
        flat, n = [], []
        for i in range(0, len(texts), 64):  # the library's own results are large: a few at a time
            ids = [e.ids for e in self.lib.encode_batch_fast(texts[i:i + 64], add_special_tokens=False)]
            n += map(len, ids)
            flat.append(np.fromiter(chain.from_iterable(ids), dtype=f"<u{self.width}", count=sum(n[i:])))
        return np.concatenate([np.zeros(0, dtype=f"<u{self.width}"), *flat]), np.concatenate([[0], np.cumsum(n, dtype=np.int64)])

    def _pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces: a pool of ids, and each piece's place and number.
        Pieces from a blank to a non-blank are encoded in rows, the rest singly."""
        at, data = _layout(words)
        row = _IS_BLANK[data[at[:-1]]] & ~_IS_BLANK[data[at[1:] - 1]]
        place, n = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        pool = np.zeros(0, dtype=f"<u{self.width}")
        if row.any():
            x, text = _layout(words.filter(pa.array(row)))
            text = text.tobytes()
            cut = np.append(x[:-1:256], x[-1])
            pool, _ = self._ids([text[a:b].decode() for a, b in zip(cut[:-1], cut[1:])])
            first = self.begins[pool]
            first[1:] &= ~self.ends[pool[:-1]]
            where = np.append(np.flatnonzero(first), len(pool))
            if len(where) != len(x):
                raise AssertionError("a token spans a cut")
            place[row], n[row] = where[:-1], np.diff(where)
        if not row.all():
            flat, where = self._ids(words.filter(pa.array(~row)).to_pylist())
            place[~row], n[~row] = where[:-1] + len(pool), np.diff(where)
            pool = np.concatenate([pool, flat])
        return pool, place, n

    def _cut(self, t: pa.Array) -> list[np.ndarray]:
        """Ids of texts that are cut at blanks."""
        at, data = _layout(t)
        if not len(data):
            return [np.zeros(0, dtype=f"<u{self.width}")] * len(t)
        blank = _IS_BLANK[data]
        start = np.zeros(len(data) + 1, dtype=bool)
        start[1:-1] = blank[1:] & ~blank[:-1]
        start[at] = True
        where = np.flatnonzero(start).astype(np.int32)
        del blank, start
        pieces = pa.StringArray.from_buffers(len(where) - 1, pa.py_buffer(where), pa.py_buffer(data)).dictionary_encode()
        pool, place, n = self._pieces(pieces.dictionary)
        code = pieces.indices.to_numpy()
        each = n.astype(np.int32)[code]
        end = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])
        small = np.int32 if max(end[-1], len(pool)) < 1 << 31 else np.int64
        shift = place.astype(small)[code]
        shift -= end[:-1].astype(small)
        idx = np.repeat(shift, each)
        idx += np.arange(end[-1], dtype=small)
        flat = pool[idx]
        doc = end[np.searchsorted(where, at)]
        return [flat[a:b] for a, b in zip(doc[:-1], doc[1:])]

    def __call__(self, t: pa.Array) -> list[bytes]:
        """Ids of each text with the end id, as little-endian bytes."""
        t = t.cast(pa.string()).fill_null("")
        if not self.cut:
            whole = np.ones(len(t), dtype=bool)
        else:
            whole = pc.match_substring_regex(t, _ODD_SPACE).to_numpy(zero_copy_only=False)
            for x in self.added:
                whole = whole | pc.match_substring(t, x).to_numpy(zero_copy_only=False)
        out: list = [None] * len(t)
        for where, encode in ((whole, self._together), (~whole, self._cut)):
            if where.any():
                for i, x in zip(np.flatnonzero(where), encode(t if where.all() else t.filter(pa.array(where)))):
                    out[i] = x.tobytes() + self.end
        return out

    def _together(self, t: pa.Array) -> list[np.ndarray]:
        flat, at = self._ids(t.to_pylist())
        return [flat[a:b] for a, b in zip(at[:-1], at[1:])]


def _layout(t: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string array."""
    at = np.frombuffer(t.buffers()[1], dtype=np.int32)[t.offset:t.offset + len(t) + 1].astype(np.int64)
    data = np.frombuffer(t.buffers()[2], dtype=np.uint8)[at[0]:at[-1]] if t.buffers()[2] is not None else np.zeros(0, np.uint8)
    return at - at[0], data


def byte_bpe_encoder(path: str, end_id: int = 0, added_tokens: bool = False) -> Callable[[], _ByteBpe]:
    """Factory of the encoder; a worker builds it once and keeps it.  With
    ``added_tokens`` the tokenizer's special tokens in a text get their own ids."""
    def make() -> _ByteBpe:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        key = path, end_id, added_tokens
        if key not in _ENCODERS:
            _ENCODERS[key] = _ByteBpe(*key)
        return _ENCODERS[key]
    return make


def _by_size(b: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` bytes of ``t``."""
    n = pc.fill_null(pc.binary_length(b.column("t")), 0).to_numpy().cumsum() // most
    cut = [0, *(np.flatnonzero(n[1:] != n[:-1]) + 1).tolist(), b.num_rows]
    for at, end in zip(cut, cut[1:]):
        if end > at:
            yield b.slice(at, end - at)


# --- tables <-> files -----------------------------------------------------------
def write_token_files(docs: DataFrame, make_encoder: Callable[[], _ByteBpe], folder: str, id_col: str = "doc_id",
                      text_col: str = "text", file_bytes: int = 16 << 20) -> DataFrame:
    """Write ids in ascending ``id_col`` order (null first, then repeated ids by
    text) as files below ``folder``; returns the manifest ``(name, n_docs,
    n_tokens)``, whose name order is the document order.  Names carry the task's
    attempt, and the manifest those of the attempts that Spark committed: files
    of lost or doubled attempts are never read.

    Rows are dealt by range, and each task encodes its range in order into
    files of about ``file_bytes``: nothing but the texts moves.  A null or
    empty text is its end id alone; an empty table gives no files."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("t"))
    src = src.repartitionByRange(parallelism(spark), "d", F.xxhash64("t")).sortWithinPartitions("d", "t") \
        .select(F.coalesce("d", F.lit(0)).alias("d"), F.col("d").isNull().alias("z"), "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encode, task, out = make_encoder(), TaskContext.get(), []
        ids, lens, parts, size = [], [], [], 0

        def flush() -> None:
            nonlocal ids, lens, parts, size
            if ids:
                name = f"ids-{task.partitionId():07d}-{len(out):05d}-{task.taskAttemptId()}.eftk"
                write_atomic(folder, name, encode_block(ids, np.array(lens), parts, encode.width))
                out.append((name, len(ids), int(sum(lens))))
            ids, lens, parts, size = [], [], [], 0
        for b in batches:
            for part_of in _by_size(b, 8 << 20):
                for d, null, x in zip(part_of.column("d").to_pylist(), part_of.column("z").to_pylist(), encode(part_of.column("t"))):
                    ids.append(None if null else int(d))
                    lens.append(len(x) // encode.width)
                    parts.append(x)
                    size += len(x)
                    if size >= file_bytes:
                        flush()
                pa.default_memory_pool().release_unused()
        flush()
        c = list(zip(*out)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.string()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64())],
                                         names=["name", "n_docs", "n_tokens"])
    done = scratch(spark, "token-manifest")
    with arrow_rows(spark, 2048):
        src.mapInArrow(run, "name string, n_docs long, n_tokens long").write.parquet(done)
    return spark.read.schema("name string, n_docs long, n_tokens long").parquet(done)


def file_bases(manifest: DataFrame) -> DataFrame:
    """``(name, base)``: ids in all files before; one row a file, of 16 MB each."""
    before = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select("name", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids binary)`` from the manifest's files: ``start``
    counts the ids of all documents before; ``ids`` are little-endian unsigned
    32-bit."""
    files = file_bases(manifest).repartition(parallelism(spark))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        for b in batches:
            for name, base in zip(b.column("name").to_pylist(), b.column("base").to_pylist()):  # one file at a time
                with fs.open_input_file(f"{path}/{name}") as f:
                    docs, ef, ids = decode_block(f.read())
                ends = ef.all()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                for at in range(0, len(docs), 512):
                    k = slice(at, at + 512)
                    cols = (docs[k], starts[k] + base, ends[k] - starts[k], [ids[x:y].astype("<u4").tobytes() for x, y in zip(starts[k], ends[k])])
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "start", "n_tokens", "ids"])
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def token_digests(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files."""
    return read_token_files(spark, folder, manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
