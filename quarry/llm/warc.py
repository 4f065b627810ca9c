"""WARC archives: a writer with revisit records and a splittable reader."""
from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import filesystem, parallelism, saved, write_atomic

__all__ = ["classify_payloads", "write_warc", "read_warc"]

_MAGIC = b"\x1f\x8b\x08"
_DATE = "2025-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = re.compile(rb"<urn:x-page:(-?\d+)>")
_READ = 1 << 20


def classify_payloads(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", least: int = 100) -> DataFrame:
    """``(id, digest, refers_to)`` of the rows whose payload of ``least`` bytes or
    more is that of a row with a smaller id.  Only digests are shuffled.  Rows
    with a null id come after all others and refer to the smallest id; rows that
    repeat the smallest id are responses."""
    d = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("p")) \
        .where(F.octet_length("p") >= least).select("id", F.sha2("p", 256).alias("digest"))
    first = d.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1 and first is not null").select("digest", "first")
    return d.join(first, "digest").where(~F.col("id").eqNullSafe(F.col("first"))).distinct() \
        .select("id", "digest", F.col("first").alias("refers_to"))


def _line(s: str) -> bytes:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", s).encode()


def _record(page_id, url, payload: bytes, refers_to, length: int, digest: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    kind, block = (b"response", http + payload) if refers_to is None else (b"revisit", http)
    name = b"none" if page_id is None else b"%d" % page_id
    head = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: <urn:x-page:" + name + b">", b"WARC-Date: " + _DATE.encode(),
            b"WARC-Payload-Digest: sha256:" + digest.encode(), b"Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append(b"WARC-Target-URI: " + _line(url))
    if refers_to is not None:
        head += [b"WARC-Profile: " + _PROFILE.encode(), b"WARC-Refers-To: <urn:x-page:%d>" % refers_to]
    head.append(b"Content-Length: %d" % len(block))
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               least: int = 100, file_bytes: int = 64 << 20) -> DataFrame:
    """Write one record a row, each a gzip member of its own, into ``*.warc.gz``
    files of about ``file_bytes`` below ``folder``; returns ``(name, n_records)``
    of the files of the attempts that Spark committed (pass it to
    :func:`read_warc`, which then leaves out those of lost attempts).

    A payload of ``least`` bytes or more that another row with a smaller id has
    too becomes a revisit of that row, without the body.  A null payload is
    empty, a null url has no target line, a null id the record name ``none``."""
    spark = pages.sparkSession
    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("p"))
    src = src.select("id", "url", "p", F.octet_length("p").alias("n"), F.sha2("p", 256).alias("digest"))
    dup = saved(classify_payloads(pages, id_col, payload_col, least), "warc-revisits").alias("r")
    src = src.alias("l").join(dup, F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.digest") == F.col("r.digest")), "left") \
        .select("l.id", "l.url", F.col("r.refers_to"), "l.n", "l.digest",
                F.when(F.col("r.refers_to").isNull(), F.col("l.p").cast("binary")).alias("p"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        task, out, held, size = TaskContext.get(), [], [], 0

        def flush() -> None:
            nonlocal held, size
            if held:
                name = f"pages-{task.partitionId():07d}-{len(out):05d}-{task.taskAttemptId()}.warc.gz"
                write_atomic(folder, name, held)
                out.append((name, len(held)))
            held, size = [], 0
        for b in batches:
            for i, url, to, n, digest, p in zip(b["id"].array, b["url"], b["refers_to"].array, b["n"], b["digest"], b["p"]):
                x = _record(None if pd.isna(i) else int(i), None if pd.isna(url) else url, p or b"", None if pd.isna(to) else int(to), int(n), digest)
                held.append(x)
                size += len(x)
                if size >= file_bytes:
                    flush()
        flush()
        yield pd.DataFrame(out, columns=["name", "n_records"]).astype({"n_records": "int64", "name": object})
    # ids as nullable integers: NaN would round large ones
    src = src.withColumn("id", F.col("id").cast("decimal(19,0)")).withColumn("refers_to", F.col("refers_to").cast("decimal(19,0)"))
    return saved(src.mapInPandas(run, "name string, n_records long"), "warc-manifest")


# --- reader ---------------------------------------------------------------------
class _Window:
    """Bytes of a file from a position on, read as needed."""

    def __init__(self, f, at: int, size: int):
        self.f, self.base, self.size, self.buf = f, at, size, bytearray()

    def has(self, at: int, n: int) -> bool:
        while at + n > self.base + len(self.buf) and self.base + len(self.buf) < self.size:
            self.f.seek(self.base + len(self.buf))
            got = self.f.read(_READ)
            if not got:
                break
            self.buf += got
        return at + n <= self.base + len(self.buf)

    def bytes(self, at: int, n: int) -> bytes:
        self.has(at, n)
        return bytes(self.buf[at - self.base:at - self.base + n])

    def drop(self, at: int) -> None:
        if at - self.base > 4 * _READ:
            del self.buf[:at - self.base]
            self.base = at


def _member(w: _Window, at: int) -> tuple[bytes, int] | None:
    """The WARC record whose gzip member starts at ``at`` and where it ends; None
    if no such member starts there."""
    z, out, pos = zlib.decompressobj(31), bytearray(), at
    try:
        while not z.eof:
            x = w.bytes(pos, 1 << 16)
            if not x:
                return None
            out += z.decompress(x)
            pos += len(x)
            if len(out) >= 5 and out[:5] != b"WARC/":
                return None
    except zlib.error:
        return None
    return (bytes(out), pos - len(z.unused_data)) if out[:5] == b"WARC/" else None


def _records(f, start: int, end: int, size: int) -> Iterator[bytes]:
    """Records whose member starts in ``[start, end)``: look for the gzip magic,
    validate by decoding; after a whole member, go on right behind it."""
    w, at = _Window(f, start, size), start
    while at < end:
        w.drop(at)
        if w.bytes(at, 3) == _MAGIC and (got := _member(w, at)):
            yield got[0]
            at = got[1]
            continue
        w.has(at, _READ)
        k = w.buf.find(_MAGIC, at + 1 - w.base)
        if k < 0:
            if w.base + len(w.buf) >= min(size, end + 2):
                return
            at = w.base + len(w.buf) - 2
        else:
            at = w.base + k


def _parse(rec: bytes) -> tuple:
    head, _, rest = rec.partition(b"\r\n\r\n")
    h = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        h[k.strip().lower()] = v.strip()
    block = rest[: int(h[b"content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    digest = h[b"warc-payload-digest"].decode().removeprefix("sha256:")
    kind = h[b"warc-type"].decode()
    name = _RECORD.fullmatch(h[b"warc-record-id"])
    to = _RECORD.fullmatch(h.get(b"warc-refers-to", b""))
    if kind == "response":
        if len(body) != length or hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"record {h[b'warc-record-id']!r}: the payload is not the one that was written")
    url = h.get(b"warc-target-uri")
    return (int(name[1]) if name else None, url.decode() if url is not None else None, kind, int(to[1]) if to else None,
            length, digest, body if kind == "response" else None)


def read_warc(spark: SparkSession, folder: str, manifest: DataFrame | None = None, split_bytes: int = 8 << 20) -> DataFrame:
    """``(page_id, url, record_type, refers_to, payload_bytes, payload_digest,
    payload)`` of every record of the ``*.warc.gz`` files below ``folder`` (of
    those that ``manifest`` names, if it is given).

    Files are cut into byte ranges; a task owns the records whose member starts
    in its range, wherever they end.  Length and digest are those of the full
    payload; a revisit has no payload of its own.  An empty folder gives no
    rows; a damaged payload raises an error."""
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length")
    if manifest is not None:
        files = files.join(manifest.select("name"), F.element_at(F.split("path", "/"), -1) == F.col("name"), "left_semi")
    splits = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)),
                                                                 F.lit(split_bytes).cast("long"))).alias("start"))
    splits = splits.repartition(parallelism(spark))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = [c.split()[0] for c in schema.split(", ")]
        for b in batches:
            for p, size, start in zip(b["path"], b["length"], b["start"]):
                fs, name = filesystem(p)
                held, n = [], 0
                with fs.open_input_file(name) as f:
                    for rec in _records(f, int(start), min(int(start) + split_bytes, int(size)), int(size)):
                        held.append(_parse(rec))
                        n += len(rec)
                        if n > 8 << 20:
                            yield _frame(held, cols)
                            held, n = [], 0
                if held:
                    yield _frame(held, cols)
    return splits.mapInPandas(run, schema)


def _frame(rows: list[tuple], cols: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=cols, dtype=object).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})
