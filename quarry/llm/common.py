"""Shared helpers of the training-data operators: scratch tables, files and byte spans."""
from __future__ import annotations

import contextlib
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

__all__ = ["scratch", "ship_package", "saved", "own_prefix", "arrow_rows", "filesystem", "write_atomic", "merge_spans", "parallelism", "table", "document_path"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_path() -> Column:
    """The path of a row of ``documents``: ``source/lang/doc_id.txt``."""
    return F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-{name}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the executors: its sources as a zip below the
    shared checkpoint folder, added once per application (what ``--py-files``
    does at submission; executors that have the package lose nothing)."""
    import hashlib
    import io
    import os
    import zipfile

    import quarry
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(quarry.__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, names in sorted(os.walk(root)):
            z.writestr(zipfile.ZipInfo(os.path.join("quarry", os.path.relpath(d, root), "").replace("/./", "/")), b"")  # packages without __init__ need it
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(d, n)
                    z.write(path, os.path.join("quarry", os.path.relpath(path, root)))
    data = buf.getvalue()
    folder, name = ensure_checkpoint_dir(spark).rstrip("/"), f"quarry-{hashlib.sha256(data).hexdigest()[:16]}.zip"
    write_atomic(folder, name, [data])
    sc.addPyFile(f"{folder}/{name}")
    _SHIPPED.add(sc.applicationId)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and reread it:
    cuts the lineage, compresses, and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, most: int):
    """Arrow batches of at most ``most`` rows for the jobs that run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= most:
        spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def own_prefix(df: DataFrame) -> str:
    """A prefix that no column of ``df`` has, for helper columns beside its own."""
    p = "_q"
    while any(c.lower().startswith(p) for c in df.columns):
        p += "q"
    return p + "_"


def parallelism(spark: SparkSession) -> int:
    """Partitions for a CPU-bound shuffle: the session's own shuffle parallelism."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def filesystem(uri: str):
    """``(pyarrow filesystem, path)`` of a URI or of an absolute local path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def write_atomic(folder: str, name: str, chunks) -> int:
    """Write ``name`` under a name of this attempt and move it into place, so that
    a retried or speculative task leaves one whole file.  Returns its size."""
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    tmp, n = f"{path}/_attempt-{uuid.uuid4().hex}", 0
    with fs.open_output_stream(tmp) as f:
        for c in chunks:
            f.write(c)
            n += len(c)
    fs.move(tmp, f"{path}/{name}")
    return n


def merge_spans(spans) -> list[tuple[int, int]]:
    """Sorted disjoint union of half-open spans (touching spans merge)."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        elif b > a:
            out.append((a, b))
    return out


def min_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` points over the links ``(i, j)``."""
    lab = np.arange(n)
    while len(i):
        lo = np.minimum(lab[i], lab[j])
        new = lab.copy()
        np.minimum.at(new, lab[i], lo)
        np.minimum.at(new, lab[j], lo)
        np.minimum.at(new, i, lo)
        np.minimum.at(new, j, lo)
        while True:
            up = new[new]
            if np.array_equal(up, new):
                break
            new = up
        if np.array_equal(new, lab):
            break
        lab = new
    return lab


def is_(df_col: str):
    """Null-safe equality of a column of both join sides, for ``left``/``right`` aliases."""
    return F.col(f"l.{df_col}").eqNullSafe(F.col(f"r.{df_col}"))
