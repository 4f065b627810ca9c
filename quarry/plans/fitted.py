"""Models that several queries of a session read, fitted once for the data they were fitted on."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quarry.plans import standins as S

_KEPT: dict = {}


def data_version(spark: SparkSession, d: str, tables: tuple[str, ...]) -> tuple:
    """A number a table that changes with its files' names, sizes or times: summed over
    the scan's metadata, so no list of files reaches the driver."""
    m = "_metadata"
    own = lambda t: S.table(spark, d, t).select(F.xxhash64(f"{m}.file_path", f"{m}.file_size", f"{m}.file_modification_time").alias("h"))
    return tuple(str(own(t).agg(F.sum(F.col("h").cast("decimal(38,0)"))).first()[0]) for t in tables)


def fitted(spark: SparkSession, d: str, name, tables: tuple[str, ...], fit: Callable):
    """``fit()``, once a session, folder and ``name`` while the tables stay the same; a
    fit on older files is released."""
    key, version = (spark.sparkContext.applicationId, d, name), data_version(spark, d, tables)
    if key not in _KEPT or _KEPT[key][0] != version:
        for other in [k for k in _KEPT if k[0] != key[0]]:  # a session that has ended
            del _KEPT[other]
        _KEPT[key] = version, fit()
    return _KEPT[key][1]
