"""Session helpers.

On a cluster the session is supplied by the platform; these helpers only
fill in settings that are unset (tests, local runs).
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quarry", memory: str = "8g") -> SparkSession:
    """Session for tests and the bench (local mode only)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.driver.memory", memory))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names a shared folder there; we never override it.  Only
    when it is unset (local tests) do we create a scratch folder.
    """
    sc = spark.sparkContext
    named, current = sc.getConf().get("spark.checkpoint.dir", None), sc.getCheckpointDir()
    if current:  # setting it again would only nest another folder
        return named or current
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        named = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(named)
    return named


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_parts(df, most: int, rows: int | None = None):
    """``df``, which is stored, dealt evenly to partitions of about ``most`` rows; as it
    is where all its rows are no more.  For steps that keep their rows as objects,
    many times the bytes that a split of the files or a coalesced shuffle had, and
    for rows that a join left in few of the partitions."""
    rows = df.count() if rows is None else rows
    return df if rows <= most else cut_lineage(df.repartition(max(-(-rows // most), df.rdd.getNumPartitions())))
