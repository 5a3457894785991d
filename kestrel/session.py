"""Session construction and the shared checkpoint folder.

On a cluster the checkpoint folder is whatever ``spark.checkpoint.dir`` names
(a shared file system).  Only when nothing is configured -- local tests -- do we
pick a scratch folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "kestrel", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, wiring it into the SparkContext.

    Reads ``spark.checkpoint.dir`` from the session.  Where it is absent, a scratch
    folder is chosen in local mode only (one machine, as in tests); on a cluster,
    whose executors would not share it, that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="kestrel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if "://" not in configured:
        os.makedirs(configured, exist_ok=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark):
    """Shuffle files of the queries run inside go when each of them ends, not when the driver's
    collector finds them: what such a query gives is written, and nothing reads its shuffles again."""
    old = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, old)


def cut_lineage(df):
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    One job writes it; the returned frame scans the files, so its lineage is
    cut and a lost executor costs a re-read, not a recomputation.
    """
    import uuid
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/kestrel-tables/{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.parquet(path)
    out = spark.read.parquet(path)
    out._cut_path = path
    return out


def drop_cut(*frames) -> None:
    """Delete tables of ``cut_lineage`` that nothing reads any more; other frames are left alone."""
    for df in frames:
        path = getattr(df, "_cut_path", None)
        if path:
            target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
            df._cut_path = None
