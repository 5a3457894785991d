"""Stream sources and sinks.

Sources: a file stream over a driver table (the table's schema is declared
from the batch reader, never inferred per file).

Sinks: ``run_stream`` drives a streaming DataFrame with ``availableNow``; each
micro-batch is written by ``foreachBatch`` into ``<sink>/epoch=<id>`` with
overwrite, so a replayed batch rewrites its own folder only (exactly-once per
epoch).  The final table is rebuilt at read time:
  * append   -> every row of every epoch;
  * update   -> newest epoch per key (keys given);
  * complete -> rows of the newest epoch.
Checkpoints and sinks live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import ensure_checkpoint_dir


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    r = spark.readStream.schema(schema).option("basePath", sf_dir)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    # A glob keeps the source a directory listing (file sources need a directory base path).
    return r.parquet(f"{sf_dir}/{name}.parque[t]")


#: Type of the rows that only move the watermark at the end of a replay.
CLOSING = "closing"
#: Their user: not null, or a join would leave them out before they reach its watermark.
CLOSING_USER = -2**63


def run_replay(spark: SparkSession, events: DataFrame, name: str, job, slices: int = 3, late_seconds: int = 1800,
               window_minutes: int = 5, timers: bool = False, progress: list | None = None) -> DataFrame:
    """``job(stream of events)`` over several micro-batches in which rows come up to ``late_seconds`` late.

    Rows arrive in ``slices`` spans of their arrival time.  Each span is written to the shared
    folder and the query, restarted from its checkpoint, takes it as one micro-batch.  Closing
    rows follow: one in the window after the last row, one a month later, which lets the
    watermark pass everything else, and one another month later, for stateful operators that
    stand behind others.  They have no id and belong to CLOSING_USER; sinks leave them out."""
    path, sink, ckpt = (scratch(spark, kind, name) for kind in ("replays", "sinks", "streams"))
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(late_seconds)) * 1_000_000
    span = events.agg(F.min(arrival).alias("lo"), F.max(arrival).alias("hi"), F.max("ts").alias("last")).first()
    stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(path)
    df = job(stream)
    if span["lo"] is not None:
        step = (span["hi"] - span["lo"]) // slices + 1
        of = F.floor((arrival - span["lo"]) / step).cast("int")
        after = F.window(F.lit(span["last"]).cast("timestamp"), f"{window_minutes} minutes").end

        def closing(*days):
            ends = spark.range(1).select(F.explode(F.array(*[after + F.expr(f"INTERVAL {d} DAYS") for d in days])).alias("_end"))
            values = {"ts": F.col("_end").cast(events.schema["ts"].dataType), "event_type": F.lit(CLOSING),
                      "user_id": F.expr(f"CAST('{CLOSING_USER}' AS BIGINT)")}
            return ends.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema.fields])

        for i, some in enumerate([*(events.where(of == i) for i in range(slices)), closing(0, 30), closing(60)]):
            some.write.parquet(f"{path}/slice={i}")
            _run(df, name, "append", sink, ckpt, None, progress, timers)
    return read_sink(spark, sink, df.schema, "append", None)


def dir_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int | None = 1) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def scratch(spark: SparkSession, kind: str, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/kestrel-{kind}/{name}/{uuid.uuid4().hex}"


def _run(df: DataFrame, name: str, mode: str, sink: str, ckpt: str, query_name: str | None, progress: list | None,
         timers: bool = False) -> None:
    """What is there now, into ``sink``.  Jobs with timers keep their state in RocksDB."""
    spark = df.sparkSession
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    if timers:
        spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def write(batch: DataFrame, epoch: int):
        batch.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    try:
        q = (df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).queryName(query_name or f"{name}_{uuid.uuid4().hex[:8]}").start())
        q.awaitTermination()
    finally:
        spark.conf.set(provider, before) if before else spark.conf.unset(provider)
    if progress is not None:
        progress += q.recentProgress


def run_stream(df: DataFrame, name: str, mode: str = "append", keys: list | None = None,
               query_name: str | None = None, progress: list | None = None) -> DataFrame:
    """Run ``df`` to completion (availableNow) and return the final sink table; ``progress``
    collects what every micro-batch reported."""
    spark = df.sparkSession
    sink = scratch(spark, "sinks", name)
    ckpt = scratch(spark, "streams", name)
    _run(df, name, mode, sink, ckpt, query_name, progress)
    return read_sink(spark, sink, df.schema, mode, keys)


def read_sink(spark: SparkSession, sink: str, schema, mode: str, keys: list | None) -> DataFrame:
    target = spark._jvm.org.apache.hadoop.fs.Path(sink)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema)  # no micro-batch produced any output
    out = spark.read.parquet(sink)
    cols = [f.name for f in schema.fields]
    if mode == "append":
        return out.select(*cols)
    if mode == "complete":
        newest = out.select(F.max("epoch")).scalar()
        return out.where(F.col("epoch") == newest).select(*cols)
    latest = out.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in cols if c not in keys]), F.col("epoch")).alias("_r"))
    return latest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols if c not in keys])
