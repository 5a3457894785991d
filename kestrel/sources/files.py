"""File sources and sinks with declared schemas.

Readers never infer a schema; JSON logs keep corrupt lines in a separate
frame instead of failing; a missing path yields an empty frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATINGS_CSV = T.StructType([T.StructField("userId", T.IntegerType()), T.StructField("movieId", T.IntegerType()),
                            T.StructField("rating", T.FloatType()), T.StructField("timestamp", T.LongType())])
MOVIES_CSV = T.StructType([T.StructField("movieId", T.IntegerType()), T.StructField("title", T.StringType()),
                           T.StructField("genres", T.StringType())])
REQUEST_LOG = T.StructType([T.StructField("timestamp", T.StringType()), T.StructField("method", T.StringType()),
                            T.StructField("path", T.StringType()), T.StructField("query_params", T.StringType()),
                            T.StructField("status_code", T.IntegerType()), T.StructField("latency_ms", T.DoubleType()),
                            T.StructField("cached", T.BooleanType())])
EXPOSURE_LOG = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("variant", T.StringType()),
                             T.StructField("experiment_id", T.StringType()), T.StructField("n_recs", T.IntegerType()),
                             T.StructField("ts", T.DoubleType()), T.StructField("event_id", T.LongType())])
LOADTEST_STATS = T.StructType([T.StructField("Name", T.StringType()), T.StructField("Request Count", T.LongType()),
                               T.StructField("Failure Count", T.LongType()), T.StructField("Requests/s", T.DoubleType()),
                               T.StructField("50%", T.DoubleType()), T.StructField("95%", T.DoubleType()),
                               T.StructField("99%", T.DoubleType()), T.StructField("Average (ms)", T.DoubleType())])
NO_GENRES = "(no genres listed)"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Ratings CSV (userId, movieId, rating, timestamp) -> (user_id, item_id, rating, ts)."""
    r = spark.read.schema(RATINGS_CSV).option("header", True).csv(path)
    return r.select(F.col("userId").cast("bigint").alias("user_id"), F.col("movieId").cast("bigint").alias("item_id"),
                    F.col("rating").cast("double").alias("rating"),
                    F.timestamp_seconds("timestamp").cast("timestamp_ntz").alias("ts"))


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Movies CSV; a null genres field becomes '(no genres listed)'."""
    m = spark.read.schema(MOVIES_CSV).option("header", True).csv(path)
    return m.select(F.col("movieId").cast("bigint").alias("item_id"), "title",
                    F.coalesce(F.col("genres"), F.lit(NO_GENRES)).alias("genres"))


def write_ratings_csv(df: DataFrame, path: str) -> None:
    df.select(F.col("user_id").cast("int").alias("userId"), F.col("item_id").cast("int").alias("movieId"),
              F.col("rating").cast("float").alias("rating"),
              F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp")).write.mode("overwrite").option(
        "header", True).csv(path)


def write_features(df: DataFrame, path: str, entity: str, ts: str = "event_timestamp") -> int:
    """S3: Parquet (snappy) with columns ordered entity, event_timestamp, features; returns the re-read row count."""
    feats = [c for c in df.columns if c not in (entity, ts)]
    df.select(entity, ts, *feats).write.mode("overwrite").option("compression", "snappy").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def feature_genre_columns(df: DataFrame) -> list:
    """Genre columns of a cached feature table, from its schema."""
    return [c for c in df.columns if c.startswith("genre_")]


def save_feature_cache(spark: SparkSession, tables: dict, path: str) -> None:
    """Named feature tables as Parquet, each in a folder of its name."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def load_feature_cache(spark: SparkSession, path: str, names: list):
    """(tables by name, genre columns in the order of the schemas).  A missing table is an error."""
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in names}
    genres = list(dict.fromkeys(c for df in tables.values() for c in feature_genre_columns(df)))
    return tables, genres


def read_event_log(spark: SparkSession, path: str, schema: T.StructType):
    """JSON lines with a declared schema -> (good, bad).  Blank lines are ignored,
    unparsable lines land in ``bad`` (column ``_corrupt``), a missing path gives empty frames."""
    full = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    if not _exists(spark, path):
        empty = spark.createDataFrame([], full)
        return empty.drop("_corrupt"), empty.select("_corrupt")
    raw = (spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
           .json(path))
    raw = raw.cache()  # a query that references only the corrupt column needs the parsed frame cached
    good = raw.where(F.col("_corrupt").isNull()).drop("_corrupt")
    bad = raw.where(F.col("_corrupt").isNotNull() & (F.trim("_corrupt") != "")).select("_corrupt")
    return good, bad


def write_event_log(df: DataFrame, path: str) -> None:
    """S6 (batch form): JSON lines; the streaming form is ``kestrel.streaming.io.run_stream``."""
    df.write.mode("append").json(path)


def read_request_log(spark: SparkSession, path: str) -> DataFrame:
    """7-column latency CSV -> (ts, method, path, status, latency_ms, cached)."""
    r = spark.read.schema(REQUEST_LOG).option("header", True).csv(path)
    return r.select(F.to_timestamp("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").cast("timestamp_ntz").alias("ts"),
                    "method", "path",
                    F.col("status_code").alias("status"), "latency_ms", "cached")


def write_request_log(req: DataFrame, path: str) -> None:
    req.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "method", "path",
               F.lit("").alias("query_params"), F.col("status").alias("status_code"), "latency_ms",
               "cached").write.mode("overwrite").option("header", True).csv(path)


def write_id_maps(mapping: DataFrame, path: str) -> None:
    """(raw id, dense idx) map as Parquet; read both directions with a join."""
    mapping.write.mode("overwrite").parquet(path)


def read_id_maps(spark: SparkSession, path: str, raw: str, idx: str) -> DataFrame:
    """The map read back.  A raw id or an index that stands twice is an error: joins with the map
    would repeat rows in one direction or the other."""
    m = spark.read.parquet(path)
    for col in (raw, idx):
        if not m.groupBy(col).count().where("count > 1").isEmpty():
            raise ValueError(f"id map {path}: {col} is not unique")
    return m


def resolve_samples(df: DataFrame) -> DataFrame:
    """Accept input_seq | sequence and target_item | label | next_item | target; comma strings
    are split into arrays of ids.  Anything else is an error."""
    cols = set(df.columns)
    seq = next((c for c in ("input_seq", "sequence") if c in cols), None)
    tgt = next((c for c in ("target_item", "label", "next_item", "target") if c in cols), None)
    if seq is None or tgt is None:
        raise ValueError(f"training samples need a sequence and a target column, got {sorted(cols)}")
    s = F.col(seq)
    if isinstance(df.schema[seq].dataType, T.StringType):
        s = F.transform(F.split(F.col(seq), ","), lambda x: F.trim(x).cast("bigint"))
    key = [c for c in ("user_idx", "user_id") if c in cols][:1]
    return df.select(*key, s.alias("input_seq"), F.col(tgt).cast("bigint").alias("target"))


def save_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Small result tables as JSON or CSV (one file per partition; reports are small)."""
    w = df.write.mode("overwrite")
    (w.json(path) if fmt == "json" else w.option("header", True).csv(path))


def read_loadtest_stats(spark: SparkSession, path: str) -> DataFrame:
    """Load-test stats CSV -> per-endpoint totals with SLA flags."""
    s = spark.read.schema(LOADTEST_STATS).option("header", True).csv(path)
    return s.select(F.col("Name").alias("name"), F.col("Request Count").alias("requests"),
                    F.col("Failure Count").alias("failures"), F.col("Requests/s").alias("rps"),
                    F.col("95%").alias("p95_ms"),
                    (F.col("95%") <= 200.0).alias("p95_ok"),
                    (F.col("Failure Count") / F.greatest(F.col("Request Count"), F.lit(1)) * 100.0 <= 1.0).alias("errors_ok"))
