"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import ensure_checkpoint_dir, shuffles_dropped


class Scratch:
    """Writes Parquet tables under ``spark.checkpoint.dir`` and drops superseded ones.

    A table cuts the lineage: executors lost later cost a re-read, not a
    recomputation, and a plan that uses it twice computes it once.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-tables"
        self.paths: dict[int, str] = {}

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{uuid.uuid4().hex}"
        with shuffles_dropped(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        self._keep = getattr(self, "_keep", []) + [out]
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table written here whose successor stands; others are left alone."""
        path = self.paths.pop(id(df), None)
        if path:
            jvm = self.spark._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def columns(df: DataFrame, *wanted: str) -> list[F.Column]:
    """The named columns of ``df`` by exact position, a null string where one is missing.

    Extra columns, also ones whose names differ only in case, are ignored.
    """
    out = []
    for name in wanted:
        exact = [f for f in df.schema.fields if f.name == name]
        out.append(F.col(f"`{name}`") if exact else F.lit(None).cast("string").alias(name))
    return out


def values(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small constant table as a local relation (no Python on the executors)."""
    names = [c.split()[0] for c in schema.split(",")]
    types = [c.split()[1] for c in schema.split(",")]

    def lit(v, t):
        if v is None:
            return f"CAST(NULL AS {t})"
        quoted = "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"CAST({quoted if isinstance(v, str) else v} AS {t})"

    if not rows:
        return spark.sql("SELECT " + ", ".join(f"{lit(None, t)} AS {n}" for n, t in zip(names, types)) + " WHERE false")
    body = ", ".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")
