"""kestrel: recommender analytics as Spark DataFrame, SQL and Structured Streaming jobs."""

from kestrel.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
