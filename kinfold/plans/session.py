"""A Spark session that the caller owns, or one for the length of a with block."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def session(spark: SparkSession | None = None, shuffle_partitions: int = 400, checkpoint_dir: str = "") -> Iterator[SparkSession]:
    """The caller's live session with its own settings, or a new one that ends with the block."""
    if spark is not None:
        yield spark
        return
    builder = SparkSession.builder.appName("kinfold").config("spark.sql.shuffle.partitions", shuffle_partitions)
    builder = builder.config("spark.sql.adaptive.enabled", True).config("spark.sql.adaptive.skewJoin.enabled", True).config("spark.sql.adaptive.coalescePartitions.enabled", True)
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", True)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    own = builder.getOrCreate()
    try:
        yield own
    finally:
        own.stop()
