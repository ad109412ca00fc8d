"""Sinks: cluster tables, and small text files through the Hadoop file system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_clusters(clusters: DataFrame, path: str, output_format: str = "parquet") -> None:
    if output_format not in ("parquet", "json"):
        raise ValueError(f"output format must be parquet or json, not {output_format!r}")
    getattr(clusters.write.mode("overwrite"), output_format)(path)


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """One UTF-8 file, replaced if it exists; any scheme that Hadoop knows."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
