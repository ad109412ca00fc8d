"""Clusters from assignments: members, spread of features, cohesion, and the quality filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.options import ClusterOptions


def first_cells(cells: DataFrame) -> DataFrame:
    """Each record's features at its lowest column: (record_id, feat)."""
    return cells.groupBy("record_id").agg(F.min_by("feat", "col_index").alias("feat"))


def aggregate_clusters(assignments: DataFrame, cells: DataFrame, max_members: int = ClusterOptions().max_cluster_size) -> DataFrame:
    """Rows (cluster_id, members, size, std_length, std_digit_ratio, std_alpha_ratio, cohesion).

    Sizes and spreads combine before the shuffle.  Members are listed only for clusters of at most max_members, null
    beyond, so that no giant cluster is gathered in one task.
    """
    own = assignments.distinct()
    joined = own.join(first_cells(cells), "record_id", "left")
    spread = lambda name: F.coalesce(F.stddev_pop(F.col(f"feat.{name}").cast("double")), F.lit(0.0)).alias(f"std_{name}")
    found = joined.groupBy("cluster_id").agg(F.count("*").alias("size"), spread("length"), spread("digit_ratio"), spread("alpha_ratio"))
    listed = own.join(found.where(F.col("size") <= max_members).select("cluster_id"), "cluster_id", "left_semi")
    members = listed.groupBy("cluster_id").agg(F.array_sort(F.collect_list("record_id")).alias("members"))
    raw = 1.0 - F.col("std_length") / 64.0 - F.col("std_digit_ratio") - F.col("std_alpha_ratio")
    scored = found.join(members, "cluster_id", "left").withColumn("cohesion", F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)))
    return scored.select("cluster_id", "members", "size", "std_length", "std_digit_ratio", "std_alpha_ratio", "cohesion")


def filter_clusters(clusters: DataFrame, options: ClusterOptions = ClusterOptions()) -> DataFrame:
    return clusters.where(F.col("size").between(options.min_cluster_size, options.max_cluster_size) & (F.col("cohesion") >= options.min_cluster_cohesion))
