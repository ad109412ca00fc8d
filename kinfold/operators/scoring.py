"""Pair metrics against a truth table, size distributions, and the report files.

Pairs are never listed: n things of one group make n (n - 1) / 2 of them.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pairs(n: str) -> Column:
    return F.coalesce(F.sum((F.col(n) * (F.col(n) - 1) / 2).cast("long")), F.lit(0)).cast("long")


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) == 0, 1.0).otherwise(F.col(part) / F.when(F.col(whole) != 0, F.col(whole)))


def pair_metrics(assignments: DataFrame, ref_ids: DataFrame, truth: DataFrame) -> DataFrame:
    """One row (TP, FP, FN, L, E, precision, recall, f1); ratios rounded to four digits at the end."""
    predicted = assignments.join(ref_ids, "record_id").select("ref_id", "cluster_id")
    found = predicted.groupBy("cluster_id").agg(F.count("*").alias("n")).agg(_pairs("n").alias("L"))
    expected = truth.groupBy("truth_id").agg(F.count("*").alias("n")).agg(_pairs("n").alias("E"))
    both = predicted.join(truth, "ref_id").groupBy("cluster_id", "truth_id").agg(F.count("*").alias("n")).agg(_pairs("n").alias("TP"))
    counts = found.withColumn("one", F.lit(1)).join(expected.withColumn("one", F.lit(1)), "one").join(both.withColumn("one", F.lit(1)), "one")
    scored = counts.withColumn("p", _ratio("TP", "L")).withColumn("r", _ratio("TP", "E"))
    f1 = F.when(F.col("p") + F.col("r") == 0, 0.0).otherwise(2 * F.col("p") * F.col("r") / F.when(F.col("p") + F.col("r") != 0, F.col("p") + F.col("r")))
    return scored.select("TP", (F.col("L") - F.col("TP")).alias("FP"), (F.col("E") - F.col("TP")).alias("FN"), "L", "E", F.round("p", 4).alias("precision"), F.round("r", 4).alias("recall"), F.round(f1, 4).alias("f1"))


def predicted_distribution(clusters: DataFrame) -> DataFrame:
    """Rows (size, clusters) by size."""
    return clusters.groupBy("size").agg(F.count("*").alias("clusters")).orderBy("size")


def truth_distribution(truth: DataFrame) -> DataFrame:
    """Rows (size, clusters) by size."""
    return truth.groupBy("truth_id").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("clusters")).orderBy("size")


def _as_dict(distribution: DataFrame) -> dict[str, int]:
    return {str(r["size"]): r["clusters"] for r in distribution.collect()}  # one row a size


def build_report(config: dict, clusters: DataFrame, assignments: DataFrame | None, ref_ids: DataFrame | None, truth: DataFrame | None, truth_file: str, timings: dict[str, float]) -> dict:
    predicted = _as_dict(predicted_distribution(clusters))
    report = {"config": config, "predicted_clusters": {"n_total": sum(predicted.values()), "size_distribution": predicted}}
    if truth is not None and ref_ids is not None and assignments is not None:
        sizes = _as_dict(truth_distribution(truth))
        report["truth_clusters"] = {"truth_file": truth_file, "n_total": sum(sizes.values()), "size_distribution": sizes}
        report["pair_metrics"] = pair_metrics(assignments, ref_ids, truth).first().asDict()
    report["timings_seconds"] = timings
    return report


def render_log(report: dict) -> str:
    """The report as text: configuration, clusters, truth, pair metrics, timings; sizes in numeric order."""
    lines = ["== configuration"]
    lines += [f"{k} = {v}" for k, v in report["config"].items()]
    for part in ("predicted_clusters", "truth_clusters"):
        if part in report:
            lines += ["", f"== {part.replace('_', ' ')}", f"total = {report[part]['n_total']}"]
            lines += [f"size {size}: {n}" for size, n in sorted(report[part]["size_distribution"].items(), key=lambda x: int(x[0]))]
    for part in ("pair_metrics", "timings_seconds"):
        if part in report:
            lines += ["", f"== {part.replace('_', ' ')}"]
            lines += [f"{k} = {v}" for k, v in report[part].items()]
    return "\n".join(lines) + "\n"


def render_json(report: dict) -> str:
    return json.dumps(report, indent=2, default=str)
