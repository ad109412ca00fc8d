"""A whole run: read, unpivot, normalize, features, keys, links, components, clusters, scores."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from kinfold.functions.lexical import extract_features, normalize
from kinfold.operators.cells import flatten, reference_ids
from kinfold.operators.clusters import aggregate_clusters, filter_clusters
from kinfold.operators.components import connected_components, ensure_checkpoint_dir
from kinfold.operators.density import density_edges
from kinfold.operators.keys import generate_keys, guard_blocks
from kinfold.operators.redundancy import redundancy_edges
from kinfold.operators.scoring import build_report, render_json, render_log
from kinfold.options import Options
from kinfold.plans.session import session
from kinfold.sources.readers import read_records, read_truth
from kinfold.sources.writers import write_clusters, write_text_file


@dataclass(frozen=True)
class Stages:
    """The frames of a run, lazily planned; a caller may act on any of them."""

    records: DataFrame
    cells: DataFrame
    keyed: DataFrame
    edges: DataFrame


def featured_cells(records: DataFrame, options: Options = Options()) -> DataFrame:
    return extract_features(normalize(flatten(records, options.source.skip_leading_columns), options.lexical))


def plan(records: DataFrame, options: Options = Options(), cells: DataFrame | None = None) -> Stages:
    """cells: the featured cells of records if a caller holds them already."""
    cells = featured_cells(records, options) if cells is None else cells
    keyed = guard_blocks(generate_keys(cells, options.keys), options.keys)
    if options.run.clustering_method == "arcs":
        edges = redundancy_edges(keyed, options.redundancy, options.keys.min_block_size).select("src", "dst")
    else:
        edges = density_edges(keyed, options.density)
    return Stages(records, cells, keyed, edges)


def assign(stages: Stages, edges: DataFrame, options: Options = Options()) -> DataFrame:
    """Rows (record_id, cluster_id) of every record with a cell, or only of those in a block."""
    vertices = stages.cells if options.clusters.vertices == "all" else stages.keyed
    return connected_components(edges, vertices.select("record_id"), options.merge)


def cluster_records(records: DataFrame, options: Options = Options()) -> DataFrame:
    """The filtered clusters of a table of records (record_id, source, data columns)."""
    ensure_checkpoint_dir(records.sparkSession)
    # keys, vertices and spreads all read the cells; they are featured once
    stages = plan(records, options, featured_cells(records, options).checkpoint())
    edges = stages.edges.checkpoint()
    return filter_clusters(aggregate_clusters(assign(stages, edges, options), stages.cells, options.clusters.max_cluster_size), options.clusters)


def run(input_path: str, output_path: str, options: Options = Options(), spark: SparkSession | None = None) -> dict:
    """Cluster the input, write the clusters and the report under output_path, and return the report.

    Pair metrics count the assignments before the quality filter, the size distribution the clusters after it.
    """
    with session(spark, options.run.shuffle_partitions, options.run.checkpoint_dir) as live:
        ensure_checkpoint_dir(live)
        records = read_records(live, input_path, options.source)
        truth = read_truth(live, options.run.truth_file) if options.run.truth_file else None
        ref_ids = reference_ids(records, options.run.ref_id_column) if truth is not None else None
        if not options.source.key_columns:
            # row numbers hold only within one reading; files keep them for the rest of the run
            records = records.checkpoint()
            ref_ids = reference_ids(records, options.run.ref_id_column) if truth is not None else None
        stages = plan(records, options)
        cells = stages.cells.persist()
        try:
            began = time.time()
            edges = stages.edges.checkpoint()
            timings = {"cluster": round(time.time() - began, 3)}
            began = time.time()
            assignments = assign(stages, edges, options).checkpoint()
            timings["connected_components"] = round(time.time() - began, 3)
            clusters = filter_clusters(aggregate_clusters(assignments, cells, options.clusters.max_cluster_size), options.clusters)
            write_clusters(clusters, output_path, options.run.output_format)
            if not options.run.metrics_enabled:
                return {"config": options.flat()}
            kept = live.read.format(options.run.output_format).load(output_path)
            report = build_report(options.flat(), kept, assignments, ref_ids, truth, options.run.truth_file, timings)
            write_text_file(live, f"{output_path}/_metrics/metrics.json", render_json(report))
            write_text_file(live, f"{output_path}/_metrics/metrics.log", render_log(report))
            return report
        finally:
            cells.unpersist()


def cluster_files(input_path: str, output_path: str, spark: SparkSession, options: Options = Options()) -> DataFrame:
    """As `run`, and the clusters as read back from output_path; the session stays the caller's."""
    run(input_path, output_path, options, spark)
    return spark.read.format(options.run.output_format).load(output_path)
