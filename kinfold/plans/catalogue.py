"""One query for each operator of the engine, over whole tables; kinfold.plans.catalogue_sql has their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions.lexical import extract_features, normalize, scaled_features
from kinfold.operators import density, keys, redundancy, scoring
from kinfold.operators.cells import flatten, reference_ids
from kinfold.operators.clusters import aggregate_clusters, filter_clusters
from kinfold.operators.components import connected_components, new_shared_folder
from kinfold.options import ClusterOptions, DensityOptions, KeyOptions, LexicalOptions, MergeOptions, Options, RedundancyOptions, SourceOptions
from kinfold.plans.engine import cluster_records, run
from kinfold.sources.readers import CELLS, read_records, read_truth, with_record_id
from kinfold.sources.writers import write_clusters

#: The data columns and the key of each table that the queries take as records.
TABLES = {
    "customer": ("c_custkey", ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")),
    "part": ("p_partkey", ("p_name", "p_brand", "p_type", "p_size")),
    "documents": ("doc_id", ("text",)),
    "supplier": ("s_suppkey", ("s_name", "s_nationkey", "s_acctbal")),
}
#: Texts of documents are taken whole; only norm_truncated cuts them, as the engine does by default.
LENGTHS = {"documents": LexicalOptions(max_value_length=2**31 - 1)}
DIGITS = 6


def records(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    key, columns = TABLES[table]
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key, *columns)
    return with_record_id(df, (key,), source=table).drop(key)


def cells(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return flatten(records(spark, sf_dir, table))


def normalized(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return normalize(cells(spark, sf_dir, table), LENGTHS.get(table, LexicalOptions()))


def featured(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return extract_features(normalized(spark, sf_dir, table))


def keyed(spark: SparkSession, sf_dir: str, table: str, options: KeyOptions = KeyOptions()) -> DataFrame:
    return keys.guard_blocks(keys.generate_keys(featured(spark, sf_dir, table), options), options)


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redundancy.initial_blocks(keyed(spark, sf_dir, "customer"))


def _long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def cells_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(spark, sf_dir, "customer").select("record_id", "col_index", "value")


def cells_skip_leading(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(records(spark, sf_dir, "customer"), 2).select("record_id", "col_index", "value")


def text_split_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    split = df.select(F.col("conv_id").alias("record_id"), F.col("turn"), F.lit("").alias("source"), F.split("text", r"[\t|;]").alias(CELLS))
    return flatten(split.select("record_id", "source", CELLS)).groupBy("record_id", "col_index").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))


def text_split_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/part.parquet")
    split = df.select(F.col("p_partkey").alias("record_id"), F.lit("").alias("source"), F.split(F.concat_ws(";", "p_name", "p_brand", "p_type"), r"[\t|;]").alias(CELLS))
    return flatten(split, 1).select("record_id", "col_index", "value")


def ref_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_ids(records(spark, sf_dir, "customer"), 1)


def norm_values(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return normalize(cells(spark, sf_dir, table)).select("record_id", "col_index", "norm_value")


def features(spark: SparkSession, sf_dir: str, table: str, names: tuple[str, ...]) -> DataFrame:
    found = featured(spark, sf_dir, table).select("record_id", "col_index", *(F.col(f"feat.{n}").alias(n) for n in names))
    for n in names:
        if n in ("length", "token_count", "unique_chars"):
            found = found.withColumn(n, F.col(n).cast("long"))
        elif not n.startswith("pattern"):
            found = found.withColumn(n, F.round(F.col(n).cast("double"), DIGITS - 1))
    return found


def feature_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = scaled_features(F.col("feat"))
    return featured(spark, sf_dir, "part").select("record_id", "col_index", *(F.round(c, DIGITS - 1).alias(n) for n, c in columns.items()))


def key_kind(spark: SparkSession, sf_dir: str, table: str, tag: str) -> DataFrame:
    found = keys.generate_keys(featured(spark, sf_dir, table))
    return found.where(F.col("block_key").startswith(tag)).select("record_id", "col_index", "block_key")


def block_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.block_sizes(keys.generate_keys(featured(spark, sf_dir, "part")))


def block_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = KeyOptions(min_block_size=3, max_block_size=500)
    return keyed(spark, sf_dir, "part", options).select("record_id", "col_index", "block_key")


def block_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redundancy.initial_blocks(keyed(spark, sf_dir, "part")).select("block_id", "record_id")


def record_key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redundancy.record_keys(keyed(spark, sf_dir, "part")).select("record_id", F.concat_ws("|", "all_keys").alias("all_keys"))


def refine(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = keyed(spark, sf_dir, "customer")
    return redundancy.refine_blocks(redundancy.initial_blocks(base), redundancy.record_keys(base), 2).select("block_id", "record_id")


def merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redundancy.merge_blocks(blocks(spark, sf_dir)).select("block_id", "record_id")


def block_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redundancy.fingerprints(blocks(spark, sf_dir))


def purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redundancy.purge_subsets(blocks(spark, sf_dir)).select("block_id", "record_id")


def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redundancy.top_blocks(blocks(spark, sf_dir), 2, 2).select("block_id", "record_id")


def edges(spark: SparkSession, sf_dir: str, weighting: str = "uniform", cost: int | None = 100_000, tau: float = 0.0, k: int = 2) -> DataFrame:
    own = blocks(spark, sf_dir)
    corpus = own.agg(F.count_distinct("record_id")).first()[0] if weighting == "idf" else None
    found = redundancy.weighted_edges(redundancy.top_blocks(own, k, 2), weighting, corpus, cost)
    return found.withColumn("weight", F.round("weight", DIGITS)).where(F.col("weight") >= tau)


def eps_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, _ = density.block_vectors(keyed(spark, sf_dir, "customer"))
    near = density.both_ways(density.neighbours(vectors, 0.1))
    return near.groupBy("block_key", F.col("a_rep").alias("rep")).agg(F.count("*").alias("vectors"), F.sum("b_copies").alias("cells"))


def dbscan_cores(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, _ = density.block_vectors(keyed(spark, sf_dir, "customer"))
    core = density.core_vectors(density.neighbours(vectors, 0.05), 5)
    return core.join(vectors, ["block_key", "vector_id"]).select("block_key", "rep", "neighbours")


def dbscan_clusters(spark: SparkSession, sf_dir: str, eps: float = 0.05, least: int = 2) -> DataFrame:
    found = density.density_edges(keyed(spark, sf_dir, "customer"), DensityOptions(dbscan_eps=eps, dbscan_min_samples=least))
    return connected_components(found, records(spark, sf_dir, "customer").select("record_id"), MergeOptions("star"))


def components(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    found = edges(spark, sf_dir, tau=0.2).select("src", "dst")
    return connected_components(found, records(spark, sf_dir, "customer").select("record_id"), MergeOptions(strategy))


def _assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by brand: assignments whose groups are known."""
    rows = records(spark, sf_dir, "part")
    return rows.select("record_id", F.min("record_id").over(_by("p_brand")).alias("cluster_id"))


def _by(*names: str):
    from pyspark.sql import Window

    return Window.partitionBy(*names)


def cluster_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = aggregate_clusters(_assignments(spark, sf_dir), featured(spark, sf_dir, "part"))
    rounded = {n: F.round(n, DIGITS - 1) for n in ("std_length", "std_digit_ratio", "std_alpha_ratio", "cohesion")}
    return found.withColumns(rounded).withColumn("members", F.concat_ws(",", F.col("members").cast("array<string>")))


def cluster_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = aggregate_clusters(_assignments(spark, sf_dir), featured(spark, sf_dir, "part"))
    return filter_clusters(found, ClusterOptions(min_cluster_size=70, max_cluster_size=90, min_cluster_cohesion=0.5)).select("cluster_id", "size")


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").cast("string").alias("ref_id"), F.col("p_type").alias("truth_id"))


def pair_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    assignments = _assignments(spark, sf_dir)
    ref_ids = assignments.select("record_id", F.col("record_id").cast("string").alias("ref_id"))
    return scoring.pair_metrics(assignments, ref_ids, _truth(spark, sf_dir))


def dist_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.predicted_distribution(aggregate_clusters(_assignments(spark, sf_dir), featured(spark, sf_dir, "part")))


def dist_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.truth_distribution(_truth(spark, sf_dir))


def end_to_end(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    options = Options().with_overrides(clustering_method=method)
    found = cluster_records(records(spark, sf_dir, "customer"), options)
    return found.select("cluster_id", "size", F.round("cohesion", DIGITS - 1).alias("cohesion"))


def recursive_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks refined twice, merged and purged after each step."""
    options = RedundancyOptions(arcs_max_recursion_depth=2, arcs_do_purge=True, arcs_tau=0.0)
    return redundancy.redundancy_edges(keyed(spark, sf_dir, "supplier"), options).withColumn("weight", F.round("weight", DIGITS))


#: The table that each reader is tried on, and how it is written first.
FORMATS: dict[str, tuple[str, SourceOptions]] = {
    "csv": ("part", SourceOptions("csv", input_has_header=True)),
    "tsv": ("customer", SourceOptions("tsv")),
    "text": ("part", SourceOptions("text")),
    "parquet": ("supplier", SourceOptions("parquet")),
}


def _written(spark: SparkSession, sf_dir: str, table: str, options: SourceOptions) -> str:
    """The key and data columns of a table as files of a format, in the shared folder."""
    key, columns = TABLES[table]
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key, *columns)
    path, kind = f"{new_shared_folder(spark)}/{table}", options.input_format
    if kind == "parquet":
        rows.write.parquet(path)
    elif kind == "text":
        rows.select(F.concat_ws(";", *rows.columns).alias("value")).write.text(path)
    else:
        rows.write.option("sep", "\t" if kind == "tsv" else options.input_delimiter).option("header", options.input_has_header).csv(path)
    return path


def source_cells(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Files read by their reader; cells named by the reference id in the first column, which is skipped."""
    table, options = FORMATS[kind]
    read = read_records(spark, _written(spark, sf_dir, table, options), options).checkpoint()
    return flatten(read, 1).join(reference_ids(read, 0), "record_id").select("ref_id", "col_index", "value")


def _truth_file(truth: DataFrame, spark: SparkSession) -> str:
    path = f"{new_shared_folder(spark)}/truth"
    truth.toDF("refID", "truthID").write.option("header", True).csv(path)
    return path


def source_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_truth(spark, _truth_file(_truth(spark, sf_dir), spark))


def sink(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Clusters written in a format and read again."""
    path = f"{new_shared_folder(spark)}/clusters"
    write_clusters(aggregate_clusters(_assignments(spark, sf_dir), featured(spark, sf_dir, "part")), path, kind)
    return spark.read.format(kind).load(path).select("cluster_id", "size", F.concat_ws(",", F.col("members").cast("array<string>")).alias("members"))


def _run(spark: SparkSession, sf_dir: str) -> str:
    """A whole run from a file to the folder of its results."""
    truth = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string"))
    options = Options().with_overrides(input_format="csv", input_has_header=True, skip_leading_columns=1, clustering_method="arcs", merge_strategy="starstar", arcs_tau=0.23, truth_file=_truth_file(truth, spark))
    output = f"{new_shared_folder(spark)}/run"
    run(_written(spark, sf_dir, "customer", options.source), output, options, spark)
    return output


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of metrics.json."""
    report = spark.read.option("multiLine", True).json(f"{_run(spark, sf_dir)}/_metrics/metrics.json")
    return report.select(F.col("predicted_clusters.n_total").alias("n_predicted"), F.col("truth_clusters.n_total").alias("n_truth"), "pair_metrics.*")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sizes of the found clusters in the order of metrics.log."""
    log = spark.read.text(f"{_run(spark, sf_dir)}/_metrics/metrics.log", wholetext=True)
    part = F.split(F.split("value", "== predicted clusters\n")[1], "\n==")[0]
    lines = log.select(F.posexplode(F.regexp_extract_all(part, F.lit("size (\\d+: \\d+)"))).alias("place", "line"))
    return lines.select("place", *(F.split("line", ": ")[k].cast("long").alias(n) for k, n in enumerate(("size", "clusters"))))


def run_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sizes of a run's clusters as read again from its output."""
    return spark.read.parquet(_run(spark, sf_dir)).groupBy("size").agg(F.count("*").alias("clusters"))


COUNTS, RATIOS = ("length", "token_count", "unique_chars"), ("digit_ratio", "alpha_ratio", "symbol_ratio", "space_ratio", "upper_ratio", "vowel_ratio")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "cells_flatten": cells_flatten,
        "cells_skip_leading": cells_skip_leading,
        "text_split_cells": text_split_cells,
        "text_split_skip": text_split_skip,
        "ref_id_map": ref_id_map,
        "norm_values": partial(norm_values, table="customer"),
        "norm_truncated": partial(norm_values, table="documents"),
        "feat_counts": partial(features, table="documents", names=COUNTS),
        "feat_ratios": partial(features, table="documents", names=RATIOS),
        "feat_entropy": partial(features, table="part", names=("entropy",)),
        "feat_entropy_text": partial(features, table="documents", names=("entropy",)),
        "feat_scaled": feature_scaling,
        "pattern": partial(features, table="customer", names=("pattern",)),
        "pattern_compact": partial(features, table="customer", names=("pattern_compact",)),
        "key_prefix": partial(key_kind, table="part", tag="PFX_"),
        "key_pattern_hash": partial(key_kind, table="part", tag="PAT_"),
        "key_compact_hash": partial(key_kind, table="part", tag="CPT_"),
        "key_length": partial(key_kind, table="documents", tag="LEN_"),
        "key_tokens": partial(key_kind, table="documents", tag="TOK_"),
        "block_sizes": block_sizes,
        "block_guard": block_guard,
        "block_members": block_members,
        "record_keys": record_key_index,
        "refine_blocks": refine,
        "block_fingerprints": block_fingerprints,
        "merge_blocks": merge,
        "purge_blocks": purge,
        "topk_blocks": topk,
        "arcs_edges_uniform": edges,
        "arcs_edges_idf": partial(edges, weighting="idf"),
        "arcs_edges_tau": partial(edges, tau=0.2),
        "arcs_pair_cost": partial(edges, cost=300),
        "eps_neighbours": eps_neighbours,
        "dbscan_cores": dbscan_cores,
        "dbscan_clusters": dbscan_clusters,
        "dbscan_border": partial(dbscan_clusters, eps=0.02, least=12),
        "components_local": partial(components, strategy="local"),
        "components_star": partial(components, strategy="star"),
        "cluster_stats": cluster_stats,
        "cluster_filter": cluster_filter,
        "pair_metrics": pair_metrics,
        "dist_predicted": dist_predicted,
        "dist_truth": dist_truth,
        "arcs_recursion": recursive_edges,
        **{f"source_{kind}": partial(source_cells, kind=kind) for kind in FORMATS},
        "source_truth": source_truth,
        "sink_parquet": partial(sink, kind="parquet"),
        "sink_json": partial(sink, kind="json"),
        "run_metrics": run_metrics,
        "run_log": run_log,
        "run_clusters": run_clusters,
        "end_to_end_arcs": partial(end_to_end, method="arcs"),
        "end_to_end_dbscan": partial(end_to_end, method="dbscan"),
    }
