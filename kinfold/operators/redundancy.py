"""Redundancy graph of blocks: refinement, merging, purging, and weighted edges between records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kinfold.operators.components import ensure_checkpoint_dir
from kinfold.options import RedundancyOptions


def initial_blocks(keyed: DataFrame) -> DataFrame:
    """Rows (block_id, used_tokens, record_id), one for each record of a block."""
    return keyed.select(F.col("block_key").alias("block_id"), F.array("block_key").alias("used_tokens"), "record_id").distinct()


def record_keys(keyed: DataFrame) -> DataFrame:
    """Rows (record_id, all_keys), the keys in order."""
    return keyed.groupBy("record_id").agg(F.array_sort(F.collect_set("block_key")).alias("all_keys"))


def with_size(blocks: DataFrame) -> DataFrame:
    sizes = blocks.groupBy("block_id").agg(F.count("*").alias("size"))
    return blocks.join(sizes, "block_id")


def refine_blocks(blocks: DataFrame, keys: DataFrame, min_support: int) -> DataFrame:
    """For each block and further key that min_support of its records carry, the block of those records.

    Blocks are told apart by their token arrays; the id is only the array's spelling.
    """
    candidate = F.explode(F.array_except("all_keys", "used_tokens")).alias("candidate")
    carried = blocks.join(keys, "record_id").select("used_tokens", "record_id", candidate)
    supported = carried.groupBy("used_tokens", "candidate").agg(F.count_distinct("record_id").alias("support")).where(F.col("support") >= min_support)
    kept = carried.join(supported, ["used_tokens", "candidate"], "left_semi")
    tokens = F.array_sort(F.array_union("used_tokens", F.array("candidate")))
    refined = kept.select(tokens.alias("used_tokens"), "record_id").distinct()
    return refined.select(F.concat_ws("|", "used_tokens").alias("block_id"), "used_tokens", "record_id")


def fingerprints(blocks: DataFrame) -> DataFrame:
    """Rows (block_id, fingerprint) of the member set; the guard bounds the members of a block."""
    members = F.array_sort(F.collect_set("record_id")).cast("array<string>")
    return blocks.groupBy("block_id").agg(F.sha2(F.concat_ws(",", members), 256).alias("fingerprint"))


def merge_blocks(blocks: DataFrame) -> DataFrame:
    """Of blocks with the same members, the one with the least id."""
    canonical = fingerprints(blocks).groupBy("fingerprint").agg(F.min("block_id").alias("block_id"))
    return blocks.join(canonical.select("block_id"), "block_id", "left_semi")


def purge_subsets(blocks: DataFrame) -> DataFrame:
    """Blocks whose members are not all in one larger block."""
    sized = with_size(blocks).select("block_id", "record_id", "size")
    other = sized.select(F.col("block_id").alias("other_id"), "record_id", F.col("size").alias("other_size"))
    shared = sized.join(other, "record_id").where("size < other_size").groupBy("block_id", "other_id", "size").agg(F.count_distinct("record_id").alias("shared"))
    return blocks.join(shared.where("shared = size").select("block_id").distinct(), "block_id", "left_anti")


def top_blocks(blocks: DataFrame, k: int = 3, min_block_size: int = 2) -> DataFrame:
    """Each record's k smallest blocks, then those that still have min_block_size records."""
    smallest = Window.partitionBy("record_id").orderBy("size", "block_id")
    ranked = with_size(blocks).withColumn("rank", F.row_number().over(smallest)).where(F.col("rank") <= k)
    left = ranked.groupBy("block_id").agg(F.count("*").alias("left")).where(F.col("left") >= min_block_size)
    return ranked.join(left.select("block_id"), "block_id", "left_semi").select("block_id", "used_tokens", "record_id")


def contribution(size: Column, weighting: str, corpus_size: int | None) -> Column:
    if weighting == "idf":
        n = F.lit(corpus_size)
        return F.when(n > size, F.log(n / size) / size).otherwise(0.0)
    return 1.0 / size


def weighted_edges(blocks: DataFrame, weighting: str = "uniform", corpus_size: int | None = None, max_block_pair_cost: int | None = 100_000) -> DataFrame:
    """Rows (src, dst, weight) with src < dst: the sum of the contributions of the blocks that both records are in.

    The pair cost bounds what a block can emit, whatever its share of the records; None or 0 and less lift the bound.
    """
    sized = with_size(blocks)
    if max_block_pair_cost is not None and max_block_pair_cost > 0:
        sized = sized.where(F.col("size") * (F.col("size") - 1) / 2 <= max_block_pair_cost)
    weighed = sized.withColumn("part", contribution(F.col("size"), weighting, corpus_size)).where("part > 0").select("block_id", "record_id", "part")
    left = weighed.withColumnRenamed("record_id", "src")
    right = weighed.select("block_id", F.col("record_id").alias("dst"))
    pairs = left.join(right, "block_id").where("src < dst")
    return pairs.groupBy("src", "dst").agg(F.sum("part").alias("weight"))


def redundancy_edges(keyed: DataFrame, options: RedundancyOptions = RedundancyOptions(), min_block_size: int = 2) -> DataFrame:
    """Edges (src, dst, weight) of at least arcs_tau."""
    blocks = initial_blocks(keyed)
    if options.arcs_max_recursion_depth:
        ensure_checkpoint_dir(keyed.sparkSession)
        keys = record_keys(keyed).checkpoint()
        for depth in range(1, options.arcs_max_recursion_depth + 1):
            refined = refine_blocks(blocks, keys, max(depth, options.arcs_min_intra_freq))
            blocks = blocks.unionByName(refined).dropDuplicates(["block_id", "record_id"])
            if options.arcs_do_merge:
                blocks = merge_blocks(blocks)
            if options.arcs_do_purge:
                blocks = purge_subsets(blocks)
            blocks = blocks.checkpoint()
    kept = top_blocks(blocks, options.arcs_top_k, min_block_size)
    corpus = keyed.agg(F.count_distinct("record_id")).first()[0] if options.arcs_weighting == "idf" else None
    edges = weighted_edges(kept, options.arcs_weighting, corpus, options.arcs_max_block_pair_cost)
    return edges.where(F.col("weight") >= options.arcs_tau)
