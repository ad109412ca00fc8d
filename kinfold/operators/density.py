"""Density clustering inside blocks, as joins.

Equal feature vectors of a block are one vector with a multiplicity.  Vectors within eps of each other are neighbours; a
vector is core if its neighbours' multiplicities reach min_samples; core vectors within eps are connected; a border
vector joins its nearest core.  Only edges between records leave this module: a star inside a
vector, and one edge between representatives of linked vectors, so their number follows the vectors, not the pairs.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.lexical import SCALES, scaled_features
from kinfold.operators.components import ensure_checkpoint_dir
from kinfold.options import DensityOptions

AXES = tuple(SCALES)
GRID = ("token_count", "unique_chars")


def block_vectors(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vectors (block_key, vector_id, axes, copies, rep) and their records (block_key, vector_id, record_id).

    vector_id: 128 bits of the axes, as two longs.
    """
    scaled = keyed.select("block_key", "record_id", *(c.alias(n) for n, c in scaled_features(F.col("feat")).items()))
    named = scaled.withColumn("vector_id", F.struct(F.xxhash64(*AXES).alias("x"), F.xxhash64(F.lit(1), *AXES).alias("y")))
    vectors = named.groupBy("block_key", "vector_id", *AXES).agg(F.count("*").alias("copies"), F.min("record_id").alias("rep"))
    return vectors, named.select("block_key", "vector_id", "record_id")


def _sum(columns) -> Column:
    return reduce(lambda a, b: a + b, columns)


def neighbours(vectors: DataFrame, eps: float) -> DataFrame:
    """Pairs of one block's vectors within eps, each once and each with itself: block_key, a, b, d2, and copies, rep of both.

    Token count and unique characters, the axes that spread most, are cut into a grid of width eps: a pair within eps is
    in equal or touching cells, so the join is an equi-join on block and cell before any distance is computed.  Of two
    touching cells only one looks at the other.
    """
    width = max(eps, 1e-6)
    grid = {axis: F.floor(F.col(axis) / width).cast("long") for axis in GRID}
    binned = vectors.withColumn("cell", F.struct(*(v.alias(k) for k, v in grid.items())))
    ahead = [steps for steps in product((-1, 0, 1), repeat=len(GRID)) if steps >= (0,) * len(GRID)]
    around = F.array(*(F.struct(*((F.col(f"cell.{axis}") + step).alias(axis) for axis, step in zip(GRID, steps, strict=True))) for steps in ahead))
    left = binned.select("block_key", F.col("vector_id").alias("a"), *(F.col(x).alias(f"a_{x}") for x in AXES), F.col("copies").alias("a_copies"), F.col("rep").alias("a_rep"), F.col("cell").alias("own"), F.explode(around).alias("cell"))
    right = binned.select("block_key", F.col("vector_id").alias("b"), *(F.col(x).alias(f"b_{x}") for x in AXES), F.col("copies").alias("b_copies"), F.col("rep").alias("b_rep"), "cell")
    d2 = _sum((F.col(f"a_{x}") - F.col(f"b_{x}")) * (F.col(f"a_{x}") - F.col(f"b_{x}")) for x in AXES)
    pairs = left.join(right, ["block_key", "cell"]).where((F.col("own") != F.col("cell")) | (F.col("a") <= F.col("b"))).withColumn("d2", d2).where(F.col("d2") <= eps * eps)
    return pairs.select("block_key", "a", "b", "d2", "a_copies", "b_copies", "a_rep", "b_rep")


def both_ways(near: DataFrame) -> DataFrame:
    """Each pair of unlike vectors in both orders."""
    turned = near.where("a != b").select("block_key", F.col("b").alias("a"), F.col("a").alias("b"), "d2", F.col("b_copies").alias("a_copies"), F.col("a_copies").alias("b_copies"), F.col("b_rep").alias("a_rep"), F.col("a_rep").alias("b_rep"))
    return near.unionByName(turned)


def core_vectors(near: DataFrame, min_samples: int) -> DataFrame:
    """Rows (block_key, vector_id, neighbours) of core vectors."""
    counted = both_ways(near).groupBy("block_key", F.col("a").alias("vector_id")).agg(F.sum("b_copies").alias("neighbours"))
    return counted.where(F.col("neighbours") >= min_samples)


def vector_links(near: DataFrame, core: DataFrame) -> DataFrame:
    """Rows (block_key, a, b, a_rep, b_rep): core pairs, and each border vector with the one core it joins: the nearest,
    of equally near ones that with the least record, then the least vector."""
    cores = core.select("block_key", F.col("vector_id").alias("b"))
    own = core.select("block_key", F.col("vector_id").alias("a"))
    # pairs of cores are needed once; only border vectors are ranked, by an aggregate that combines before the shuffle
    core_pairs = near.where("a != b").join(cores, ["block_key", "b"], "left_semi").join(own, ["block_key", "a"], "left_semi")
    border = both_ways(near).join(cores, ["block_key", "b"], "left_semi").join(own, ["block_key", "a"], "left_anti")
    nearest = border.groupBy("block_key", "a").agg(F.min("a_rep").alias("a_rep"), F.min(F.struct("d2", "b_rep", "b")).alias("best"))
    joined = nearest.select("block_key", "a", F.col("best.b").alias("b"), "a_rep", F.col("best.b_rep").alias("b_rep"))
    return core_pairs.select("block_key", "a", "b", "a_rep", "b_rep").unionByName(joined)


def density_edges(keyed: DataFrame, options: DensityOptions = DensityOptions()) -> DataFrame:
    """Distinct edges (src, dst), src < dst, that connect the records of each block's clusters."""
    ensure_checkpoint_dir(keyed.sparkSession)
    vectors, members = block_vectors(keyed)
    # both are small beside the cells, and every later step reads them
    vectors = vectors.checkpoint()
    near = neighbours(vectors, options.dbscan_eps).checkpoint()
    core = core_vectors(near, options.dbscan_min_samples)
    links = vector_links(near, core)
    # links lead from border vectors and from cores
    joined = core.select("block_key", "vector_id").unionByName(links.select("block_key", F.col("a").alias("vector_id"))).distinct()
    clustered = members.join(joined, ["block_key", "vector_id"], "left_semi")
    reps = vectors.select("block_key", "vector_id", "rep")
    star = clustered.join(reps, ["block_key", "vector_id"]).select(F.col("rep").alias("x"), F.col("record_id").alias("y"))
    edges = star.unionByName(links.select(F.col("a_rep").alias("x"), F.col("b_rep").alias("y")))
    return edges.where("x != y").select(F.least("x", "y").alias("src"), F.greatest("x", "y").alias("dst")).distinct()
