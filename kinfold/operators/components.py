"""Connected components of an edge table.

Distributed form: alternating large-star and small-star rounds (Kiveris et al., "Connected Components in MapReduce and
Beyond", SoCC 2014).  A vertex's smallest neighbour comes from an aggregate that combines before the shuffle, and goes
back to its edges by an equi-join, which adaptive execution can split where a hub owns many edges; no vertex's edges
are ever gathered in one place.  Every round is cut from its lineage by a checkpoint in the shared folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.options import MergeOptions

ROWS_PER_PARTITION = 50_000


class NotConverged(RuntimeError):
    """The star rounds reached their limit while edges still changed."""


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The checkpoint folder that spark.checkpoint.dir names; a temporary one only where all executors are the driver."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context._jsc.sc().isLocal():
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="kinfold-checkpoints-"))


def new_shared_folder(spark: SparkSession) -> str:
    """A name in the shared checkpoint folder that no other run uses."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{uuid.uuid4().hex}"


def _simple_edges(edges: DataFrame) -> DataFrame:
    """Distinct edges with src > dst, no loops."""
    return edges.where("src != dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    lowest = both.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("src", "low").alias("low"))
    return both.where("dst > src").join(lowest, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("src").agg(F.min("dst").alias("low"))
    moved = edges.join(lowest, "src").where("dst != low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.unionByName(lowest.select("src", F.col("low").alias("dst"))).distinct()


def _compact(edges: DataFrame, rows: int) -> DataFrame:
    """edges, of at most so many rows, in no more partitions than these need; a round writes as many files."""
    most = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return edges.coalesce(max(1, min(most, -(-rows // ROWS_PER_PARTITION))))


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())


def star_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Rows (node, component) for every vertex of a non-loop edge; component is its smallest reachable vertex.

    Null endpoints are ignored; an empty table gives an empty table.  Raises NotConverged after max_rounds.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    state = _simple_edges(edges.where("src IS NOT NULL AND dst IS NOT NULL")).checkpoint()
    before = _signature(state)
    for _ in range(max_rounds):
        if not before[0]:
            break
        # a round never adds edges
        state = _compact(_small_star(_large_star(state)), before[0]).checkpoint()
        now = _signature(state)
        if now == before:
            break
        before = now
    else:
        raise NotConverged(f"components still changed after {max_rounds} rounds")
    roots = state.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return state.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)


def local_components(edges: DataFrame) -> DataFrame:
    """The same rows by union-find on the driver; only for edge tables of a checked size."""
    spark, parent = edges.sparkSession, {}

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    pairs = edges.where("src IS NOT NULL AND dst IS NOT NULL AND src != dst").select("src", "dst").toPandas()
    for a, b in pairs.itertuples(index=False):
        parent.setdefault(a, a)
        parent.setdefault(b, b)
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    schema = T.StructType([T.StructField("node", edges.schema["src"].dataType), T.StructField("component", edges.schema["src"].dataType)])
    return spark.createDataFrame([(int(x), int(find(x))) for x in parent], schema)


def connected_components(edges: DataFrame, vertices: DataFrame | None = None, options: MergeOptions = MergeOptions()) -> DataFrame:
    """Rows (record_id, cluster_id) by the chosen strategy; `vertices` (record_id) adds isolated records."""
    simple = edges.where("src != dst").select("src", "dst").distinct()
    strategy = options.merge_strategy
    if strategy == "auto":
        # the edges are computed once, for the count and for what follows
        ensure_checkpoint_dir(edges.sparkSession)
        simple = simple.checkpoint()
        strategy = "local" if simple.count() <= options.merge_local_edge_limit else "star"
    found = local_components(simple) if strategy == "local" else star_components(simple, options.cc_max_iterations)
    found = found.select(F.col("node").alias("record_id"), F.col("component").alias("cluster_id"))
    if vertices is None:
        return found
    return vertices.select("record_id").distinct().join(found, "record_id", "left").select("record_id", F.coalesce("cluster_id", "record_id").alias("cluster_id"))
