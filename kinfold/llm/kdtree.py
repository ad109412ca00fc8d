"""Exact top-k search by inner product over KD-trees, one per shard.

Vectors are dealt to shards of neighbours: median splits, fitted on at most `sample_rows` vectors, part the space into
regions, and a region of more than `shard_rows` vectors, such as one of equal vectors, is dealt by hash into as many
shards as it needs.  Every vector is in exactly one shard.  A shard's tree splits at the median of the widest side of
each box; every node keeps the tight bounding box of its vectors, and no vector of a box can score more with a query than
the box's corner that suits each component best.  A query goes down a tree best bound first and stops at the first node
whose bound lies below its k-th best score so far.

A query first searches its own shard.  The boxes of the other trees' roots, not the trees, then meet the queries in blocks,
and a pair of query and shard is kept only if the bound reaches the k-th score.  The shards kept are searched in turns of
growing size, best bounds first; after each turn the new k-th score drops shards of the later turns.  Trees and queries
travel only to where such a pair is left.

Components are turned into integers, floor(scale * x) with x as double; scores are exact 64-bit integers.  Where a vector's
squares sum to 2 ** 63 or more, scores might not fit, and the search raises OverflowError before it starts.

Cases: vectors that are null or hold null or non-finite components, and rows with a null vec_id, take no part; empty
vectors score 0; only vectors of one length are compared; of rows that share a vec_id each is a query of its own and a
candidate for the others; fewer candidates than k give fewer rows; an empty table gives an empty table; other columns
are not read.  Ties go to the smaller vec_id.
"""

from __future__ import annotations

import heapq
import io
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kinfold.llm.common import cut_lineage

#: Below this size all products and sums of a score are exact in double precision.
EXACT = 1 << 53
#: The largest double that is a 64-bit integer.
LARGEST = (1 << 63) - 1024


@dataclass(frozen=True)
class SearchOptions:
    k: int = 5
    scale: float = 256.0
    shard_rows: int = 16_384
    leaf_rows: int = 64
    query_block: int = 2048
    #: Vectors that the regions are fitted on, at most; they decide where a vector lies, never whether it is searched.
    sample_rows: int = 4096
    #: Roots whose boxes are compared with a block of queries at once.
    box_rows: int = 1024
    #: A turn visits this many times the shards of the turn before.
    turn_growth: int = 4


def corner_scores(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each query and box, the score of the box's best corner; never less, and exact where doubles are."""
    largest = max(1, int(np.abs(low).max(initial=0)), int(np.abs(high).max(initial=0)))
    most = max(1, int(np.abs(queries).max(initial=0))) * largest * max(1, queries.shape[1])
    up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    scores = up @ high.T.astype(np.float64) + down @ low.T.astype(np.float64)
    if most >= EXACT:
        terms = np.abs(queries).sum(1).astype(np.float64)[:, None] * largest
        scores = np.minimum(np.ceil(scores + terms * (queries.shape[1] + 4) * 2.0**-50), float(LARGEST))
    return scores.astype(np.int64)


class Regions:
    """Median splits of a bounded sample; node n has the children 2n + 1 and 2n + 2, the leaves are the regions."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth if sample.shape[1] else 0
        self.axis, self.value = np.zeros((1 << self.depth) - 1, np.int64), np.zeros((1 << self.depth) - 1, np.int64)
        at = np.zeros(len(sample), np.int64)  # the node of each vector of the sample
        for n in range(len(self.axis)):
            part = sample[at == n]
            if len(part):
                self.axis[n] = (part.max(0) - part.min(0)).argmax()
                side = np.sort(part[:, self.axis[n]])
                middle = max(len(side) // 2, int(np.searchsorted(side, side[0], "right")))  # not all on one side
                self.value[n] = side[min(middle, len(side) - 1)]
                at[at == n] = 2 * n + 1 + (part[:, self.axis[n]] >= self.value[n])

    def of(self, vectors: np.ndarray) -> np.ndarray:
        node, each = np.zeros(len(vectors), np.int64), np.arange(len(vectors))
        for _ in range(self.depth):
            node = 2 * node + 1 + (vectors[each, self.axis[node]] >= self.value[node])
        return node - ((1 << self.depth) - 1)


class Tree:
    """A complete binary tree over integer vectors; node n has the children 2n + 1 and 2n + 2."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, leaf_rows: int):
        depth = 0
        while len(ids) > leaf_rows << depth:
            depth += 1
        order, nodes = np.arange(len(ids)), (2 << depth) - 1
        begin, end = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        low, high = np.zeros((nodes, vectors.shape[1]), np.int64), np.zeros((nodes, vectors.shape[1]), np.int64)
        end[0] = len(ids)
        for n in range(nodes):
            own = order[begin[n] : end[n]]
            if len(own):
                low[n], high[n] = vectors[own].min(0), vectors[own].max(0)
            if 2 * n + 2 < nodes:
                half = begin[n] + len(own) // 2
                if len(own) > 1 and vectors.shape[1]:
                    side = vectors[own, int((high[n] - low[n]).argmax())]
                    order[begin[n] : end[n]] = own[np.argpartition(side, len(own) // 2)]
                begin[2 * n + 1], end[2 * n + 1], begin[2 * n + 2], end[2 * n + 2] = begin[n], half, half, end[n]
        self.ids, self.rows, self.vectors = ids[order], rows[order], vectors[order]
        self.begin, self.end, self.low, self.high = begin, end, low, high

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **vars(self))
        return out.getvalue()

    @classmethod
    def unpack(cls, raw: bytes) -> Tree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(raw)) as arrays:
            for name in arrays.files:
                setattr(tree, name, arrays[name])
        return tree

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that a vector of each node's box can score with each query."""
        return corner_scores(queries, self.low, self.high)

    def search(self, query: np.ndarray, bounds: np.ndarray, row: int, k: int, at_least: int | None) -> list[tuple[int, int]]:
        """The best (score, vec_id) of all rows but `row`, among those that score at_least or more."""
        best: list[tuple[int, int]] = []  # a heap whose top is the worst
        ahead = [(-int(bounds[0]), 0)]
        leaves = len(self.begin) // 2
        while ahead:
            bound, n = heapq.heappop(ahead)
            limit = best[0][0] if len(best) == k else at_least
            if limit is not None and -bound < limit:
                break
            if n < leaves:
                for child in (2 * n + 1, 2 * n + 2):
                    if self.end[child] > self.begin[child] and (limit is None or bounds[child] >= limit):
                        heapq.heappush(ahead, (-int(bounds[child]), child))
                continue
            part = slice(int(self.begin[n]), int(self.end[n]))
            scores = self.vectors[part] @ query
            fit = self.rows[part] != row
            if limit is not None:
                fit &= scores >= limit
            for at in np.flatnonzero(fit).tolist():
                entry = (int(scores[at]), -int(self.ids[part.start + at]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(score, -number) for score, number in best]


def _integers(vector: Column, scale: float) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def vectors_of(table: DataFrame, is_query: Column, options: SearchOptions, id_col: str, vector_col: str) -> DataFrame:
    """Rows (row, vec_id, size, asked, v) of the vectors that take part."""
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    some = table.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(finite)
    return some.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.size(vector_col).alias("size"), F.coalesce(is_query, F.lit(False)).alias("asked"), _integers(F.col(vector_col), options.scale).alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(whole.flatten(), dtype=np.int64).reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def _fit_regions(vectors: DataFrame, total: int, options: SearchOptions) -> dict[int, Regions]:
    """The regions of each length of vectors that has more than one shard, from a sample of a bounded number of rows."""
    if total <= options.shard_rows:
        return {}
    sample = vectors.select("size", "v").orderBy(F.xxhash64("row", F.lit(2))).limit(options.sample_rows).toArrow()
    sizes, found = sample.column("size").to_numpy(), {}
    for size in np.unique(sizes).tolist():
        own = sample.filter(pa.array(sizes == size))
        shards = total * own.num_rows / sample.num_rows / options.shard_rows
        depth = min(math.ceil(math.log2(max(shards, 1))), int(math.log2(max(own.num_rows / 8, 1))))
        if depth:
            found[size] = Regions(_matrix(own.column("v"), own.num_rows), depth)
    return found


def _dealt(vectors: DataFrame, regions: dict[int, Regions], options: SearchOptions) -> DataFrame:
    """vectors with `shard`: the region, and the piece of the region that a hash of the row names."""

    def place(batches):
        for batch in batches:
            sizes, region = batch.column("size").to_numpy(), np.zeros(batch.num_rows, np.int64)
            for size, own in regions.items():
                at = np.flatnonzero(sizes == size)
                if len(at):
                    region[at] = own.of(_matrix(batch.column("v").take(pa.array(at)), len(at)))
            yield batch.append_column("region", pa.array(region))

    placed = vectors.mapInArrow(place, "row long, vec_id long, size int, asked boolean, v array<long>, region long")
    pieces = placed.groupBy("size", "region").agg(F.ceil(F.count("*") / options.shard_rows).alias("pieces"))
    piece = F.pmod(F.xxhash64("row"), F.col("pieces"))
    return placed.join(pieces, ["size", "region"]).select("row", "vec_id", "size", "asked", "v", (F.shiftleft("region", 32) + piece).alias("shard"))


def top_k(table: DataFrame, is_query: Column, options: SearchOptions = SearchOptions(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best of all other rows for each row of `table` with is_query."""
    vectors = cut_lineage(vectors_of(table, is_query, options, id_col, vector_col))
    squares = F.aggregate("v", F.lit(0.0), lambda sum_, x: sum_ + x.cast("double") * x.cast("double"))
    total, n_asked, longest = vectors.agg(F.count("*"), F.count_if("asked"), F.max(squares)).first()
    if longest is not None and longest >= LARGEST:
        raise OverflowError(f"components are too large for scores of 64 bits: the squares of a vector sum to {longest:.3g} at scale {options.scale:g}")
    dealt = cut_lineage(_dealt(vectors, _fit_regions(vectors, total, options), options))
    blocks = max(1, -(-n_asked // options.query_block))
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")
    asked = dealt.where("asked").select("row", "vec_id", "size", "v", "shard", block.alias("block"))

    def build(part: pa.Table) -> pa.Table:
        own = _matrix(part.column("v"), part.num_rows)
        tree = Tree(part.column("vec_id").to_numpy(), part.column("row").to_numpy(), own, options.leaf_rows)
        box = [pa.array([side[0].tolist()], pa.list_(pa.int64())) for side in (tree.low, tree.high)]
        return pa.table([part.column("size").slice(0, 1), part.column("shard").slice(0, 1), *box, pa.array([tree.pack()], pa.binary())], ["size", "shard", "low", "high", "tree"])

    def search(trees: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if trees.num_rows and queries.num_rows:
            tree = Tree.unpack(trees.column("tree")[0].as_py())
            own = _matrix(queries.column("v"), queries.num_rows)
            bounds = tree.bounds(own)
            limits = queries.column("at_least").to_pylist()
            for k, (row, number) in enumerate(zip(queries.column("row").to_pylist(), queries.column("vec_id").to_pylist(), strict=True)):
                out += [(row, number, found, score) for score, found in tree.search(own[k], bounds[k], row, options.k, limits[k])]
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("row", "query_id", "vec_id", "score"), columns, strict=True)})

    def reach(boxes: pa.Table, queries: pa.Table) -> pa.Table:
        """Of a block of queries and some roots' boxes, the pairs whose bound reaches the query's k-th score."""
        q, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        bounds = np.zeros((queries.num_rows, boxes.num_rows), np.int64)
        if boxes.num_rows and queries.num_rows:
            bounds = corner_scores(_matrix(queries.column("v"), queries.num_rows), _matrix(boxes.column("low"), boxes.num_rows), _matrix(boxes.column("high"), boxes.num_rows))
            limits = queries.column("at_least")
            some = limits.is_null().to_numpy()[:, None] | (bounds >= limits.fill_null(0).to_numpy()[:, None])
            some &= queries.column("shard").to_numpy()[:, None] != boxes.column("shard").to_numpy()[None, :]
            q, b = np.nonzero(some)
        rows, shards = queries.column("row").to_numpy(), boxes.column("shard").to_numpy()
        return pa.table({"row": pa.array(rows[q], pa.int64()), "shard": pa.array(shards[b], pa.int64()), "bound": pa.array(bounds[q, b], pa.int64())})

    trees = cut_lineage(dealt.groupBy("size", "shard").applyInArrow(build, "size int, shard long, low array<long>, high array<long>, tree binary"))
    vector = asked.select("row", "vec_id", "v")
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")

    def searched(pairs: DataFrame) -> DataFrame:
        """What the pairs (row, size, block, shard, at_least) find; a tree goes to each block with a pair for it."""
        keys = ("size", "shard", "block")
        wanted = trees.select("size", "shard", "tree").join(pairs.select(*keys).distinct(), ["size", "shard"])
        wanted = wanted.toDF("tree_size", "tree_shard", "tree", "tree_block")  # other names: both sides come from `pairs`
        queries = pairs.join(vector, "row")
        return wanted.groupBy("tree_size", "tree_shard", "tree_block").cogroup(queries.groupBy(*keys)).applyInArrow(search, "row long, query_id long, vec_id long, score long")

    def best_of(found: DataFrame) -> DataFrame:
        return cut_lineage(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= options.k))

    def with_limit(queries: DataFrame, found: DataFrame) -> DataFrame:
        lowest = found.groupBy("row").agg(F.when(F.count("*") >= options.k, F.min("score")).alias("at_least"))
        return queries.join(lowest, "row", "left")

    place = asked.select("row", "size", "block")
    found = best_of(searched(asked.select("row", "size", "block", "shard", F.lit(None).cast("long").alias("at_least"))))
    parts = max(1, -(-trees.count() // options.box_rows))
    boxes = trees.select("size", "shard", "low", "high", F.pmod(F.xxhash64("shard"), F.lit(parts)).alias("part"))
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    keys = ("size", "block", "part")
    queries = with_limit(asked, found).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))
    pairs = boxes.select("*", each).groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(reach, "row long, shard long, bound long")
    order = Window.partitionBy("row").orderBy(F.col("bound").desc(), "shard")
    # 4 shards, then 16, then 64: turn n has the places up to the n-th sum of such steps
    growth = options.turn_growth
    turn = F.floor(F.log(float(growth), F.row_number().over(order) * (growth - 1) / F.lit(growth) + 1) - 1e-9)
    pending = cut_lineage(pairs.withColumn("turn", turn.cast("int")))
    last = pending.agg(F.max("turn")).first()[0]
    for number in range(0 if last is None else last + 1):
        now = with_limit(pending.where(F.col("turn") == number), found).where("at_least IS NULL OR bound >= at_least")
        now = cut_lineage(now.join(place, "row").select("row", "size", "block", "shard", "at_least"))
        found = best_of(found.drop("rank").unionByName(searched(now)))
    return found.select("query_id", "rank", "vec_id", "score")
