r"""Mixing sources to target weights, in DataFrame operations only.

Every source is dealt into blocks by a hash of its rows; a pass over a source is a permutation of its blocks.  A source's
target says how many whole passes it gives and how much of a last one; that makes an exact quota of blocks, the last of
them cut to the words still missing.  The quotas of all sources are then split down a binary tree to the output shards:
at each node the left side's blocks are drawn from the node's without replacement (multivariate hypergeometric, source
by source from the conditional distributions), so every shard mixes all sources and the quotas add up exactly.  Shard
after shard takes the next blocks of each source's permutation, which keeps the draws disjoint, and shuffles its rows.

Sizes are words, runs of anything but U+0020 and U+0009..U+000D.  Sources in order of code point, null last, weigh 5, 2,
1, repeating; targets share `share` times all words by weight, a target stops at `most` times its source's words and the
excess is shared again by weight.

There is one row a source, and at most MOST_BLOCKS rows a source and pass, in what is planned before the rows are dealt:
sources are ranked and filled up in one task, which takes some millions of sources, not a source for every document.
The one block of a source that is cut is dealt once more into parts, whole ones of which are taken in turn, so that only
the rows of a single part, 1 / MOST_BLOCKS of a block of any size, are put in order.

Cases: a null text has size 0; null is a source of its own; sources without words have target 0 and give nothing; equal
rows are taken together or apart, but every rerun takes as many; an empty table gives an empty table; other columns are
carried along, and of them only those named like a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kinfold.llm.common import cut_lineage, shuffle_partitions

#: A source has at most this many blocks, whatever its size; a power of two.
MOST_BLOCKS = 4096
ROWS_PER_BLOCK = 32
#: Sources, and the draws of blocks, are broadcast up to this many rows, about 20 MB.
MOST_ROWS_SENT = 100_000
#: The weights in turn.
WEIGHTS = (5.0, 2.0, 1.0)

RESULTS = ("size", "source_size", "target", "taken", "shards")


@dataclass(frozen=True)
class MixOptions:
    share: float = 1.5
    most: float = 2.0
    tree_depth: int = 4
    seed: int = 2024


def _prepared(docs: DataFrame, carried: list[str], options: MixOptions) -> DataFrame:
    """Rows (row, doc_id, source, source_key, size, row_hash); row: the struct of the carried columns."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    row_hash = F.xxhash64(F.lit(options.seed), F.col("doc_id"), F.col("text"))
    return docs.select(F.struct(*carried).alias("row"), "doc_id", "source", _source_key().alias("source_key"), size.alias("size"), row_hash.alias("row_hash"))


def _source_key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("none"))


def source_targets(sources: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """sources (source_key, source, source_size, ...) with weight and target; one row a source."""
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(WEIGHTS)
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (turn + 1).cast("int"))).withColumn("cap", options.most * F.col("source_size"))
    # in order of cap / weight: the level if all sources before are capped; it holds from the first that it doesn't reach
    filled = weighed.withColumn("full_at", F.col("cap") / F.col("weight"))
    before = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    left = options.share * F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = filled.withColumn("level", left / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    held = level.withColumn("held", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(all_rows))
    target = F.when(F.col("held").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("held") * F.col("weight")))
    return held.withColumn("target", target).drop("cap", "full_at", "level", "held")


def _ln_factorial(x: str) -> str:
    """ln(x!) by Stirling's series at x + 9."""
    z = f"(({x}) + 9D)"
    low = " * ".join(f"(({x}) + {k}D)" for k in range(1, 9))
    return f"(({z} - 0.5D) * ln({z}) - {z} + 0.9189385332046727D + 1D / (12D * {z}) - 1D / (360D * pow({z}, 3)) + 1D / (1260D * pow({z}, 5)) - ln({low}))"


def _hypergeometric(population: str, good: str, draws: str, u: str) -> str:
    """SQL for the number of good ones among draws without replacement, where the distribution reaches u."""
    low, high = f"greatest(0L, {draws} + {good} - {population})", f"least({good}, {draws})"
    f = _ln_factorial
    ln_first = f"{f(good)} + {f(f'{population} - {good}')} + {f(draws)} + {f(f'{population} - {draws}')} - {f(population)} - {f('lo')} - {f(f'{good} - lo')} - {f(f'{draws} - lo')} - {f(f'{population} - {good} - {draws} + lo')}"
    step = f"ln((({good}) - k) * (({draws}) - k) / ((k + 1D) * ({population} - {good} - {draws} + k + 1D)))"
    start = f"transform(array({low}), lo -> named_struct('ln_p', {ln_first}, 'sum', 0D, 'value', lo))[0]"
    go_on = f"named_struct('ln_p', IF(k < {high}, a.ln_p + {step}, a.ln_p), 'sum', a.sum + exp(a.ln_p), 'value', IF(a.sum + exp(a.ln_p) < {u}, least(k + 1L, {high}), a.value))"
    return f"aggregate(sequence({low}, {high}), {start}, (a, k) -> {go_on}, a -> a.value)"


def shard_quotas(sources: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """sources (source_key, quota long) split down the tree: rows (source_key, shard_ends array<long>).

    shard_ends[k] is the number of the source's blocks that shards 0..k take.
    """
    ordered = F.sort_array(F.collect_list(F.struct("source_key", "quota")))
    nodes = sources.agg(ordered.alias("both")).select(F.col("both.source_key").alias("keys"), F.lit(0).alias("node"), F.col("both.quota").alias("quotas"))
    total = "aggregate(quotas, 0L, (a, q) -> a + q)"
    for depth in range(options.tree_depth):
        u = f"((xxhash64({options.seed}, {depth}, node, size(acc.taken)) & 9007199254740991) / 9007199254740992D)"
        draw = _hypergeometric("acc.population", "q", "acc.draws", u)
        body = f"transform(array({draw}), x -> named_struct('population', acc.population - q, 'draws', acc.draws - x, 'taken', concat(acc.taken, array(x))))[0]"
        # an odd block goes left or right by a coin
        half = f"CAST(({total} + (xxhash64({options.seed}, {depth}, node) & 1)) DIV 2 AS BIGINT)"
        left = f"aggregate(quotas, named_struct('population', {total}, 'draws', {half}, 'taken', CAST(array() AS array<bigint>)), (acc, q) -> {body}, acc -> acc.taken)"
        split = nodes.select("keys", "node", "quotas", F.expr(left).alias("left_part"))
        sides = F.explode(F.array(F.struct((2 * F.col("node")).alias("node"), F.col("left_part").alias("quotas")), F.struct((2 * F.col("node") + 1).alias("node"), F.expr("transform(quotas, (q, i) -> q - left_part[i])").alias("quotas"))))
        nodes = split.select("keys", sides.alias("side")).select("keys", "side.node", "side.quotas")
    each = nodes.select("node", F.explode(F.arrays_zip("keys", "quotas")).alias("x")).select("node", F.col("x.keys").alias("source_key"), F.col("x.quotas").alias("quota"))
    parts = each.groupBy("source_key").agg(F.sort_array(F.collect_list(F.struct("node", "quota"))).alias("parts"))
    return parts.select("source_key", F.expr("transform(parts, (p, i) -> aggregate(slice(parts, 1, i + 1), 0L, (a, x) -> a + x.quota))").alias("shard_ends"))


def _plan(prepared: DataFrame, options: MixOptions) -> tuple[DataFrame, DataFrame]:
    """Sources with their targets, and for every block that is drawn its draws (at most two passes)."""
    dealt = F.pmod(F.col("row_hash"), F.lit(MOST_BLOCKS))
    fine = cut_lineage(prepared.groupBy("source_key", "source", dealt.alias("deal")).agg(F.sum("size").alias("words"), F.count("*").alias("n")))
    sources = fine.groupBy("source_key", "source").agg(F.sum("words").alias("source_size"), F.sum("n").alias("n"))
    wanted = F.greatest(F.lit(0.0), F.ceil(F.log2(F.col("n") / ROWS_PER_BLOCK)))
    sources = cut_lineage(source_targets(sources, options).withColumn("n_blocks", F.least(F.lit(MOST_BLOCKS), F.pow(F.lit(2.0), wanted)).cast("long")))
    blocks = fine.join(sources.select("source_key", "source_size", "target", "n_blocks"), "source_key")
    blocks = blocks.groupBy("source_key", (F.col("deal") % F.col("n_blocks")).alias("block"), "source_size", "target").agg(F.sum("words").alias("words"), F.sum("n").alias("rows"))
    whole = F.floor(F.col("target") / F.col("source_size"))
    passes = blocks.where("source_size > 0").withColumn("whole", whole).withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole"))))
    order = Window.partitionBy("source_key", "pass").orderBy(F.xxhash64(F.lit(options.seed), F.col("source_key"), F.col("pass"), F.col("block")), "block")
    ranked = passes.withColumn("before", F.sum("words").over(order) - F.col("words")).withColumn("draw", F.row_number().over(order).cast("long") - 1)
    missing = F.col("target") - F.col("whole") * F.col("source_size") - F.col("before")
    drawn = ranked.where((F.col("pass") < F.col("whole")) | (missing > 0)).withColumn("cut", F.when((F.col("pass") == F.col("whole")) & (missing < F.col("words")), missing))
    # at most two passes of MOST_BLOCKS blocks share a source's order
    drawn = cut_lineage(drawn.withColumn("draw", F.row_number().over(Window.partitionBy("source_key").orderBy("pass", "draw")).cast("long") - 1))
    quotas = drawn.groupBy("source_key").agg(F.count("*").alias("quota"))
    placed = drawn.join(shard_quotas(quotas, options), "source_key").withColumn("shard", F.expr("size(filter(shard_ends, e -> e <= draw))"))
    by_block = placed.groupBy("source_key", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard", F.col("cut")))).alias("draws"), F.max("cut").alias("cut"), F.max("rows").alias("rows"))
    return sources, by_block


def mix(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """docs (doc_id, text, source, ...) with size, source_size, target, taken and shards.

    taken: words the mix takes of the row, with repeats; shards: the output shard of each time it is taken.
    """
    carried = [c for c in docs.columns if c not in RESULTS]
    return _mixed(_prepared(docs, carried, options), options).select(*(F.col("row").getField(c).alias(c) for c in carried), *RESULTS)


def mix_sizes(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """As mix, without the texts: rows (doc_id, source, size, source_size, target, taken, shards)."""
    light = cut_lineage(_prepared(docs, ["doc_id", "source"], options))
    return _mixed(light, options).select("row.doc_id", "row.source", *RESULTS)


def _sent(few: DataFrame) -> DataFrame:
    """A checkpointed table to be broadcast if it is small; beyond that the join deals both sides by its key."""
    return F.broadcast(few) if few.count() <= MOST_ROWS_SENT else few


def _mixed(prepared: DataFrame, options: MixOptions) -> DataFrame:
    """Rows (row, and RESULTS)."""
    sources, by_block = _plan(prepared, options)
    keyed = prepared.join(_sent(sources.select("source_key", "source_size", "target", "n_blocks")), "source_key")
    keyed = keyed.withColumn("block", F.pmod(F.col("row_hash"), F.lit(MOST_BLOCKS)) % F.col("n_blocks"))
    planned = keyed.join(_sent(cut_lineage(by_block)), ["source_key", "block"], "left")
    clear = planned.where("cut IS NULL").withColumn("in_cut", F.lit(True))
    # of a block that is cut: its parts while they fit; of the next one its longest rows while they fit, then its shortest, to the nearest
    inside = planned.where("cut IS NOT NULL")
    n_parts = F.least(F.lit(MOST_BLOCKS), F.pow(F.lit(2.0), F.greatest(F.lit(0.0), F.ceil(F.log2(F.col("rows") / ROWS_PER_BLOCK))))).cast("long")
    inside = inside.withColumn("part", F.pmod(F.xxhash64(F.lit(options.seed + 1), "row_hash"), n_parts))
    parts = inside.groupBy("source_key", "part", "cut").agg(F.sum("size").alias("part_size"))
    # one block of a source is cut: at most MOST_BLOCKS rows share a source's order
    parts = cut_lineage(parts.select("source_key", "part", (F.col("cut") - F.sum("part_size").over(Window.partitionBy("source_key").orderBy("part")) + F.col("part_size")).alias("left"), "part_size"))
    inside = inside.join(_sent(parts), ["source_key", "part"])
    sure = inside.where("left >= part_size OR left <= 0").withColumn("in_cut", F.col("left") >= F.col("part_size")).drop("part", "left", "part_size")
    inside = inside.where("left < part_size AND left > 0").withColumn("cut", F.col("left")).drop("part", "left", "part_size")
    block = Window.partitionBy("source_key", "block")
    down = block.orderBy(F.col("size").desc(), "row_hash", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("source_key", "block", "fits").orderBy("size", "row_hash", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    parted = inside.withColumn("fits", F.sum("size").over(down) <= F.col("cut"))
    parted = parted.withColumn("still", F.col("cut") - F.sum(F.when(F.col("fits"), F.col("size")).otherwise(0)).over(block))
    parted = parted.withColumn("in_cut", F.col("fits") | (2 * F.sum("size").over(up) - F.col("size") <= 2 * F.col("still"))).drop("fits", "still")
    both = clear.unionByName(sure).unionByName(parted)
    held = F.filter(F.coalesce(F.col("draws"), F.array().cast(by_block.schema["draws"].dataType)), lambda d: F.col("in_cut") | d["cut"].isNull())
    return both.withColumn("held", held).select("row", "size", "source_size", "target", (F.size("held") * F.col("size")).alias("taken"), F.col("held.shard").alias("shards"))


def take(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, shard by shard, in random order within a shard.

    A shard's random places are cut into as many pieces as give every task of a shuffle its share, so that shards may be
    of any size.  Partitions are in order of shard and piece, their rows in order of place, so that files written of the
    result, taken by name, hold the mix in its order.
    """
    rows = _mixed(_prepared(docs, docs.columns, options), options).select("row", F.posexplode("shards").alias("turn", "shard"))
    place = F.xxhash64(F.lit(options.seed), F.col("shard"), F.col("turn"), F.col("row.doc_id"), F.col("row.text"))
    shards = 2**options.tree_depth
    pieces = -(-shuffle_partitions(docs.sparkSession) // shards)
    piece = F.floor((F.col("place").cast("double") / 2.0**64 + 0.5) * pieces)
    taken = rows.withColumn("place", place).withColumn("piece", piece)
    # a place of 1 - 2 ** -64 rounds to 1
    number = F.col("shard") * pieces + F.least(F.col("piece"), F.lit(pieces - 1))
    dealt = taken.repartitionById(shards * pieces, number.cast("int")).sortWithinPartitions("place")
    return dealt.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
