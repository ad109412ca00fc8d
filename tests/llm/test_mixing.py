import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kinfold.llm import mixing
from kinfold.llm.mixing import MixOptions


def expected_targets(sizes):
    """Shares filled up by rounds: whoever is above its limit is set to it, the rest is shared again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def rows_of(n=400):
    rows = []
    for i in range(n):
        source = None if i % 11 == 0 else "hot" if i % 3 == 0 else f"s{i % 7}"
        rows.append((i, " ".join(["w"] * (i * 37 % 90)), source))
    rows += [(1000, None, "s1"), (1001, "", "empty"), (None, "a b c", None), (5, "x y", "s2"), (5, "x y", "s2"), (1002, "long " * 5000, "s3")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(), "doc_id long, text string, source string").withColumns({c: F.lit("x") for c in ("size", "block", "draws", "cut", "row", "shard", "target")})


def test_takes_come_near_their_targets(docs):
    rows = mixing.mix_sizes(docs).collect()
    sizes, targets, taken, longest = defaultdict(int), {}, defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        targets[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * len(r.shards)
    assert len(rows) == len(rows_of())
    for r in rows:
        assert r.source_size == sizes[r.source]
        longest[r.source] = max(longest[r.source], r.size)
    for source, target in expected_targets(dict(sizes)).items():
        assert targets[source] == pytest.approx(target)
        assert abs(taken[source] - target) <= max(50, longest[source] / 2)


def test_reruns_agree(docs):
    key = lambda rows: Counter((r.doc_id, r.taken, tuple(r.shards)) for r in rows)
    assert key(mixing.mix_sizes(docs).collect()) == key(mixing.mix_sizes(docs.repartition(7)).collect())


def test_take_repeats_whole_rows(docs):
    taken = Counter(r.doc_id for r in mixing.take(docs).collect())
    plan = defaultdict(int)
    for r in mixing.mix(docs).collect():
        plan[r.doc_id] += len(r.shards)
    assert taken == Counter({k: v for k, v in plan.items() if v})
    assert mixing.take(docs).columns == docs.columns
    mixed = mixing.mix(docs)
    assert set(docs.columns) <= set(mixed.columns)


def test_files_hold_the_mix_in_its_order(docs, spark, tmp_path):
    """File after file, row after row: shard after shard, and the documents of a shard in an order that mixes sources."""
    mixing.take(docs).write.parquet(str(tmp_path / "mix"))
    rows = spark.read.parquet(str(tmp_path / "mix")).select("doc_id", "_metadata.file_name", "_metadata.row_index").collect()
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.file_name, r.row_index))]
    shards = defaultdict(Counter)
    for r in mixing.mix_sizes(docs).collect():
        for s in r.shards:
            shards[s][r.doc_id] += 1
    at = 0
    for s in sorted(shards):
        n = sum(shards[s].values())
        assert Counter(order[at : at + n]) == shards[s] and order[at : at + n] != sorted(order[at : at + n], key=str)
        at += n
    assert at == len(order)


def test_empty(spark, docs):
    assert mixing.mix_sizes(docs.limit(0)).count() == 0
    assert mixing.take(docs.limit(0)).count() == 0


def test_quotas_add_up(spark):
    quotas = {"=a": 1000, "=b": 37, "=c": 0, "none": 4}
    options = MixOptions(tree_depth=3)
    sources = spark.createDataFrame(list(quotas.items()), "source_key string, quota long")
    ends = {r.source_key: r.shard_ends for r in mixing.shard_quotas(sources, options).collect()}
    assert {k: v[-1] for k, v in ends.items()} == quotas
    parts = {k: [b - a for a, b in zip([0, *v], v, strict=False)] for k, v in ends.items()}
    assert all(p >= 0 for v in parts.values() for p in v)
    totals = [sum(v[k] for v in parts.values()) for k in range(8)]
    assert max(totals) - min(totals) <= 3


def test_splits_are_hypergeometric(spark):
    """First splits over many seeds have the mean and variance of the distribution, and its support."""
    n, good = 40, 16
    sql = mixing._hypergeometric("40L", "16L", "20L", "u")
    us = spark.range(2000).select(((F.col("id") + 0.5) / 2000).alias("u"))
    drawn = [r[0] for r in us.select(F.expr(sql)).collect()]
    pmf = [math.comb(good, k) * math.comb(n - good, 20 - k) / math.comb(n, 20) for k in range(good + 1)]
    counts = Counter(drawn)
    for k, p in enumerate(pmf):
        assert counts[k] / 2000 == pytest.approx(p, abs=1.1e-3)
