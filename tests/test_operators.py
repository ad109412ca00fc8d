import random

import pytest
from pyspark.sql import functions as F

from kinfold.functions.lexical import extract_features, normalize
from kinfold.operators import density, keys, redundancy, scoring
from kinfold.operators.cells import flatten, reference_ids
from kinfold.operators.clusters import aggregate_clusters, filter_clusters
from kinfold.operators.components import NotConverged, connected_components, local_components, star_components
from kinfold.options import ClusterOptions, DensityOptions, KeyOptions, MergeOptions, Options, RedundancyOptions


def test_flatten(spark):
    df = spark.createDataFrame([(1, "f", "a", "", 3), (2, "f", None, "b", None)], "record_id long, source string, x string, y string, z int")
    assert sorted(flatten(df).select("record_id", "col_index", "value").collect()) == [(1, 0, "a"), (1, 2, "3"), (2, 1, "b")]
    assert sorted(flatten(df, 1).select("record_id", "col_index", "value").collect()) == [(1, 1, "3"), (2, 0, "b")]
    with pytest.raises(ValueError):
        flatten(df, 3)
    text = spark.createDataFrame([(1, "f", ["k", "a", ""]), (2, "f", []), (3, "f", None)], "record_id long, source string, _cells array<string>")
    assert flatten(text, 1).select("record_id", "col_index", "value").collect() == [(1, 0, "a")]
    assert [tuple(r) for r in reference_ids(text, 0).collect()] == [(1, "k")]
    assert [tuple(r) for r in reference_ids(df, 1).collect()] == [(2, "b")]
    with pytest.raises(ValueError):
        reference_ids(df, 9)


def test_keys(spark):
    df = spark.createDataFrame([(2,), (3,), (4,), (5,), (512,), (513,)], "n int")
    assert [r[0] for r in df.select(keys.length_key(F.col("n"))).collect()] == ["LEN_1", "LEN_2", "LEN_2", "LEN_3", "LEN_14", "LEN_15"]
    assert spark.range(1).select(keys.token_key(F.lit(40))).first()[0] == "TOK_32"
    cells = extract_features(normalize(spark.createDataFrame([(1, "f", 0, "Alpha 1"), (2, "f", 1, "alpha 2")], "record_id long, source string, col_index int, value string")))
    found = {r.block_key for r in keys.generate_keys(cells).collect()}
    assert {k[:4] for k in found} == {"PFX_", "PAT_", "CPT_", "LEN_", "TOK_"} and len(found) == 5
    none = KeyOptions(emit_prefix_key=False, emit_pattern_key=False, emit_length_key=False, emit_token_key=False, emit_compressed_pattern_key=False)
    with pytest.raises(ValueError):
        keys.generate_keys(cells, none)
    assert keys.guard_blocks(keys.generate_keys(cells), KeyOptions(max_block_size=2, min_block_size=2)).count() == 10
    assert keys.guard_blocks(keys.generate_keys(cells), KeyOptions(min_block_size=3)).count() == 0


def blocks_of(spark, members):
    rows = [(b, [b], r) for b, records in members.items() for r in records]
    return spark.createDataFrame(rows, "block_id string, used_tokens array<string>, record_id long")


def test_weights(spark):
    blocks = blocks_of(spark, {"B1": [1, 2], "B2": [1, 2, 3]})
    uniform = {(r.src, r.dst): r.weight for r in redundancy.weighted_edges(blocks).collect()}
    assert uniform == {(1, 2): pytest.approx(5 / 6), (1, 3): pytest.approx(1 / 3), (2, 3): pytest.approx(1 / 3)}
    idf = redundancy.weighted_edges(blocks, "idf", 3).collect()
    assert [(r.src, r.dst) for r in idf] == [(1, 2)] and idf[0].weight == pytest.approx(0.202733, abs=1e-5)
    assert redundancy.weighted_edges(blocks, max_block_pair_cost=2).count() == 1
    assert redundancy.weighted_edges(blocks, max_block_pair_cost=None).count() == 3
    assert redundancy.weighted_edges(blocks, max_block_pair_cost=-1).count() == 3


def test_refine_merge_purge(spark):
    blocks = blocks_of(spark, {"A": [1, 2, 3], "B": [1, 2]})
    index = spark.createDataFrame([(1, ["A", "B"]), (2, ["A", "B"]), (3, ["A"])], "record_id long, all_keys array<string>")
    refined = redundancy.refine_blocks(blocks, index, 2)
    assert sorted((r.block_id, r.record_id) for r in refined.collect()) == [("A|B", 1), ("A|B", 2)]
    merged = redundancy.merge_blocks(blocks.unionByName(refined))
    assert {r.block_id for r in merged.collect()} == {"A", "A|B"}
    assert {r.block_id for r in redundancy.purge_subsets(merged).collect()} == {"A"}


def test_top_blocks(spark):
    blocks = blocks_of(spark, {"one": [1], "two": [1, 2], "three": [1, 2, 3]})
    # a block of one takes a place before it is dropped
    assert {(r.block_id, r.record_id) for r in redundancy.top_blocks(blocks, 1, 2).collect()} == set()
    assert {(r.block_id, r.record_id) for r in redundancy.top_blocks(blocks, 2, 2).collect()} == {("two", 1), ("two", 2), ("three", 2), ("three", 3)}


def test_redundancy_recursion(spark):
    rows = [(r, k) for r, own in {1: "AB", 2: "AB", 3: "A", 4: "C", 5: "C"}.items() for k in own]
    keyed = spark.createDataFrame(rows, "record_id long, block_key string")
    options = RedundancyOptions(arcs_max_recursion_depth=2, arcs_do_purge=True, arcs_weighting="idf", arcs_tau=0.1)
    assert {(r.src, r.dst) for r in redundancy.redundancy_edges(keyed, options).collect()} >= {(1, 2), (4, 5)}
    with pytest.raises(NotImplementedError):
        RedundancyOptions(arcs_density_floor=0.5)


def closure(n, edges):
    low = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


@pytest.mark.parametrize("seed", range(4))
def test_components_agree(spark, seed):
    rnd = random.Random(seed)
    n = 60
    pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(45)] + ([(i, i + 1) for i in range(20, 50)] if seed % 2 else [])
    edges = spark.createDataFrame(pairs, "src long, dst long")
    vertices = spark.createDataFrame([(i,) for i in range(n)], "record_id long")
    expected = dict(enumerate(closure(n, pairs)))
    for options in (MergeOptions("local"), MergeOptions("star"), MergeOptions("auto", merge_local_edge_limit=10), MergeOptions("auto")):
        assert {r.record_id: r.cluster_id for r in connected_components(edges, vertices, options).collect()} == expected


def test_components_edges(spark):
    empty = spark.createDataFrame([], "src long, dst long")
    assert star_components(empty).count() == 0 and local_components(empty).count() == 0
    odd = spark.createDataFrame([(5, 6), (6, 5), (9, 9), (None, 1)], "src long, dst long")
    for found in (star_components(odd), local_components(odd)):
        assert sorted(map(tuple, found.collect())) == [(5, 5), (6, 5)]
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "src long, dst long")
    with pytest.raises(NotConverged):
        star_components(path, 1)


def dbscan(points, eps, least):
    near = [[j for j, q in enumerate(points) if sum((a - b) ** 2 for a, b in zip(p, q, strict=True)) <= eps * eps] for p in points]
    core = [len(x) >= least for x in near]
    return near, core


@pytest.mark.parametrize("least", [1, 2, 4])
def test_density(spark, least):
    rnd = random.Random(least)
    words = ["".join(rnd.choice("ab1 -") for _ in range(rnd.randint(2, 9))) for _ in range(40)]
    values = [(i, "f", 0, w) for i, w in enumerate(words)]
    cells = extract_features(normalize(spark.createDataFrame(values, "record_id long, source string, col_index int, value string")))
    keyed = cells.withColumn("block_key", F.lit("k"))
    from kinfold.functions.lexical import scaled_features

    columns = scaled_features(F.col("feat"))
    points = {r.record_id: tuple(r[n] for n in columns) for r in keyed.select("record_id", *(c.alias(n) for n, c in columns.items())).collect()}
    ids, eps = sorted(points), 0.15
    near, core = dbscan([points[i] for i in ids], eps, least)
    pairs = [(ids[i], ids[j]) for i in range(len(ids)) for j in near[i] if i != j and core[i] and core[j]]
    expected = closure(max(ids) + 1, pairs)
    found = density.density_edges(keyed, DensityOptions(eps, least))
    got = closure(max(ids) + 1, [(r.src, r.dst) for r in found.collect()])
    cores = [ids[i] for i in range(len(ids)) if core[i]]
    for a in cores:
        for b in cores:
            assert (got[a] == got[b]) == (expected[a] == expected[b])
    for i, a in enumerate(ids):  # a border joins one of its cores, noise nobody
        touching = {expected[ids[j]] for j in near[i] if core[j]}
        if not core[i]:
            assert (got[a] in {got[ids[j]] for j in near[i] if core[j]}) if touching else got.count(got[a]) == 1 or got[a] == a


def test_density_golden(spark):
    """Three equal values and a far one: a star of the equal ones."""
    rows = [(10, "f", 0, "aaaa"), (11, "f", 0, "aaaa"), (12, "f", 0, "aaaa"), (99, "f", 0, "1234 5678 9012")]
    cells = extract_features(normalize(spark.createDataFrame(rows, "record_id long, source string, col_index int, value string")))
    found = density.density_edges(cells.withColumn("block_key", F.lit("k")), DensityOptions(0.2, 2))
    assert sorted(map(tuple, found.collect())) == [(10, 11), (10, 12)]


def test_clusters(spark):
    feat = "struct<length:int,digit_ratio:float,alpha_ratio:float>"
    cells = spark.createDataFrame([(1, 0, (4, 0.0, 1.0)), (1, 1, (50, 1.0, 0.0)), (2, 3, (6, 0.5, 0.5))], f"record_id long, col_index int, feat {feat}")
    assigned = spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "record_id long, cluster_id long")
    rows = {r.cluster_id: r for r in aggregate_clusters(assigned, cells).collect()}
    assert rows[1].cohesion == pytest.approx(0.484375) and rows[1].members == [1, 2] and rows[1]["size"] == 2
    assert rows[3].cohesion == 1.0
    assert {r.cluster_id: r.members for r in aggregate_clusters(assigned, cells, 1).collect()} == {1: None, 3: [3]}
    assert [r.cluster_id for r in filter_clusters(aggregate_clusters(assigned, cells), ClusterOptions(min_cluster_cohesion=0.4)).collect()] == [1]


def test_scores(spark):
    assigned = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4)], "record_id long, cluster_id long")
    ref = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "record_id long, ref_id string")
    truth = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", "y")], "ref_id string, truth_id string")
    assert scoring.pair_metrics(assigned, ref, truth).first().asDict() == {"TP": 1, "FP": 2, "FN": 1, "L": 3, "E": 2, "precision": 0.3333, "recall": 0.5, "f1": 0.4}
    none = scoring.pair_metrics(assigned.limit(0), ref, truth.limit(0)).first()
    assert (none.precision, none.recall, none.f1) == (1.0, 1.0, 1.0)
    assert [tuple(r) for r in scoring.truth_distribution(truth).collect()] == [(2, 2)]


def test_options():
    changed = Options().with_overrides(clustering_method="arcs", arcs_tau=0.5, min_block_size=3)
    assert (changed.run.clustering_method, changed.redundancy.arcs_tau, changed.keys.min_block_size) == ("arcs", 0.5, 3)
    assert changed.flat()["arcs_tau"] == 0.5
    for bad in ({"clustering_method": "x"}, {"arcs_weighting": "tf"}, {"merge_strategy": "y"}, {"input_format": "orc"}, {"output_format": "csv"}, {"no_such": 1}, {"min_block_size": 0}, {"max_cluster_size": 1}):
        with pytest.raises(ValueError):
            Options().with_overrides(**bad)
