import random
from collections import Counter

import numpy as np
import pytest

from kinfold.llm import simhash
from by_hand import components_by_hand, print_by_hand


def near_texts(seed, n=120):
    rnd = random.Random(seed)
    base = [[rnd.choice("abcdefghij") * rnd.randint(1, 4) for _ in range(300)] for _ in range(6)]
    rows = []
    for i in range(n):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 5])):
            words[rnd.randrange(len(words))] = f"x{i}"
        rows.append((i * 3, " ".join(words)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "One two"), (1004, "one TWO"), (1005, "Éa b"), (None, rows[0][1]), (None, "alone here now then"), (3, rows[5][1]), (3, rows[5][1]), (1006, "long words " * 20_000)]
    rnd.shuffle(rows)
    return rows


def test_every_pair_within_four_bits_shares_an_anchor():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    for bits in range(5):
        y = x.copy()
        for k in range(len(x)):
            for b in rng.choice(64, bits, replace=False):
                y[k] ^= np.uint64(1) << np.uint64(b)
        for a, b in zip(x[:400], y[:400], strict=True):
            one, two = (set(simhash.anchors(np.array([p], np.uint64))[1].tolist()) for p in (a, b))
            assert one & two and len(one) <= 33


def test_links_at_anchors_are_all_links():
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 2**64, 30, dtype=np.uint64)
    prints = np.unique(np.concatenate([seeds[rng.integers(0, 30, 2000)] ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64))]))
    which, anchor = simhash.anchors(prints)
    a, b = simhash.links_at_anchors(anchor, prints[which])
    root = {p: p for p in prints.tolist()}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for p, q in zip(a.tolist(), b.tolist(), strict=True):
        root[find(p)] = find(q)
    for k, p in enumerate(prints):
        for q in prints[: k][np.bitwise_count(prints[:k] ^ p) <= 4].tolist():
            assert find(int(p)) == find(q)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rows = near_texts(seed)
    df = spark.createDataFrame([(*r, 7, "f") for r in rows], "doc_id long, text string, component long, fingerprint string")
    found = Counter((r.doc_id, r.fingerprint & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(df).collect())
    assert found == components_by_hand(rows)


def test_rows_that_share_a_doc_id_are_judged_each(spark):
    """A row of doc 5 that is like doc 3 goes, its other row, unlike all, stays; of unlike rows of one id both stay."""
    like, alone, other, fourth = (" ".join(f"{c}{i}" for i in range(40)) for c in "abcd")
    df = spark.createDataFrame([(5, alone), (5, like), (3, like), (9, other), (9, fourth)], "doc_id long, text string")
    found = sorted((r.doc_id, r.text) for r in simhash.keep_one_of_each(df).collect())
    assert found == sorted([(5, alone), (3, like), (9, other), (9, fourth)])


def test_one_of_each_stays(spark):
    rows = near_texts(3)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n long")
    kept = [r.doc_id for r in simhash.keep_one_of_each(df).collect()]
    # a group of rows keeps one with its least id, whatever other rows have that id
    prints, group = [print_by_hand(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    expected = {}
    for g, (d, _) in zip(group, rows, strict=True):
        if d is not None:
            expected[g] = min(expected.get(g, d), d)
    assert sorted(k for k in kept if k is not None) == sorted(expected.values()) and kept.count(None) == 2


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one_of_each(empty).count() == 0
    with pytest.raises(ValueError):
        simhash.links(empty, 9)


def test_query(spark, sf_dir):
    import __spark_entry__ as entry

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = Counter((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in entry.queries()["op8_simhash"](spark, sf_dir).collect())
    assert found == components_by_hand(rows)
