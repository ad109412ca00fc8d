import random
import re

import numpy as np
import pytest

import corpus_pipeline
from kinfold.llm import near_copies


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept_by_hand(rows):
    """The (doc_id, text) of each group's first row, and the rows without an id."""
    import hashlib

    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 10 * len(a & b) >= 8 * len(a | b) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    key = lambda r: (r[0], hashlib.md5((r[1] or "").encode()).hexdigest())
    first = {}
    for g, r in zip(group, rows, strict=True):
        if r[0] is not None:
            first[g] = min(first.get(g, r), r, key=key)
    return sorted(map(key, first.values())), sum(d is None for d, _ in rows)


def kept(spark, rows, docs_of=near_copies.keep_one_of_each):
    import hashlib

    out = docs_of(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, class long")).collect()
    return sorted((r.doc_id, hashlib.md5((r.text or "").encode()).hexdigest()) for r in out if r.doc_id is not None), sum(r.doc_id is None for r in out)


@pytest.mark.parametrize("seed,tight", [(1, False), (2, True)])
def test_against_brute_force(spark, monkeypatch, seed, tight):
    """tight: components of several chunks, and several rounds of leaders."""
    if tight:
        for name, value in (("CHUNK", 7), ("LEADERS", 2), ("MOST_LEADERS", 5)):
            monkeypatch.setattr(near_copies, name, value)
    rnd = random.Random(seed)
    base = [[rnd.choice("abcdefghij") * rnd.randint(1, 4) for _ in range(rnd.choice([6, 40, 300]))] for _ in range(9)]
    rows = []
    for i in range(150):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 1, 2, 3, 4, 6, 8])):
            words[rnd.randrange(len(words))] = f"x{i}"
        rows.append((i * 3, " ".join(words)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "One two"), (1004, "one TWO"), (1005, "Éa b"), (None, rows[0][1]), (None, "alone"), (3, rows[5][1]), (3, rows[5][1]), (1006, "long words " * 20_000)]
    rnd.shuffle(rows)
    assert kept(spark, rows) == kept_by_hand(rows)


def test_the_stage_links_copies_beyond_four_bits(spark, sf_dir):
    """Documents 1 and 177 of the smallest tables have similarity 0.83 and fingerprints 9 bits apart."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    expected, _ = kept_by_hand(rows)
    out = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()]
    assert sorted(out) == [d for d, _ in expected] and 1 in out and 177 not in out


def test_links_are_exact():
    rnd = random.Random(3)
    sets = [sorted(rnd.sample(range(30), rnd.choice([0, 1, 5, 20, 24, 25, 28]))) for _ in range(60)]
    arrays = [np.array(x, "<u8") for x in sets]
    a, b = near_copies.linked(arrays, arrays[:20])
    expected = {(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets[:20]) if 10 * len(set(x) & set(y)) >= 8 * len(set(x) | set(y))}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == expected


def test_empty(spark):
    assert near_copies.keep_one_of_each(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def prints_of_pairs(n, own, other, shared):
    """Fingerprints of n pairs of random sets, one beside the other."""
    rng = np.random.default_rng(own)
    sets = [x for _ in range(n) for x in [rng.integers(0, 2**64, own + other - shared, dtype=np.uint64)] for x in (x[:own], x[own - shared :])]
    return near_copies.wide_prints(np.concatenate(sets), np.array([len(x) for x in sets])), np.array([len(x) for x in sets])


def test_bits_are_majorities_of_the_shingles():
    prints, sizes = prints_of_pairs(2, 700, 700, 600)
    assert prints.shape == (4, near_copies.WORDS)
    rng = np.random.default_rng(700)
    sets = [rng.integers(0, 2**64, 800, dtype=np.uint64)[:700] for _ in range(2)]
    single = near_copies.wide_prints(np.concatenate(sets), np.ones(1400, np.int64)).reshape(2, 700, -1)
    bits = np.unpackbits(single.view(np.uint8), axis=2)
    assert np.array_equal(np.unpackbits(prints[::2].view(np.uint8), axis=1), 2 * bits.sum(1) > 700)
    blocks = [near_copies.block_of(prints, t) for t in range(near_copies.TABLES)]
    for row, print_ in enumerate(prints):
        whole = int.from_bytes(print_.astype("<u8").tobytes(), "little")
        assert [int(b[row]) for b in blocks] == [whole >> 23 * t & 0x7FFFFF for t in range(near_copies.TABLES)]


@pytest.mark.parametrize("own,other,shared", [(9, 9, 8), (90, 90, 80), (800, 1000, 800), (4, 5, 4)])
def test_texts_at_the_least_similarity_meet_at_an_anchor(own, other, shared):
    """The stage's candidates are SimHash fingerprints at anchors: pairs at exactly 0.8 link at one of them."""
    prints, sizes = prints_of_pairs(300, own, other, shared)
    met = set()
    for t in range(near_copies.TABLES):
        a, b = near_copies.links_at_anchors(near_copies.block_of(prints, t), prints, sizes)
        met |= {frozenset(p) for p in zip(a.tolist(), b.tolist(), strict=True)}
    assert met == {frozenset((2 * k, 2 * k + 1)) for k in range(300)}


def test_a_hot_anchor_loses_no_link():
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 2**64, (900, near_copies.WORDS), dtype=np.uint64)
    noise = lambda n, share: np.packbits(rng.random((n, 384)) < share, axis=1).view(np.uint64)
    prints[:600] = prints[0] ^ noise(600, 0.08)
    prints[600:640] = prints[599] ^ noise(40, 0.2)
    prints[700:720] = prints[700] ^ noise(20, 0.1)
    order, sizes = rng.permutation(900), np.sort(rng.integers(80, 100, 900))
    prints = prints[order]

    def groups(a, b):
        node, root = near_copies._forest(np.asarray(a), np.asarray(b))
        label = np.arange(900)
        label[node] = root
        return label.tolist()

    i, j = np.triu_indices(900, 1)
    near = (np.bitwise_count(prints[i] ^ prints[j]).sum(1) <= near_copies.MAX_BITS) & (np.bitwise_count(prints[i, :2] ^ prints[j, :2]).sum(1) <= near_copies.FIRST_BITS) & (sizes[i] >= 0.8 * sizes[j])
    assert groups(*near_copies.links_of(prints, sizes)) == groups(i[near], j[near])
    blocks = near_copies.block_of(prints, 2)
    whole = groups(*near_copies.links_at_anchors(blocks, prints, sizes))
    dealt = [near_copies.links_at_anchors(blocks, prints, sizes, 3, k) for k in range(3)]
    assert groups(*(np.concatenate(x) for x in zip(*dealt, strict=True))) == whole


def test_classes_dealt_by_anchor(spark, monkeypatch):
    """More classes of a size than a bucket takes."""
    monkeypatch.setattr(near_copies, "BUCKET_CLASSES", 7)
    rnd = random.Random(8)
    base = [[rnd.choice("abcdefghij") * rnd.randint(1, 4) for _ in range(n)] for n in (9, 60, 66, 130)]
    rows = []
    for i in range(60):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 1, 2, 3])):
            words[rnd.randrange(len(words))] = f"x{i}"
        rows.append((i, " ".join(words)))
    assert kept(spark, rows) == kept_by_hand(rows)
