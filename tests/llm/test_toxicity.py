import os
import random
import zlib

import numpy as np
import pytest

from kinfold.llm import toxicity
from kinfold.llm.toxicity import FitOptions, Machine


def corpus(n=600, seed=4):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefg") for _ in range(rnd.randint(3, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        own = [rnd.choice(words) for _ in range(rnd.randint(5, 80))]
        toxic = i % 4 == 0
        if toxic:
            own[rnd.randrange(len(own))] = rnd.choice(["moronx", "Scumlord", "scumbagz"])
        rows.append((i, " ".join(own)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_columns(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in [*rows, (9000, None), (9001, ""), (None, "moronx"), (3, "moronx again"), (9002, "long words " * 50_000)]], "doc_id long, text string, terms string, score double")
    truth = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")
    found = toxicity.toxicity(docs, truth).collect()
    assert len(found) == len(rows) + 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    label = dict(labels)
    held = [r for r in found if r.held_out and r.doc_id in label]
    assert {r.doc_id for r in held} == {i for i in label if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum(r.predicted == label[r.doc_id] for r in held)
    assert right / len(held) > 0.95
    clean = {r.doc_id for r in toxicity.reject_toxic(docs, truth).collect()}
    assert clean == {r.doc_id for r in found if not r.predicted and r.doc_id != 3} | ({3} if any(r.doc_id == 3 and not r.predicted for r in found) else set())


def test_held_out_labels_are_not_read(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scores = []
    for flip in (0, 1):
        changed = [(i, y ^ flip if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
        scores.append(sorted(map(tuple, toxicity.toxicity(docs, spark.createDataFrame(changed, "doc_id long, toxic int")).collect())))
    assert scores[0] == scores[1]


def test_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r.score < 1e-6 for r in toxicity.toxicity(docs, none).collect())
    assert toxicity.toxicity(docs.limit(0), none).count() == 0


def test_score_is_the_factorization_machine():
    rng = np.random.default_rng(1)
    machine = Machine(np.arange(6), 0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    own = [0, 2, 5]
    pair = sum(machine.factors[a] @ machine.factors[b] for k, a in enumerate(own) for b in own[:k])
    expected = 1 / (1 + np.exp(-(0.3 + machine.weights[own].sum() + pair)))
    assert machine.scores(np.array(own), np.zeros(3, int), 2) == pytest.approx([expected, 1 / (1 + np.exp(-0.3))])


def test_pairs_that_no_sum_of_weights_can_tell():
    """Toxic exactly if both words, or neither, stand together: only the pairwise part can learn it."""
    rnd = random.Random(8)
    terms, y = [], []
    for _ in range(2000):
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        terms.append(np.array(sorted({10 if a else 11, 20 if b else 21})))
        y.append(float(a == b))
    machine = toxicity.fit_rows(np.array(y), terms, FitOptions(min_z=0.0, epochs=60))
    at = {int(t): k for k, t in enumerate(machine.terms)}
    score = lambda *t: machine.scores(np.array([at[x] for x in t]), np.zeros(len(t), int), 1)[0]
    assert min(score(10, 20), score(11, 21)) > 0.5 > max(score(10, 21), score(11, 20))


def test_a_pair_of_terms_without_a_signal_of_their_own():
    """Two terms never together in clean documents and together in 45 toxic ones, with the options of production."""
    rnd = np.random.default_rng(3)
    terms, y = [], []
    for i in range(6000):
        own, toxic = set((100 + rnd.choice(400, 12, replace=False)).tolist()), i >= 3000
        own |= {10} if i < 60 else {20} if i < 120 else {10, 20} if 3000 <= i < 3045 else {30} if toxic else set()
        terms.append(np.array(sorted(own)))
        y.append(float(toxic))
    machine = toxicity.fit_rows(np.array(y), terms, FitOptions())
    at = {int(t): k for k, t in enumerate(machine.terms)}
    assert {10, 20} <= at.keys() and not set(range(100, 500)) <= at.keys()
    score = lambda *t: machine.scores(np.array([at[x] for x in t]), np.zeros(len(t), int), 1)[0]
    assert score(10, 20) > 0.5 > max(score(10), score(20))


def test_the_driver_does_not_fit(spark, monkeypatch):
    """Its memory doesn't hold the pairs of the sample's terms."""
    driver, fit_rows = os.getpid(), toxicity.fit_rows

    def elsewhere(y, terms, options):
        assert os.getpid() != driver
        return fit_rows(y, terms, options)

    rows, labels = corpus(200)
    docs, truth = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    learned = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5]
    terms = [np.unique(np.array([b for w in toxicity.text_words(rows[i][1]) for b in toxicity.word_buckets(w)], "<u4")) for i in learned]
    expected = fit_rows(np.array([labels[i][1] for i in learned], np.float64), terms, FitOptions())
    monkeypatch.setattr(toxicity, "fit_rows", elsewhere)
    machine = toxicity.fit(docs, truth)
    assert machine.bias == expected.bias and all(np.array_equal(getattr(machine, k), getattr(expected, k)) for k in ("terms", "weights", "factors"))
