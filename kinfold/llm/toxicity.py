"""Toxicity scores from a factorization machine over hashed terms.

A document is the set of its hashed terms: each lower-cased word and the word's prefixes of 3 to 7 letters (a stem with
an ending never seen before still counts).  The score is the logistic of

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

so that two terms together (an insult with a group mention) can weigh more, or less, than the sum of both.  A term has
weight if the labels of the sample's documents with it differ from the others' (|z| of min_z or more), or if it is in a
pair whose documents' labels differ from those of all documents and of either term's (each by a log likelihood ratio of
pair_evidence or more; all pairs are counted).

The model is fitted on a bounded sample of the labelled documents: at most `sample_per_class` of each label, those with
the smallest hash of doc_id.  One task of an executor fits it; the driver only gets the machine.  Scores cover every whole text.  Labels, lang, source and doc_id are never inputs.

Cases: a null or empty text has no terms and gets the base score; labels that are null count as unlabelled; of labels
given twice the highest counts; without labels of both kinds every score is the share of toxic labels (0 without any).
Repeated rows are scored one by one; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import give_back

HASH_BITS = 20
PREFIXES = range(3, 8)
TERM = re.compile(r"\w+")
#: Words known to a worker before its cache starts anew.
CACHE_WORDS = 100_000


@dataclass(frozen=True)
class FitOptions:
    sample_per_class: int = 3000
    factors: int = 4
    epochs: int = 30
    batch: int = 256
    rate: float = 0.1
    decay: float = 1e-4
    min_texts: int = 4
    min_z: float = 3.0
    #: At least; where more pairs are compared, the logarithm of their number counts (at most one by chance).
    pair_evidence: float = 16.0
    seed: int = 7


@dataclass(frozen=True)
class Machine:
    """terms: sorted buckets that carry weight; bias, weights and factors: of the machine."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, rows: np.ndarray, which: np.ndarray, n: int) -> np.ndarray:
        """rows: indices into terms; which: the document of each; n: number of documents."""
        linear = np.bincount(which, self.weights[rows], n)
        pair = np.zeros(n)
        for f in range(self.factors.shape[1]):
            v = self.factors[rows, f]
            pair += np.bincount(which, v, n) ** 2 - np.bincount(which, v * v, n)
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + pair / 2, -30, 30)))


def word_buckets(word: str) -> list[int]:
    parts = ["=" + word, *("^" + word[:k] for k in PREFIXES if len(word) >= k)]
    return [xxhash.xxh32_intdigest(p) >> (32 - HASH_BITS) for p in parts]


def text_words(text: str | None) -> set[str]:
    return set(TERM.findall((text or "").lower()))


def is_held_out(doc_id: Column) -> Column:
    """The rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, options: FitOptions) -> DataFrame:
    """Rows (doc_id, toxic, terms), labels and term buckets of the bounded sample."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = None
    for label in (0, 1):
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(options.sample_per_class)
        picked = part if picked is None else picked.unionByName(part)

    def work(batches):
        for batch in (part for whole in batches for part in _slices(whole)):
            packed = [np.unique(np.array([b for w in text_words(t) for b in word_buckets(w)], "<u4")).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(packed, pa.binary())], ["doc_id", "toxic", "terms"])

    # at most two times sample_per_class rows are broadcast
    joined = docs.join(F.broadcast(picked), "doc_id").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(work, f"doc_id {id_type}, toxic int, terms binary").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("terms").alias("terms"))


def fit(docs: DataFrame, labels: DataFrame, options: FitOptions = FitOptions()) -> Machine:
    """docs (doc_id, text), labels (doc_id, toxic): the machine for their bounded sample."""

    def learn(table: pa.Table) -> pa.Table:
        rows = table.sort_by("doc_id").select(["toxic", "terms"]).to_pydict()
        machine = fit_rows(np.array(rows["toxic"], np.float64), [np.frombuffer(t, "<u4") for t in rows["terms"]], options)
        del rows
        give_back()
        arrays = (machine.terms.astype("<i8"), machine.weights.astype("<f8"), machine.factors.astype("<f8"))
        return pa.table({"bias": pa.array([float(machine.bias)]), **{name: pa.array([x.tobytes()], pa.binary()) for name, x in zip(("terms", "weights", "factors"), arrays, strict=True)}})

    found = _sample(docs, labels, options).groupBy(F.lit(0).alias("all")).applyInArrow(learn, "bias double, terms binary, weights binary, factors binary").collect()
    if not found:
        return fit_rows(np.zeros(0), [], options)
    bias, terms, weights, factors = found[0]
    return Machine(np.frombuffer(terms, "<i8"), bias, np.frombuffer(weights, "<f8"), np.frombuffer(factors, "<f8").reshape(-1, options.factors))


def _evidence(toxic: np.ndarray, seen: np.ndarray, share: np.ndarray | float) -> np.ndarray:
    """Log likelihood ratio of a share of toxic / seen against `share`, negative where it is lower."""
    own = toxic / seen
    share = np.clip(share, 1e-9, 1 - 1e-9)
    ratio = toxic * np.log(np.maximum(own, 1e-300) / share) + (seen - toxic) * np.log(np.maximum(1 - own, 1e-300) / (1 - share))
    return np.where(own < share, -ratio, ratio)


def paired_terms(y: np.ndarray, terms: list[np.ndarray], often: np.ndarray, least: float) -> np.ndarray:
    """Those of the terms `often` that are in a pair which tells more of the label than both its terms and than no term."""
    n, share = len(y), y.mean()
    size = np.array([len(own) for own in terms])
    doc = np.repeat(np.arange(n, dtype=np.int32), size)
    index = np.full(1 << HASH_BITS, -1, np.int32)
    index[often] = np.arange(len(often))
    column = index[np.concatenate(terms)]
    some = column >= 0
    column, doc = column[some], doc[some]
    # terms of the same documents (a word and its prefixes) are one column; marks are random, two of 62 bits for each document
    marks = np.random.default_rng(0).integers(0, 1 << 62, (2, n))
    sums = [np.zeros(len(often), np.int64) for _ in marks]
    for total, mark in zip(sums, marks, strict=True):
        np.add.at(total, column, mark[doc])
    _, first, same = np.unique(np.stack(sums, 1), axis=0, return_index=True, return_inverse=True)
    same = same.ravel().astype(np.int32)
    keep = first[same[column]] == column
    column, doc = same[column[keep]], doc[keep]
    seen, toxic = np.bincount(column, minlength=len(first)), np.bincount(column, y[doc], len(first))
    own_share = toxic / np.maximum(seen, 1)
    # the most that any pair of a term can reach: all its toxic documents and no other, or all its clean ones and no other
    reach = np.maximum(toxic * -np.log(np.maximum(own_share, share)), (seen - toxic) * -np.log(1 - np.minimum(own_share, share)))
    able = np.flatnonzero(reach >= least)
    least = max(least, 2 * np.log(max(len(able), 1)) - np.log(2))
    able = np.flatnonzero(reach >= least)
    fewest = least / -np.log(min(share, 1 - share))
    # from the most frequent to the rarest, so that the later ones of a document are few
    able = able[np.argsort(-seen[able], kind="stable")]
    place = np.full(len(first), -1)
    place[able] = np.arange(len(able))
    some = place[column] >= 0
    column, doc, own_share = place[column[some]].astype(np.int32), doc[some], own_share[able]
    order = np.lexsort((column, doc))
    flat, ends = column[order], np.cumsum(np.bincount(doc, minlength=n))
    # of each column, where its entries are in flat
    home = np.argsort(flat, kind="stable")
    cuts = np.searchsorted(flat[home], np.arange(len(able) + 1))
    owner = doc[order]
    found = np.zeros(len(able), bool)
    for k in range(len(able) - 1):
        at = home[cuts[k] : cuts[k + 1]]
        docs_of, left = owner[at], len(able) - k - 1
        counts = []
        for label in (y[docs_of] > 0, y[docs_of] <= 0):
            later = [flat[i:e] for i, e in zip((at[label] + 1).tolist(), ends[docs_of[label]].tolist(), strict=True)]
            counts.append(np.bincount(np.concatenate(later) - (k + 1), minlength=left) if later else np.zeros(left, np.int64))
        both = counts[0] + counts[1]
        others = np.flatnonzero(both >= fewest)
        if not len(others):
            continue
        t, c = counts[0][others].astype(float), both[others].astype(float)
        others += k + 1
        against = np.stack([_evidence(t, c, share), _evidence(t, c, own_share[k]), _evidence(t, c, own_share[others])])
        hit = others[(against.min(0) >= least) | (against.max(0) <= -least)]
        if len(hit):
            found[k] = True
            found[hit] = True
    return often[np.isin(same, able[found])]


def fit_rows(y: np.ndarray, terms: list[np.ndarray], options: FitOptions) -> Machine:
    n, positive = len(y), float(y.sum())
    none = np.zeros(0, np.int64)
    if not 0 < positive < n:
        share = positive / n if n else 0.0
        return Machine(none, 30.0 * np.sign(share - 0.5), np.zeros(0), np.zeros((0, options.factors)))
    share, seen, toxic = positive / n, np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
    for label, own in zip(y, terms, strict=True):  # a document's terms are distinct
        seen[own] += 1
        toxic[own] += label
    z = (toxic - seen * share) / np.sqrt(seen * share * (1 - share) + 1e-9)
    often = seen >= options.min_texts
    chosen = np.union1d(np.flatnonzero(often & (np.abs(z) >= options.min_z)), paired_terms(y, terms, np.flatnonzero(often), options.pair_evidence))
    index = np.full(1 << HASH_BITS, -1)
    index[chosen] = np.arange(len(chosen))
    kept = [index[own][index[own] >= 0] for own in terms]
    row, doc = np.concatenate(kept), np.repeat(np.arange(n), [len(k) for k in kept])
    at = np.searchsorted(doc, np.arange(n + 1))
    rng = np.random.default_rng(options.seed)
    w, v, bias = np.zeros(len(chosen)), rng.normal(0, 0.02, (len(chosen), options.factors)), np.log(share / (1 - share))
    gw, gv, gb = np.full(len(chosen), 1e-8), np.full(v.shape, 1e-8), 1e-8
    # both labels weigh the same in a fit; the bias keeps documents without useful terms below one half
    for _ in range(options.epochs):
        order = rng.permutation(n)
        for k in range(0, n, options.batch):
            docs_of = order[k : k + options.batch]
            lens = at[docs_of + 1] - at[docs_of]
            local = np.repeat(np.arange(len(docs_of)), lens)
            rows = row[np.concatenate([np.arange(at[d], at[d + 1]) for d in docs_of])] if lens.sum() else np.zeros(0, np.int64)
            s = np.zeros((len(docs_of), options.factors))
            np.add.at(s, local, v[rows])
            pair = ((s**2).sum(1) - np.bincount(local, (v[rows] ** 2).sum(1), len(docs_of))) / 2
            margin = np.clip(bias + np.bincount(local, w[rows], len(docs_of)) + pair, -30, 30)
            err = (1 / (1 + np.exp(-margin)) - y[docs_of]) / len(docs_of)
            g = np.bincount(rows, err[local], len(w)) + options.decay * w
            dv = np.zeros_like(v)
            np.add.at(dv, rows, err[local][:, None] * (s[local] - v[rows]))
            dv += options.decay * v
            gw, gv, gb = gw + g * g, gv + dv * dv, gb + err.sum() ** 2
            w -= options.rate * g / np.sqrt(gw)
            v -= options.rate * 0.2 * dv / np.sqrt(gv)
            bias -= options.rate * err.sum() / np.sqrt(gb)
    return Machine(chosen, float(bias), w, v)


class _Scorer:
    """Scores of whole texts; remembers the terms of the words it has met."""

    def __init__(self, machine: Machine):
        self.machine, self.known = machine, {}
        self.at = {int(b): k for k, b in enumerate(machine.terms)}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        rows: list[int] = []
        sizes, known, at = [], self.known, self.at
        if len(known) > CACHE_WORDS:
            known.clear()
        for text in texts:
            mine: set[int] = set()
            for word in text_words(text):
                found = known.get(word)
                if found is None:
                    found = known[word] = tuple([at[b] for b in word_buckets(word) if b in at])
                if found:
                    mine.update(found)
            rows.extend(sorted(mine))
            sizes.append(len(mine))
        return self.machine.scores(np.array(rows, np.int64), np.repeat(np.arange(len(sizes)), sizes), len(sizes))


def _slices(batch: pa.RecordBatch, rows: int = 500):
    return (batch.slice(k, rows) for k in range(0, batch.num_rows, rows))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """Rows (doc_id, score) for every row of docs (doc_id, text)."""

    def work(batches):
        scorer = _Scorer(machine)
        for batch in (part for whole in batches for part in _slices(whole)):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer(batch.column(1).to_pylist()))], ["doc_id", "score"])
        del scorer
        give_back()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(work, f"doc_id {id_type}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, options: FitOptions = FitOptions()) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted) for every row of docs, learned from labels (doc_id, toxic)."""
    pairs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    scored = score(pairs, fit(pairs, labels.select("doc_id", "toxic"), options))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, options: FitOptions = FitOptions()) -> DataFrame:
    """The rows of docs, all columns, whose text doesn't score as toxic."""
    machine = fit(docs.select("doc_id", F.col("text").cast("string").alias("text")), labels.select("doc_id", "toxic"), options)

    at = docs.columns.index("text")

    def keep(batches):
        scorer = _Scorer(machine)
        for batch in (part for whole in batches for part in _slices(whole)):
            yield batch.filter(pa.array(scorer(batch.column(at).to_pylist()) < 0.5))
        del scorer
        give_back()

    return docs.mapInArrow(keep, docs.schema)
