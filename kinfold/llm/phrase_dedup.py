r"""Repeated word passages located by Aho-Corasick automata, all but their first occurrence removed.

1. Confirm: windows of `window` consecutive words that may recur meet in the bucket of their core (kinfold.llm.windows).
   There those that occur more than once are found, the words left and right of the core one by one, the core by its
   128-bit name.  Neighbouring windows that recur side by side make one passage; its first occurrence is noted.
2. Compile: every block of documents gets the passages that can occur in it, those whose cores it holds, and compiles
   them to automata (pyahocorasick), in shards of at most SHARD_WORDS words.
3. Stream: every document of the block goes whole through each of these automata, which report every occurrence of every
   passage, word for word.  An automaton for a block costs what the block holds, however large the corpus is.

Of a passage's occurrences the first stays: smallest doc_id, then smallest start.  Every window of a later occurrence
covers words to remove; windows are judged on the input, not on what is left.

Cases: words are runs of anything but U+0020 and U+0009..U+000D, compared unchanged; null, empty and blank texts have no
words; a text shorter than a window keeps all; rows that share a doc_id are one document as to order, so of equal starts
neither is earlier and both stay; null ids come last and share one place in the order; an id that isn't an integer raises
ValueError; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import ranges, space_mask
from kinfold.llm.windows import Answers, Block, Exchange, Sent, Shape, covered, find_repeats

WINDOW = 20
#: Words of the passages that one automaton holds.
SHARD_WORDS = 500_000
#: A passage in a phrase: its first and last window there, and where it stands first in the corpus.
PASSAGE = np.dtype([("low", "u1"), ("high", "u1"), ("doc_id", "<i8"), ("place", "<i8")])


def _word_lines(sent: Sent, rows: np.ndarray, side: int, counts: np.ndarray, width: int) -> np.ndarray:
    """The words left (0) or right (2) of the core as numbers from 1, from the core outwards; 0 beyond the phrase."""
    number = pd.factorize(np.array([*sent.contexts(rows, side).split(), None], object)[:-1])[0] + 1
    lines = np.zeros((len(rows), width), np.int64)
    row = np.repeat(np.arange(len(rows)), counts)
    at = ranges(np.zeros(len(rows), np.int64), counts)
    lines[row, counts[row] - 1 - at if side == 0 else at] = number
    return lines


def _prefix_classes(core: np.ndarray, lines: np.ndarray) -> list[np.ndarray]:
    """For every k a number for each line, equal for lines of one core that share their first k words."""
    out = [core]
    for k in range(lines.shape[1]):
        out.append(np.unique(out[-1] * (int(lines[:, k].max(initial=0)) + 1) + lines[:, k], return_inverse=True)[1])
    return out


def resolve(sent: Sent, reach: int, core: int) -> tuple[np.ndarray, np.ndarray]:
    """The passages of every phrase, as PASSAGE."""
    one, group, many = sent.distinct()
    core_id = np.cumsum(np.concatenate([[True], (sent.names[one][1:] != sent.names[one][:-1]).any(1)])) - 1
    left, last = sent.left[one], sent.last[one]
    endings = _prefix_classes(core_id, _word_lines(sent, one, 0, left, reach - 1))
    beginnings = _prefix_classes(core_id, _word_lines(sent, one, 2, last - left + reach - 1, reach - 1))
    # of every window that recurs: phrase, number, and where its first occurrence stands
    found = []
    for depth in range(reach):
        some = np.flatnonzero((left - last <= depth) & (depth <= left))
        if not len(some):
            continue
        _, window, counts = np.unique(endings[depth][some] * (len(one) + 1) + beginnings[reach - 1 - depth][some], return_inverse=True, return_counts=True)
        recurs = np.flatnonzero((counts[window] > 1) | many[some])
        some, window, k = some[recurs], window[recurs], left[some[recurs]] - depth
        doc, place = sent.doc_id[one][some], sent.place[one][some] + k
        order = np.lexsort((place, doc, window))
        head = np.concatenate([[True], window[order][1:] != window[order][:-1]]) if len(order) else np.zeros(0, bool)
        first = order[head][np.cumsum(head) - 1]
        owner = np.empty(len(order), np.int64)
        owner[order] = first
        found.append(np.stack([some, k, doc[owner], place[owner]]))
    line, k, doc, place = np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
    order = np.lexsort((k, line))
    line, k, doc, place = line[order], k[order], doc[order], place[order]
    # a passage goes on while the next window recurs too and stands next to it at the first occurrence
    begins = np.concatenate([[True], (line[1:] != line[:-1]) | (k[1:] != k[:-1] + 1) | (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)]) if len(line) else np.zeros(0, bool)
    heads = np.flatnonzero(begins)
    passages = np.zeros(len(heads), PASSAGE)
    passages["low"], passages["high"] = k[heads], k[np.append(heads[1:], len(k)) - 1] if len(heads) else 0
    passages["doc_id"], passages["place"] = doc[heads], place[heads]
    own = np.bincount(line[heads], minlength=len(one))
    begin = np.cumsum(own) - own
    rows = np.repeat(np.arange(len(group)), own[group])
    return rows, passages[ranges(begin[group], own[group])].view(np.uint8).reshape(len(rows), PASSAGE.itemsize)


class _Automata:
    """Passages, as word numbers of a block, in sharded automata."""

    def __init__(self, words: np.ndarray, begin: np.ndarray, end: np.ndarray):
        self.words, self.begin, self.end = words, begin, end
        self.shard = (np.cumsum(end - begin) - (end - begin)) // SHARD_WORDS

    def occurrences(self, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, first word and passage of every occurrence in the texts (first word and number of words of each)."""
        text, start, passage = ([np.zeros(0, np.int64)] for _ in range(3))
        for k in np.unique(self.shard):
            automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
            for number in np.flatnonzero(self.shard == k).tolist():
                automaton.add_word(tuple(self.words[self.begin[number] : self.end[number]].tolist()), number)
            automaton.make_automaton()
            hits: list[tuple[int, int]] = []
            sizes = []
            for a, n in zip(first.tolist(), counts.tolist(), strict=True):
                before = len(hits)
                if n:
                    hits.extend(automaton.iter(tuple(self.words[a : a + n].tolist())))
                sizes.append(len(hits) - before)
            ends, which = np.array(hits, np.int64).reshape(-1, 2).T
            own = np.repeat(np.arange(len(sizes)), sizes)
            text.append(own)
            passage.append(which)
            start.append(first[own] + ends + 1 - (self.end - self.begin)[which])
        return np.concatenate(text), np.concatenate(start), np.concatenate(passage)


def _sole(of: np.ndarray, other: np.ndarray, n: int) -> np.ndarray:
    """For each of n classes the one class that `other` names wherever `of` is that class; -1 if there is none or another."""
    low, high = np.full(n, n), np.full(n, -1)
    np.minimum.at(low, of, other)
    np.maximum.at(high, of, other)
    return np.where(low == high, low, -1)


def _patterns(x: Answers) -> np.ndarray:
    """First and last window start of each passage where it first stands in the block, doc_id and place of its owner.

    Passages of phrases that always follow each other in the block, here and at the first occurrence, are one.
    """
    order = np.argsort(x.i0, kind="stable")
    i0, i1 = x.i0[order], x.i1[order]
    known, first, kind = np.unique(x.contents[order], return_index=True, return_inverse=True)
    near = i0[1:] == i1[:-1] + 1
    behind = _sole(kind, np.append(np.where(near, kind[1:], -1), -1), len(known))
    before = _sole(kind, np.append(-1, np.where(near, kind[:-1], -1)), len(known))
    own = np.searchsorted(known, x.keys)
    passages = np.ascontiguousarray(x.payload).view(PASSAGE).ravel()
    begin, end = i0[first[own]] + passages["low"], i0[first[own]] + passages["high"]
    order = np.argsort(begin, kind="stable")
    own, begin, end, doc, place = own[order], begin[order], end[order], passages["doc_id"][order], passages["place"][order]
    follows = (begin[1:] == end[:-1] + 1) & (doc[1:] == doc[:-1]) & (place[1:] == place[:-1] + begin[1:] - begin[:-1])
    follows &= (behind[own[:-1]] == own[1:]) & (before[own[1:]] == own[:-1])
    heads = np.flatnonzero(np.append(True, ~follows))
    return np.stack([begin[heads], end[np.append(heads[1:], len(own)) - 1], doc[heads], place[heads]])


def _gone(block: Block, answers: list[Answers]) -> np.ndarray:
    """The words of a block that are to be removed."""
    symbols, window = block.symbols, block.shape.window
    if not answers:
        return np.zeros(len(symbols), bool)
    begin, end, doc_id, place = np.concatenate([_patterns(x) for x in answers], axis=1)
    end += window
    words = pd.factorize(np.array([*symbols.data.tobytes().split(), None], object)[:-1])[0].astype(np.int64)
    text, start, passage = _Automata(words, begin, end).occurrences(symbols.first, symbols.counts)
    stands_first = (block.doc_id[text] == doc_id[passage]) & (start - symbols.first[text] == place[passage])
    later = np.flatnonzero(~stands_first)
    change = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(change, start[later], 1)
    np.subtract.at(change, start[later] + (end - begin)[passage[later]], 1)
    return np.cumsum(change[:-1]) > 0


def _finish(block: Block, table: pa.Table, answers: list[Answers]) -> pa.Table:
    symbols, gone = block.symbols, _gone(block, answers)
    total = np.concatenate([[0], np.cumsum(gone)])
    stop = symbols.first + symbols.counts
    sizes = np.append(symbols.starts, len(symbols.data))
    sizes = np.diff(sizes)
    kept = symbols.data[~np.repeat(gone, sizes)]
    ends = np.concatenate([[0], np.cumsum(np.where(gone, 0, sizes))])
    raw = kept.tobytes()
    return pa.table(
        {
            "doc_id": table.column("doc_id"),
            "n_words": pa.array(symbols.counts, pa.int64()),
            "n_removed": pa.array(total[stop] - total[symbols.first], pa.int64()),
            "kept": pa.array([raw[a : max(a, b - 1)].decode() for a, b in zip(ends[symbols.first].tolist(), ends[stop].tolist(), strict=True)], pa.string()),
        }
    )


def shape_of(window: int) -> Shape:
    if window < 4:
        raise ValueError("a window has 4 words at least")
    return Shape(window, min(window // 2, 200), min(2, window // 2), max(2, min(window // 2, 200) // 5), True)


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", options: Exchange = Exchange()) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept): docs without what later occurrences of a window cover.

    kept: the remaining words, joined by one space.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    return find_repeats(docs, shape_of(window), resolve, _finish, f"doc_id {id_type}, n_words long, n_removed long, kept string", id_col, text_col, options)


def _cut(block: Block, table: pa.Table, answers: list[Answers]) -> pa.Table:
    """The texts without their removed words and the white space that follows each of these; all else as it was."""
    gone = _gone(block, answers)
    data, offsets = block.offsets_data
    gap = space_mask(data)
    at_start = np.zeros(len(data) + 1, bool)
    at_start[offsets] = True
    begins = ~gap & (at_start[:-1] | np.concatenate([[True], gap[:-1]])[: len(data)])
    # of every byte, the word that it is in or follows; none before the first word of a text
    word = np.cumsum(begins) - 1
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    cut = (word >= block.symbols.first[text]) & gone[np.maximum(word, 0)] if len(gone) else np.zeros(len(data), bool)
    left = np.concatenate([[0], np.cumsum(~cut)])[offsets]
    raw = data[~cut].tobytes()
    null = np.asarray(table.column("text").combine_chunks().is_null())
    texts = [None if n else raw[a:b].decode() for n, a, b in zip(null.tolist(), left[:-1].tolist(), left[1:].tolist(), strict=True)]
    return pa.table({"rest": table.column("rest"), "text": pa.array(texts, pa.string())})


def strip_repeats(docs: DataFrame, window: int = WINDOW, options: Exchange = Exchange()) -> DataFrame:
    """The rows of docs, all columns, with such texts stripped; n_chars, if there, follows the new text.

    A removed word goes with the white space behind it; line breaks, indentation and blanks of all that stays are kept.
    """
    others = docs.select(*(c for c in docs.columns if c != "text")).schema
    found = find_repeats(docs, shape_of(window), resolve, _cut, f"rest {others.simpleString()}, text string", options=options, keep_rest=True)
    columns = {c: F.col("text") if c == "text" else F.col("rest").getField(c) for c in docs.columns}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return found.select(*(column.alias(name) for name, column in columns.items()))
