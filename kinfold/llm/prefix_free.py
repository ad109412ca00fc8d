"""Corpus order by prefix-free parsing, in numpy.

A rolling hash of TRIGGER bytes that is 0 modulo MODULUS is a trigger.  Triggers cut every text into phrases: a phrase ends
with a trigger, with which the next phrase begins; the last one ends with its text.  The distinct phrases are the
dictionary, the texts as sequences of phrases are the parse.  No suffix of a phrase that is longer than a trigger is a
prefix of another, so the order of two places in the corpus is that of their phrases' suffixes, which the dictionary's
suffix array gives, and where these are equal that of the phrases behind, which the parse's suffix array gives.

Repetitive text has a small dictionary: what occurs many times is sorted once.
"""

from __future__ import annotations

import numpy as np

TRIGGER = 8
MODULUS = 32
#: An odd multiplier, and the constants of a 64-bit finalizer.
BASE = 0x9E3779B97F4A7C15
FINAL_1, FINAL_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
#: Places whose hashes, or whose bytes, are held at once.
CHUNK = 1 << 18
#: Bytes of a suffix that make up its first key: 9 bits each, 0 stands for the end of the text.
FIRST = 7
#: Last bytes of two windows that are compared before the whole windows.
LAST = 4


def trigger_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of the triggers that lie inside one text each."""
    found = []
    for lo in range(0, max(len(data) - TRIGGER + 1, 0), CHUNK):
        n = min(CHUNK, len(data) - TRIGGER + 1 - lo)
        h = np.zeros(n, np.uint64)
        for k in range(TRIGGER):
            h = h * np.uint64(BASE) + data[lo + k : lo + k + n]
        h = (h ^ (h >> np.uint64(30))) * np.uint64(FINAL_1)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(FINAL_2)
        found.append(np.flatnonzero((h ^ (h >> np.uint64(31))) % np.uint64(MODULUS) == 0) + lo)
    begin = np.concatenate(found) if found else np.zeros(0, np.int64)
    text = np.searchsorted(offsets, begin, "right") - 1
    return begin[begin + TRIGGER <= offsets[text + 1]] + TRIGGER


def suffix_ranks(keys: np.ndarray, covers: int, left: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes by their first `depth` symbols or more, equal suffixes having the rank of the first.

    keys: one for each suffix, in the order of its first `covers` symbols; left: symbols up to the end of its string.
    Doubles what is compared in every round, and sorts only what isn't told apart yet.
    """
    n = len(keys)
    kind = np.int32 if n < 2**31 - 2 else np.int64
    order = np.argsort(keys)  # equal keys get one rank, so that their order doesn't matter
    keys = keys[order]
    order = order.astype(kind)
    new = np.ones(n + 1, bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:n])
    del keys
    rank = np.empty(n, kind)
    rank[order] = np.maximum.accumulate(np.where(new[:n], np.arange(n, dtype=kind), 0))
    # shorter suffixes than what is covered are told apart; longer ones are if no neighbour has their key
    open_ = order[~(new[:n] & new[1:])]
    open_ = open_[left[open_] >= covers]
    del order, new
    while covers < depth and len(open_):
        behind = np.where(left[open_] > covers, rank[np.minimum(open_ + covers, n - 1)] + 1, 0)
        pair = rank[open_].astype(np.int64) * (n + 2) + behind
        order = np.argsort(pair)
        at, pair = open_[order], pair[order]
        del order, behind, open_
        new = np.ones(len(at) + 1, bool)
        np.not_equal(pair[1:], pair[:-1], out=new[1:-1])
        del pair
        old = rank[at]
        new_old = np.ones(len(at), bool)
        np.not_equal(old[1:], old[:-1], out=new_old[1:])
        places = np.arange(len(at), dtype=kind)
        base = np.maximum.accumulate(np.where(new_old, places, 0))
        start = np.maximum.accumulate(np.where(new[:-1], places, 0))
        rank[at] = old + start - base
        del old, start, base, new_old, places
        covers *= 2
        open_ = at[~(new[:-1] & new[1:])]
        open_ = open_[left[open_] >= covers]
    return rank


class Parse:
    """Texts (one buffer, offsets) as phrases, with the suffix arrays of dictionary and parse."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, depth: int):
        self.data = data
        texts = np.flatnonzero(np.diff(offsets))
        ends = trigger_ends(data, offsets)
        # the phrases in order: begins at a text's first byte or with a trigger, ends with the next trigger or the text
        begin = np.sort(np.concatenate([offsets[texts], ends - TRIGGER]), kind="stable")
        order = np.argsort(np.concatenate([ends, offsets[texts + 1]]), kind="stable")
        end = np.concatenate([ends, offsets[texts + 1]])[order]
        is_last = order >= len(ends)
        self.begin, self.end, self.is_last = begin, end, is_last
        raw = data.tobytes()
        names = [raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        for k in np.flatnonzero(is_last).tolist():
            names[k] = (names[k],)
        known = {name: k for k, name in enumerate(dict.fromkeys(names))}
        self.phrase = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
        del raw, known, names  # what the suffix arrays need comes beside no phrase's bytes
        # the dictionary: where each distinct phrase stands first is where its bytes are read
        _, one = np.unique(self.phrase, return_index=True)
        sizes = end[one] - begin[one]
        self.at = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(self.at, sizes)
        symbols = np.concatenate([data[np.repeat(begin[one], sizes) + place].astype(np.int64) + 1, np.zeros(FIRST, np.int64)])
        left = np.repeat(sizes, sizes) - place
        keys = np.zeros(len(left), np.int64)
        for k in range(FIRST):
            keys <<= 9
            keys |= symbols[k : k + len(keys)] * (left > k)
        del place, symbols
        self.dictionary = suffix_ranks(keys, FIRST, left, depth)
        del keys
        # the parse, by ranks of phrases; a text's last phrase ends its sequence
        last = np.flatnonzero(is_last)
        left = np.repeat(last, np.diff(np.concatenate([[-1], last]))) - np.arange(len(begin)) + 1
        self.parse = suffix_ranks(self.dictionary[self.at[self.phrase]], 1, left, depth)

    def order(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of the corpus in corpus order, and of each whether what follows equals what follows the one before."""
        own = np.searchsorted(self.begin, places, "right") - 1
        inside = self.dictionary[self.at[self.phrase[own]] + places - self.begin[own]]
        behind = np.where(self.is_last[own], -1, self.parse[np.minimum(own + 1, len(self.begin) - 1)])
        # ranks are below the numbers of symbols and of phrases, whose product is far below 2 ** 63
        both = inside.astype(np.int64) * (len(self.begin) + 1) + behind + 1
        order = np.argsort(both)
        both = both[order]
        return order, np.concatenate([[False], both[1:] == both[:-1]])

    def classes(self, places: np.ndarray, window: int) -> np.ndarray:
        """A number for each place, equal for equal next `window` bytes, which no text may end within: neighbours in
        corpus order are in one class if their common prefix is that long."""
        if not len(places):
            return np.zeros(0, np.int64)
        order, same = self.order(places)
        at = places[order]
        wide = np.lib.stride_tricks.sliding_window_view(self.data, window)
        unsure = np.flatnonzero(~same)[1:]
        # most neighbours that aren't equal differ in their windows' last bytes
        for back in range(1, min(window, LAST) + 1):
            unsure = unsure[self.data[at[unsure] + window - back] == self.data[at[unsure - 1] + window - back]]
        for lo in range(0, len(unsure), CHUNK // window + 1):
            some = unsure[lo : lo + CHUNK // window + 1]
            same[some] = (wide[at[some]] == wide[at[some - 1]]).all(1)
        out = np.empty(len(places), np.int64)
        out[order] = np.cumsum(~same) - 1
        return out
