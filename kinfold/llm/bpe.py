"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

The symbols of all new words of a batch lie in one flat array.  Each round looks up every adjacent pair by binary
search in the sorted pair keys, takes the lowest rank of each word, merges that pair wherever it stands in the word,
and looks up only the pairs that changed.  Words already met in a worker come from a cache of bounded size; the cache
changes the speed, never the result.

Results follow the `tokenizers` library for a byte-level BPE file (no normalizer, ByteLevel pre-tokenizer):
* null and empty texts have no ids and decode to the empty text;
* strings of added tokens inside a text become their single id, as with add_special_tokens=False;
* repeated rows are encoded one by one; other columns of the input are not read, so their names may clash freely.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import give_back, ranges, text_runs

#: Fixed value: the splitting pattern of the ByteLevel pre-tokenizer.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts are handled in runs of about this many bytes; a longer text is a run of its own.
RUN_BYTES = 1 << 20
#: Words kept in a task's cache before it starts anew.
CACHE_WORDS = 200_000
#: Longer words use a heap, since their number of rounds grows with their length.
ROUND_BYTES = 4096
NO_PAIR = np.int64(1) << 40


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizer:
    """One byte-level BPE file, ready for batches of texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, to_byte = spec["model"]["vocab"], _byte_characters()
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.size = 1 + max([*vocab.values(), *self.added.values()])
        self.byte_id = np.zeros(256, np.int64)
        for char, byte in to_byte.items():
            self.byte_id[byte] = vocab[char]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.merged = key[order], order.astype(np.int64), merged[order]
        spelled: list[bytes] = [b""] * self.size
        for token, number in vocab.items():
            spelled[number] = bytes(to_byte[c] for c in token)
        for token, number in self.added.items():
            spelled[number] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_at = np.concatenate([[0], np.cumsum([len(s) for s in spelled])]).astype(np.int64)
        self.split = regex.compile(SPLIT_PATTERN)
        names = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {name: k for k, name in enumerate(self.added)}
        self.found = [np.array(list(self.added.values()), np.int64)]
        self.counts = [np.ones(len(self.added), np.int64)]

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_PAIR), self.merged[at]

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the number of ids of each word."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lengths = np.array([len(w) for w in words], np.int64)
        long = np.flatnonzero(lengths > ROUND_BYTES)
        by_heap = {int(k): self._merge_long(words[k]) for k in long}
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        if len(long):
            keep = ~np.isin(word, long)
            sym, word = sym[keep], word[keep]
        done_sym, done_word = [np.concatenate([np.zeros(0, np.int64), *by_heap.values()])], [np.repeat(long, [len(v) for v in by_heap.values()]).astype(np.int64)]
        rank, into = np.full(len(sym), NO_PAIR), np.zeros(len(sym), np.int64)
        if len(sym) > 1:
            rank[:-1], into[:-1] = self._lookup(sym[:-1], sym[1:])
            rank[:-1][word[:-1] != word[1:]] = NO_PAIR
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(starts, len(sym)))
            lowest = np.minimum.reduceat(rank, starts)
            active = lowest < NO_PAIR
            if not active.all():
                rest = np.repeat(~active, sizes)
                done_sym.append(sym[rest])
                done_word.append(word[rest])
                sym, word, rank, into, sizes, lowest = sym[~rest], word[~rest], rank[~rest], into[~rest], sizes[active], lowest[active]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, sizes))
            # of a run of overlapping pairs (a a a), every second one from the left is merged
            first = np.concatenate([[True], np.diff(hit) != 1])
            run_start = hit[first][np.cumsum(first) - 1]
            hit = hit[(hit - run_start) % 2 == 0]
            sym[hit] = into[hit]
            gone = np.zeros(len(sym), bool)
            gone[hit + 1] = True
            stays = ~gone
            at = hit - np.cumsum(gone)[hit]
            sym, word, rank, into = sym[stays], word[stays], rank[stays], into[stays]
            changed = np.concatenate([at, at[at > 0] - 1])
            last = changed >= len(sym) - 1
            rank[changed[last]] = NO_PAIR
            changed = changed[~last]
            rank[changed], into[changed] = self._lookup(sym[changed], sym[changed + 1])
            rank[changed[word[changed] != word[changed + 1]]] = NO_PAIR
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(words)).astype(np.int64)

    def _merge_long(self, word: bytes) -> np.ndarray:
        """One long word: the same merges, taken in order of rank and place from a heap."""
        sym = self.byte_id[np.frombuffer(word, np.uint8)]
        rank, into = self._lookup(sym[:-1], sym[1:])
        ids, n = sym.tolist(), len(sym)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, a, b, m) for i, (r, a, b, m) in enumerate(zip(rank.tolist(), ids, ids[1:], into.tolist(), strict=False)) if r < NO_PAIR]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = after[i]
            if j < n:
                r, m = self._lookup(np.array([ids[i]]), np.array([ids[j]]))
                if r[0] < NO_PAIR:
                    heapq.heappush(heap, (int(r[0]), i, ids[i], ids[j], int(m[0])))

        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = m, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([v for v, k in zip(ids, alive, strict=True) if k], np.int64)

    def words(self, text: str) -> list[str]:
        if self.special is None or not any(name in text for name in self.added):
            return self.split.findall(text)
        out: list[str] = []
        for part in self.special.split(text):
            out += [part] if part in self.added else self.split.findall(part)
        return out

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each text."""
        if len(self.number) > CACHE_WORDS:
            self.forget()
        split = [self.words(t) for t in texts]
        number = self.number
        new = list(dict.fromkeys(w for words in split for w in words if w not in number))
        if new:
            ids, counts = self.merge_words([w.encode() for w in new])
            number.update(zip(new, range(len(number), len(number) + len(new)), strict=True))
            self.found.append(ids)
            self.counts.append(counts)
        if len(self.found) > 1:
            self.found, self.counts = [np.concatenate(self.found)], [np.concatenate(self.counts)]
        flat, counts = self.found[0], self.counts[0]
        starts = np.cumsum(counts) - counts
        per_text = np.array([len(words) for words in split], np.int64)
        which = np.fromiter((number[w] for words in split for w in words), np.int64, int(per_text.sum()))
        sizes = counts[which]
        ids = flat[ranges(starts[which], sizes)]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(per_text)
        return ids, total[ends] - total[ends - per_text]

    def decode_batch(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ids; bytes that are no UTF-8 become U+FFFD."""
        sizes = np.diff(self.spelled_at)[ids]
        data = self.spelled[ranges(self.spelled_at[ids], sizes)].tobytes()
        total = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(counts)
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(total[ends - counts].tolist(), total[ends].tolist(), strict=True)]


@lru_cache(maxsize=2)
def load_tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, ids, decoded): ids as flat little-endian unsigned 32-bit integers, and their decoding.

    doc_id may be null or repeated and is passed through; see the module for nulls and empty texts.  An empty table
    gives an empty table.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def work(batches):
        tokenizer = load_tokenizer(tokenizer_path)
        for part in (run for batch in batches for run in text_runs(batch, 1, RUN_BYTES)):
            ids, counts = tokenizer.encode_batch([t or "" for t in part.column(1).to_pylist()])
            raw = ids.astype("<u4").tobytes()
            ends = np.cumsum(counts) * 4
            packed = [raw[x - 4 * n : x] for x, n in zip(ends.tolist(), counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(packed, pa.binary()), pa.array(tokenizer.decode_batch(ids, counts), pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )
        tokenizer.forget()
        give_back()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, f"doc_id {id_type}, n_tokens long, ids binary, decoded string")
