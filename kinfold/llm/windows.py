"""Where windows of text repeat across a corpus: anchors, two exchanges, and the replies.

A window is a run of `window` symbols (bytes or words) of one text.  A rolling hash over `gram` symbols picks an anchor
for each window: the leftmost smallest hash among its first `span` positions.  Equal windows have equal anchors, and
consecutive windows mostly share one, so the text falls into phrases, each the stretch of window starts of one anchor.
All windows of a phrase hold the phrase's core, the window - span + 1 symbols from the anchor on; a window is then the
symbols left of the anchor, the core, and what follows it.

1. Every block of texts sends the hash of each distinct core to the bucket of that hash, which answers with those that
   occur more than once.  A window whose core occurs once occurs once; this step never says that a window repeats.
2. Phrases with a repeated core send the stretch that their windows cover to the bucket of the core (words: without the
   core, which its 128-bit name stands for), where `resolve` (of the operator) finds the windows that repeat and answers
   each block for each of its phrases.
3. Every block joins the answers to its texts, and `finish` (of the operator) makes its rows.

Answers are addressed by block and content, not by row, so equal phrases of a block are sent once.  A core that occurs
more than `hot` times has its phrases cut into pieces of `fine` window starts, each with a longer core of its own, so
that its contexts spread over many buckets by what they hold.

What a worker holds is one block or one bucket; a text longer than a block is cut into chunks where hashes are computed.
The texts are shuffled once, by block; the three passes over them share that exchange.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.llm.common import Words, give_back, ranges, shuffle_partitions, total_text_bytes, utf8_buffer

#: Window starts whose hashes are computed at once.
CHUNK = 1 << 19
#: An odd multiplier, its inverse modulo 2**64, and the constants of a 64-bit finalizer.
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
FINAL_1, FINAL_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
LAST_ID = np.iinfo(np.int64).max
#: What a block counts of one core at most; more than any `hot`, so that a core hot in one block is hot.
MOST_COUNTED = 65535


@dataclass(frozen=True)
class Shape:
    """Lengths in symbols; see the module."""

    window: int
    span: int
    gram: int
    fine: int
    words: bool

    def core(self, level: int) -> int:
        return self.window - self.reach(level) + 1

    def reach(self, level: int) -> int:
        return self.fine if level else self.span


@dataclass(frozen=True)
class Exchange:
    block_bytes: int = 2 << 20
    bucket_bytes: int = 8 << 20
    hot: int = 2000

    def __post_init__(self):
        if not 1 <= self.hot < MOST_COUNTED:
            raise ValueError(f"hot lies between 1 and {MOST_COUNTED - 1}")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(FINAL_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(FINAL_2)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, 0 to n at least."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, CHUNK + 4096)
        _POWERS[:] = [np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size - 1, m, np.uint64))]) for m in (MULTIPLIER, INVERSE)]
    return _POWERS[0], _POWERS[1]


def _prefix(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes."""
    up, _ = _powers(len(data))
    return np.concatenate([[np.uint64(0)], np.cumsum(_BYTE_VALUES[data] * up[: len(data)])])


class Symbols:
    """The symbols of a block's texts, as bytes or as words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, shape: Shape):
        self.shape = shape
        if shape.words:
            words = Words(data, offsets)
            self.data, self.starts, self.ends, self.counts, self.first = words.data, words.starts, words.ends, words.counts, words.first
            self.hashes = self._word_hashes()
        else:
            self.data, self.counts, self.first = data, np.diff(offsets), offsets[:-1]
            self.starts = self.ends = None
        self.raw = memoryview(np.ascontiguousarray(self.data)).cast("B") if len(self.data) else memoryview(b"")

    def __len__(self) -> int:
        return len(self.starts) if self.shape.words else len(self.data)

    def begin(self, symbol: np.ndarray) -> np.ndarray:
        """First byte of each symbol; of one past the last, the end."""
        if not self.shape.words:
            return symbol
        return np.append(self.starts, len(self.data))[symbol]

    def end(self, symbol: np.ndarray) -> np.ndarray:
        """End of what belongs to the symbols before: words keep the space behind them."""
        return symbol if not self.shape.words else self.begin(symbol)

    def _word_hashes(self) -> np.ndarray:
        out = np.zeros(len(self.starts), np.uint64)
        k = 0
        while k < len(out):
            stop = max(k + 1, int(np.searchsorted(self.ends, self.starts[k] + CHUNK, "right")))
            s, e = self.starts[k:stop], self.ends[k:stop]
            if e[-1] - s[0] > 2 * CHUNK:
                out[k] = xxhash.xxh3_64_intdigest(self.data[s[0] : e[0]].tobytes())
                stop = k + 1
            else:
                p = _prefix(self.data[s[0] : e[-1]])
                _, down = _powers(e[-1] - s[0])
                out[k:stop] = mixed((p[e - s[0]] - p[s - s[0]]) * down[s - s[0]])
            k = stop
        return out

    def order(self, lo: int, hi: int) -> np.ndarray:
        """The rolling hash at positions lo to hi, as far as `gram` symbols are left."""
        gram = self.shape.gram
        if min(hi + gram - 1, len(self)) - lo < gram:
            return np.zeros(0, np.uint64)
        if self.shape.words:
            h = self.hashes[lo : hi + gram - 1]
            out = h[: len(h) - gram + 1].copy()
            for k in range(1, gram):
                out = out * np.uint64(MULTIPLIER) + h[k : k + len(out)]
            return mixed(out)
        p = _prefix(self.data[lo : hi + gram - 1])
        _, down = _powers(len(p))
        return mixed((p[gram:] - p[:-gram]) * down[: len(p) - gram])

    def _chunks(self):
        """Ranges of window starts: whole texts together, or a part of one long text."""
        windows = np.maximum(self.counts - self.shape.window + 1, 0)
        t, n = 0, len(windows)
        total = np.concatenate([[0], np.cumsum(self.counts)])
        while t < n:
            if windows[t] > CHUNK:
                for a in range(0, int(windows[t]), CHUNK):
                    begin = int(self.first[t]) + a
                    yield begin, min(begin + CHUNK, int(self.first[t] + windows[t])), t, t + 1
                t += 1
                continue
            u = max(t + 1, int(np.searchsorted(total, total[t] + CHUNK, "right")) - 1)
            long = np.flatnonzero(windows[t:u] > CHUNK)
            u = t + int(long[0]) if len(long) else u
            yield int(self.first[t]), int(self.first[u - 1] + self.counts[u - 1]), t, u
            t = u

    def phrases(self) -> tuple[np.ndarray, ...]:
        """Text, anchor, first and last window start of every phrase."""
        window, span = self.shape.window, self.shape.span
        found = []
        for lo, hi, t, u in self._chunks():
            top = min(hi + span + self.shape.gram - 1, len(self))
            order = self.order(lo, top)
            if len(order) < span:
                continue
            best = (order & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(order), dtype=np.uint64)
            width = 1
            while 2 * width <= span:
                best = np.minimum(best[:-width], best[width:])
                width *= 2
            if width < span:
                best = np.minimum(best[: width - span], best[span - width :])
            anchor = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
            begin = np.maximum(self.first[t:u], lo)
            stop = np.minimum(self.first[t:u] + np.maximum(self.counts[t:u] - window + 1, 0), hi)
            some = np.flatnonzero(stop > begin)
            begin, stop = begin[some], stop[some]
            inside = np.zeros(len(anchor) + 1, np.int8)
            inside[begin - lo] += 1
            np.subtract.at(inside, np.minimum(stop - lo, len(anchor)), 1)
            at = np.flatnonzero(np.cumsum(inside[:-1]))
            if not len(at):
                continue
            a = anchor[at]
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (at[1:] != at[:-1] + 1)]))
            last = np.append(new[1:], len(at)) - 1
            i0 = at[new] + lo
            found.append((np.searchsorted(self.first[t:u], i0, "right") - 1 + t, a[new] + lo, i0, at[last] + lo))
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        text, anchor, i0, i1 = (np.concatenate(x) for x in zip(*found, strict=True))
        # texts without symbols share their first index with the next; the last of equal ones has the symbols
        return text, anchor, i0, i1

    def core_names(self, anchor: np.ndarray, level: int) -> np.ndarray:
        """128 bits for each core, as two columns."""
        a, b = self.begin(anchor), self.end(anchor + self.shape.core(level))
        raw, digest = self.raw, xxhash.xxh3_128_digest
        return np.frombuffer(b"".join([digest(raw[x:y], level) for x, y in zip(a.tolist(), b.tolist(), strict=True)]), "<u8").reshape(-1, 2)

    def contents(self, anchor: np.ndarray, i0: np.ndarray, i1: np.ndarray, level: int) -> np.ndarray:
        """64 bits for all that a phrase's windows hold."""
        a, b = self.begin(i0), self.end(i1 + self.shape.window)
        raw, digest = self.raw, xxhash.xxh3_64_intdigest
        found = np.fromiter((digest(raw[x:y], level) for x, y in zip(a.tolist(), b.tolist(), strict=True)), np.uint64, len(a))
        return found ^ mixed((anchor - i0 + 1).astype(np.uint64))


def cut_fine(anchor: np.ndarray, i0: np.ndarray, i1: np.ndarray, fine: int) -> tuple[np.ndarray, ...]:
    """Phrases cut into pieces of `fine` window starts: index of the phrase, anchor, first and last start."""
    low, high = (anchor - i1) // fine, (anchor - i0) // fine
    many = high - low + 1
    which = np.repeat(np.arange(len(anchor)), many)
    part = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + low[which]
    a = anchor[which] - part * fine
    return which, a, np.maximum(i0[which], a - fine + 1), np.minimum(i1[which], a)


class Block:
    """A block's phrases, and those of hot cores in pieces."""

    def __init__(self, table: pa.Table, shape: Shape):
        self.shape = shape
        self.offsets_data = utf8_buffer(table.column("text"))
        self.symbols = Symbols(*self.offsets_data, shape)
        self.text, self.anchor, self.i0, self.i1 = self.symbols.phrases()
        self.names = self.symbols.core_names(self.anchor, 0)
        ids = table.column("doc_id").combine_chunks()
        # only operators that order documents read it; they insist on integers
        self.doc_id = np.asarray(ids.cast(pa.int64()).fill_null(LAST_ID)) if pa.types.is_integer(ids.type) else np.zeros(len(ids), np.int64)

    def of_level(self, level: int, names: np.ndarray) -> tuple[np.ndarray, ...]:
        """Text, anchor, first and last start of the phrases whose core is named; at level 1 in pieces."""
        some = np.flatnonzero(np.isin(self.names[:, 0], names))
        text, a, i0, i1 = self.text[some], self.anchor[some], self.i0[some], self.i1[some]
        if level:
            which, a, i0, i1 = cut_fine(a, i0, i1, self.shape.fine)
            text = text[which]
        return text, a, i0, i1


@dataclass
class Answers:
    """What `resolve` said of a block's phrases at one level: first and last window start and content of each phrase; the
    contents it spoke of, and a line of bytes for each."""

    reach: int
    i0: np.ndarray
    i1: np.ndarray
    contents: np.ndarray
    keys: np.ndarray
    payload: np.ndarray


def _bytes_of(raw: memoryview, begin: np.ndarray, end: np.ndarray) -> bytes:
    return b"".join([raw[x:y] for x, y in zip(begin.tolist(), end.tolist(), strict=True)])


def _by_bucket(bucket: np.ndarray, buckets: int):
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        yield k, order[cuts[k] : cuts[k + 1]]


def _key(table: pa.Table, name: str = "block") -> int:
    return table.column(name)[0].as_py()


_REPLY = "block long, level int, keys binary, payload binary"
_SENT = "bucket int, block long, level int, names binary, contents binary, shape binary, lengths binary, bytes binary, places binary"


@dataclass
class Sent:
    """What one bucket has got at one level: a row for each phrase that a block sent."""

    block: np.ndarray
    names: np.ndarray
    contents: np.ndarray
    left: np.ndarray
    last: np.ndarray
    copies: np.ndarray
    raw: bytes
    begin: np.ndarray
    size: np.ndarray
    doc_id: np.ndarray
    place: np.ndarray

    def contexts(self, rows: np.ndarray, side: int) -> bytes:
        """What lies left of the core (0) or right of it (2) in these phrases, one after the other."""
        return np.frombuffer(self.raw, np.uint8)[ranges(self.begin[rows, side], self.size[rows, side])].tobytes()

    def stretches(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All that these phrases' windows cover, one phrase after the other, and where each begins and ends."""
        sizes = self.size[rows].sum(1)
        return np.frombuffer(self.raw, np.uint8)[ranges(self.begin[rows, 0], sizes)], np.concatenate([[0], np.cumsum(sizes)])

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of phrases with equal content the row that stands first; the group of every row; whether a group stands twice."""
        order = np.lexsort((self.place, self.doc_id, self.contents, self.names[:, 1], self.names[:, 0]))
        key = np.stack([self.names[order, 0], self.names[order, 1], self.contents[order]], 1)
        new = np.concatenate([[True], (key[1:] != key[:-1]).any(1)])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        return order[new], group, np.bincount(group, self.copies) > 1


def _unpack(table: pa.Table, level: int) -> Sent:
    rows = [r for r in table.to_pylist() if r["level"] == level]
    join = lambda c: b"".join(r[c] for r in rows)
    names = np.frombuffer(join("names"), "<u8").reshape(-1, 2)
    shape = np.frombuffer(join("shape"), np.uint8).reshape(-1, 3).astype(np.int64)
    lengths = np.frombuffer(join("lengths"), "<u4").astype(np.int64)
    places = np.frombuffer(join("places"), "<i8").reshape(-1, 2)
    places = places if len(places) else np.zeros((len(names), 2), np.int64)
    begin = (np.cumsum(lengths) - lengths).reshape(-1, 3)
    block = np.repeat([r["block"] for r in rows], [len(r["contents"]) // 8 for r in rows]).astype(np.int64) if rows else np.zeros(0, np.int64)
    return Sent(block, names, np.frombuffer(join("contents"), "<u8"), shape[:, 0], shape[:, 1], shape[:, 2], join("bytes"), begin, lengths.reshape(-1, 3), places[:, 0], places[:, 1])


def find_repeats(docs: DataFrame, shape: Shape, resolve: Callable, finish: Callable, schema: str, id_col: str = "doc_id", text_col: str = "text", options: Exchange = Exchange(), keep_rest: bool = False) -> DataFrame:
    """Apply `finish` to every block of docs with the answers of `resolve`.

    resolve(Sent, reach, core) -> (rows, payload): phrases of Sent, any number of times, and a line of bytes for each.
    finish(Block, table, answers): rows of `schema`, one for each row of table, from what resolve said of its phrases.
    With keep_rest the table has the other columns of docs as the struct `rest`.
    """
    if shape.words and not isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"{id_col} must be an integer: it says which document comes first")
    spark = docs.sparkSession
    rest = [F.struct(*(c for c in docs.columns if c != text_col)).alias("rest")] if keep_rest else []
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *rest)
    total, parts = total_text_bytes(rows, "text"), shuffle_partitions(spark)
    blocks, buckets = max(-(-total // options.block_bytes), parts), max(-(-total // options.bucket_bytes), parts)
    rows = rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"), *rows.columns)

    def first_pass(table: pa.Table) -> pa.Table:
        block = Block(table, shape)
        names, counts = np.unique(block.names[:, 0], return_counts=True)
        out = [(k, names[own].tobytes(), np.minimum(counts[own], MOST_COUNTED).astype("<u2").tobytes()) for k, own in _by_bucket(names % np.uint64(buckets), buckets)]
        number = _key(table)
        del block
        give_back()
        return pa.table({"bucket": pa.array([r[0] for r in out], pa.int32()), "block": pa.array([number] * len(out), pa.int64()), "names": pa.array([r[1] for r in out], pa.binary()), "counts": pa.array([r[2] for r in out], pa.binary())})

    def repeated(table: pa.Table) -> pa.Table:
        got = [(r["block"], np.frombuffer(r["names"], "<u8"), np.frombuffer(r["counts"], "<u2")) for r in table.select(["block", "names", "counts"]).to_pylist()]
        known, inverse = np.unique(np.concatenate([n for _, n, _ in got]), return_inverse=True)
        total = np.bincount(inverse, np.concatenate([c for _, _, c in got]), len(known))
        out = []
        for block, names, _ in got:
            times = total[np.searchsorted(known, names)]
            for level, some in ((0, (times > 1) & (times <= options.hot)), (1, times > options.hot)):
                if some.any():
                    out.append((block, level, names[some].tobytes()))
        return pa.table({"block": pa.array([r[0] for r in out], pa.int64()), "level": pa.array([r[1] for r in out], pa.int32()), "keys": pa.array([r[2] for r in out], pa.binary()), "payload": pa.array([None] * len(out), pa.binary())})

    def keys_of(replies: pa.Table, level: int) -> np.ndarray:
        return np.frombuffer(b"".join(r["keys"] for r in replies.to_pylist() if r["level"] == level), "<u8")

    def second_pass(table: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        if table.num_rows and replies.num_rows:
            block, number = Block(table, shape), _key(table)
            for level in (0, 1):
                names = keys_of(replies, level)
                if not len(names):
                    continue
                if level:
                    out.append((int(number % buckets), number, 2, names.tobytes(), b"", b"", b"", b"", b""))
                symbols = block.symbols
                text, a, i0, i1 = block.of_level(level, names)
                contents = symbols.contents(a, i0, i1, level)
                order = np.lexsort((i0 - symbols.first[text], block.doc_id[text], contents))
                first = order[np.concatenate([[True], contents[order][1:] != contents[order][:-1]])] if len(order) else order
                copies = np.diff(np.append(np.flatnonzero(np.concatenate([[True], contents[order][1:] != contents[order][:-1]])), len(order))) if len(order) else order
                text, a, i0, i1, contents = text[first], a[first], i0[first], i1[first], contents[first]
                core = symbols.core_names(a, level)
                own = np.stack([a - i0, i1 - i0, np.minimum(copies, 2)], 1).astype(np.uint8)
                edges = [symbols.begin(i0), symbols.begin(a), symbols.end(a + shape.core(level)), symbols.end(i1 + shape.window)]
                if shape.words:
                    lengths = np.stack([edges[1] - edges[0], np.zeros(len(a), np.int64), edges[3] - edges[2]], 1).astype("<u4")
                else:
                    lengths = np.diff(np.stack(edges, 1), axis=1).astype("<u4")
                places = np.stack([block.doc_id[text], i0 - symbols.first[text]], 1).astype("<i8")
                for k, some in _by_bucket(core[:, 0] % np.uint64(buckets), buckets):
                    if shape.words:
                        flat = _bytes_of(symbols.raw, np.stack([edges[0][some], edges[2][some]], 1).ravel(), np.stack([edges[1][some], edges[3][some]], 1).ravel())
                    else:
                        flat = _bytes_of(symbols.raw, edges[0][some], edges[3][some])
                    out.append((k, number, level, core[some].tobytes(), contents[some].tobytes(), own[some].tobytes(), lengths[some].tobytes(), flat, places[some].tobytes() if shape.words else b""))
        give_back()
        columns = list(zip(*out, strict=True)) if out else [[]] * 9
        kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 6]
        return pa.table({n.split()[0]: pa.array(c, k) for n, c, k in zip(_SENT.split(", "), columns, kinds, strict=True)})

    def answer(table: pa.Table) -> pa.Table:
        out = [(r["block"], 2, r["names"], b"") for r in table.to_pylist() if r["level"] == 2]
        for level in (0, 1):
            sent = _unpack(table, level)
            if not len(sent.block):
                continue
            rows, payload = resolve(sent, shape.reach(level), shape.core(level))
            order = np.argsort(sent.block[rows], kind="stable")
            rows, payload = rows[order], payload[order]
            for own in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(sent.block[rows])) + 1) if len(rows) else []:
                out.append((int(sent.block[rows[own[0]]]), level, sent.contents[rows[own]].tobytes(), payload[own].tobytes()))
        give_back()
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 2]
        return pa.table({n.split()[0]: pa.array(c, k) for n, c, k in zip(_REPLY.split(", "), columns, kinds, strict=True)})

    def last_pass(table: pa.Table, replies: pa.Table) -> pa.Table:
        block, answers = Block(table, shape), []
        got = replies.to_pylist()
        hot = np.frombuffer(b"".join(r["keys"] for r in got if r["level"] == 2), "<u8")
        for level in (0, 1):
            mine = [r for r in got if r["level"] == level]
            if not mine:
                continue
            keys = np.frombuffer(b"".join(r["keys"] for r in mine), "<u8")
            payload = np.frombuffer(b"".join(r["payload"] for r in mine), np.uint8).reshape(len(keys), -1)
            text, a, i0, i1 = block.of_level(1, hot) if level else (block.text, block.anchor, block.i0, block.i1)
            answers.append(Answers(shape.reach(level), i0, i1, block.symbols.contents(a, i0, i1, level), keys, payload))
        out = finish(block, table, answers)
        del block
        give_back()
        return out

    sent = rows.groupBy("block").applyInArrow(first_pass, "bucket int, block long, names binary, counts binary")
    known = sent.groupBy("bucket").applyInArrow(repeated, _REPLY)
    context = rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(second_pass, _SENT)
    answers = context.groupBy("bucket").applyInArrow(answer, _REPLY)
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(last_pass, schema)


def covered(starts: np.ndarray, window: int, n: int) -> np.ndarray:
    """The symbols that windows at these starts cover."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.subtract.at(change, starts + window, 1)
    return np.cumsum(change[:-1]) > 0
