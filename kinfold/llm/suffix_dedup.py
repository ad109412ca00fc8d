"""Repeated byte strings found by prefix-free parsing.

Places of the corpus that can begin equal windows are brought together (kinfold.llm.windows): each bucket gets whole
stretches of text, every window of which either occurs once in the corpus or has all its occurrences in that bucket.  A
bucket parses its stretches into phrases at rolling-hash triggers, sorts the suffixes of the distinct phrases and of the
parse, combines both into the order of its part of the corpus (kinfold.llm.prefix_free), and reads off which neighbours
in that order share a window (200 bytes) or more.  No hash decides that two windows are equal.

Cases: null and empty texts have no bytes; a text shorter than the window has no window; repeated rows are copies of each
other; doc_id may be null or repeated and is passed through; an empty table gives an empty table; other columns are not
read.  Offsets count UTF-8 bytes.  Removal can cut a character; `kept` is binary for that reason.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kinfold.llm.common import ranges
from kinfold.llm.prefix_free import Parse
from kinfold.llm.windows import Answers, Block, Exchange, Sent, Shape, covered, find_repeats

WINDOW = 200


def resolve(sent: Sent, reach: int, core: int) -> tuple[np.ndarray, np.ndarray]:
    """The phrases with windows that occur elsewhere, and bits for these windows."""
    one, group, many = sent.distinct()
    data, offsets = sent.stretches(one)
    windows = sent.last[one] + 1
    classes = Parse(data, offsets, reach + core - 1).classes(ranges(offsets[:-1], windows), reach + core - 1)
    row = np.repeat(np.arange(len(one)), windows)
    marks = np.zeros((len(one), reach), bool)
    marks[row, ranges(np.zeros(len(one), np.int64), windows)] = (np.bincount(classes)[classes] > 1) | many[row]
    some = np.flatnonzero(marks.any(1)[group])
    return some, np.packbits(marks, axis=1)[group[some]]


def _marked(answers: list[Answers]) -> np.ndarray:
    """The window starts of a block that are marked."""
    starts = [np.zeros(0, np.int64)]
    for x in answers:
        order = np.argsort(x.keys)
        at = np.minimum(np.searchsorted(x.keys, x.contents, sorter=order), len(x.keys) - 1)
        hit = np.flatnonzero(x.keys[order[at]] == x.contents)
        which, k = np.nonzero(np.unpackbits(x.payload[order[at[hit]]], axis=1)[:, : x.reach])
        starts.append(x.i0[hit][which] + k)
    return np.concatenate(starts)


def _finish(block: Block, table: pa.Table, answers: list[Answers]) -> pa.Table:
    data, offsets = block.offsets_data
    gone = covered(_marked(answers), block.shape.window, len(data))
    # a run that ends where its text ends doesn't join the next text's
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = gone & ~np.concatenate([[False], gone[:-1] & ~edge[1:-1]]) if len(data) else gone
    total = np.concatenate([[0], np.cumsum(gone)])
    spans = np.concatenate([[0], np.cumsum(starts)])
    ends = gone & ~np.concatenate([gone[1:] & ~edge[1:-1], [False]]) if len(data) else gone
    begin_at, end_at = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    kept = data[~gone]
    kept_at = offsets - total[offsets]
    n_spans = np.diff(spans[offsets])
    owner = np.repeat(np.arange(len(n_spans)), n_spans)
    bounds = np.stack([begin_at - offsets[owner], end_at - offsets[owner]], 1)
    first = np.concatenate([[0], np.cumsum(n_spans)])
    raw = kept.tobytes()
    return pa.table(
        {
            "doc_id": table.column("doc_id"),
            "n_bytes": pa.array(np.diff(offsets), pa.int64()),
            "n_removed": pa.array(np.diff(total[offsets]), pa.int64()),
            "n_spans": pa.array(n_spans, pa.int64()),
            "spans": pa.array([bounds[first[t] : first[t + 1]].tolist() for t in range(len(n_spans))], pa.list_(pa.list_(pa.int64()))),
            "kept": pa.array([raw[a:b] for a, b in zip(kept_at[:-1].tolist(), kept_at[1:].tolist(), strict=True)], pa.binary()),
        }
    )


def shape_of(window: int) -> Shape:
    if window < 32:
        raise ValueError("a window has 32 bytes at least")
    # three quarters of a window may lie before its core: fewer and longer stretches
    span = min(3 * window // 4, 200)
    return Shape(window, span, min(12, window // 4), max(2, span // 10), False)


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", options: Exchange = Exchange()) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, spans, kept): docs without the bytes of any window that occurs twice.

    spans: [begin, end) of the removed runs, in bytes of the text; kept: the remaining bytes.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept binary"
    return find_repeats(docs, shape_of(window), resolve, _finish, schema, id_col, text_col, options)
