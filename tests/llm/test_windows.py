import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinfold.llm import phrase_dedup, prefix_free, suffix_dedup, windows
from kinfold.llm.windows import Exchange
from by_hand import bytes_by_hand, words_by_hand

TIGHT = Exchange(block_bytes=500, bucket_bytes=700, hot=3)


def own_bytes(df, window, options=Exchange()):
    found = suffix_dedup.remove_repeats(df, window, options=options)
    return Counter(tuple(r) for r in found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect())


def own_words(df, window, options=Exchange()):
    found = phrase_dedup.remove_repeats(df, window, options=options)
    return Counter(tuple(r) for r in found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256)).collect())


def sample(seed, alphabet, joint):
    rnd = random.Random(seed)
    text = lambda n: joint(rnd).join(rnd.choice(alphabet) for _ in range(n))
    passages = [text(rnd.randint(5, 60)) for _ in range(12)]
    rows = [(i, joint(rnd).join(rnd.choice(passages) if rnd.random() < 0.5 else text(rnd.randint(0, 12)) for _ in range(rnd.randint(0, 7)))) for i in range(100)]
    rows += [(500, None), (501, ""), (502, " \t "), (503, "a " * 500), (504, "ab " * 300), (505, rows[7][1]), (7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, rows[9][1]), (506, "x"), (507, "é" * 90), (508, "a" * 400)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("window,options", [(40, Exchange()), (40, TIGHT), (64, Exchange(hot=2))])
def test_bytes(spark, window, options):
    rows = sample(window, "abcdé\n ", lambda r: "")
    df = spark.createDataFrame([(*r, 1, 2, "t") for r in rows], "doc_id long, text string, block long, bucket long, rest string")
    assert own_bytes(df, window, options) == bytes_by_hand(rows, window)


@pytest.mark.parametrize("window,options", [(10, Exchange()), (10, TIGHT), (20, Exchange(hot=2)), (5, Exchange())])
def test_words(spark, window, options):
    rows = sample(window, ["a", "b", "ç", "dd", "e."], lambda r: r.choice([" ", "\n", "  "]))
    df = spark.createDataFrame([(*r, 1, 2, "t") for r in rows], "doc_id long, text string, block long, bucket long, rest string")
    assert own_words(df, window, options) == words_by_hand(rows, window)


def test_spans_and_kept_bytes(spark):
    passage = "".join(map(str, range(100, 180)))
    df = spark.createDataFrame([(1, "left " + passage + " é"), (2, passage + " right")], "doc_id long, text string")
    rows = {r.doc_id: r for r in suffix_dedup.remove_repeats(df).collect()}
    assert rows[1].spans == [[5, 246]] and bytes(rows[1].kept) == "left é".encode()
    assert rows[2].spans == [[0, 241]] and bytes(rows[2].kept) == b"right"


def test_a_very_long_text(spark):
    rnd = random.Random(5)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(1_300_000))
    rows = [(1, long), (2, long[700_000:700_300]), (3, "x" + long[10:250])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(df).collect()}
    assert found == {1: (540, 2), 2: (300, 1), 3: (240, 1)}


def test_phrases_do_not_depend_on_chunks(monkeypatch):
    rnd = random.Random(6)
    texts = ["".join(rnd.choice("ab c") for _ in range(n)) for n in (5000, 0, 300, 3000, 90, 4500)]
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)])
    for shape in (suffix_dedup.shape_of(40), phrase_dedup.shape_of(20)):
        whole = [anchor_of(windows.Symbols(data, offsets, shape))]
        monkeypatch.setattr(windows, "CHUNK", 1000)
        whole.append(anchor_of(windows.Symbols(data, offsets, shape)))
        monkeypatch.undo()
        assert whole[0] == whole[1]
        assert len(whole[0]) == sum(max(0, n - shape.window + 1) for n in windows.Symbols(data, offsets, shape).counts)


def anchor_of(symbols):
    return {i: (t, a) for t, a, i0, i1 in zip(*map(list, symbols.phrases()), strict=True) for i in range(i0, i1 + 1)}


def test_strip_repeats_keeps_columns_and_clean_texts(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(1, f"a  b\n{passage}", "en", 9), (2, f"{passage} end", "de", 9), (3, None, None, None), (4, "c  d", "en", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string, n_chars long")
    found = {r.doc_id: r for r in phrase_dedup.strip_repeats(df).collect()}
    assert found[1].text == rows[0][1] and found[2].text == "end" and found[2].n_chars == 3
    assert found[3].text is None and found[4].text == "c  d" and found[4].block == "en"
    assert phrase_dedup.strip_repeats(df).columns == df.columns


def cut_by_hand(text, gone):
    """Words of the marked places go with the white space behind them."""
    out, at = "", 0
    for k, m in enumerate(re.finditer(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text)):
        out += text[at : m.start()] + ("" if gone[k] else m.group())
        at = m.end()
    return out + text[at:]


def test_strip_repeats_keeps_the_layout(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    before, after = "line one\n\n    code here\n", "last\tline \n"
    rows = [(1, passage), (2, f"{before}{passage}\n{after}"), (3, f"  {passage}"), (4, f"é\t{passage}  \n"), (5, f"{passage}\n\nmore\n  {passage} end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in phrase_dedup.strip_repeats(df).collect()}
    assert found == {1: passage, 2: before + after, 3: "  ", 4: "é\t", 5: "more\n  end"}


@pytest.mark.parametrize("options", [Exchange(), TIGHT])
def test_strip_repeats_by_hand(spark, options):
    rows = [r for r in sample(3, ["a", "b", "ç", "dd", "e."], lambda r: r.choice([" ", "\n", "  ", "\n\t"])) if r[0] is not None]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in phrase_dedup.strip_repeats(df, 10, options).collect()}
    first, expected = {}, {}
    for i, t in rows:
        words = (t or "").split()
        for k in range(len(words) - 9):
            first.setdefault(tuple(words[k : k + 10]), (i, k))
    for i, t in rows:
        words = (t or "").split()
        gone = [False] * len(words)
        for k in range(len(words) - 9):
            if first[tuple(words[k : k + 10])] != (i, k):
                gone[k : k + 10] = [True] * 10
        expected[i] = None if t is None else cut_by_hand(t, gone)
    assert found == expected and any(found[i] != t for i, t in rows)


def test_ids_that_have_no_order(spark):
    df = spark.createDataFrame([("a", "x")], "doc_id string, text string")
    with pytest.raises(ValueError):
        phrase_dedup.remove_repeats(df)
    with pytest.raises(ValueError):
        Exchange(hot=70_000)


def test_automata_in_shards(spark, monkeypatch):
    """Many small automata find what one finds."""
    rows = sample(4, ["a", "b", "ç", "dd", "e."], lambda r: " ")
    table = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())})
    block = windows.Block(table, phrase_dedup.shape_of(10))
    begin = np.flatnonzero(block.symbols.counts[block.text] >= 12)[:200]
    begin = block.i0[begin]
    words = np.unique(block.symbols.hashes, return_inverse=True)[1].astype(np.int64)
    automata = lambda: {tuple(x) for x in zip(*map(list, phrase_dedup._Automata(words, begin, begin + 10).occurrences(block.symbols.first, block.symbols.counts)), strict=True)}
    whole = {(t, s, tuple(words[begin[p] : begin[p] + 10].tolist())) for t, s, p in automata()}
    monkeypatch.setattr(phrase_dedup, "SHARD_WORDS", 30)
    assert whole == {(t, s, tuple(words[begin[p] : begin[p] + 10].tolist())) for t, s, p in automata()}
    assert {s for _, s, _ in whole} >= set(begin.tolist())


@pytest.mark.parametrize("modulus", [1, 3, 32])
def test_corpus_order_is_that_of_a_plain_suffix_sort(monkeypatch, modulus):
    monkeypatch.setattr(prefix_free, "MODULUS", modulus)
    rnd = random.Random(modulus)
    parts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 40))) for _ in range(5)]
    texts = [b"".join(rnd.choice(parts) for _ in range(rnd.randint(0, 8))) for _ in range(40)] + [b"", b"a" * 300, b"\x00" * 50, bytes(range(256))]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    parse = prefix_free.Parse(data, offsets, len(data))
    suffix = [t[k:] for t in texts for k in range(len(t))]
    order, same = parse.order(np.arange(len(data)))
    assert [suffix[k] for k in order] == sorted(suffix)
    assert same.tolist() == [False] + [a == b for a, b in zip(sorted(suffix), sorted(suffix)[1:], strict=False)]
    full = np.array([k for k, x in enumerate(suffix) if len(x) >= 30])
    classes = parse.classes(full, 30)
    assert len(set(classes.tolist())) == len({suffix[k][:30] for k in full}) == len({(c, suffix[k][:30]) for c, k in zip(classes.tolist(), full, strict=True)})


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert phrase_dedup.remove_repeats(empty).count() == 0
    assert phrase_dedup.strip_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.shape_of(8)


def test_queries(spark, sf_dir):
    import __spark_entry__ as entry

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, entry.queries()["op1_suffix_dedup"](spark, sf_dir).collect())) == bytes_by_hand(rows, 200)
    assert Counter(map(tuple, entry.queries()["op6_phrase_dedup"](spark, sf_dir).collect())) == words_by_hand(rows, 20)


@pytest.mark.parametrize("seed", range(6))
def test_suffix_ranks_where_strings_end_at_each_length(seed):
    """Ends of strings at, before and behind what a round covers, few symbols, many equal strings."""
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 40, 60)
    strings = [rng.integers(1, 3, n).tolist() for n in sizes]
    strings += [strings[k][: rng.integers(1, len(strings[k]) + 1)] for k in range(60)]
    suffixes = [s[k:] for s in strings for k in range(len(s))]
    left = np.array([len(s) for s in suffixes])
    for covers in (1, 2, 7):
        padded = [(s + [0] * covers)[:covers] for s in suffixes]
        keys = np.array([sum(x << 9 * (covers - 1 - k) for k, x in enumerate(p)) for p in padded])
        ordered = sorted(suffixes)
        first = {}
        for k, s in enumerate(ordered):
            first.setdefault(tuple(s), k)
        assert prefix_free.suffix_ranks(keys, covers, left, 64).tolist() == [first[tuple(s)] for s in suffixes]


def test_ranks_of_a_large_bucket_do_not_overflow(monkeypatch):
    """The product of the numbers of symbols and phrases passes 32 bits; most neighbours differ only before their last bytes."""
    monkeypatch.setattr(prefix_free, "MODULUS", 4)
    rng = np.random.default_rng(2)
    pool = rng.integers(97, 101, (40, 64)).astype(np.uint8)
    data = pool[rng.integers(0, 40, 6000)].ravel()
    offsets = np.arange(0, len(data) + 1, 192)
    places = np.concatenate([np.arange(a, a + 92) for a in offsets[:-1]])
    parse = prefix_free.Parse(data, offsets, 101)
    assert parse.dictionary.dtype == np.int32  # half the memory of the sort that took most of the time
    parse.dictionary += np.int32(2**31 - 1 - parse.dictionary.max())
    found = parse.classes(places, 101)
    texts = [data[k : k + 101].tobytes() for k in places.tolist()]
    known = {}
    assert len(set(zip(found.tolist(), (known.setdefault(t, len(known)) for t in texts), strict=True))) == len(known) == found.max() + 1
