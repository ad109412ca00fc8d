import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from kinfold.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = ["", "a" * 9000, "ab" * 5000, " <|endoftext|>  x<|endoftext|>", "<|endoftext", "aaaa aaa  aa\n\n  b", "é中\U0001f600 x", "\r\n\t  x 's'S 123 ⁴", "don't we'll I'm", "\x00\x01", "   ", "a  \n", "Ünïcödé", "​﻿"]


@pytest.fixture(scope="module")
def library():
    return Library.from_file(PATH)


def test_same_ids_as_the_library(library):
    rnd = random.Random(1)
    texts = AWKWARD + ["".join(rnd.choice("abcdefgh01 .,'\n") for _ in range(rnd.randint(0, 400))) for _ in range(200)]
    texts.append("".join(rnd.choice("abcdefgh01") for _ in range(6000)))
    own = bpe.Tokenizer(PATH)
    for _ in range(2):  # the second time all words come from the cache
        ids, counts = own.encode_batch(texts)
        parts = [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])]
        assert parts == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert own.decode_batch(ids, counts) == [library.decode(p, skip_special_tokens=False) for p in parts] == texts


def test_a_full_cache_starts_anew(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    own = bpe.Tokenizer(PATH)
    for text in ("one two three four five", "six seven<|endoftext|>", "one six"):
        ids, _ = own.encode_batch([text])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_heap_and_rounds_agree():
    own, rnd = bpe.Tokenizer(PATH), random.Random(2)
    for n in (1, 2, 3, 50, 700):
        word = bytes(rnd.choice(b"aabbct ") for _ in range(n))
        assert own.merge_words([word])[0].tolist() == own._merge_long(word).tolist()


def test_broken_bytes_decode_to_the_replacement_character(library):
    own = bpe.Tokenizer(PATH)
    ids = np.array(library.encode("中", add_special_tokens=False).ids[:1])
    assert own.decode_batch(ids, np.array([1]))[0] == library.decode(ids.tolist(), skip_special_tokens=False)


def test_operator(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(AWKWARD)] + [(None, None, "y"), (3, "again", "z"), (3, "again", "z")]
    found = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string, ids string"), PATH).collect()
    assert len(found) == len(rows)
    key = lambda d, t: (str(d), tuple(library.encode(t or "", add_special_tokens=False).ids), t or "")
    assert sorted((str(r.doc_id), tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded) for r in found) == sorted(key(d, t) for d, t, _ in rows)
    assert all(r.n_tokens * 4 == len(r.ids) for r in found)
    assert bpe.encode(spark.createDataFrame([], "doc_id string, text string"), PATH).count() == 0


def test_query(spark, sf_dir, library):
    import __spark_entry__ as entry

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    for r in entry.queries()["op9_bpe"](spark, sf_dir).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
