import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer as Library

import corpus_pipeline
from kinfold.llm import mixing, toxicity
from by_hand import words_by_hand
from test_near_copies import kept_by_hand


def test_every_stage_against_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        seen[name] = (docs, spark.read.parquet(str(tmp_path / name)))
        docs = seen[name][1]
        assert docs.columns == columns or k == 4 and docs.columns[:4] == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    before, after = seen["toxicity"]
    score = {r.doc_id: r.predicted for r in toxicity.toxicity(before, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    assert Counter(r.doc_id for r in after.collect()) == Counter(d for d, p in score.items() if not p)

    before, after = seen["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, _ in kept_by_hand(rows)[0])

    before, after = seen["repeated_passages"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    texts = {r.doc_id: r.text for r in after.collect()}
    touched = 0
    for doc_id, _, removed, digest in words_by_hand(rows, 20):
        text, whole = texts[doc_id], dict(rows)[doc_id]
        assert text == whole if not removed else hashlib.sha256(" ".join(text.split()).encode()).hexdigest() == digest
        # what stays is as it was: the text is a subsequence of the whole one, white space included
        left = iter(whole or "")
        assert all(c in left for c in text or "")
        touched += removed > 0
    assert touched

    before, after = seen["mixing"]
    plan = Counter({r.doc_id: len(r.shards) for r in mixing.mix_sizes(before).collect()})
    assert Counter(r.doc_id for r in after.collect()) == +plan

    before, after = seen["encoding"]
    library = Library.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    texts = {r.doc_id: r.text for r in before.collect()}
    rows = after.collect()
    assert len(rows) == before.count()
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(texts[r.doc_id], add_special_tokens=False).ids
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).select("doc_id", "n_tokens").collect())) == Counter((r.doc_id, r.n_tokens) for r in rows)
