import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import kdtree, licenses, quality, sql, token_scan
from kinfold.llm.kdtree import SearchOptions
from kinfold.llm.quality import QualityOptions


@pytest.mark.parametrize("name", ["op2_token_counts", "op4_quality", "op7_kdtree", "op10_licenses"])
def test_queries_match_their_sql(spark, sf_dir, duck, same_rows, name):
    import __spark_entry__ as entry

    same_rows(entry.queries()[name](spark, sf_dir).toPandas(), duck.sql(sql.oracle_sql()[name]).df())


def top_by_hand(rows, k):
    fit = [(n, [math.floor(256 * x) for x in v]) for n, v in rows if n is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, (q, v) in enumerate(fit):
        if q % 50 == 0:
            scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), n) for j, (n, w) in enumerate(fit) if j != i and len(w) == len(v)))[:k]
            out += [(q, r + 1, n, -s) for r, (s, n) in enumerate(scored)]
    return Counter(out)


@pytest.mark.parametrize("shard_rows,leaf_rows,dims", [(40, 4, 5), (10_000, 8, 3), (60, 3, 8)])
def test_top_k(spark, shard_rows, leaf_rows, dims):
    rnd = random.Random(dims)
    rows = [(i, [np.float32(rnd.choice([-1, 0, 0.5, 1]) * rnd.random()).item() for _ in range(dims)]) for i in range(300)]
    rows += [(i, rows[50][1]) for i in range(300, 330)] + [(50, rows[7][1]), (400, None), (401, [None] * dims), (402, [float("nan")] * dims), (403, [float("inf")] * dims), (None, rows[0][1]), (450, [0.0] * (dims + 1)), (500, [1.0] * (dims + 1))]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<float>, row long, size int, score long")
    found = kdtree.top_k(df, F.col("vec_id") % 50 == 0, SearchOptions(shard_rows=shard_rows, leaf_rows=leaf_rows, query_block=5))
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == top_by_hand(rows, 5)


def test_top_k_of_few(spark):
    one = spark.createDataFrame([(50, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert kdtree.top_k(one, F.col("vec_id") % 50 == 0).count() == 0
    assert kdtree.top_k(one.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    two = one.unionByName(one.withColumn("vec_id", F.lit(1).cast("long")))
    assert kdtree.top_k(two, F.col("vec_id") % 50 == 0).count() == 1


@pytest.mark.parametrize("growth,box_rows", [(2, 3), (4, 1024)])
def test_top_k_in_turns(spark, growth, box_rows):
    """Many shards, regions and turns, and a third of all vectors equal."""
    rnd = random.Random(growth)
    rows = [(i, [1.0, 0.5, -2.0] if i % 3 == 0 else [rnd.gauss(4 * (i % 4), 1) for _ in range(3)]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    options = SearchOptions(shard_rows=25, leaf_rows=4, query_block=4, sample_rows=120, box_rows=box_rows, turn_growth=growth)
    found = kdtree.top_k(df, F.col("vec_id") % 50 == 0, options)
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == top_by_hand(rows, 5)


def test_regions_part_all_rows():
    rng = np.random.default_rng(1)
    sample = rng.integers(-9, 9, (200, 3))
    sample[:120] = 4
    regions = kdtree.Regions(sample, 4)
    assert len(set(regions.of(sample).tolist())) > 4 and regions.of(sample).max() < 16
    assert len(set(kdtree.Regions(np.full((50, 2), 7), 3).of(np.full((9, 2), 7)).tolist())) == 1


def test_large_components(spark):
    """Exact as long as scores fit 64 bits, and an error beyond, not a wrong score."""
    rnd = random.Random(5)
    rows = [(i, [float(rnd.randint(-6_000_000, 6_000_000)) for _ in range(3)]) for i in range(120)]
    schema = "vec_id long, embedding array<double>"
    found = kdtree.top_k(spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0, SearchOptions(shard_rows=20, leaf_rows=3))
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == top_by_hand(rows, 5)
    for large in (3e7, 1e30, 1e308):
        with pytest.raises(OverflowError):
            kdtree.top_k(spark.createDataFrame([*rows, (999, [large, 0.0, 0.0])], schema), F.col("vec_id") % 50 == 0)


def test_boxes_bound_and_prune():
    rng = np.random.default_rng(3)
    vectors = rng.integers(-300, 300, (500, 4))
    tree = kdtree.Tree.unpack(kdtree.Tree(np.arange(500), np.arange(500), vectors, 16).pack())
    queries = rng.integers(-300, 300, (20, 4))
    bounds = tree.bounds(queries)
    for n in range(len(tree.begin)):
        own = tree.vectors[tree.begin[n] : tree.end[n]]
        assert (own @ queries.T <= bounds[:, n]).all()
        assert (own.min(0) == tree.low[n]).all() and (own.max(0) == tree.high[n]).all()


def lengths_by_hand(ids, end):
    out, size = [], 0
    for x in ids:
        if x == end:
            out.append((size, True))
            size = 0
        else:
            size += 1
    return out + ([(size, False)] if size else [])


@pytest.mark.parametrize("block,kind,whole", [(1, "<u4", 0), (3, "<u2", 1 << 20), (7, "<u4", 1 << 20), (7, "<u4", 0), (1000, "<u4", 0)])
def test_flat_files(spark, tmp_path, monkeypatch, block, kind, whole):
    monkeypatch.setattr(token_scan, "WHOLE_BYTES", whole)
    rnd = random.Random(block)
    expected = {}
    for k, n in enumerate((0, 1, 500, 300)):
        ids = [9 if rnd.random() < (0.2 if k % 2 else 0.01) else rnd.randint(0, 8) for _ in range(n)] + ([9] if k == 3 else [])
        path = tmp_path / f"f{k}.bin"
        path.write_bytes(np.array(ids, kind).tobytes())
        expected[f"f{k}.bin"] = lengths_by_hand(ids, 9)
    width = np.dtype(kind).itemsize
    blocks = token_scan.read_flat_files(spark, str(tmp_path / "*.bin"), width, block)
    rows = token_scan.document_lengths(token_scan.scan_blocks(blocks, 9, width)).collect()
    found = {name: [] for name in expected}
    for r in sorted(rows, key=lambda r: (r.file, r.ordinal)):
        assert r.ordinal == len(found[r.file.rsplit("/", 1)[1]])
        found[r.file.rsplit("/", 1)[1]].append((r.n_tokens, r.closed))
    assert found == expected


def test_scan_over_chunks(spark, monkeypatch):
    """More blocks than one chunk of the scan holds, documents over many blocks and chunks."""
    monkeypatch.setattr(token_scan, "SCAN_WIDTH", 4)
    rnd = random.Random(2)
    ids = [9 if rnd.random() < 0.03 else 1 for _ in range(400)]
    rows = [("f", k, np.array(ids[k * 5 : k * 5 + 5], "<u4").tobytes(), 0) for k in range(80)] + [("g", 0, None, 0)]
    blocks = spark.createDataFrame(rows, "file string, block long, payload binary, chunk int")
    found = token_scan.document_lengths(token_scan.scan_blocks(blocks, 9)).collect()
    assert [(r.n_tokens, r.closed) for r in sorted(found, key=lambda r: r.ordinal)] == lengths_by_hand(ids, 9)


def test_token_counts(spark, tmp_path):
    rows = [(1, "a b"), (2, None), (3, ""), (None, "x"), (3, "y y y"), (4, "w " * 200_000)]
    spark.createDataFrame([(*r, "f") for r in rows], "doc_id long, text string, file string").write.parquet(str(tmp_path / "d"))
    found = token_scan.token_counts(spark.read.parquet(str(tmp_path / "d")))
    assert Counter(map(tuple, found.collect())) == Counter((d, len((t or "").split())) for d, t in rows)
    assert token_scan.token_counts(spark.read.parquet(str(tmp_path / "d")).limit(0)).count() == 0


def test_flat_files_of_texts(spark, tmp_path, monkeypatch):
    """Files hold nothing but ids, whatever their bytes; documents of many files of a partition are found by place."""
    monkeypatch.setattr(token_scan, "RUN_BYTES", 40)
    monkeypatch.setattr(token_scan, "FILE_RUNS", 3)
    rnd = random.Random(4)
    rows = [(k, rnd.choice([None, "", " "]) if k % 9 == 0 else " ".join(rnd.choice("abcdefgh") * 3 for _ in range(rnd.randint(1, 30)))) for k in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    token_scan.write_flat_files(docs, str(tmp_path / "flat"))
    files = [f.read_bytes() for f in (tmp_path / "flat").glob("part-*")]
    ids = [np.frombuffer(f, "<u4") for f in files]
    assert len(files) > 20 and all(len(f) % 4 == 0 and i[-1] == token_scan.END for f, i in zip(files, ids, strict=True))
    assert sum(len(i) for i in ids) == sum(len((t or "").split()) + 1 for _, t in rows)
    assert Counter(map(tuple, token_scan.token_counts(docs).collect())) == Counter((d, len((t or "").split())) for d, t in rows)


def test_changed_rows_raise(spark, tmp_path, monkeypatch):
    spark.range(5).selectExpr("id AS doc_id", "'a b' AS text").coalesce(1).write.parquet(str(tmp_path / "d"))
    write = token_scan.write_flat_files
    monkeypatch.setattr(token_scan, "write_flat_files", lambda docs, *rest: write(docs.where("doc_id < 4"), *rest))
    with pytest.raises(Exception, match="changed between"):
        token_scan.token_counts(spark.read.parquet(str(tmp_path / "d"))).collect()


def test_licenses(spark):
    rows = [
        (1, "Some text.\nReleased under the MIT License.\nMore."),
        (2, "released UNDER the mit license"),
        (3, "This is about the license of a driver."),
        (4, None),
        (5, ""),
        (6, "Permission to use, copy, modify, and/or distribute this software for any purpose\nwith or without fee is hereby granted, provided that the above copyright notice and\nthis permission notice appear in all copies.\n\nOther words here."),
        (7, "word " * 200_000 + "\nLicensed under CC BY-NC 4.0."),
    ]
    df = spark.createDataFrame([(*r, 0.5, "x") for r in rows], "doc_id long, text string, dice double, license string")
    found = {r.doc_id: (r.license, r.dice, r.n_lines) for r in licenses.scan(df).collect()}
    assert found[1] == ("MIT", 1.0, 1) and found[2] == ("MIT", 1.0, 1) and found[7] == ("CC-BY-NC-4.0", 1.0, 1)
    assert found[3] == found[4] == found[5] == (None, 0.0, 0)
    assert found[6] == ("ISC", 1.0, 0)
    assert licenses.scan(df.limit(0)).count() == 0


def test_size_bounds_lose_no_template():
    scanner, rnd = licenses.Scanner(), random.Random(1)
    words = [w for _, t in licenses.TEMPLATES for w in t.split()]
    for _ in range(300):
        text = " ".join(rnd.choice(licenses.TEMPLATES)[1].split()[: rnd.choice([2, 5, 10, 40, 200, 400])] + [rnd.choice(words) for _ in range(rnd.randint(0, 3))])
        own = licenses.bigrams(licenses.words_of(text))
        plain = {(2 * len(own & t) / (len(own) + len(t)), name) for name, t, _ in scanner.templates if own}
        assert set(scanner.passage(licenses.words_of(text))) == {x for x in plain if x[0] >= scanner.least}


def test_licence_texts_inside_other_texts():
    """Whole texts, with a copyright line, broken lines, comment signs, and prose before and behind."""
    scanner = licenses.Scanner()
    prose = "the quick brown fox jumps over the lazy dog while nobody in this town looks up from the morning paper "
    for name, text in licenses.TEMPLATES:
        if len(text.split()) < 60:
            continue
        words = text.split()
        broken = "\n".join("# " + " ".join(words[k : k + 11]) for k in range(0, len(words), 11))
        assert scanner.text(f"Copyright (c) 2020 Jane Doe\n\n{broken}\n\nimport os")[0] == name
        assert scanner.text(prose * 5 + text + " " + prose * 5)[0] == name
    assert scanner.text("Photos by Jane Doe. Licensed under CC BY 4.0. All names changed.")[:2] == ("CC-BY-4.0", 1.0)
    assert scanner.text(prose * 40) == (None, 0.0, 0)


def test_equal_scores_go_to_the_first_name():
    templates = (("b", "one two three four"), ("a", "one two three five"))
    assert licenses.Scanner(templates, 0.5).text("one two three") == ("a", 0.8, 1)


def repeats_by_hand(text):
    words = (text or "").split()
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            hit.update(range(i, i + 5))
    return len(words), len(hit)


def test_quality_measures(spark):
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice("abc") for _ in range(n)) for n in (0, 4, 5, 6, 7, 40, 300)] + ["x y z\nx y z\n \n\nq", None, "#a*|", "a b c d e f g h i a b c d e", "w " * 50_000]
    df = spark.createDataFrame([(i, t, None if i % 3 else "en", 5) for i, t in enumerate(texts)], "doc_id long, text string, lang string, words int")
    rows = {r.doc_id: r for r in quality.measures(df).collect()}
    for i, t in enumerate(texts):
        assert (rows[i].n_words, rows[i].n_repeat_words) == repeats_by_hand(t), t
    assert rows[7].n_dup_lines == 1 and rows[7].n_lines == 3 and rows[9].n_symbols == 3 and rows[9].word_chars == 4


def binomial_tail(n, k, p):
    return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


def test_cutoffs_are_safe_and_the_next_is_not(spark):
    """Good documents with symbol ratios spread evenly: the strictest cutoff is where the exact tail says."""
    n = 300
    measured = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit(1000).cast("long").alias("n_words"), F.lit(1000).cast("long").alias("word_chars"), F.col("id").alias("n_symbols"), F.lit(10).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dup_lines"), F.lit(0).cast("long").alias("n_shouts"), F.lit(0).cast("long").alias("n_repeat_words"))
    labels = measured.select("doc_id", F.lit(1).alias("quality"))
    options = QualityOptions(max_false_rejection=0.2)
    cut = quality.safe_cutoffs(measured, labels, options).first().cut_symbols
    safe = [c for c in quality.RULES["symbols"][1] if binomial_tail(n, sum(i / 1000 > c for i in range(n)), Fraction(1, 5)) <= 0.05]
    assert cut == min(safe) and len(safe) < quality.LEVELS
    assert all(len(c) == quality.LEVELS and list(c) == sorted(c) for _, c in quality.RULES.values())
    few = quality.safe_cutoffs(measured.limit(20), labels, QualityOptions()).first()
    assert few.cut_symbols is None


def test_strata_share_the_error_by_size_and_rules_are_judged_together(spark):
    """Of 600 good documents in one stratum and 200 in another some are above two rules' cutoffs, partly the same ones."""
    rows = [("a", i, int(40 * (i % 60 == 0)), int(5 * (i % 50 == 0))) for i in range(600)] + [("b", 1000 + i, int(90 * (i == 7)), 0) for i in range(200)]
    measured = spark.createDataFrame([(i, lang, 1000, 1000, s, 10, d, 0, 0) for lang, i, s, d in rows], "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_shouts long, n_repeat_words long")
    found = {r.stratum: r for r in quality.safe_cutoffs(measured, measured.select("doc_id", F.lit(1).alias("quality")), QualityOptions(max_false_rejection=0.06)).collect()}
    for lang in "ab":
        own = [r for r in rows if r[0] == lang]
        levels = list(zip(quality.RULES["symbols"][1], quality.RULES["lines"][1], strict=True))
        rejected = [sum(s / 1000 > x or d / 10 > y for _, _, s, d in own) for x, y in levels]
        safe = [k for k, n in enumerate(rejected) if binomial_tail(len(own), n, Fraction(6, 100)) <= 0.05 * len(own) / 800]
        assert (found[f"={lang}"].cut_symbols, found[f"={lang}"].cut_lines) == levels[min(safe)]


def test_judge_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "one two", "en"), (2, "a b c d e f g h i j k", None), (None, None, "en"), (1, "x " * 30, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    rows = Counter((r.doc_id, r.base_failed, r.kept) for r in quality.judge(docs, labels).collect())
    assert rows == Counter([(1, True, False), (2, False, True), (None, True, False), (1, True, False)])
    assert quality.judge(docs.limit(0), labels).count() == 0
