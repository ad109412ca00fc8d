import math
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.functions.lexical import compact, extract_features, normalize, pattern
from kinfold.functions.lexical import features as feature_struct
from kinfold.options import LexicalOptions

CASES = ["ab12", "A B", "hello-world", "", "(415) 555-1212", "abc123", "   ", "ABCDE", "x²①Ⅷ", "a b\tc", "naïve ÀÉ", "\U00010a40\U0001f600z", "aaaa", "a-b_c/d.e,f;g:h|i"]


def features(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, norm_value string")
    return [r for r in df.select("i", feature_struct(F.col("norm_value")).alias("f")).select("i", "f.*").orderBy("i").collect()]


def by_hand(text):
    n = len(text)
    digits, letters = sum(c.isdigit() for c in text), sum(c.isalpha() for c in text)
    spaces, upper = sum(c.isspace() for c in text), sum(c.isalpha() and c.isupper() for c in text)
    vowels = sum(c in "aeiouAEIOU" for c in text)
    counts = [text.count(c) for c in set(text)]
    over = lambda a, b: a / b if b else 0.0
    return {
        "length": n,
        "digit_ratio": over(digits, n),
        "alpha_ratio": over(letters, n),
        "space_ratio": over(spaces, n),
        "symbol_ratio": over(n - digits - letters - spaces, n),
        "upper_ratio": over(upper, letters),
        "vowel_ratio": over(vowels, letters),
        "unique_chars": len(set(text)),
        "entropy": -sum(c / n * math.log2(c / n) for c in counts) if n else 0.0,
    }


@pytest.mark.parametrize("text,signature,short", [("ab12", "AA99", "A9"), ("A B", "A A", "A A"), ("hello-world", "AAAAA-AAAAA", "A-A"), ("(415) 555-1212", "(999) 999-9999", "(9) 9-9"), ("", "", "")])
def test_patterns(spark, text, signature, short):
    row = spark.createDataFrame([(text,)], "v string").select(pattern(F.col("v")).alias("p"), compact(pattern(F.col("v"))).alias("c")).first()
    assert (row.p, row.c) == (signature, short)


def test_features_match_python(spark):
    for text, row in zip(CASES, features(spark, CASES), strict=True):
        for name, value in by_hand(text).items():
            assert row[name] == pytest.approx(value, abs=1e-6), (text, name)
    null = features(spark, [None])[0]
    assert null["length"] == 0 and null["entropy"] == 0 and null["pattern"] == ""


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cn"], max_codepoint=0x2FFF), max_size=30), min_size=5, max_size=20))
def test_features_match_python_on_any_text(spark, texts):
    texts = [t for t in texts if all(unicodedata.category(c)[0] != "C" for c in t)]
    for text, row in zip(texts, features(spark, texts), strict=True):
        for name in ("length", "unique_chars", "entropy", "space_ratio"):
            assert row[name] == pytest.approx(by_hand(text)[name], abs=1e-6), (text, name)


def test_token_count(spark):
    assert [r.token_count for r in features(spark, ["a-b_c/d.e,f;g:h|i", "  ", "one two"])] == [9, 0, 2]


def test_normalize(spark):
    df = spark.createDataFrame([(1, " A\x07  B\t\nC "), (2, "\tab"), (3, "x"), (4, None), (5, "Z" * 600)], "record_id long, value string")
    rows = {r.record_id: r.norm_value for r in normalize(df).collect()}
    assert rows == {1: "a b c", 2: " ab", 5: "z" * 512}
    plain = normalize(df, LexicalOptions(lowercase=False, collapse_whitespace=False, strip_non_printable=False, min_value_length=1, max_value_length=4))
    assert {r.record_id: r.norm_value for r in plain.collect()}[1] == " A\x07 "


def test_feature_struct(spark):
    df = spark.createDataFrame([("abc123",)], "norm_value string")
    feat = extract_features(df).first().feat
    assert (feat.length, feat.digit_ratio, feat.alpha_ratio) == (6, 0.5, 0.5)
