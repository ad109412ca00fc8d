r"""Quality rules whose cutoffs carry a guarantee, in DataFrame operations only.

Base rules: a document fails with fewer than `min_words` words, or with more than `max_repeat_percent` of its words in
5-word windows that the text holds twice or more.  Each further rule rejects a document whose ratio lies above a cutoff.
Cutoffs come in levels from loose to strict, one cutoff for each rule a level, and are chosen from labelled documents, the
holdout, for each stratum (lang).  A level is safe if, were its false rejection rate (good documents that any rule rejects)
`max_false_rejection` or more, as few rejections as were seen would have a probability of at most the stratum's share of
`confidence_miss`, by the exact binomial distribution.  What a level rejects, the stricter ones reject too: levels are
tested in the fixed order from loose to strict up to the first that isn't safe, which needs no correction for their
number.  Strata are corrected for by weighted Bonferroni, each with a share by its number of good documents.  So with
probability 1 - confidence_miss no stratum loses more than max_false_rejection of its good documents through all rules
together.  The last safe level holds; without one no rule rejects anything in that stratum.  With the defaults a stratum
that holds half of the good documents needs 183 of them, one that holds a tenth 263.

Words are runs of anything but U+0020 and U+0009..U+000D.  Cases: a null text has no words and fails the base rules;
a null lang is a stratum of its own; of labels given twice for a doc_id the lower quality counts; null labels and labels
with a null doc_id count as missing; repeated rows are judged one by one; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kinfold.llm.common import cut_lineage

#: The ratios, and the cutoffs of each from the strictest level to the loosest.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", (0.01, 0.02, 0.04, 0.08, 0.12, 0.2, 0.3, 0.5)),
    "lines": ("n_dup_lines / greatest(n_lines, 1)", (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7)),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", (0.01, 0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2)),
    "shouts": ("n_shouts / greatest(word_chars, 1)", (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7)),
}

LEVELS = 8
#: Cutoffs of at most this many strata are broadcast.
MOST_STRATA_SENT = 10_000


@dataclass(frozen=True)
class QualityOptions:
    min_words: int = 10
    max_repeat_percent: int = 20
    max_false_rejection: float = 0.02
    confidence_miss: float = 0.05


def _let(value: Column, body) -> Column:
    """body(value), with value computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column, n_words: Column) -> Column:
    """Words in 5-word windows found twice or more in the array."""
    window = F.transform(F.sequence(F.lit(0), n_words - 5), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(5))))

    def covered(places: Column) -> Column:
        reach = F.transform(places, lambda p, k: F.least(F.lit(5), F.coalesce(F.get(places, k + 1) - p, F.lit(5))))
        return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

    def places(pairs: Column) -> Column:
        # neighbours in the order of hashes; a null hash compares as neither
        again = lambda x, k: F.coalesce(F.get(pairs, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(pairs, k + 1)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(pairs, again), lambda x: x["i"]))

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _let(_let(pairs, places), covered)).otherwise(0)

    return F.when(n_words >= 6, _let(window, count)).otherwise(0).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, lang, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_shouts, n_repeat_words), one a row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = docs.select(
        "doc_id",
        F.col("lang").cast("string").alias("lang"),
        F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"[A-Z!]")).cast("long").alias("n_shouts"),
    )
    return split.select(
        "doc_id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_shouts",
        _repeat_words(F.col("words"), F.size("words")).alias("n_repeat_words"),
    )


def _stratum(lang: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), lang), F.lit("none"))


def _ratio(rule: str) -> Column:
    return F.expr(RULES[rule][0])


def safe_cutoffs(measured: DataFrame, labels: DataFrame, options: QualityOptions = QualityOptions()) -> DataFrame:
    """Rows (stratum, cut_<rule>...): the cutoffs of the strictest safe level, or nulls."""
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1")
    holdout = measured.join(good.select("doc_id"), "doc_id", "left_semi").withColumn("stratum", _stratum(F.col("lang")))
    rejected = lambda level: reduce(lambda a, b: a | b, (_ratio(rule) > cutoffs[level] for rule, (_, cutoffs) in RULES.items()))
    seen = holdout.groupBy("stratum").agg(F.count("*").alias("n"), *(F.sum(rejected(k).cast("long")).alias(f"level_{k}") for k in range(LEVELS)))
    strata = cut_lineage(seen)
    rate = options.max_false_rejection
    # ln P(X = k) by its ratios to P(X = k - 1); the largest k whose P(X <= k) is small enough lies below the mean
    total = strata.agg(F.sum("n")).first()[0] or 1
    terms = strata.select("stratum", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") * rate))).alias("k"))
    upto = Window.partitionBy("stratum").orderBy("k")
    step = F.when(F.col("k") == 0, F.col("n") * F.log(F.lit(1 - rate))).otherwise(F.log((F.col("n") - F.col("k") + 1) / F.col("k") * (rate / (1 - rate))))
    tail = terms.withColumn("ln_p", F.sum(step).over(upto)).withColumn("tail", F.sum(F.exp("ln_p")).over(upto))
    most = tail.where(F.col("tail") <= options.confidence_miss * F.col("n") / total).groupBy("stratum").agg(F.max("k").alias("most"))
    found = strata.join(most, "stratum", "left")
    # rejections grow towards level 0: all levels from the first within the bound on are safe
    cut = lambda rule: F.coalesce(*(F.when(F.col(f"level_{k}") <= F.col("most"), F.lit(c)) for k, c in enumerate(RULES[rule][1])))
    return found.select("stratum", *(cut(rule).alias(f"cut_{rule}") for rule in RULES))


def judge(docs: DataFrame, labels: DataFrame, options: QualityOptions = QualityOptions()) -> DataFrame:
    """For each row of docs (doc_id, text, lang) its measures, base_failed and kept; labels (doc_id, quality)."""
    measured = cut_lineage(measures(docs))
    cutoffs = safe_cutoffs(measured, labels, options)
    base = (F.col("n_words") < options.min_words) | (100 * F.col("n_repeat_words") > options.max_repeat_percent * F.col("n_words"))
    above = F.lit(False)
    for rule in RULES:
        above = above | F.coalesce(_ratio(rule) > F.col(f"cut_{rule}"), F.lit(False))
    # one row a stratum; many strata take the shuffled join instead
    cutoffs = cut_lineage(cutoffs)
    cutoffs = F.broadcast(cutoffs) if cutoffs.count() <= MOST_STRATA_SENT else cutoffs
    judged = measured.withColumn("stratum", _stratum(F.col("lang"))).join(cutoffs, "stratum", "left")
    return judged.select(*measured.columns, base.alias("base_failed"), (~base & ~above).alias("kept"))
