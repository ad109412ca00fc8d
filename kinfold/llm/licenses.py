"""Licence texts and notices in documents, by Dice coefficient over word bigrams.

Passages are normalised (lower case, words of letters and digits only) and compared to licence templates: twice the number
of shared distinct bigrams over the sum of both numbers.  Passages are every line, every paragraph (lines between blank
ones), the whole text, and, for notices inside longer lines or paragraphs, windows of a template's number of words that
begin where the text has one of its bigrams.

Two sets can reach `least` only if the smaller has at least least / (2 - least) times as many bigrams as the larger: other
templates are not compared to a passage, and windows only of templates of whose bigrams the text holds that share.

Cases: null and empty texts, and passages of fewer than two words, match nothing: license null, dice 0; of equal scores
the template whose name comes first counts; repeated rows are scanned one by one; an empty table gives an empty table;
other columns are not read.  Licences known only by a notice (kinfold.llm.license_texts) are not found by their full text.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.license_texts import TEMPLATES

LEAST = 0.8
WORD = re.compile(r"[0-9a-z]+")
PARAGRAPH = re.compile(r"\n[\x20\x09-\x0D]*\n")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


def dice(a: set, b: set) -> float:
    return 2 * len(a & b) / (len(a) + len(b))


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST):
        if not 0 < least <= 1:
            raise ValueError("least lies above 0 and up to 1")
        self.least = least
        split = [(name, words_of(text)) for name, text in templates]
        self.templates = sorted(((name, bigrams(words), len(words)) for name, words in split), key=lambda t: len(t[1]))
        self.holding: dict[tuple[str, str], list[int]] = {}
        for k, (_, own, _) in enumerate(self.templates):
            for pair in own:
                self.holding.setdefault(pair, []).append(k)

    def passage(self, words: list[str]) -> list[tuple[float, str]]:
        own, out = bigrams(words), []
        for name, other, _ in self.templates:
            few, many = sorted((len(own), len(other)))
            # the score if all of the smaller set is shared; the templates ascend in size
            if few and 2 * few / (few + many) >= self.least:
                score = dice(own, other)
                if score >= self.least:
                    out.append((score, name))
            elif len(other) > len(own):
                break
        return out

    def windows(self, words: list[str], hits: dict[int, list[int]]) -> list[tuple[float, str]]:
        """hits: where the bigrams of each template stand in words."""
        out = []
        for k, places in hits.items():
            name, own, length = self.templates[k]
            if (2 - self.least) * len({(words[i], words[i + 1]) for i in places}) < self.least * len(own):
                continue
            best = max(dice(bigrams(words[i : i + length]), own) for i in places)
            if best >= self.least:
                out.append((best, name))
        return out

    def text(self, text: str | None) -> tuple[str | None, float, int]:
        """Best template, its score, and the number of lines that match any."""
        lines = [words_of(line) for line in (text or "").split("\n")]
        words = [w for line in lines for w in line]
        hits: dict[int, list[int]] = {}
        for i, pair in enumerate(zip(words, words[1:], strict=False)):
            for k in self.holding.get(pair, ()):
                hits.setdefault(k, []).append(i)
        if not hits:
            return None, 0.0, 0
        found = self.windows(words, hits)
        matching = 0
        for line in lines:
            matched = self.passage(line)
            matching += bool(matched)
            found += matched
        if len(lines) > 1:
            for part in PARAGRAPH.split(text):
                if "\n" in part:
                    found += self.passage(words_of(part))
            found += self.passage(words)
        if not found:
            return None, 0.0, 0
        score, name = min(found, key=lambda x: (-x[0], x[1]))
        return name, score, matching


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, license, dice, n_lines) for every row of docs; n_lines: lines that match a template."""

    def work(batches):
        scanner = Scanner(templates, least)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                names, scores, lines = zip(*map(scanner.text, part.column(1).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(lines, pa.int64())], ["doc_id", "license", "dice", "n_lines"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, f"doc_id {id_type}, license string, dice double, n_lines long")
