"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from kinfold.llm import licenses, quality


def _quality() -> str:
    o = quality.QualityOptions()
    rate = o.max_false_rejection
    counts = ", ".join(f"count(*) FILTER ({' OR '.join(f'({ratio}) > {cutoffs[k]}' for ratio, cutoffs in quality.RULES.values())}) AS level_{k}" for k in range(quality.LEVELS))
    cuts = ", ".join(f"CASE {' '.join(f'WHEN level_{k} <= most THEN {c}' for k, c in enumerate(cutoffs))} END AS cut_{rule}" for rule, (_, cutoffs) in quality.RULES.items())
    above = " OR ".join(f"coalesce(({quality.RULES[rule][0]}) > cut_{rule}, false)" for rule in quality.RULES)
    base = f"(n_words < {o.min_words} OR 100 * n_repeat_words > {o.max_repeat_percent} * n_words)"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word, generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS pos FROM d
), g AS (
  SELECT rid, word, pos, CASE WHEN lead(pos, 4) OVER o IS NOT NULL THEN [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o] END AS gram
  FROM w WINDOW o AS (PARTITION BY rid ORDER BY pos)
), f AS (
  SELECT rid, word, pos, CASE WHEN gram IS NOT NULL AND count(*) OVER (PARTITION BY rid, gram) > 1 THEN 1 ELSE 0 END AS again FROM g
), r AS (
  SELECT rid, word, max(again) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS covered FROM f
), c AS (
  SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars, sum(covered) AS n_repeat_words FROM r GROUP BY rid
), l AS (
  SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, length(text) - length(regexp_replace(text, '[A-Z!]', '', 'g')) AS n_shouts FROM d
), m AS (
  SELECT doc_id, coalesce('=' || lang, 'none') AS stratum, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_shouts::BIGINT AS n_shouts, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d JOIN l USING (rid) LEFT JOIN c USING (rid)
), good AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1
), s AS (
  SELECT stratum, count(*) AS n, {counts} FROM m WHERE doc_id IN (SELECT doc_id FROM good) GROUP BY stratum
), t AS (
  SELECT stratum, n, unnest(range(0, ceil(n * {rate})::BIGINT + 1)) AS k FROM s
), p AS (
  SELECT stratum, n, k, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({rate}) + (n - k) * ln(1 - {rate}))) OVER (PARTITION BY stratum ORDER BY k) AS tail FROM t
), b AS (
  SELECT stratum, max(k) AS most FROM p WHERE tail <= {o.confidence_miss} * n / (SELECT sum(n) FROM s) GROUP BY stratum
), cut AS (
  SELECT stratum, {cuts} FROM s LEFT JOIN b USING (stratum)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {base} AS base_failed, NOT {base} AND NOT ({above}) AS kept
FROM m LEFT JOIN cut USING (stratum)
"""


TOKEN_COUNTS = r"""
SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents
"""

#: Bytes as pairs of hexadecimal digits; a window's key is the checksum of its digits.
SUFFIX_DEDUP = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
), b AS (
  SELECT rid, digits, unnest(range(0, length(digits) // 2)) AS i FROM d
), k AS (
  SELECT rid, i, substring(digits, 2 * i + 1, 2) AS byte, CASE WHEN 2 * i + 400 <= length(digits) THEN md5_number(substring(digits, 2 * i + 1, 400)) END AS key FROM b
), t AS (
  SELECT key FROM k WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1
), c AS (
  SELECT rid, i, byte, max(CASE WHEN t.key IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS gone FROM k LEFT JOIN t USING (key)
), e AS (
  SELECT *, coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY i), 0) AS before FROM c
), g AS (
  SELECT rid, sum(gone)::BIGINT AS n_removed, (count(*) FILTER (gone = 1 AND before = 0))::BIGINT AS n_spans, string_agg(byte, '' ORDER BY i) FILTER (gone = 0) AS kept FROM e GROUP BY rid
)
SELECT doc_id, (length(digits) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN g USING (rid)
"""

PHRASE_DEDUP = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS place, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
  SELECT rid, place, words, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d
), k AS (
  SELECT rid, place, pos, word, CASE WHEN pos + 19 <= len(words) THEN array_to_string(words[pos:pos + 19], ' ') END AS key FROM w
), f AS (
  SELECT key, min({'place': place, 'pos': pos}) AS earliest FROM k WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1
), c AS (
  SELECT rid, pos, word, max(CASE WHEN f.earliest < {'place': place, 'pos': pos} THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM k LEFT JOIN f USING (key)
), g AS (
  SELECT rid, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (gone = 0) AS kept FROM c GROUP BY rid
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN g USING (rid)
"""

TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.rid AS rid, q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.rid <> c.rid AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def _licenses() -> str:
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    values = ", ".join(f"({k}, {quote(name)}, {quote(text)})" for k, (name, text) in enumerate(licenses.TEMPLATES))
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), p AS (
  SELECT rid, 'line' AS kind, unnest(string_split(text, chr(10))) AS passage, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d
  UNION ALL
  SELECT * FROM (SELECT rid, 'part' AS kind, unnest(string_split_regex(text, '\n[\x20\x09-\x0D]*\n')) AS passage, generate_subscripts(string_split_regex(text, '\n[\x20\x09-\x0D]*\n'), 1) AS k FROM d) WHERE contains(passage, chr(10))
  UNION ALL
  SELECT rid, 'text', text, 1 FROM d WHERE contains(text, chr(10))
), t(tid, name, text) AS (VALUES {values}
), w AS (
  SELECT rid, kind, k, regexp_extract_all(lower(passage), '[0-9a-z]+') AS words FROM p
), b AS (
  SELECT DISTINCT rid, kind, k, unnest(list_zip(words[1:len(words) - 1], words[2:])) AS pair FROM w WHERE len(words) > 1
), tw AS (
  SELECT tid, name, regexp_extract_all(lower(text), '[0-9a-z]+') AS words FROM t
), tb AS (
  SELECT DISTINCT tid, name, unnest(list_zip(words[1:len(words) - 1], words[2:])) AS pair FROM tw
), tn AS (SELECT tid, count(*) AS n FROM tb GROUP BY tid
), bn AS (SELECT rid, kind, k, count(*) AS n FROM b GROUP BY rid, kind, k
), s AS (
  SELECT rid, kind, k, tid, name, count(*) AS shared FROM b JOIN tb USING (pair) GROUP BY rid, kind, k, tid, name
), m AS (
  SELECT rid, kind, k, name, 2 * shared / (bn.n + tn.n) AS dice FROM s JOIN bn USING (rid, kind, k) JOIN tn USING (tid)
), h AS (
  SELECT rid, generate_subscripts(words, 1) AS i, unnest(list_zip(words[1:len(words) - 1], words[2:])) AS pair FROM (SELECT rid, regexp_extract_all(lower(text), '[0-9a-z]+') AS words FROM d) WHERE len(words) > 1
), hit AS (
  SELECT rid, i, pair, tid FROM h JOIN tb USING (pair)
), near AS (
  SELECT rid, tid FROM hit JOIN tn USING (tid) GROUP BY rid, tid, tn.n HAVING {2 - licenses.LEAST} * count(DISTINCT pair) >= {licenses.LEAST} * tn.n
), win AS (
  SELECT s.rid, s.tid, s.i, tw.name, count(DISTINCT h.pair) AS n_window, count(DISTINCT CASE WHEN tb.pair IS NOT NULL THEN h.pair END) AS shared
  FROM hit s JOIN near USING (rid, tid) JOIN tw ON tw.tid = s.tid JOIN h ON h.rid = s.rid AND h.i BETWEEN s.i AND s.i + len(tw.words) - 2 LEFT JOIN tb ON tb.tid = s.tid AND tb.pair = h.pair
  GROUP BY s.rid, s.tid, s.i, tw.name
), x AS (
  SELECT rid, name, max(2 * shared / (n_window + tn.n)) AS dice FROM win JOIN tn USING (tid) GROUP BY rid, name
), g AS (
  SELECT rid, name, dice, row_number() OVER (PARTITION BY rid ORDER BY dice DESC, name) AS r FROM m WHERE dice >= {licenses.LEAST}
), l AS (
  SELECT rid, count(DISTINCT k) AS n_lines FROM m WHERE kind = 'line' AND dice >= {licenses.LEAST} GROUP BY rid
), best AS (
  SELECT rid, name, dice FROM (SELECT rid, name, dice, row_number() OVER (PARTITION BY rid ORDER BY dice DESC, name) AS r FROM (SELECT rid, name, dice FROM g WHERE r = 1 UNION ALL SELECT rid, name, dice FROM x WHERE dice >= {licenses.LEAST})) WHERE r = 1
)
SELECT doc_id, name AS license, coalesce(dice, 0.0)::DOUBLE AS dice, coalesce(n_lines, 0)::BIGINT AS n_lines
FROM d LEFT JOIN best USING (rid) LEFT JOIN l USING (rid)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_suffix_dedup": SUFFIX_DEDUP, "op6_phrase_dedup": PHRASE_DEDUP, "op2_token_counts": TOKEN_COUNTS, "op4_quality": _quality(), "op7_kdtree": TOP_K, "op10_licenses": _licenses()}
