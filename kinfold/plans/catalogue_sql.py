"""DuckDB SQL for the queries of kinfold.plans.catalogue, built from common table expressions."""

from __future__ import annotations

from kinfold.functions.lexical import SCALES
from kinfold.options import LENGTH_EDGES

#: Classes of characters as RE2 spells them.
SPACES = r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
DIGITS = (
    r"\p{Nd}\x{B2}\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}\x{24EA}"
    r"\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)
COLUMNS = {
    "customer": ("c_custkey", ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")),
    "part": ("p_partkey", ("p_name", "p_brand", "p_type", "p_size")),
    "documents": ("doc_id", ("text",)),
    "supplier": ("s_suppkey", ("s_name", "s_nationkey", "s_acctbal")),
}


def cells(table: str, skip: int = 0) -> str:
    key, columns = COLUMNS[table]
    parts = [f"SELECT {key}::BIGINT AS record_id, {k}::INTEGER AS col_index, {c}::VARCHAR AS value FROM {table}" for k, c in enumerate(columns[skip:])]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE length(value) > 0"


def norm(table: str, longest: int = 512) -> str:
    clean = r"regexp_replace(value, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g')"
    return rf"""cells AS ({cells(table)}), norm AS (
  SELECT * FROM (SELECT record_id, col_index, substring(regexp_replace(trim(lower({clean}), ' '), '\s+', ' ', 'g'), 1, {longest}) AS norm_value FROM cells) WHERE length(norm_value) >= 2
)"""


#: Texts of documents are taken whole.
LONGEST = {"documents": 2**31 - 1}


def feats(table: str) -> str:
    count = lambda cls: f"length(norm_value) - length(regexp_replace(norm_value, '[{cls}]', '', 'g'))"
    ratio = lambda part, whole: f"CASE WHEN {whole} > 0 THEN ({part}) / {whole} ELSE 0 END::FLOAT"
    return rf"""{norm(table, LONGEST.get(table, 512))}, counted AS (
  SELECT *, length(norm_value) AS n, {count(DIGITS)} AS digits, {count(r'\p{L}')} AS letters, {count(SPACES)} AS spaces, {count(r'\p{Lu}')} AS uppers, {count('aeiouAEIOU')} AS vowels,
         len(list_filter(string_split_regex(norm_value, '[{SPACES}\-_/.,;:|]+'), lambda x: x <> ''))::BIGINT AS token_count, string_split(norm_value, '') AS chars,
         regexp_replace(regexp_replace(regexp_replace(norm_value, '\p{{L}}', 'A', 'g'), '[{DIGITS}]', '9', 'g'), '[{SPACES}]', ' ', 'g') AS pattern
  FROM norm
), feat AS (
  SELECT record_id, col_index, norm_value, n::BIGINT AS length, token_count, len(list_distinct(chars))::BIGINT AS unique_chars,
         {ratio('digits', 'n')} AS digit_ratio, {ratio('letters', 'n')} AS alpha_ratio, {ratio('n - digits - letters - spaces', 'n')} AS symbol_ratio, {ratio('spaces', 'n')} AS space_ratio,
         {ratio('uppers', 'letters')} AS upper_ratio, {ratio('vowels', 'letters')} AS vowel_ratio, abs(list_aggregate(chars, 'entropy'))::FLOAT AS entropy, pattern,
         array_to_string(list_filter(string_split(pattern, ''), lambda x, i: i = 1 OR string_split(pattern, '')[i - 1] <> x), '') AS pattern_compact
  FROM counted
)"""


def crc32(value: str) -> str:
    """The checksum by its rule: one step of eight shifts a byte."""
    digits = f"hex(encode({value}))"
    data = f"list_transform(range(1, length({digits}), 2), lambda i: ('0x' || substring({digits}, i, 2))::BIGINT)"
    step = "list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda acc, b: {step}), 4294967295)"


def key_expressions(prefix: int = 3) -> dict[str, str]:
    buckets = " ".join(f"WHEN length <= {edge} THEN {k}" for k, edge in enumerate(LENGTH_EDGES))
    return {
        "PFX": f"'PFX_' || substring(norm_value, 1, {prefix})",
        "PAT": f"'PAT_' || ({crc32('pattern')} % 10000)",
        "CPT": f"'CPT_' || ({crc32('pattern_compact')} % 10000)",
        "LEN": f"'LEN_' || (CASE {buckets} ELSE {len(LENGTH_EDGES)} END)",
        "TOK": "'TOK_' || least(token_count, 32)",
    }


def keys(table: str, kinds: tuple[str, ...] = ("PFX", "PAT", "CPT", "LEN", "TOK"), prefix: int = 3) -> str:
    found = key_expressions(prefix)
    # the checksum is computed once for each pattern
    hashed = [(k, "pattern" if k == "PAT" else "pattern_compact") for k in kinds if k in ("PAT", "CPT")]
    tables = "".join(f", hash_{k} AS (SELECT {c}, {found[k]} AS key_{k} FROM (SELECT DISTINCT {c} FROM feat))" for k, c in hashed)
    joins = "".join(f" JOIN hash_{k} USING ({c})" for k, c in hashed)
    spelled = ", ".join(f"key_{k}" if k in ("PAT", "CPT") else found[k] for k in kinds)
    return f"{feats(table)}{tables}, generated AS (SELECT record_id, col_index, norm_value, length, {', '.join(SCALED)}, unnest([{spelled}]) AS block_key FROM feat{joins})"


SCALED = tuple(n for n in SCALES if n != "length")


def guarded(table: str, low: int = 2, high: int = 50_000, kinds: tuple[str, ...] = ("PFX", "PAT", "CPT", "LEN", "TOK"), prefix: int = 3) -> str:
    return f"{keys(table, kinds, prefix)}, keyed AS (SELECT * FROM generated WHERE block_key IN (SELECT block_key FROM generated GROUP BY block_key HAVING count(*) BETWEEN {low} AND {high}))"


def all_blocks(table: str = "customer") -> str:
    return f"{guarded(table)}, blocks AS (SELECT DISTINCT block_key AS block_id, record_id FROM keyed)"


def top(k: int = 2, before: str = "") -> str:
    return f"""{before or all_blocks()}, sized AS (SELECT *, count(*) OVER (PARTITION BY block_id) AS size FROM blocks
), ranked AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY size, block_id) AS r FROM sized
), few AS (SELECT block_id, record_id FROM ranked WHERE r <= {k}
), best AS (SELECT * FROM few WHERE block_id IN (SELECT block_id FROM few GROUP BY block_id HAVING count(*) >= 2))"""


def weighted(part: str = "1.0 / size", cost: int = 100_000, tau: float = 0.0, k: int = 2, before: str = "") -> str:
    return f"""{top(k, before)}, weighed AS (SELECT *, ({part})::DOUBLE AS part FROM (SELECT *, count(*) OVER (PARTITION BY block_id) AS size, (SELECT count(DISTINCT record_id) FROM blocks) AS corpus FROM best) WHERE size * (size - 1) / 2 <= {cost}
), edges AS (SELECT * FROM (
  SELECT a.record_id AS src, b.record_id AS dst, round(sum(a.part), 6) AS weight FROM weighed a JOIN weighed b ON a.block_id = b.block_id AND a.record_id < b.record_id WHERE a.part > 0 GROUP BY 1, 2) WHERE weight >= {tau})"""


def vectors(guard: str = "") -> str:
    scaled = ", ".join(f"({f'ln(1 + length::DOUBLE)' if n == 'length' else f'{n}::DOUBLE'}) / {s} AS s_{n}" for n, s in SCALES.items())
    names = ", ".join(f"s_{n}" for n in SCALES)
    return f"""{guard or guarded('customer')}, scaled AS (SELECT block_key, record_id, {scaled} FROM keyed
), vec AS (SELECT block_key, {names}, count(*) AS copies, min(record_id) AS rep, row_number() OVER () AS vid FROM scaled GROUP BY block_key, {names})"""


def near(eps: float, guard: str = "") -> str:
    d2 = " + ".join(f"(a.s_{n} - b.s_{n}) * (a.s_{n} - b.s_{n})" for n in SCALES)
    return f"{vectors(guard)}, near AS (SELECT a.block_key, a.vid AS a, b.vid AS b, a.rep AS a_rep, b.rep AS b_rep, b.copies AS b_copies, {d2} AS d2 FROM vec a JOIN vec b ON a.block_key = b.block_key WHERE {d2} <= {eps!r} * {eps!r})"


def components(edges: str, table: str = "customer", key: str = "c_custkey") -> str:
    """Rows (record_id, cluster_id): the least record that can be reached, handed on from neighbour to neighbour."""
    return f"""sym AS MATERIALIZED (SELECT src AS x, dst AS y FROM {edges} UNION SELECT dst, src FROM {edges}
), reach(record_id, cluster_id) USING KEY (record_id) AS (
  SELECT {key}::BIGINT, {key}::BIGINT FROM {table}
  UNION SELECT c.record_id, min(n.cluster_id) FROM reach n JOIN sym ON sym.y = n.record_id JOIN recurring.reach c ON c.record_id = sym.x GROUP BY c.record_id, c.cluster_id HAVING min(n.cluster_id) < c.cluster_id)"""


def with_clause(body: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{body}\n{select}"


BRANDS = "assigned AS (SELECT p_partkey::BIGINT AS record_id, p_brand, min(p_partkey) OVER (PARTITION BY p_brand)::BIGINT AS cluster_id FROM part)"


def cluster_table(before: str = "") -> str:
    """Clusters of the relation assigned, over the features of feat."""
    spread = lambda n: f"coalesce(stddev_pop({n}::DOUBLE), 0)"
    return f"""{before or f"{feats('part')}, {BRANDS}"}, lowest AS (SELECT record_id, arg_min(length, col_index) AS length, arg_min(digit_ratio, col_index) AS digit_ratio, arg_min(alpha_ratio, col_index) AS alpha_ratio FROM feat GROUP BY record_id
), clusters AS (
  SELECT *, greatest(0.0, least(1.0, 1.0 - std_length / 64.0 - std_digit_ratio - std_alpha_ratio)) AS cohesion FROM (
    SELECT cluster_id, array_to_string(list_sort(list(record_id)), ',') AS members, count(*)::BIGINT AS size, {spread('length')} AS std_length, {spread('digit_ratio')} AS std_digit_ratio, {spread('alpha_ratio')} AS std_alpha_ratio
    FROM assigned LEFT JOIN lowest USING (record_id) GROUP BY cluster_id))"""


def refined_blocks(table: str, steps: int) -> str:
    """Blocks refined step by step, each time merged by equal members and purged of subsets of larger blocks."""
    out = f"{guarded(table)}, member AS (SELECT DISTINCT block_key, record_id FROM keyed), blocks_0 AS (SELECT block_key AS id, [block_key] AS tokens, record_id FROM member)"
    for k in range(1, steps + 1):
        out += f""", candidate_{k} AS (SELECT b.tokens, b.record_id, m.block_key AS c FROM blocks_{k - 1} b JOIN member m USING (record_id) WHERE NOT list_contains(b.tokens, m.block_key)
), support_{k} AS (SELECT tokens, c FROM candidate_{k} GROUP BY tokens, c HAVING count(DISTINCT record_id) >= {max(k, 2)}
), fine_{k} AS (SELECT DISTINCT list_sort(list_append(tokens, c)) AS tokens, record_id FROM candidate_{k} JOIN support_{k} USING (tokens, c)
), both_{k} AS (SELECT DISTINCT ON (id, record_id) id, tokens, record_id FROM (SELECT * FROM blocks_{k - 1} UNION ALL SELECT array_to_string(tokens, '|'), tokens, record_id FROM fine_{k})
), merged_{k} AS (SELECT * FROM both_{k} WHERE id IN (SELECT min(id) FROM (SELECT id, list_sort(list(record_id)) AS members FROM both_{k} GROUP BY id) GROUP BY members)
), sized_{k} AS (SELECT id, record_id, count(*) OVER (PARTITION BY id) AS size FROM merged_{k}
), inside_{k} AS (SELECT DISTINCT id FROM (SELECT a.id, b.id AS other, a.size, count(*) AS shared FROM sized_{k} a JOIN sized_{k} b ON a.record_id = b.record_id AND a.size < b.size GROUP BY 1, 2, 3) WHERE shared = size
), blocks_{k} AS MATERIALIZED (SELECT * FROM merged_{k} WHERE id NOT IN (SELECT id FROM inside_{k}))"""
    return f"{out}, blocks AS (SELECT id AS block_id, record_id FROM blocks_{steps})"


def pairs_of(name: str, relation: str, group: str) -> str:
    return f"pairs_{name} AS (SELECT coalesce(sum(n * (n - 1) // 2), 0)::BIGINT AS {name} FROM (SELECT count(*) AS n FROM {relation} GROUP BY {group}))"


METRICS = (
    "TP, L - TP AS FP, E - TP AS FN, L, E, round(CASE WHEN L = 0 THEN 1 ELSE TP / L END, 4) AS precision, round(CASE WHEN E = 0 THEN 1 ELSE TP / E END, 4) AS recall, "
    "round(CASE WHEN TP = 0 THEN 0 ELSE 2.0 * (TP / L) * (TP / E) / (TP / L + TP / E) END, 4) AS f1 FROM pairs_L, pairs_E, pairs_TP"
)


def oracle_sql() -> dict[str, str]:
    feature = lambda table, *columns: with_clause(feats(table), f"SELECT record_id, col_index, {', '.join(columns)} FROM feat")
    rounded = lambda n: f"round({n}::DOUBLE, 5) AS {n}"
    key = lambda table, kind: with_clause(keys(table, (kind,)), "SELECT record_id, col_index, block_key FROM generated")
    text_cells = r"cells AS (SELECT conv_id::BIGINT AS record_id, generate_subscripts(string_split_regex(text, '[\t|;]'), 1) - 1 AS col_index, unnest(string_split_regex(text, '[\t|;]')) AS value FROM conversations)"
    part_cells = r"cells AS (SELECT p_partkey::BIGINT AS record_id, i::INTEGER AS col_index, value FROM (SELECT p_partkey, unnest([p_brand, p_type]) AS value, generate_subscripts([p_brand, p_type], 1) - 1 AS i FROM part))"
    idf = "CASE WHEN corpus > size THEN ln(corpus / size) / size ELSE 0 END"
    refined = f"""{guarded('customer')}, member AS (SELECT DISTINCT block_key, record_id FROM keyed
), pairs AS (SELECT a.block_key AS used, b.block_key AS candidate, a.record_id FROM member a JOIN member b ON a.record_id = b.record_id AND a.block_key <> b.block_key
), support AS (SELECT used, candidate FROM pairs GROUP BY 1, 2 HAVING count(DISTINCT record_id) >= 2)"""
    prints = f"{all_blocks()}, prints AS (SELECT block_id, sha256(array_to_string(list(record_id::VARCHAR ORDER BY record_id), ',')) AS fingerprint FROM blocks GROUP BY block_id)"
    subsets = f"""{all_blocks()}, sized AS (SELECT *, count(*) OVER (PARTITION BY block_id) AS size FROM blocks
), inside AS (SELECT DISTINCT block_id FROM (SELECT a.block_id, b.block_id AS other, a.size, count(*) AS shared FROM sized a JOIN sized b ON a.record_id = b.record_id AND a.size < b.size GROUP BY 1, 2, 3) WHERE shared = size)"""
    eps_edges = """, edges AS (
  SELECT DISTINCT least(a_rep, b_rep) AS src, greatest(a_rep, b_rep) AS dst FROM near WHERE a_rep <> b_rep AND a IN (SELECT vid FROM core) AND b IN (SELECT vid FROM core)
  UNION SELECT DISTINCT least(rep, record_id), greatest(rep, record_id) FROM scaled JOIN vec USING (block_key, {names}) WHERE rep <> record_id AND vid IN (SELECT vid FROM core)
)""".format(names=", ".join(f"s_{n}" for n in SCALES))
    core = lambda k: f", core AS (SELECT a AS vid, sum(b_copies)::BIGINT AS neighbours FROM near GROUP BY a HAVING sum(b_copies) >= {k})"
    assigned = ", assigned AS (SELECT record_id, cluster_id FROM reach WHERE record_id IN (SELECT record_id FROM feat))"
    whole_run = lambda edges: with_clause(cluster_table(f"{edges}, {components('edges')}{assigned}"), "SELECT cluster_id, size, round(cohesion, 5) AS cohesion FROM clusters WHERE size BETWEEN 2 AND 1000000 AND cohesion >= 0", True)
    source = lambda table: f"SELECT record_id::VARCHAR AS ref_id, col_index, value FROM ({cells(table)})"
    border_edges = eps_edges.replace("vid IN (SELECT vid FROM core)\n)", "vid IN (SELECT vid FROM core UNION SELECT a FROM border)\n  UNION SELECT least(x, y), greatest(x, y) FROM border WHERE x <> y\n)")
    border_edges = ", border AS (SELECT a, a_rep AS x, min({'d': d2, 'r': b_rep}).r AS y FROM near WHERE b IN (SELECT vid FROM core) AND a NOT IN (SELECT vid FROM core) GROUP BY a, a_rep)" + border_edges
    run_clusters = cluster_table(f"{weighted(tau=0.23, k=3)}, {components('edges')}{assigned}")
    run_sizes = "SELECT size, count(*) AS clusters FROM clusters WHERE size BETWEEN 2 AND 1000000 AND cohesion >= 0 GROUP BY size"
    dist = "SELECT size, count(*) AS clusters FROM (SELECT count(*) AS size FROM {} GROUP BY {}) GROUP BY size"
    edge_rows = "SELECT src, dst, weight FROM edges"
    return {
        "cells_flatten": f"SELECT record_id, col_index, value FROM ({cells('customer')})",
        "cells_skip_leading": f"SELECT record_id, col_index, value FROM ({cells('customer', 2)})",
        "text_split_cells": with_clause(text_cells, "SELECT record_id, col_index::INTEGER AS col_index, count(*) AS n, min(value) AS low, max(value) AS high FROM cells WHERE length(value) > 0 GROUP BY ALL"),
        "text_split_skip": with_clause(part_cells, "SELECT record_id, col_index, value FROM cells WHERE length(value) > 0"),
        "ref_id_map": "SELECT c_custkey::BIGINT AS record_id, c_nationkey::VARCHAR AS ref_id FROM customer WHERE length(c_nationkey::VARCHAR) > 0",
        "norm_values": with_clause(norm("customer"), "SELECT record_id, col_index, norm_value FROM norm"),
        "norm_truncated": with_clause(norm("documents"), "SELECT record_id, col_index, norm_value FROM norm"),
        "feat_counts": feature("documents", "length", "token_count", "unique_chars"),
        "feat_ratios": feature("documents", *(rounded(n) for n in ("digit_ratio", "alpha_ratio", "symbol_ratio", "space_ratio", "upper_ratio", "vowel_ratio"))),
        "feat_entropy": feature("part", rounded("entropy")),
        "feat_entropy_text": feature("documents", rounded("entropy")),
        "feat_scaled": feature("part", *(f"round(({'ln(1 + length::DOUBLE)' if n == 'length' else f'{n}::DOUBLE'}) / {s}, 5) AS {n}" for n, s in SCALES.items())),
        "pattern": feature("customer", "pattern"),
        "pattern_compact": feature("customer", "pattern_compact"),
        "key_prefix": key("part", "PFX"),
        "key_pattern_hash": key("part", "PAT"),
        "key_compact_hash": key("part", "CPT"),
        "key_length": key("documents", "LEN"),
        "key_tokens": key("documents", "TOK"),
        "block_sizes": with_clause(keys("part"), "SELECT block_key, count(*) AS size FROM generated GROUP BY block_key"),
        "block_guard": with_clause(guarded("part", 3, 500), "SELECT record_id, col_index, block_key FROM keyed"),
        "block_members": with_clause(guarded("part"), "SELECT DISTINCT block_key AS block_id, record_id FROM keyed"),
        "record_keys": with_clause(guarded("part"), "SELECT record_id, array_to_string(list_sort(list(DISTINCT block_key)), '|') AS all_keys FROM keyed GROUP BY record_id"),
        "refine_blocks": with_clause(refined, "SELECT DISTINCT least(used, candidate) || '|' || greatest(used, candidate) AS block_id, record_id FROM pairs JOIN support USING (used, candidate)"),
        "block_fingerprints": with_clause(prints, "SELECT block_id, fingerprint FROM prints"),
        "merge_blocks": with_clause(prints, "SELECT block_id, record_id FROM blocks WHERE block_id IN (SELECT min(block_id) FROM prints GROUP BY fingerprint)"),
        "purge_blocks": with_clause(subsets, "SELECT block_id, record_id FROM blocks WHERE block_id NOT IN (SELECT block_id FROM inside)"),
        "topk_blocks": with_clause(top(), "SELECT block_id, record_id FROM best"),
        "arcs_edges_uniform": with_clause(weighted(), edge_rows),
        "arcs_edges_idf": with_clause(weighted(idf), edge_rows),
        "arcs_edges_tau": with_clause(weighted(tau=0.2), edge_rows),
        "arcs_pair_cost": with_clause(weighted(cost=300), edge_rows),
        "eps_neighbours": with_clause(near(0.1), "SELECT block_key, a_rep AS rep, count(*) AS vectors, sum(b_copies)::BIGINT AS cells FROM near GROUP BY block_key, a_rep"),
        "dbscan_cores": with_clause(near(0.05) + core(5), "SELECT vec.block_key, rep, neighbours FROM core JOIN vec USING (vid)"),
        "dbscan_clusters": with_clause(near(0.05) + core(2) + eps_edges + ", " + components("edges"), "SELECT record_id, cluster_id FROM reach", True),
        "components_local": with_clause(weighted(tau=0.2) + ", " + components("edges"), "SELECT record_id, cluster_id FROM reach", True),
        "components_star": with_clause(weighted(tau=0.2) + ", " + components("edges"), "SELECT record_id, cluster_id FROM reach", True),
        "cluster_stats": with_clause(cluster_table(), "SELECT cluster_id, members, size, round(std_length, 5) AS std_length, round(std_digit_ratio, 5) AS std_digit_ratio, round(std_alpha_ratio, 5) AS std_alpha_ratio, round(cohesion, 5) AS cohesion FROM clusters"),
        "cluster_filter": with_clause(cluster_table(), "SELECT cluster_id, size FROM clusters WHERE size BETWEEN 70 AND 90 AND cohesion >= 0.5"),
        "pair_metrics": with_clause(
            ", ".join((pairs_of("L", "part", "p_brand"), pairs_of("E", "part", "p_type"), pairs_of("TP", "part", "p_brand, p_type"))),
            f"SELECT {METRICS}",
        ),
        "dist_predicted": dist.format("part", "p_brand"),
        "dist_truth": dist.format("part", "p_type"),
        "dbscan_border": with_clause(near(0.02) + core(12) + border_edges + ", " + components("edges"), "SELECT record_id, cluster_id FROM reach", True),
        "arcs_recursion": with_clause(weighted(k=3, before=refined_blocks("supplier", 2)), edge_rows),
        "source_csv": source("part"),
        "source_tsv": source("customer"),
        "source_text": source("part"),
        "source_parquet": source("supplier"),
        "source_truth": "SELECT p_partkey::VARCHAR AS ref_id, p_type AS truth_id FROM part",
        "sink_parquet": with_clause(cluster_table(), "SELECT cluster_id, size, members FROM clusters"),
        "sink_json": with_clause(cluster_table(), "SELECT cluster_id, size, members FROM clusters"),
        "run_metrics": with_clause(
            f"{run_clusters}, t AS (SELECT record_id, cluster_id, c_nationkey AS truth FROM assigned JOIN customer ON c_custkey = record_id), {pairs_of('L', 'assigned', 'cluster_id')}, {pairs_of('E', 'customer', 'c_nationkey')}, {pairs_of('TP', 't', 'cluster_id, truth')}",
            f"SELECT (SELECT count(*) FROM clusters WHERE size BETWEEN 2 AND 1000000 AND cohesion >= 0) AS n_predicted, (SELECT count(DISTINCT c_nationkey) FROM customer) AS n_truth, {METRICS}",
            True,
        ),
        "run_log": with_clause(run_clusters, f"SELECT (row_number() OVER (ORDER BY size) - 1)::INTEGER AS place, size, clusters FROM ({run_sizes})", True),
        "run_clusters": with_clause(run_clusters, run_sizes, True),
        "end_to_end_arcs": whole_run(weighted(tau=0.2, k=3)),
        "end_to_end_dbscan": whole_run(near(0.35) + core(2) + eps_edges),
    }
