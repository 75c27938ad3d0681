"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from auditlake.llm.chat import CONTROL
from auditlake.llm.quality import stop_list

OP1 = r"""
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), t AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS top FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN top IS NULL OR top IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN top IS DISTINCT FROM page_id THEN top END AS refers_to
FROM t
"""

OP2 = r"""
WITH parts AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), grams AS (
  SELECT doc_id, text, i, count(*) OVER (PARTITION BY doc_id, text, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT doc_id, text, w, unnest(range(1, len(w) - 1)) AS i FROM parts)
), covered AS (
  SELECT doc_id, text, count(DISTINCT i + k) AS n
  FROM grams, (VALUES (0), (1), (2)) AS t(k) WHERE n > 1 GROUP BY doc_id, text
), base AS (
  SELECT p.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(coalesce(p.text, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(list_filter(w, lambda x: list_contains(s.stop, x))) AS BIGINT) AS n_stop,
    len(lines) AS n_lines,
    len(list_filter(lines, lambda l: regexp_matches(l, '^\s*[-*•‣·]\s'))) AS n_bullets,
    len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)\s*$'))) AS n_ellipses
  FROM parts p LEFT JOIN covered c ON c.doc_id IS NOT DISTINCT FROM p.doc_id AND c.text IS NOT DISTINCT FROM p.text,
    (SELECT [@STOP@] AS stop) s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND word_chars BETWEEN 2 * n_words AND 15 * n_words
    AND n_symbols <= 0.1 * n_words AND n_stop >= 0.02 * n_words AND n_dup_lines <= 0.5 * n_lines
    AND n_bullets <= 0.9 * n_lines AND n_ellipses <= 0.3 * n_lines AS kept
FROM base
"""


OP4 = r"""
WITH rules(rule, h, p, verdict) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'),
    ('net/fr/', 'net', '/fr/', 'block')
), cut AS (
  SELECT page_id, row_number() OVER () AS row,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), best AS (
  SELECT row, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM cut, rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY row
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM cut LEFT JOIN best USING (row)
"""

OP6 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
), found AS (
  SELECT row, i, g.n, item_id
  FROM (SELECT row, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
    FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)) g
  JOIN windows v ON v.gram = g.gram AND v.n = g.n
), hit AS (
  SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(i, i + n)) AS place FROM found) GROUP BY row
), named AS (
  SELECT row, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT row, item_id FROM found) GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(m.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit h USING (row) LEFT JOIN named m USING (row)
"""

_ESCAPED = "replace({}, '\\', '\\\\')"
for _c in CONTROL:
    _ESCAPED = f"replace({_ESCAPED}, '{_c}', '{_c[0]}\\{_c[1:]}')"

OP7 = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), learned AS (
  SELECT conv_id, string_agg(text, '' ORDER BY turn, text) AS t FROM rows WHERE role = 'assistant' GROUP BY conv_id
)
SELECT r.conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || r.text || chr(10), '' ORDER BY turn, role, r.text)) AS turns_sha256,
  CAST(length(coalesce(any_value(t), '')) AS BIGINT) AS loss_chars, sha256(coalesce(any_value(t), '')) AS loss_sha256,
  CAST(sum({len("<|turn|><|text|><|end|>")} + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("r.text")})) AS BIGINT) AS formatted_chars
FROM rows r LEFT JOIN learned l ON l.conv_id IS NOT DISTINCT FROM r.conv_id GROUP BY r.conv_id
"""

# Levels that the SQL of op12 goes up: 8 ** 6 rows a language, 8 ** 3 languages.
LEAF_LEVELS, TOP_LEVELS = 6, 3

OP12_LEAVES = r"""
crc(bytes) AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b))),
raw AS (
  SELECT doc_id, lang, @FIELDS@ AS head, text,
    CASE WHEN xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda c, b: xor(c // 256, bytes[xor(c % 256, b) + 1]), 4294967295), 4294967295) % 3 = 0
      THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS altered
  FROM documents, crc
), leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(altered) || ':' || altered, '-')) AS start
  FROM raw
), l0 AS (
  SELECT lang AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h,
    count(*) OVER (PARTITION BY lang) AS m, doc_id, leaf, start
  FROM leaves
)"""


def _tree_sql(name: str, levels: int) -> str:
    """Nodes, siblings and the top of every tree over the rows of ``<name>0``."""
    parts = []
    for k in range(levels):
        parts.append(
            f"""{name}s{k} AS (
  SELECT a.tree, a.i, any_value(a.m) AS m,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM {name}{k} a JOIN {name}{k} b ON a.tree IS NOT DISTINCT FROM b.tree AND a.i // 8 = b.i // 8
  GROUP BY a.tree, a.i
), {name}{k + 1} AS (
  SELECT tree, i // 8 AS i, CASE WHEN any_value(m) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h,
    (any_value(m) + 7) // 8 AS m
  FROM {name}{k} GROUP BY tree, i // 8
)"""
        )
    return ", ".join(parts)


def _fold_sql(name: str, tree: str, levels: int, source: str, place: str) -> str:
    """Rows of ``source`` with ``fold`` and ``proof`` taken up through the levels."""
    parts = []
    for k in range(levels):
        before = source if k == 0 else f"{name}f{k}"
        parts.append(
            f"""{name}f{k + 1} AS (
  SELECT f.* EXCLUDE (fold, proof), CASE WHEN s.m > 1 THEN sha256(s.before || fold || s.after) ELSE fold END AS fold,
    proof || s.before || s.after AS proof
  FROM {before} f JOIN {name}s{k} s ON s.tree IS NOT DISTINCT FROM f.{tree} AND s.i = f.{place} // {8**k}
)"""
        )
    return ", ".join(parts)


def _op12() -> str:
    said = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
    fields = " || ".join(said.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    tops = f"""t0 AS (
  SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i, h, count(*) OVER () AS m, tree AS lang FROM l{LEAF_LEVELS}
)"""
    start = "p0 AS (SELECT l0.*, i AS place, start AS fold, '' AS proof FROM l0)"
    over = f"""q0 AS (
  SELECT f.*, t0.i AS top, t0.h AS subroot, 0 AS above FROM lf{LEAF_LEVELS} f JOIN t0 ON t0.lang IS NOT DISTINCT FROM f.tree
)"""
    steps = [
        OP12_LEAVES.replace("@FIELDS@", fields),
        _tree_sql("l", LEAF_LEVELS),
        tops,
        _tree_sql("t", TOP_LEVELS),
        start,
        _fold_sql("l", "tree", LEAF_LEVELS, "p0", "place"),
        over,
        _fold_sql("t", "above", TOP_LEVELS, "q0", "top"),
    ]
    return f"""WITH {", ".join(steps)}
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = r.h AS verified
FROM tf{TOP_LEVELS}, t{TOP_LEVELS} r
"""




OP13 = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
    coalesce(vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(embedding, lambda c: c <> 0)) > 0, false) AS usable
  FROM embeddings
), linked AS MATERIALIZED (
  SELECT a.row, a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.row <> b.row
  WHERE a.usable AND b.usable AND CASE WHEN len(a.x) = len(b.x) THEN list_cosine_similarity(a.x, b.x) END >= 0.93
), reached(a, b) AS (
  SELECT DISTINCT vec_id, vec_id FROM v WHERE usable
  UNION SELECT reached.a, linked.b FROM reached JOIN linked ON linked.a = reached.b
), least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a),
counted AS (SELECT row, count(*) AS n FROM linked GROUP BY row)
SELECT v.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links,
  CASE WHEN usable THEN component_id ELSE vec_id END AS component_id,
  coalesce(v.vec_id = CASE WHEN usable THEN component_id ELSE vec_id END, true) AS kept
FROM v LEFT JOIN least ON least.a = v.vec_id LEFT JOIN counted USING (row)
"""


def _op11(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain rounds over all vectors and entries; sums of doubles here are exact integers."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: floor(4096 * CAST(x AS DOUBLE))) AS v, len(embedding) // {parts} AS w
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (SELECT row, part, v[part * w + 1 : (part + 1) * w] AS v FROM kept, range({parts}) t(part)
), b0 AS MATERIALIZED (
  SELECT part, entry, v FROM p JOIN (SELECT row, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {entries}) USING (row)
)"""
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""a{k} AS MATERIALIZED (
  SELECT row, p.part, min(CAST(list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, b.v) + list_inner_product(b.v, b.v) AS BIGINT) * {entries} + entry) AS best
  FROM p JOIN b{k} b ON b.part = p.part GROUP BY row, p.part
)"""
        )
        if k < rounds:
            steps.append(
                f"""m{k} AS (
  SELECT part, entry, list(floor(s / n) ORDER BY place) AS v
  FROM (SELECT part, best % {entries} AS entry, place, sum(v[place]) AS s, count(*) AS n
    FROM (SELECT a{k}.part, best, v, unnest(range(1, len(v) + 1)) AS place FROM a{k} JOIN p ON p.row = a{k}.row AND p.part = a{k}.part)
    GROUP BY part, best % {entries}, place) GROUP BY part, entry
), b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{k} b LEFT JOIN m{k} m ON m.part = b.part AND m.entry = b.entry)"""
            )
    return f"""WITH {", ".join(steps)}, coded AS (
  SELECT row, string_agg(printf('%02x', best % {entries}), '' ORDER BY part) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error
  FROM a{rounds} GROUP BY row
), books AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place)) AS digest
  FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS place FROM b{rounds})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM kept JOIN coded USING (row), books
"""


_STOP = ", ".join(f"'{w}'" for w in stop_list())

ORACLES: dict[str, str] = {
    "op1_warc": OP1,
    "op2_quality_rules": OP2.replace("@STOP@", _STOP),
    "op4_url_filters": OP4,
    "op6_decontaminate": OP6,
    "op7_chat_formatting": OP7,
    "op11_vector_codes": _op11(),
    "op12_merkle_manifest": _op12(),
    "op13_embedding_neighbours": OP13,
}
