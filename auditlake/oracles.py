"""DuckDB SQL with the meaning of each query, written apart from the Spark code.

The lookup rows are inlined as ``VALUES`` and the mapping document as JSON text,
which SQL takes apart itself.
"""

from __future__ import annotations

import json

from auditlake import fixtures as fx
from auditlake.sources.terms import ENUMS, TERMS


def _values(rows: list[tuple]) -> str:
    def one(value) -> str:
        return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(one(v) for v in row) + ")" for row in rows)


_TERM_ROWS = _values([(t, term, c) for t, captions in TERMS.items() for term, c in captions.items()])
_ENUM_ROWS = _values(
    [(*key[2:-2].split("', '"), c, number) for key, ids in ENUMS.items() for c, number in ids.items()]
)
_CLASS_ROWS = _values(
    [
        ("AUTH", "authentication"),
        ("SYSTEM_CONFIG", "scheduled_job_activity"),
        ("USER_MANAGEMENT", "account_change"),
        ("ACCESS_ITEM", "account_change"),
        ("ACCESS_REQUEST", "account_change"),
        ("PROVISIONING", "account_change"),
        ("PASSWORD_ACTIVITY", "account_change"),
    ]
)
_MAPPING_TEXT = json.dumps(fx.DEMO_MAPPING).replace("'", "''")

_AUDIT = """
audit AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
    CASE WHEN k % 20 = 0 THEN 'PROVISIONING' WHEN k % 20 = 1 THEN 'UNMAPPED'
         WHEN event_type = 'signup' THEN 'USER_MANAGEMENT' WHEN event_type = 'error' THEN 'SYSTEM_CONFIG'
         WHEN event_type = 'click' THEN 'ACCESS_ITEM' WHEN event_type = 'view' THEN 'AUTH'
         WHEN event_type = 'purchase' THEN 'ACCESS_REQUEST' END AS type,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS created,
    ['CREATE', 'UPDATE', 'DELETE', 'ADD', 'REQUEST', 'LOGOUT', 'GRANT', 'ZZZ'][k % 8 + 1] AS operation,
    CASE WHEN value < 5 THEN 'STARTED' WHEN value < 50 THEN 'PASSED' ELSE 'FAILED' END AS status,
    CASE WHEN user_id % 7 <> 0 THEN 'user_' || CAST(user_id AS VARCHAR) END AS actor_name,
    'Source ' || CAST(user_id % 5 AS VARCHAR) AS source_name,
    ['t' || CAST(k % 3 AS VARCHAR), event_type] AS tags,
    date_trunc('milliseconds', ts) AS created_at, event_id, event_type, user_id, k
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
)"""
_CLASSES = f"classes(type, class_name) AS (VALUES {_CLASS_ROWS})"
_TERMS = f"terms(type, term, caption) AS (VALUES {_TERM_ROWS})"
_ENUMS = f"enums(object, attribute, caption, id) AS (VALUES {_ENUM_ROWS})"
# Rules as written, flattened from the document: one row per rule, branch and target.
_RULES = f"""
docs AS (SELECT t.key AS type, t.value AS body FROM json_each('{_MAPPING_TEXT}'::JSON) t),
items AS (
  SELECT d.type, json_extract_string(d.body, '$.staticValues.class_name') AS class_name, f.key AS source,
    m.value AS rule,
    CAST(row_number() OVER (PARTITION BY d.type ORDER BY f.id, CAST(m.key AS INTEGER)) - 1 AS INTEGER) AS rule_no
  FROM docs d, json_each(json_extract(d.body, '$.fieldMappings')) f, json_each(f.value) m
),
targets AS (
  SELECT type, rule_no, NULL AS term, json_extract_string(rule, '$.target_field') AS target
  FROM items WHERE json_type(rule, '$.target_field') = 'VARCHAR'
  UNION ALL
  SELECT i.type, i.rule_no, t.key, json_extract_string(t.value, '$')
  FROM items i, json_each(json_extract(i.rule, '$.target_field')) t
  WHERE json_type(i.rule, '$.target_field') = 'OBJECT'
),
branches AS (
  SELECT i.type, i.rule_no, json_extract_string(c.value, '$.condition') AS condition,
    json_extract_string(c.value, '$.source_field') AS source_field
  FROM items i, json_each(json_extract(i.rule, '$.conditions')) c
),
rules AS (
  SELECT i.type, i.class_name, i.rule_no, i.source, b.condition, b.source_field, t.term, t.target,
    json_extract_string(i.rule, '$.transform') AS transform,
    json_extract_string(i.rule, '$.output_type') AS output_type,
    json_extract_string(i.rule, '$.concat_string') AS concat_string
  FROM items i JOIN targets t ON t.type = i.type AND t.rule_no = i.rule_no
  LEFT JOIN branches b ON b.type = i.type AND b.rule_no = i.rule_no
)"""
_TYPE_COUNTS = """
counts AS (
  SELECT c.type, CAST(count(a.id) AS BIGINT) AS n_events
  FROM classes c LEFT JOIN audit a ON a.type = c.type GROUP BY c.type
)"""
_CAPTIONED = """
captioned AS (
  SELECT a.*, coalesce(t.caption, 'Other') AS caption, t.caption IS NOT NULL AS hit
  FROM audit a LEFT JOIN terms t ON t.type = a.type AND t.term = a.operation
)"""
_RECORDS = """
records AS (
  SELECT c.class_name, '1.0.0-rc.2' AS metadata_version, 'Identity Audit' AS product_name,
    coalesce(t1.caption, 'Other') AS activity_name,
    CAST(coalesce(e1.id, 0) AS INTEGER) AS activity_id,
    coalesce(t2.caption, 'Other') AS status,
    CAST(coalesce(e2.id, 0) AS INTEGER) AS status_id,
    CAST(epoch_us(a.created_at) // 1000000 AS BIGINT) AS time,
    coalesce(
      CASE WHEN a.actor_name IS NULL THEN a.source_name
           WHEN contains(a.actor_name, 'System') THEN a.source_name
           WHEN contains(a.actor_name, 'user_1') THEN NULL
           WHEN NOT list_contains(a.tags, 't1') THEN a.id END,
      a.actor_name) AS actor_user_name,
    CASE WHEN a.actor_name IS NOT NULL THEN coalesce(t3.caption, 'Other') END AS actor_user_type,
    CAST(CASE WHEN a.actor_name IS NOT NULL THEN coalesce(e3.id, 0) END AS INTEGER) AS actor_user_type_id,
    a.source_name AS src_name, a.source_name AS src_group_name, a.operation AS src_kind,
    a.id, a.type, a.created
  FROM audit a
  JOIN classes c ON c.type = a.type
  LEFT JOIN terms t1 ON t1.type = a.type AND t1.term = a.operation
  LEFT JOIN terms t2 ON t2.type = a.type AND t2.term = a.status
  LEFT JOIN terms t3 ON t3.type = a.type AND t3.term = 'USER'
  LEFT JOIN enums e1 ON e1.object = c.class_name AND e1.attribute = 'activity_id'
    AND e1.caption = coalesce(t1.caption, 'Other')
  LEFT JOIN enums e2 ON e2.object = c.class_name AND e2.attribute = 'status_id'
    AND e2.caption = CASE WHEN c.class_name = 'scheduled_job_activity' THEN 'Job ' ELSE '' END
      || coalesce(t2.caption, 'Other')
  LEFT JOIN enums e3 ON e3.object = 'user' AND e3.attribute = 'type_id'
    AND e3.caption = 'Actor ' || coalesce(t3.caption, 'Other')
)"""
_LAKE_KEYS = f"""'{fx.TENANT.region}' AS region, '{fx.TENANT.account_id}' AS "accountId",
  substr(created, 1, 4) || substr(created, 6, 2) || substr(created, 9, 2) AS "eventDay" """

_READY = "created > '2024-01-10T00:00:00.000Z' AND created < '2024-01-30T23:00:00.000Z'"
# all from the default start up to the lag
_SETTLED = "created > '2023-01-01T00:00:00.000Z' AND created < '2024-01-30T23:00:00.000Z'"
_MAPPED = "(SELECT type FROM classes)"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


_A = _with(_AUDIT)
_AC = _with(_AUDIT, _CLASSES)
_ALL = _with(_AUDIT, _CLASSES, _TERMS, _ENUMS, _RECORDS)
_ACR = _with(_AUDIT, _CLASSES, _RULES, _TYPE_COUNTS)
_LANDED = _ALL + f"SELECT *, {_LAKE_KEYS} FROM records"

ORACLES: dict[str, str] = {
    # sources and sinks
    "scan_events": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "scan_table": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "jsonl_roundtrip": _ALL + "SELECT * FROM records",
    "infer_schema": _AC
    + """SELECT class_name, 'OBJECT<' || string_agg(name || ': ' || kind, ', ' ORDER BY name) || '>' AS schema
FROM (
  SELECT DISTINCT class_name, name,
    CASE json_type(body, name) WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT'
         WHEN 'ARRAY' THEN 'ARRAY<STRING>' END AS kind
  FROM (SELECT class_name, body, unnest(json_keys(body)) AS name
        FROM (SELECT class_name, to_json({'id': id, 'type': a.type, 'created': created, 'operation': operation,
                'status': status, 'size': length(operation), 'tags': tags}) AS body
              FROM audit a JOIN classes c ON c.type = a.type)))
GROUP BY class_name""",
    "lake_roundtrip": _LANDED,
    "file_routes": _AC
    + """SELECT CASE class_name WHEN 'account_change' THEN 'ext_identity-acct-chng'
  WHEN 'authentication' THEN 'ext_identity-auth' ELSE 'ext_identity-sched-job' END AS route,
  CAST(count(*) AS BIGINT) AS n_events
FROM audit a JOIN classes c ON c.type = a.type GROUP BY ALL""",
    "one_scan_roundtrip": _LANDED,
    "table_to_lake": _LANDED,
    "route_classes": _ALL
    + f"""SELECT class_name, location, location || '/region=' || region || '/accountId=' || "accountId"
  || '/eventDay=' || "eventDay" AS path, CAST(count(*) AS BIGINT) AS n_events
FROM (SELECT class_name, CASE class_name WHEN 'account_change' THEN 'ext/identity-acct-chng'
        WHEN 'authentication' THEN 'ext/identity-auth'
        WHEN 'scheduled_job_activity' THEN 'ext/identity-sched-job' END AS location, {_LAKE_KEYS}
      FROM records)
GROUP BY ALL""",
    "terms_table": _with(_AUDIT, _TERMS)
    + """SELECT t.type, t.term, t.caption, CAST(count(a.id) AS BIGINT) AS n_events
FROM terms t LEFT JOIN audit a ON a.type = t.type AND a.operation = t.term GROUP BY ALL""",
    "enum_table": _with(_AUDIT, _CLASSES, _TERMS, _ENUMS, _CAPTIONED)
    + """SELECT e.object, e.attribute, e.caption, '(''' || e.object || ''', ''' || e.attribute || ''')' AS key,
  CAST(e.id AS INTEGER) AS id, CAST(count(u.id) AS BIGINT) AS n_events
FROM enums e LEFT JOIN (SELECT c.class_name, a.caption, a.id FROM captioned a JOIN classes c ON c.type = a.type) u
  ON u.class_name = e.object AND e.attribute = 'activity_id' AND u.caption = e.caption
GROUP BY ALL""",
    "mapping_rules": _ACR + "SELECT r.*, c.n_events FROM rules r JOIN counts c ON c.type = r.type",
    # filters and predicates
    "incremental_range": _A + f"SELECT id, type, created FROM audit WHERE {_READY}",
    "type_membership": _AC + f"SELECT id, type, created FROM audit WHERE type IN {_MAPPED}",
    "drop_unmapped": _AC + f"SELECT id, type FROM audit WHERE type IN {_MAPPED}",
    "cond_in_string": _A
    + """SELECT id, contains(coalesce(actor_name, 'System'), 'user_1') AS in_actor,
  contains(source_name, 'source') AS lower_in_source, contains(operation, 'E') AS in_operation FROM audit""",
    "cond_not_in": _A
    + """SELECT id, NOT contains(coalesce(actor_name, 'System'), 'user_1') AS not_in_actor,
  NOT list_contains(tags, 't1') AS not_in_tags, NOT contains(operation, 'A') AS not_in_operation FROM audit""",
    "cond_in_list": _A
    + """SELECT id, list_contains(tags, 't1') AS has_t1, list_contains(tags, 't') AS has_t,
  list_contains(tags, 'view') AS has_view FROM audit""",
    "cond_in_object": """SELECT event_id AS id, list_contains(json_keys(props), 'k') AS map_has_k,
  list_contains(json_keys(props), 'j') AS map_has_j, list_contains(json_keys(props), 'k') AS variant_has_k,
  event_type = 'view' AS mixed_has_view,
  user_id % 3 = 1 AND contains(event_type, 'vi') AS mixed_has_vi,
  user_id % 7 <> 0 AS struct_has_name
FROM events""",
    "cond_system_default": """SELECT event_id AS id,
  user_id % 3 <> 1 OR contains(event_type, 'System') AS system_in_word,
  CASE WHEN user_id % 4 = 0 THEN TRUE END AS system_in_number,
  CASE WHEN user_id % 2 <> 0 THEN TRUE END AS system_in_flag,
  user_id % 2 = 0 OR event_type = 'System' AS system_in_items,
  user_id % 2 = 0 OR event_type = 'System' AS system_in_entries,
  TRUE AS system_in_missing,
  NOT (user_id % 3 <> 1 OR contains(event_type, 'Sys')) AS sys_not_in_word
FROM events""",
    "null_gate": _AC
    + f"SELECT id, coalesce(actor_name, 'nobody') AS who, 'kept' AS never FROM audit WHERE type IN {_MAPPED}",
    "blank_targets": _ACR
    + """SELECT r.type, r.source, r.term, c.n_events FROM rules r JOIN counts c ON c.type = r.type
WHERE regexp_full_match(r.target, '\\s*')""",
    "prune_key": """SELECT event_id AS id,
  CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 2 END AS INTEGER) AS n_entries,
  CASE WHEN event_type <> 'click' THEN event_type END AS entry_kind,
  TRUE AS keeps_null_entry,
  CASE WHEN event_type <> 'click' THEN event_type || ',' ELSE '' END || '-,kept' AS items,
  CASE WHEN event_type <> 'click' THEN '{"kind":"' || event_type || '","user_id":' || user_id || '}'
       ELSE '{"user_id":' || user_id || '}' END AS object,
  CASE WHEN event_type <> 'click' THEN '[{"kind":"' || event_type || '"}]' ELSE '[{}]' END AS objects
FROM events""",
    "empty_guard": _with(_AUDIT, _CLASSES, _TYPE_COUNTS) + "SELECT type, n_events, n_events = 0 AS is_empty FROM counts",
    "https_only": "SELECT page_id, url FROM pages WHERE lower(url) LIKE 'https:%'",
    # projections and record shaping
    "nested_get": """SELECT event_id AS id, user_id AS struct_user, CAST(NULL AS VARCHAR) AS below_text,
  event_type AS variant_b, user_id AS dotted_key, CAST(NULL AS VARCHAR) AS below_scalar,
  CAST(json_extract(props, '$.k') AS INTEGER) AS variant_k
FROM events""",
    "nested_set": _A
    + """SELECT id, actor_name AS user_name, tags[1] AS user_tag, source_name AS source,
  '{"name":"' || actor_name || '"}' AS gap FROM audit""",
    "wrap_raw": _AC
    + f"""SELECT id, type, created, operation, status, actor_name, source_name,
  array_to_string(tags, ',') AS tags FROM audit WHERE type IN {_MAPPED}""",
    "static_values": _AC
    + """SELECT a.id, c.class_name, '1.1' AS version, 'It''s "Audit" ${user.name}' AS product,
  CAST(1 AS INTEGER) AS severity_id, TRUE AS ok FROM audit a JOIN classes c ON c.type = a.type""",
    "field_mapping": _AC
    + f"""SELECT id, operation AS activity, source_name AS src_name, CAST(NULL AS VARCHAR) AS src_literal
FROM audit WHERE type IN {_MAPPED}""",
    "first_match_source": _AC
    + f"""SELECT id, CASE WHEN contains(coalesce(actor_name, 'System'), 'user_1') THEN NULL
  WHEN contains(coalesce(actor_name, 'System'), 'user_') THEN actor_name
  WHEN NOT list_contains(tags, 't2') THEN source_name END AS picked
FROM audit WHERE type IN {_MAPPED}""",
    "fan_out": _with(_AUDIT, _CLASSES, _TERMS)
    + """SELECT a.id, CASE WHEN actor_name IS NOT NULL THEN coalesce(u.caption, 'Other') END AS user_type,
  CASE WHEN actor_name IS NOT NULL THEN coalesce(p.caption, 'Other') END AS user_outcome,
  actor_name AS copy_one, actor_name AS copy_two
FROM audit a JOIN classes c ON c.type = a.type
LEFT JOIN terms u ON u.type = a.type AND u.term = 'USER'
LEFT JOIN terms p ON p.type = a.type AND p.term = 'PASSED'""",
    "last_write_wins": _AC
    + f"""SELECT id, coalesce(actor_name, CASE WHEN contains(operation, 'E') THEN operation END, 'static') AS label,
  coalesce(actor_name, status) AS other
FROM audit WHERE type IN {_MAPPED}""",
    "event_day": _A + "SELECT id, strftime(created_at, '%Y%m%d') AS \"eventDay\" FROM audit",
    "tenant_columns": "SELECT CAST(event_id AS VARCHAR) AS id, 'eu-west-1' AS region,"
    " '012345678901' AS \"accountId\" FROM events",
    "transform_events": _ALL + "SELECT * FROM records",
    "unlike_types": _with(_AUDIT, _CLASSES, _TERMS)
    + """SELECT a.id, c.class_name,
  CASE a.type WHEN 'AUTH' THEN operation WHEN 'SYSTEM_CONFIG' THEN 'Job ' || coalesce(t.caption, 'Other')
    WHEN 'ACCESS_ITEM' THEN CASE WHEN list_contains(tags, 't1') THEN status END END AS label,
  CASE a.type WHEN 'AUTH' THEN 'seen' WHEN 'ACCESS_ITEM' THEN 'item' WHEN 'USER_MANAGEMENT' THEN created END AS note,
  CASE a.type WHEN 'SYSTEM_CONFIG' THEN '7' WHEN 'USER_MANAGEMENT' THEN actor_name END AS level
FROM audit a JOIN classes c ON c.type = a.type
LEFT JOIN terms t ON t.type = a.type AND t.term = a.operation
WHERE a.type IN ('AUTH', 'SYSTEM_CONFIG', 'ACCESS_ITEM', 'USER_MANAGEMENT')""",
    "rule_defaults": _ACR
    + """SELECT coalesce(output_type, 'norm_string') AS output_type, coalesce(concat_string, '') AS concat_string,
  CAST(count(*) AS BIGINT) AS n_rules, CAST(sum(n_events) AS BIGINT) AS n_applications
FROM rules r JOIN counts c ON c.type = r.type WHERE transform = 'normalize' GROUP BY ALL""",
    # lookups
    "normalize_term": _with(_AUDIT, _TERMS, _CAPTIONED) + "SELECT id, type, operation, caption FROM captioned",
    "normalize_prefix": _with(_AUDIT, _TERMS, _CAPTIONED) + "SELECT id, 'Job ' || caption AS prefixed FROM captioned",
    "enum_id": _with(_AUDIT, _CLASSES, _ENUMS)
    + """SELECT u.id, u.class_name, u.attribute, u.caption, CAST(coalesce(e.id, 0) AS INTEGER) AS enum_id
FROM (
  SELECT a.id, c.class_name, CASE WHEN a.type = 'AUTH' THEN 'actor.user.type_id' ELSE 'activity_id' END AS attribute,
    CASE WHEN a.type = 'AUTH' THEN 'Actor ' ELSE '' END || operation[1] || lower(operation[2:]) AS caption
  FROM audit a JOIN classes c ON c.type = a.type
) u
LEFT JOIN enums e ON e.caption = u.caption
  AND e.object = CASE WHEN u.attribute = 'activity_id' THEN u.class_name ELSE 'user' END
  AND e.attribute = CASE WHEN u.attribute = 'activity_id' THEN 'activity_id' ELSE 'type_id' END""",
    "type_dispatch": _AC + "SELECT a.id, a.type, c.class_name FROM audit a JOIN classes c ON c.type = a.type",
    "normalize_to_id": _ALL
    + """SELECT id, CASE WHEN type = 'SYSTEM_CONFIG' THEN 'Job ' ELSE '' END || status AS caption, status_id
FROM records""",
    # aggregations
    "events_per_class": _AC
    + """SELECT class_name, CAST(count(*) AS BIGINT) AS n_events
FROM audit a JOIN classes c ON c.type = a.type GROUP BY class_name""",
    "run_metrics": _AC
    + """SELECT CAST(count(*) AS BIGINT) AS received, CAST(count(class_name) AS BIGINT) AS transformed,
  CAST(count(*) FILTER (class_name = 'account_change') AS BIGINT) AS account_change,
  CAST(count(*) FILTER (class_name = 'authentication') AS BIGINT) AS authentication,
  CAST(count(*) FILTER (class_name = 'scheduled_job_activity') AS BIGINT) AS scheduled_job_activity
FROM audit a LEFT JOIN classes c ON c.type = a.type""",
    "next_checkpoint": _A + f"SELECT max(created) AS next_checkpoint FROM audit WHERE {_READY}",
    "total_and_caught_up": _AC
    + f"""SELECT CAST(count(*) AS BIGINT) AS total, count(*) < 10000 AS caught_up
FROM audit WHERE {_READY} AND type IN {_MAPPED}""",
    "lookup_coverage": _with(_AUDIT, _TERMS, _CAPTIONED)
    + """SELECT type, hit, CAST(count(*) AS BIGINT) AS n_events, CAST(count(DISTINCT operation) AS BIGINT) AS n_terms
FROM captioned GROUP BY type, hit""",
    # sorts, limits, sets
    "sorted_events": _A + "SELECT id, type, created FROM audit ORDER BY created, id",
    "page": _A + "SELECT id, type, created FROM audit ORDER BY created, id LIMIT 1000 OFFSET 250",
    "deep_page": _A + "SELECT id, type, created FROM audit ORDER BY created, id LIMIT 300 OFFSET 600",
    "page_after": _A
    + "SELECT id, type, created FROM audit WHERE created >= '2024-01-15T00:00:00.000Z' ORDER BY created, id LIMIT 500",
    "append_pages": _A
    + """SELECT id, type, created FROM audit WHERE created < '2024-01-20T00:00:00.000Z'
UNION ALL SELECT id, type, created FROM audit WHERE created > '2024-01-10T00:00:00.000Z'""",
    # scalar functions
    "to_epoch": _A
    + """SELECT id,
  CAST(CASE event_id % 6 WHEN 0 THEN s WHEN 1 THEN s WHEN 2 THEN s - 7200 END AS BIGINT) AS epoch,
  CAST(CASE WHEN event_id % 6 < 3 THEN s END AS BIGINT) AS wall_epoch
FROM (SELECT id, event_id, epoch_us(created_at) // 1000000 AS s FROM audit)""",
    "epoch_all_fields": _A
    + """SELECT id, s AS time, s AS span_at, operation AS span_op, s AS span_deep_at,
  created AS history_at, created AS data_time
FROM (SELECT *, CAST(epoch_us(created_at) // 1000000 AS BIGINT) AS s FROM audit)""",
    "path_parts": """SELECT page_id, CAST(len(p) AS INTEGER) AS n_parts, p[-2] AS parent, p[-1] AS leaf,
  q[-2] AS comma_parent, q[-1] AS comma_leaf
FROM (SELECT page_id, string_split(url, '.') AS p, string_split(url, ',') AS q FROM pages)""",
    "parse_conditions": _A
    + """SELECT id, CASE event_id % 4 WHEN 0 THEN operation WHEN 1 THEN operation WHEN 2 THEN operation || ' in x' END AS value,
  CASE event_id % 4 WHEN 0 THEN 'attributes.tags' WHEN 1 THEN 'attributes.sourceName'
    WHEN 2 THEN 'actor.name' END AS path,
  CASE event_id % 4 WHEN 0 THEN FALSE WHEN 1 THEN TRUE WHEN 2 THEN TRUE END AS negated
FROM audit""",
    "iso_format": _A + "SELECT id, strftime(created_at - INTERVAL 60 MINUTE, '%Y-%m-%dT%H:%M:%S.%gZ') AS lagged FROM audit",
    "older_than_day": _A
    + """SELECT id, days, days > 0 AS older
FROM (SELECT id, CAST(floor((epoch_us(TIMESTAMP '2024-01-20 12:00:00') - epoch_us(created_at)) / 86400000000.0) AS BIGINT) AS days
      FROM audit)""",
    "escape_literal": _A + "SELECT id, regexp_replace(created, '([-.:])', '\\\\\\1', 'g') AS escaped FROM audit",
    "type_clause": _AC
    + f"""SELECT string_agg('type:' || type, ' OR ' ORDER BY type) AS clause
FROM (SELECT DISTINCT type FROM audit WHERE type IN {_MAPPED})""",
    # streaming and incremental
    "stream_ingest": _LANDED,
    "stream_commit": _ALL
    + f"""SELECT class_name, "eventDay", CAST(count(*) AS BIGINT) AS n_events
FROM (SELECT class_name, {_LAKE_KEYS} FROM records) GROUP BY ALL""",
    "batch_ingest": _LANDED + f" WHERE {_SETTLED}",
    "batch_replay": _ALL
    + f"""SELECT class_name, "eventDay", CAST(count(*) AS BIGINT) AS n_events
FROM (SELECT class_name, {_LAKE_KEYS} FROM records WHERE {_SETTLED}) GROUP BY ALL""",
    "table_ingest": _LANDED + f" WHERE {_SETTLED}",
    "late_files": _ALL
    + f"""SELECT id, class_name, "eventDay" FROM (SELECT id, class_name, {_LAKE_KEYS} FROM records
  WHERE CAST(id AS BIGINT) % 10 <> 0 AND {_SETTLED})
UNION ALL SELECT id, 'event has no type', NULL FROM audit, (VALUES (0), (1)) WHERE CAST(id AS BIGINT) % 10 = 0""",
    "bounded_run": _ALL
    + f"""SELECT id || '-' || copy AS id, class_name, {_LAKE_KEYS.split('AS "accountId",')[1]}
FROM (SELECT *, substr(created, 1, 14) || '00:00.000Z' AS hour FROM records), range(4) t(copy)
WHERE hour <= (SELECT coalesce(min(hour) FILTER (n >= 12000), max(hour)) FROM (
  SELECT hour, sum(count(*)) OVER (ORDER BY hour) AS n FROM (
    SELECT substr(created, 1, 14) || '00:00.000Z' AS hour FROM audit a JOIN classes c ON c.type = a.type, range(4)
    WHERE hour < '2024-01-30T23:00:00.000Z') GROUP BY hour))""",
    "safety_lag": _A + "SELECT id, created FROM audit WHERE created < '2024-01-20T11:00:00.000Z'",
    "clamp_checkpoint": """SELECT user_id, saved,
  CASE WHEN saved IS NULL OR epoch_us(TIMESTAMP '2024-01-30 11:00:00') - epoch_us(created_at) >= 86400000000
       THEN '2024-01-30T11:00:00.000Z' ELSE saved END AS position
FROM (SELECT user_id, CASE WHEN user_id % 11 <> 0 THEN strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%gZ') END AS saved,
        date_trunc('milliseconds', max(ts)) AS created_at FROM events GROUP BY user_id)""",
    # open bodies
    "prune_open": """SELECT event_id AS id, '{"a":{"at":"' || day || '","deep":' || CASE WHEN event_type = 'click' THEN '{}' ELSE '{"at":"' || event_type || '"}' END
  || CASE WHEN event_type = 'click' THEN '' ELSE ',"kind":"' || event_type || '"' END
  || ',"list":[' || CASE WHEN event_type = 'click' THEN '' ELSE '"' || event_type || '",' END || '{"size":' || user_id || '},[1.5]]},"data":{"time":"' || day
  || '"},"empty":{},"id":' || event_id || CASE WHEN event_type = 'click' THEN '' ELSE ',"kind":"' || event_type || '"' END
  || ',"n":null,"ok":true,"time":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') || '"}' AS body
FROM (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events)""",
    "epoch_open": """SELECT event_id AS id, CAST(epoch_us(date_trunc('milliseconds', ts)) // 1000000 AS BIGINT) AS time,
  CAST(epoch_us(date_trunc('day', ts)) // 1000000 AS BIGINT) AS a_at, event_type AS deep_at, strftime(ts, '%Y-%m-%d') AS data_time,
  '["' || event_type || '","click",{"click":2,"size":' || user_id || '},["click",1.5]]' AS list, 'BIGINT' AS time_kind
FROM events""",
    "schema_paths": """WITH e AS (SELECT event_type AS class_name, * FROM events),
total AS (SELECT class_name, count(*) AS n_all FROM e GROUP BY class_name),
found AS (
  SELECT class_name, path, type, count(*) AS n FROM (
    SELECT class_name, unnest([
      {'path': '', 'type': 'OBJECT'}, {'path': 'type', 'type': 'STRING'},
      {'path': 'size', 'type': CASE WHEN event_id % 3 = 0 THEN 'STRING' ELSE 'BIGINT' END},
      {'path': CASE WHEN event_id % 4 < 2 THEN 'note' END, 'type': CASE WHEN event_id % 4 = 0 THEN 'VOID' ELSE 'STRING' END},
      {'path': 'tags', 'type': 'ARRAY'}, {'path': 'tags[]', 'type': 'STRING'}, {'path': 'tags[]', 'type': 'ARRAY'},
      {'path': 'tags[][]', 'type': 'STRING'}, {'path': 'tags[][]', 'type': 'BIGINT'},
      {'path': 'by_user', 'type': 'OBJECT'}, {'path': 'by_user.*', 'type': 'OBJECT'}, {'path': 'by_user.*.seen', 'type': 'BOOLEAN'},
      {'path': '[''a.b'']', 'type': 'OBJECT'}], recursive := true) FROM e)
  WHERE path IS NOT NULL GROUP BY ALL
)
SELECT class_name, path, type, CAST(n AS BIGINT) AS n, CAST(CASE WHEN is_key THEN n_all END AS BIGINT) AS n_objects,
  CASE WHEN is_key THEN sum(n) OVER (PARTITION BY class_name, path) < n_all END AS optional,
  count(*) FILTER (type <> 'VOID') OVER (PARTITION BY class_name, path) > 1 AS conflict
FROM (SELECT *, path <> '' AND NOT ends_with(path, '[]') AND NOT ends_with(path, '*') AS is_key FROM found) JOIN total USING (class_name)""",
    "landed_open": _A
    + """SELECT id, list_contains(tags, 't1') AS has_t1, actor_name FROM audit
WHERE contains(coalesce(actor_name, 'System'), 'user_1') OR contains(operation, 'E')""",
    "bucketed_lookup": _with(_AUDIT, _TERMS, _CAPTIONED) + "SELECT id, type, operation, caption, hit FROM captioned",
    # catalog, hooks, history
    "catalog_lake": _LANDED,
    "hooked_transform": _with(_AUDIT, _CLASSES, _TERMS)
    + """SELECT a.id, c.class_name, actor_name[1:5] || repeat('*', length(actor_name) - 5) AS who,
  CAST(length(operation) * 10 AS INTEGER) AS load, coalesce(t.caption, 'Other') AS label
FROM audit a JOIN classes c ON c.type = a.type LEFT JOIN terms t ON t.type = a.type AND t.term = a.operation""",
    "run_history": _with(_AUDIT, _CLASSES, _TERMS, f"ready AS (SELECT * FROM audit WHERE {_SETTLED} AND type IN {_MAPPED})")
    + """SELECT source, type, hit, CAST(count(*) AS BIGINT) AS n_events, CAST(count(DISTINCT term) AS BIGINT) AS n_terms,
  CAST(3 AS BIGINT) AS n_runs, CAST(any_value(n_written) AS BIGINT) AS n_written
FROM (
  SELECT u.*, t.term IS NOT NULL AS hit
  FROM (SELECT 'operation' AS source, type, operation AS term FROM ready UNION ALL SELECT 'status', type, status FROM ready) u
  LEFT JOIN terms t ON t.type = u.type AND t.term = u.term
), (SELECT count(*) AS n_written FROM ready) GROUP BY source, type, hit""",
    "compacted_lake": _ALL
    + """SELECT class_name, day AS "eventDay", CAST(count(*) AS BIGINT) AS n_events,
  CAST(CASE WHEN max(day) < '20240125' THEN 1 ELSE count(DISTINCT CAST(id AS BIGINT) % 3) END AS BIGINT) AS n_leaves
FROM (SELECT class_name, id, substr(created, 1, 4) || substr(created, 6, 2) || substr(created, 9, 2) AS day FROM records) GROUP BY class_name, day""",
    "replay_dedup": _AC
    + """SELECT CASE WHEN event_id % 50 <> 0 THEN a.id END AS id, class_name, created
FROM audit a JOIN classes c ON c.type = a.type,
  range(CASE WHEN event_id % 50 = 0 AND event_id % 4 < 3 AND user_id % 3 = 0 THEN 2 ELSE 1 END)""",
}
