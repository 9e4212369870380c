"""Queries of the general problems 4 and 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kodeks.operators import nested
from kodeks.operators.history import act_change_history
from kodeks.session import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return act_change_history(table(spark, sf_dir, "act_changes")).select("eli", "eli_annotation", "valid_from", "valid_to")


def p4_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return act_change_history(table(spark, sf_dir, "act_changes"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.reference_positions(table(spark, sf_dir, "act_references"))


def p7_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.reference_tables(table(spark, sf_dir, "act_references"))[0]


def p7_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.reference_tables(table(spark, sf_dir, "act_references"))[1]


def p7_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.rejects(table(spark, sf_dir, "act_references"), "record_id", "call_result")


QUERIES = {f.__name__: f for f in (p4_found, p4_history, p7_found, p7_references, p7_texts, p7_rejects)}

# The same history in plain SQL: windows over whole tables instead of a merge.
_NORMAL = """
WITH raw AS (SELECT regexp_replace(upper(regexp_replace(eli, '[\\s\\p{Z}\\p{Cf}]+', '', 'g')), '/0+([0-9])', '/\\1', 'g') AS eli,
  regexp_replace(upper(regexp_replace(eli_annotation, '[\\s\\p{Z}\\p{Cf}]+', '', 'g')), '/0+([0-9])', '/\\1', 'g') AS eli_annotation,
  snapshot_date AS snap, loaded_at, change_row_id,
  lower(trim(regexp_replace(type_of_change, '[\\s\\p{Z}]+', ' ', 'g'))) AS t, lower(trim(regexp_replace(date_of_change_annotation, '[\\s\\p{Z}]+', ' ', 'g'))) AS d
  FROM act_changes),
clean AS (SELECT eli, eli_annotation, snap, loaded_at, change_row_id,
  CASE WHEN t IN ('', '-', 'brak', 'b.d.', 'n/d') OR NOT regexp_matches(t, '\\p{L}') THEN NULL ELSE t END AS t,
  CASE WHEN regexp_matches(d, '^[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}') THEN replace(substr(d, 1, 10), '/', '-')
    WHEN regexp_matches(d, '^[0-9]{2}[.][0-9]{2}[.][0-9]{4}') THEN substr(d, 7, 4) || '-' || substr(d, 4, 2) || '-' || substr(d, 1, 2)
    WHEN regexp_matches(d, '^[0-9]+ [^ ]+ [0-9]{4}') THEN split_part(d, ' ', 3) || '-' || lpad(CAST(list_position(['stycznia', 'lutego', 'marca', 'kwietnia', 'maja', 'czerwca', 'lipca', 'sierpnia', 'września', 'października', 'listopada', 'grudnia'], split_part(d, ' ', 2)) AS VARCHAR), 2, '0') || '-' || lpad(split_part(d, ' ', 1), 2, '0')
    END AS d FROM raw WHERE eli <> '' AND eli_annotation <> '' AND snap IS NOT NULL),
one AS (SELECT eli, eli_annotation, snap, t, CAST(try_cast(d AS DATE) AS VARCHAR) AS d FROM clean QUALIFY row_number() OVER (PARTITION BY eli, eli_annotation, snap ORDER BY loaded_at DESC, change_row_id DESC) = 1),
snaps AS (SELECT snap, row_number() OVER (ORDER BY snap) AS n, coalesce(lead(snap) OVER (ORDER BY snap), '') AS nxt FROM (SELECT DISTINCT snap FROM one)),
filled AS (SELECT eli, eli_annotation, snap, n, nxt, last_value(t IGNORE NULLS) OVER w AS t, last_value(d IGNORE NULLS) OVER w AS d
  FROM one JOIN snaps USING (snap) WINDOW w AS (PARTITION BY eli, eli_annotation ORDER BY n ROWS UNBOUNDED PRECEDING)),
marked AS (SELECT *, CASE WHEN lag(n) OVER w = n - 1 AND lag(t) OVER w IS NOT DISTINCT FROM t AND lag(d) OVER w IS NOT DISTINCT FROM d THEN 0 ELSE 1 END AS b
  FROM filled WINDOW w AS (PARTITION BY eli, eli_annotation ORDER BY n)),
grouped AS (SELECT *, sum(b) OVER (PARTITION BY eli, eli_annotation ORDER BY n ROWS UNBOUNDED PRECEDING) AS g FROM marked)
"""
# The bodies in SQL: decoded, unwrapped, and their arrays and single objects laid out.
BODIES = """
WITH raw AS (SELECT DISTINCT record_id, eli, call_result AS b FROM act_references WHERE record_id IS NOT NULL AND call_result IS NOT NULL AND json_valid(call_result)),
decoded AS (SELECT record_id, eli, CASE WHEN json_type(b) = 'VARCHAR' THEN json_extract_string(b, '$') ELSE b END AS b FROM raw),
body AS (SELECT DISTINCT record_id, eli, CASE WHEN json_type(b, '$.references') = 'OBJECT' THEN CAST(json_extract(b, '$.references') AS VARCHAR) ELSE b END AS b FROM decoded WHERE json_valid(b) AND json_type(b) = 'OBJECT'),
rel AS (SELECT record_id, eli, relation, json_extract(b, '$."' || relation || '"') AS v FROM (SELECT *, unnest(json_keys(b)) AS relation FROM body)),
refs AS (SELECT record_id, eli, relation, CAST(i AS INTEGER) AS ref_pos, r FROM (SELECT record_id, eli, relation, unnest(range(CAST(json_array_length(v) AS BIGINT))) AS i, unnest(json_extract(v, '$[*]')) AS r FROM rel WHERE json_type(v) = 'ARRAY'
  UNION ALL SELECT record_id, eli, relation, 0, v FROM rel WHERE json_type(v) = 'OBJECT') WHERE json_type(r) = 'OBJECT'),
held AS (SELECT *, json_extract(r, '$.act.texts') AS t FROM refs),
texts AS (SELECT record_id, eli, relation, ref_pos, CAST(i AS INTEGER) AS text_pos, x FROM (SELECT record_id, eli, relation, ref_pos, unnest(range(CAST(json_array_length(t) AS BIGINT))) AS i, unnest(json_extract(t, '$[*]')) AS x FROM held WHERE json_type(t) = 'ARRAY'
  UNION ALL SELECT record_id, eli, relation, ref_pos, 0, t FROM held WHERE json_type(t) = 'OBJECT') WHERE json_type(x) = 'OBJECT')
"""
_ART = "CASE json_type(r, '$.art') WHEN 'ARRAY' THEN '[' || coalesce(array_to_string(list_transform(json_extract(r, '$.art[*]'), lambda x: CAST(x AS VARCHAR)), ', '), '') || ']' ELSE json_extract_string(r, '$.art') END"
SQL = {
    "p7_found": BODIES + "SELECT record_id, relation, ref_pos, CAST(-1 AS INTEGER) AS text_pos FROM refs UNION SELECT record_id, relation, ref_pos, text_pos FROM texts",
    "p7_references": BODIES + f"SELECT DISTINCT record_id, eli, relation, ref_pos, json_extract_string(r, '$.date') AS date, {_ART} AS art, json_extract_string(r, '$.act.ELI') AS act_eli, json_extract_string(r, '$.act.type') AS act_type, json_extract_string(r, '$.act.title') AS act_title, json_extract_string(r, '$.act.promulgation') AS promulgation, json_extract_string(r, '$.act.announcementDate') AS announcement_date FROM refs",
    "p7_texts": BODIES + "SELECT DISTINCT record_id, eli, relation, ref_pos, text_pos, json_extract_string(x, '$.type') AS text_type, json_extract_string(x, '$.fileName') AS file_name FROM texts",
    "p7_rejects": "SELECT DISTINCT record_id, CASE WHEN call_result IS NULL THEN 'null' WHEN NOT json_valid(call_result) THEN 'not_json' ELSE 'no_object' END AS reason FROM act_references WHERE call_result IS NULL OR NOT json_valid(call_result) OR json_type(call_result) NOT IN ('OBJECT', 'VARCHAR')",
    "p4_found": _NORMAL + "SELECT eli, eli_annotation, min(snap) AS valid_from, arg_max(nxt, n) AS valid_to FROM grouped GROUP BY eli, eli_annotation, g",
    "p4_history": _NORMAL + "SELECT eli, eli_annotation, min(snap) AS valid_from, arg_max(nxt, n) AS valid_to, any_value(t) AS type_of_change, any_value(d) AS date_of_change_annotation FROM grouped GROUP BY eli, eli_annotation, g",
}
