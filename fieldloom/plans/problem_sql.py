"""SQL for the queries p1 to p5: written for DuckDB, with its own ways to the same results."""

_INV = r"[\x{ad}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{2064}\x{feff}]"
_WS = r"[\s\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{85}\x{b}]"


def _code(c: str) -> str:
    path = f"regexp_replace({c}, '(?s)[?#].*$', '')"
    plain = f"lower(regexp_replace(regexp_replace(url_decode(replace({path}, '+', '%2B')), '{_INV}', '', 'g'), '{_WS}+', '', 'g'))"
    return f"nullif(regexp_extract({plain}, '(?s)^.*-([a-z0-9]{{10}})(\\.[a-z0-9]{{1,5}})?(/.*)?$', 1), '')"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


def _unfold(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '^[ \\t\\r\\n]*[\\[{{]') AND json_valid({text}) THEN {text}::JSON END"


_NODES = f"""
WITH RECURSIVE t AS (
  SELECT item_id, '' AS parent_path, '' AS node_path, '' AS shape, '' AS dewey, '' AS parent_dewey, raw_json::JSON AS v, raw_json::JSON AS own FROM airport_items WHERE json_valid(raw_json)
  UNION ALL
  SELECT item_id, parent_path, node_path, shape, dewey, parent_dewey, CASE WHEN json_type(w) = 'VARCHAR' THEN {_unfold("(w ->> '$')")} ELSE w END AS v, w AS own
  FROM (
    SELECT t.item_id, CASE WHEN json_type(t.v) = 'OBJECT' THEN t.node_path ELSE t.parent_path END AS parent_path,
      CASE WHEN t.node_path = '' THEN e.key ELSE t.node_path || '/' || e.key END AS node_path,
      CASE WHEN json_type(t.v) = 'ARRAY' THEN t.shape || '[]' WHEN t.shape = '' THEN replace(e.key, '/', '~1') ELSE t.shape || '/' || replace(e.key, '/', '~1') END AS shape,
      CASE WHEN t.dewey = '' THEN '' ELSE t.dewey || '.' END || CASE WHEN json_type(t.v) = 'OBJECT' THEN (list_position(json_keys(t.v), e.key) - 1)::VARCHAR ELSE e.key END AS dewey,
      CASE WHEN json_type(t.v) = 'OBJECT' THEN t.dewey ELSE t.parent_dewey END AS parent_dewey,
      e.value AS w
    FROM t, json_each(t.v) e WHERE json_type(t.v) IN ('OBJECT', 'ARRAY')
  )
)"""


def _key(c: str) -> str:
    return f"replace(replace(trim(regexp_replace(regexp_replace(upper({c}), '{_INV}', '', 'g'), '{_WS}+', ' ', 'g')), ' AND ', ' & '), ' ', '')"


_SHARES = f"""
WITH names AS (
  SELECT DISTINCT {_key('n')} AS k, country AS name FROM (SELECT country, country AS n FROM country_ref UNION ALL SELECT country, unnest(also_known) FROM country_ref)
), r AS (
  SELECT l.*, name FROM link_rows l LEFT JOIN names ON k = {_key('l.country')}
)"""

_CLASS = f"""
WITH u AS (
  SELECT detail_id, load_no, column_name, v,
    CASE WHEN v IS NULL OR {_strip('v')} IN ('', 'N/A') THEN 'missing'
      WHEN column_name = 'airport_light_intensity' AND v IN ('NO LIGHT', 'LOW', 'MEDIUM', 'HIGH', 'LOW-HIGH', 'PILOT CONTROLLED') THEN '=' || v
      WHEN column_name = 'customs' AND v IN ('Yes', 'No', 'On Request', 'Prior Notice') THEN '=' || v
      WHEN column_name = 'icao' AND regexp_full_match(v, '[A-Z][A-Z][A-Z][A-Z]') THEN '=' || v
      ELSE 'invalid' END AS kind
  FROM (
    SELECT detail_id, load_no, 'airport_light_intensity' AS column_name, airport_light_intensity AS v FROM detail_rows
    UNION ALL SELECT detail_id, load_no, 'customs', customs FROM detail_rows
    UNION ALL SELECT detail_id, load_no, 'icao', icao FROM detail_rows
  )
)"""

_TEXTS = "airport_link airport_name city country icao iata airport_light_intensity customs airport_of_entry slots_required open_24_hours facility_use distance_from_city variation elevation_ft".split()


def _profile(c: str) -> str:
    """Ranges are those of the column's own type: numbers compare as numbers, times as times."""
    text = f"CAST({c} AS VARCHAR)"
    shown = f"strftime({{}}({c}), '%Y-%m-%d %H:%M:%S')" if c == "loaded_at" else f"CAST({{}}({c}) AS VARCHAR)"
    missing = f"{c} IS NULL OR {_strip(text)} IN ('', 'N/A')"
    return f"""SELECT '{c}' AS column_name, load_no, count(*)::BIGINT AS n_rows, (count(*) FILTER ({missing}))::BIGINT AS n_missing,
  count(DISTINCT {c})::BIGINT AS n_distinct, {shown.format('min')} AS low, {shown.format('max')} AS high FROM detail_rows GROUP BY load_no"""


def _plain(c: str) -> str:
    """Whether a field isn't itself the text of an object or list, which would be a row of its own."""
    return f"NOT (json_type(v -> '$.{c}') = 'VARCHAR' AND regexp_matches(v ->> '$.{c}', '^[ \\t\\r\\n]*[\\[{{]') AND json_valid(v ->> '$.{c}'))"


_SCALAR = "(v IS NULL OR json_type(v) NOT IN ('OBJECT', 'ARRAY'))"
_FIELDS = f"""{_NODES}, f AS (SELECT item_id, parent_dewey AS dewey, regexp_replace(shape, '/?[^/]*$', '') AS schema_path, CASE WHEN parent_path = '' THEN node_path ELSE substr(node_path, length(parent_path) + 2) END AS field_name,
  CASE WHEN json_type(own) <> 'NULL' THEN own ->> '$' END AS value FROM t WHERE node_path <> '' AND shape NOT LIKE '%[]' AND {_SCALAR})"""

SQL = {
    "p1_parents": f"""{_NODES} SELECT shape AS schema_path, count(*)::BIGINT AS n_rows, count(DISTINCT item_id)::BIGINT AS n_records, count(DISTINCT
  CASE WHEN dewey <> '' THEN item_id || ':' || parent_dewey END)::BIGINT AS n_parents FROM t WHERE json_type(v) = 'OBJECT'
  GROUP BY shape""",
    "p1_values": f"""{_NODES} SELECT item_id, dewey, parent_dewey, shape AS schema_path, CASE WHEN json_type(own) <> 'NULL'
  THEN own ->> '$' END AS value FROM t WHERE shape LIKE '%[]' AND {_SCALAR}""",
    "p1_fields": f"{_FIELDS} SELECT * FROM f",
    "p1_columns": f"""{_FIELDS} SELECT schema_path, field_name, CASE WHEN count(value) > 0 AND bool_and(regexp_full_match(value, '-?(0|[1-9][0-9]{{0,17}})')) THEN 'bigint'
  WHEN count(value) > 0 AND bool_and(regexp_full_match(value, '-?(0|[1-9][0-9]*)([.][0-9]+)?([eE][+-]?[0-9]+)?')) THEN 'double' WHEN count(value) > 0 AND bool_and(value IN ('true', 'false')) THEN 'boolean' ELSE 'string' END AS type,
  count(*)::BIGINT AS n_rows, count(value)::BIGINT AS n_values FROM f GROUP BY schema_path, field_name""",
    "p1_groups": f"""{_NODES} SELECT item_id, dewey, parent_dewey, v ->> '$.Group' AS group_name FROM t
  WHERE json_type(v) = 'OBJECT' AND shape = 'Additional Airport Details[]'""",
    "p1_found": f"{_NODES} SELECT item_id, parent_path, node_path FROM t WHERE node_path <> '' AND json_type(v) = 'OBJECT'",
    "p1_tables": f"""{_NODES} SELECT shape AS schema_path, count(*)::BIGINT AS n_rows, count(DISTINCT item_id)::BIGINT AS n_records FROM t
  WHERE json_type(v) = 'OBJECT' GROUP BY shape""",
    "p1_details": f"""{_NODES} SELECT item_id, dewey, parent_dewey, {", ".join(f"CASE WHEN json_type(v -> '$.{c}') NOT IN ('OBJECT', 'ARRAY') AND {_plain(c)} THEN v ->> '$.{c}' END AS {c.lower()}" for c in ("Name", "City", "Country", "Link", "ICAO", "IATA"))}
FROM t WHERE json_type(v) = 'OBJECT' AND shape = 'Airport Details'""",
    "p1_entries": f"""{_NODES} SELECT item_id, dewey, parent_dewey, v ->> '$.Key' AS entry_key, CASE WHEN json_type(v -> '$.Value') NOT IN ('OBJECT', 'ARRAY') AND {_plain('Value')} THEN v ->> '$.Value' END AS entry_value
FROM t WHERE json_type(v) = 'OBJECT' AND shape = 'Additional Airport Details[]/Entries[]'""",
    "p3_found": f"""
WITH r AS (
  SELECT 'link_rows' AS table_name, row_id AS id, {_code('airport_link')} AS code FROM link_rows
  UNION ALL
  SELECT 'airport_items', item_id, (
    SELECT arg_min(code, ord) FROM (
      SELECT {_code("(e.value ->> '$')")} AS code, row_number() OVER () AS ord FROM json_each(CASE WHEN json_type(raw_json, '$."Airport Details"') = 'VARCHAR' THEN (raw_json ->> '$."Airport Details"')::JSON ELSE raw_json -> '$."Airport Details"' END) e
      WHERE json_type(e.value) = 'VARCHAR' AND (e.value ->> '$') LIKE '%/%' AND NOT regexp_matches({_strip("(e.value ->> '$')")}, '{_WS}')) WHERE code IS NOT NULL)
  FROM airport_items
), c AS (SELECT table_name, code, min(id) AS first_id FROM r WHERE code IS NOT NULL GROUP BY ALL),
w AS (SELECT table_name, code, first_id, unnest(list_transform(range(1, 11), lambda i: left(code, i - 1) || '?' || substr(code, i + 1))) AS open_place FROM c),
g AS (SELECT table_name, open_place, min(first_id) AS first_id FROM w GROUP BY ALL),
k AS (SELECT w.table_name, w.code, min(g.first_id) AS first_id FROM w JOIN g ON w.table_name = g.table_name AND w.open_place = g.open_place GROUP BY ALL)
SELECT r.table_name, k.first_id, r.id AS later_id FROM r JOIN k ON r.table_name = k.table_name AND r.code = k.code WHERE r.id > k.first_id""",
    "p4_found": f"""{_SHARES}, t AS (SELECT batch_no, count(*) AS total FROM r GROUP BY batch_no) SELECT r.batch_no, name AS country FROM r
  JOIN t ON r.batch_no = t.batch_no WHERE name IS NOT NULL GROUP BY r.batch_no, name, total HAVING count(*) * 20 >= total""",
    "p4_counts": f"""{_SHARES}, t AS (SELECT batch_no, count(*) AS total FROM r GROUP BY batch_no) SELECT r.batch_no, name AS country,
  count(*)::BIGINT AS n_rows, total::BIGINT AS batch_rows FROM r JOIN t ON r.batch_no = t.batch_no GROUP BY r.batch_no, name, total""",
    "p4_summary": f"""{_SHARES} SELECT name AS country, count(*)::BIGINT AS n_rows, min(harvested_at) AS first_at, max(harvested_at) AS last_at,
  (count(*) FILTER (airport_link IS NULL OR regexp_full_match(airport_link, ' *')))::BIGINT AS no_link FROM r GROUP BY name""",
    "p5_found": f"""{_CLASS},
s AS (SELECT column_name, load_no, kind, count(*) AS n FROM u GROUP BY ALL),
t AS (SELECT column_name, load_no, sum(n) AS total FROM s GROUP BY ALL),
p AS (SELECT t.column_name, t.load_no, k.kind, coalesce(s.n, 0) / total AS share FROM t JOIN (SELECT DISTINCT column_name, kind FROM s) k ON t.column_name = k.column_name LEFT JOIN s ON s.column_name = t.column_name AND s.load_no = t.load_no AND s.kind = k.kind)
SELECT 'cell' AS case_kind, column_name, load_no, detail_id FROM u WHERE kind = 'invalid'
UNION ALL
SELECT DISTINCT 'shift', a.column_name, a.load_no, 0 FROM p a JOIN p b ON a.column_name = b.column_name AND a.kind = b.kind AND a.load_no = b.load_no + 1 WHERE round(abs(a.share - b.share), 12) > 0.15""",
    "p5_profile": " UNION ALL ".join(_profile(c) for c in [*_TEXTS, "detail_id", "loaded_at"]),
}
