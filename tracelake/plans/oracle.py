"""SQL twins of the registered queries, in DuckDB's dialect.

Written against the base tables, independently of the Spark plans: a prelude
of CTEs states the derived log in flat form, each query the operator's rule.
"""

from __future__ import annotations

# Flat relations of the derived log: one per kind of message.
PRELUDE = """
WITH ev AS (
  SELECT event_id, user_id, event_type, value, props, user_id % 16 AS k,
         epoch_us(ts) * 1000 AS time_ns, event_id * 10 + 10000 AS seq,
         '00000000-0000-7000-8000-' || lpad(CAST(user_id % 16 AS VARCHAR), 12, '0') AS segment_id,
         'src' || CAST(user_id % 4 AS VARCHAR) AS source_name
  FROM events
), seg AS (
  SELECT k, segment_id, source_name, min(time_ns) AS lo, max(time_ns) AS hi
  FROM ev GROUP BY k, segment_id, source_name
), starts AS (
  SELECT k AS seq, segment_id, source_name, lo AS time_ns FROM seg WHERE k % 8 <> 5
  UNION ALL
  SELECT 100 + k, segment_id, source_name || 'b', lo - 1000000000 FROM seg WHERE k % 4 = 0
  UNION ALL
  SELECT 200 + k, segment_id, 'src0c', lo + 7 FROM seg WHERE k = 8
), ends AS (
  SELECT 1000000000 + k AS seq, segment_id, source_name, hi AS time_ns FROM seg WHERE k % 8 <> 7
  UNION ALL
  SELECT 1000000100 + k, segment_id, source_name, hi - 5000000000 FROM seg WHERE k % 5 = 0
), type_no(event_name, no) AS (
  VALUES ('click', 0), ('error', 1), ('purchase', 2), ('signup', 3), ('view', 4)
), schemas AS (
  SELECT DISTINCT 300 + 5 * k + no AS seq, segment_id, source_name, event_name, 1 AS form
  FROM ev JOIN type_no ON event_type = event_name
  WHERE NOT (k = 13 AND event_type = 'signup')
  UNION ALL
  SELECT 400 + k, segment_id, source_name, 'view', 2 FROM seg WHERE k % 2 = 0
), form_fields(form, field_pos, field_name, data_type, unit) AS (
  VALUES (1, 0, 'value', 'float64', 'USD'), (1, 1, 'user_id', 'int64', NULL),
         (1, 2, 'state', 'uint8', NULL), (2, 0, 'value', 'float32', 'EUR')
), named AS (
  SELECT 250 + k AS seq, segment_id, source_name, 'error' AS event_name, 'state' AS field_name,
         0 AS pos, 'uint8' AS tag, '9' AS key, 'LOST' AS label FROM seg
  UNION ALL
  SELECT base + k, segment_id, source_name, event_name, 'state', key, 'uint8',
         CAST(key AS VARCHAR), label
  FROM seg, (VALUES (500, 'error'), (520, 'view')) b(base, event_name),
       (VALUES (0, 'IDLE'), (1, 'INIT'), (2, 'RUNNING'), (3, 'ERROR')) s(key, label)
  UNION ALL
  SELECT 600 + k, segment_id, source_name, 'error', 'state', pos, 'uint8', '3', label
  FROM seg, (VALUES (0, 'FAULT'), (1, 'FAILED')) s(pos, label) WHERE k % 3 = 0
  UNION ALL
  SELECT seq, segment_id, source_name, event_name, field_name, 0, tag, key, label
  FROM seg JOIN (VALUES (4, 620, 'view', 'state', 'string', 'x', 'TEXT'),
                        (2, 640, 'view', 'nope', 'uint8', '0', 'Z'),
                        (6, 660, 'click', 'value', 'string', 'a', 'A'))
       o(k, seq, event_name, field_name, tag, key, label) USING (k)
), envelopes AS (
  SELECT seq, segment_id, source_name, 'segment_start' AS kind, time_ns, NULL AS name,
         CAST(NULL AS BIGINT) AS items FROM starts
  UNION ALL
  SELECT seq, segment_id, source_name, 'segment_end', time_ns, NULL, NULL FROM ends
  UNION ALL
  SELECT seq, segment_id, source_name, 'event_schema', NULL, event_name,
         CASE form WHEN 1 THEN 3 ELSE 1 END FROM schemas
  UNION ALL
  SELECT seq, segment_id, source_name, 'named_values', NULL, event_name, count(*)
  FROM named GROUP BY seq, segment_id, source_name, event_name
  UNION ALL
  SELECT seq, segment_id, source_name, 'event', time_ns, event_type,
         CASE event_type WHEN 'purchase' THEN 4 ELSE 3 END FROM ev
), samples AS (
  SELECT seq, segment_id, source_name, time_ns, event_type AS message, 'value' AS signal,
         'float64' AS tag, CAST(value AS VARCHAR) AS key, value AS f, CAST(NULL AS BIGINT) AS i
  FROM ev
  UNION ALL
  SELECT seq, segment_id, source_name, time_ns, event_type, 'user_id', 'int64',
         CAST(user_id AS VARCHAR), NULL, user_id FROM ev
  UNION ALL
  SELECT seq, segment_id, source_name, time_ns, event_type, 'state',
         CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN 'int16' ELSE 'uint8' END,
         CAST(event_id % 4 AS VARCHAR), NULL, event_id % 4 FROM ev
  UNION ALL
  SELECT seq, segment_id, source_name, time_ns, event_type, 'k', 'int64',
         json_extract_string(props, '$.k'), NULL,
         CAST(json_extract_string(props, '$.k') AS BIGINT) FROM ev WHERE event_type = 'purchase'
), sample_text AS (
  SELECT *, regexp_replace(key, '\\.0$', '') AS shown FROM samples
), control AS (
  SELECT * FROM envelopes WHERE kind <> 'event'
), cat_segments AS (
  SELECT c.segment_id,
         coalesce((SELECT arg_max(s.source_name, s.seq) FROM starts s
                   WHERE s.segment_id = c.segment_id),
                  arg_min(c.source_name, c.seq)) AS source,
         (SELECT min(s.time_ns) FROM starts s WHERE s.segment_id = c.segment_id) AS start_time_ns,
         (SELECT arg_max(e.time_ns, e.seq) FROM ends e
          WHERE e.segment_id = c.segment_id) AS end_time_ns
  FROM control c GROUP BY c.segment_id
), cat_schemas AS (
  SELECT segment_id, event_name, min(seq) AS schema_seq, arg_min(form, seq) AS form
  FROM schemas GROUP BY segment_id, event_name
), cat_fields AS (
  SELECT * FROM cat_schemas JOIN form_fields USING (form)
), cat_values AS (
  SELECT n.segment_id, n.event_name, n.field_name, n.tag, n.key, f.field_pos,
         max(n.seq) AS seq, arg_max(n.label, n.seq * 100 + n.pos) AS label
  FROM named n JOIN cat_fields f USING (segment_id, event_name, field_name)
  WHERE n.seq > f.schema_seq
  GROUP BY n.segment_id, n.event_name, n.field_name, n.tag, n.key, f.field_pos
), cat_signals AS (
  SELECT f.segment_id, s.source, f.event_name AS message, f.field_name AS signal, f.data_type,
         f.unit, f.field_pos,
         CAST(count(v.key) > 0 AS BIGINT) AS has_value_table,
         count(DISTINCT CASE WHEN v.tag = 'uint8' THEN v.key END) AS n_values,
         f.segment_id || '/' || s.source || '/' || f.event_name AS table_key
  FROM cat_fields f JOIN cat_segments s USING (segment_id)
  LEFT JOIN cat_values v USING (segment_id, event_name, field_name)
  GROUP BY f.segment_id, s.source, f.event_name, f.field_name, f.data_type, f.unit, f.field_pos
)
"""

_SIGNALS = """
SELECT table_key || '.' || signal AS key_string,
       '"' || segment_id || '"."' || source || '/' || message || '"' AS table_name,
       table_key, source, message, signal, data_type, unit, has_value_table, n_values
FROM cat_signals
"""

_UUID = (
    "'^([0-9a-fA-F]{32}|(\\{|urn:uuid:)?[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\\}?)$'"
)


def _hyphenated(text: str) -> str:
    bare = f"lower(regexp_replace(regexp_replace({text}, '^urn:uuid:', ''), '[{{}}-]', '', 'g'))"
    cuts = ", ".join(f"substr({bare}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"concat_ws('-', {cuts})"


def _filter_parts(source: str) -> str:
    """Parsed parts of column ``filter`` of a relation, rule by rule."""
    return f"""
  cut AS (
    SELECT *, instr(filter, '/') AS a,
           instr(substr(filter, instr(filter, '/') + 1), '/') AS b
    FROM {source}
  ), part AS (
    SELECT *, substr(filter, 1, a - 1) AS p1, substr(filter, a + 1, b - 1) AS p2,
           substr(filter, a + b + 1) AS p3
    FROM cut
  ), parsed AS (
    SELECT * EXCLUDE (a, b, p1, p2, p3),
      CASE WHEN filter IS NULL THEN NULL
           WHEN a = 0 OR b = 0 THEN 'missing_separator'
           WHEN p1 <> '*' AND NOT regexp_matches(p1, {_UUID}) THEN 'invalid_uuid' END AS error,
      CASE WHEN p1 <> '*' THEN {_hyphenated('p1')} END AS s1,
      CASE WHEN p2 <> '*' THEN p2 END AS s2,
      CASE WHEN p3 <> '*' THEN p3 END AS s3
    FROM part
  ), filter_parts AS (
    SELECT * EXCLUDE (s1, s2, s3),
      CASE WHEN error IS NULL THEN s1 END AS f_segment,
      CASE WHEN error IS NULL THEN s2 END AS f_source,
      CASE WHEN error IS NULL THEN s3 END AS f_event
    FROM parsed
  )"""


_MATCH = """
  (f_segment IS NULL OR f_segment = e.segment_id)
  AND (f_source IS NULL OR f_source = e.source_name)
  AND (f_event IS NULL OR (e.kind = 'event' AND f_event = e.name))
"""

_KEYS = """
, key_base AS (
  SELECT event_id,
    CASE event_id % 3 WHEN 0 THEN '*' WHEN 1 THEN segment_id
         ELSE upper(replace(segment_id, '-', '')) END AS seg,
    source_name || '/' || event_type || '.' ||
      CASE event_id % 4 WHEN 0 THEN 'value' WHEN 1 THEN 'user_id' WHEN 2 THEN 'state'
                        ELSE 'no.such' END AS rest,
    source_name, event_type,
    CASE event_id % 4 WHEN 0 THEN 'value' WHEN 1 THEN 'user_id' WHEN 2 THEN 'state'
                      ELSE 'no.such' END AS signal
  FROM ev
), key_parts AS (
  SELECT event_id,
    CASE WHEN event_id % 11 = 0 THEN 'not_a_key'
         WHEN event_id % 13 = 0 THEN 'not_a_key'
         WHEN event_id % 17 = 0 THEN 'not_a_key'
         WHEN event_id % 19 = 0 THEN 'invalid_uuid' END AS error,
    CASE event_id % 3 WHEN 0 THEN NULL ELSE segment_id END AS segment_id,
    key_base.source_name AS source, key_base.event_type AS message, signal
  FROM key_base JOIN ev USING (event_id)
), key_table AS (
  SELECT event_id, error,
    CASE WHEN error IS NULL THEN segment_id END AS segment_id,
    CASE WHEN error IS NULL THEN source END AS source,
    CASE WHEN error IS NULL THEN message END AS message,
    CASE WHEN error IS NULL THEN signal END AS signal
  FROM key_parts
)
"""

_SNAPSHOT = """
, snap AS (
  SELECT (SELECT max(s.seq) FROM starts s WHERE s.segment_id = c.segment_id) AS seq, segment_id,
         source AS source_name, 'segment_start' AS kind, 0 AS phase, '' AS event_name,
         -1 AS field_pos, start_time_ns AS time_ns, CAST(NULL AS VARCHAR) AS content
  FROM cat_segments c WHERE start_time_ns IS NOT NULL
  UNION ALL
  SELECT (SELECT max(s.seq) FROM ends s WHERE s.segment_id = c.segment_id), segment_id, source,
         'segment_end', 2, '', -1, end_time_ns, NULL
  FROM cat_segments c WHERE end_time_ns IS NOT NULL
  UNION ALL
  SELECT f.schema_seq, f.segment_id, s.source, 'event_schema', 1, f.event_name, -1, NULL,
         string_agg(concat_ws(':', f.field_name, f.data_type, f.unit), ',' ORDER BY f.field_pos)
  FROM cat_fields f JOIN cat_segments s USING (segment_id)
  GROUP BY f.schema_seq, f.segment_id, s.source, f.event_name
  UNION ALL
  SELECT max(v.seq), v.segment_id, s.source, 'named_values', 1, v.event_name, v.field_pos, NULL,
         string_agg(concat_ws(':', v.tag, v.key, v.label), ','
                    ORDER BY concat_ws(':', v.tag, v.key, v.label))
  FROM cat_values v JOIN cat_segments s USING (segment_id)
  GROUP BY v.segment_id, s.source, v.event_name, v.field_pos
)
"""

_LATE = """
, past AS (SELECT * FROM envelopes WHERE seq <= 60000 AND kind <> 'event'),
late_seg AS (
  SELECT p.segment_id,
    coalesce((SELECT arg_max(s.source_name, s.seq) FROM starts s
              WHERE s.segment_id = p.segment_id), arg_min(p.source_name, p.seq)) AS source
  FROM past p GROUP BY p.segment_id
)
SELECT 0 AS part, sn.seq, sn.segment_id, sn.source_name, sn.kind,
       CASE WHEN sn.event_name = '' THEN NULL ELSE sn.event_name END AS name, sn.time_ns
FROM snap sn JOIN late_seg USING (segment_id) WHERE sn.kind <> 'segment_end'
UNION ALL
SELECT 1, seq, segment_id, source_name, kind, name, time_ns
FROM envelopes WHERE seq > 60000 AND kind = 'event' AND name = 'error'
"""

_WIRE = """
, wire AS (
  SELECT event_id, source_name AS stream_id, (event_id // 100) * 4 + k % 4 AS batch_no,
         row_number() OVER (PARTITION BY source_name, event_id // 100 ORDER BY event_id) - 1 AS pos,
         segment_id, source_name, time_ns, event_type,
         CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 'event_schema'
              ELSE 'event' END AS kind,
         CASE WHEN event_id % 29 = 0 THEN 'int8' WHEN event_id % 31 = 0 THEN 'uint8'
              WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN 'uint16'
              WHEN event_id % 43 = 0 THEN 'uint32' ELSE 'uint8' END AS tag,
         CASE WHEN event_id % 29 = 0 THEN 300 WHEN event_id % 31 = 0 THEN NULL
              WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN 65535
              WHEN event_id % 43 = 0 THEN 4294967296 ELSE event_id % 4 END AS num
  FROM ev
), wire_checked AS (
  SELECT *, row_number() OVER (ORDER BY batch_no, stream_id, pos) - 1 AS wseq,
    CASE WHEN event_id % 47 = 0 THEN 'invalid_uuid'
         WHEN kind IS NULL THEN 'missing_message'
         WHEN kind = 'event_schema' AND event_id % 2 <> 0 THEN 'missing_data_type'
         WHEN kind = 'event' AND (tag IS NULL OR num IS NULL) THEN 'missing_value'
         WHEN kind = 'event' AND (num > CASE tag WHEN 'int8' THEN 127 WHEN 'uint8' THEN 255
              WHEN 'uint16' THEN 65535 ELSE 4294967295 END) THEN 'truncation' END AS error
  FROM wire
)
"""

_JSON = """
, lex(no, lexeme, kind, txt) AS (
  VALUES (0, '300', 'number', '300'), (1, '-1', 'number', '-1'), (2, '1.5', 'number', '1.5'),
         (3, '1e300', 'number', '1.0E300'), (4, 'true', 'bool', 'true'), (5, 'null', 'null', NULL),
         (6, '"AQID"', 'string', 'AQID'), (7, '"text"', 'string', 'text'), (8, '"1"', 'string', '1'),
         (9, '[1,2]', 'array', '[1,2]'),
         (10, '18446744073709551615', 'number', '18446744073709551615'),
         (11, '1.0', 'number', '1.0')
), types(no, data_type, low, high) AS (
  VALUES (0, 'int8', -128::HUGEINT, 127::HUGEINT), (1, 'int16', -32768, 32767),
         (2, 'int32', -2147483648, 2147483647),
         (3, 'int64', -9223372036854775808, 9223372036854775807),
         (4, 'uint8', 0, 255), (5, 'uint16', 0, 65535), (6, 'uint32', 0, 4294967295),
         (7, 'uint64', 0, 18446744073709551615), (8, 'float32', NULL, NULL),
         (9, 'float64', NULL, NULL),
         (10, 'timestamp[ns]', -9223372036854775808, 9223372036854775807),
         (11, 'binary', NULL, NULL), (12, 'string', NULL, NULL), (13, 'bool', NULL, NULL)
), json_cells AS (
  SELECT e.event_id, t.data_type, t.low, t.high,
    coalesce(l.kind, 'number') AS kind,
    CASE WHEN l.no IS NOT NULL THEN l.txt
         WHEN e.event_id % 15 = 12 THEN CAST(e.value AS VARCHAR)
         WHEN e.event_id % 15 = 13 THEN CAST(e.user_id AS VARCHAR)
         ELSE json_extract_string(e.props, '$.k') END AS txt
  FROM ev e JOIN types t ON t.no = e.event_id % 14 LEFT JOIN lex l ON l.no = e.event_id % 15
), json_typed AS (
  SELECT *,
    CASE WHEN data_type IN ('string', 'binary') THEN kind = 'string'
         WHEN data_type = 'bool' THEN kind = 'bool' ELSE kind = 'number' END AS fits,
    CASE WHEN regexp_matches(txt, '^-?[0-9]+$') THEN TRY_CAST(txt AS HUGEINT) END AS whole
  FROM json_cells
)
"""


def _with(*parts: str) -> str:
    return PRELUDE + "".join(parts)


ORACLE = {
    "segments_fold": _with(
        "SELECT segment_id, source, start_time_ns, end_time_ns FROM cat_segments"
    ),
    "segments_fold_from": _with("""
SELECT segment_id,
  coalesce(arg_max(source_name, seq) FILTER (WHERE kind = 'segment_start'),
           arg_min(source_name, seq)) AS source,
  min(time_ns) FILTER (WHERE kind = 'segment_start') AS start_time_ns,
  arg_max(time_ns, seq) FILTER (WHERE kind = 'segment_end') AS end_time_ns,
  min(seq) AS first_seq
FROM envelopes GROUP BY segment_id
"""),
    "remove_segment": _with("""
, kept AS (
  SELECT e.* FROM envelopes e JOIN seg USING (segment_id)
  WHERE seg.k % 3 <> 0 OR e.seq > 450
)
SELECT segment_id,
  coalesce(arg_max(source_name, seq) FILTER (WHERE kind = 'segment_start'),
           arg_min(source_name, seq)) AS source,
  min(time_ns) FILTER (WHERE kind = 'segment_start') AS start_time_ns,
  arg_max(time_ns, seq) FILTER (WHERE kind = 'segment_end') AS end_time_ns,
  count(DISTINCT name) FILTER (WHERE kind = 'event_schema') AS n_schemas
FROM kept WHERE kind <> 'event' GROUP BY segment_id
"""),
    "schemas_first_wins": _with("""
SELECT segment_id, event_name, schema_seq, CAST(field_pos AS BIGINT) AS field_pos, field_name,
       data_type, unit
FROM cat_fields
"""),
    "duplicate_schemas": _with("""
SELECT s.seq, s.segment_id, s.event_name, c.schema_seq
FROM schemas s JOIN cat_schemas c USING (segment_id, event_name) WHERE s.seq > c.schema_seq
"""),
    "value_tables": _with(
        "SELECT segment_id, event_name, field_name, tag, key, label FROM cat_values"
    ),
    "signals": _with(_SIGNALS),
    "snapshot_rows": _with(_SNAPSHOT, """
SELECT seq, segment_id, source_name, kind, CAST(phase AS BIGINT) AS phase, event_name,
       CAST(field_pos AS BIGINT) AS field_pos, time_ns, content FROM snap
"""),
    "snapshot_refold": _with(_SIGNALS),
    "signal_key_parse": _with(_KEYS, """
SELECT event_id, segment_id, source, message, signal, error FROM key_table
"""),
    "signal_lookup": _with(_KEYS, """
SELECT k.event_id, s.table_key || '.' || s.signal AS key_string, s.data_type, s.unit
FROM key_table k JOIN cat_signals s
  ON k.source = s.source AND k.message = s.message AND k.signal = s.signal
 AND (k.segment_id IS NULL OR k.segment_id = s.segment_id)
WHERE k.error IS NULL
"""),
    "signal_json": _with("""
SELECT s.segment_id AS data_segment_id, s.source, s.message, s.signal,
  '{"data_segment_id":"' || s.segment_id || '","source":"' || s.source || '","message":"'
  || s.message || '","signal":"' || s.signal || '","data_type":"' || s.data_type || '"'
  || CASE WHEN s.unit IS NULL THEN '' ELSE ',"unit":"' || s.unit || '"' END
  || CASE WHEN s.has_value_table = 0 THEN '' ELSE ',"value_table":{' || coalesce(
       (SELECT string_agg('"' || v.key || '":"' || v.label || '"', ',' ORDER BY v.key)
        FROM cat_values v WHERE v.segment_id = s.segment_id AND v.event_name = s.message
          AND v.field_name = s.signal AND v.tag = 'uint8'), '') || '}' END
  || '}' AS json
FROM cat_signals s
"""),
    "filter_parse": _with("""
, texts AS (
  SELECT event_id,
    CASE event_id % 5 WHEN 0 THEN '*' WHEN 1 THEN segment_id WHEN 2 THEN '{' || segment_id || '}'
         WHEN 3 THEN 'urn:uuid:' || upper(segment_id)
         ELSE replace(segment_id, '-', '') END AS p1,
    CASE event_id % 3 WHEN 0 THEN '*' WHEN 1 THEN source_name ELSE '' END AS p2,
    CASE event_id % 4 WHEN 0 THEN '*' WHEN 1 THEN event_type || '/x' ELSE event_type END AS p3,
    user_id
  FROM ev
), base AS (
  SELECT event_id,
    CASE WHEN event_id % 7 = 0 THEN p1 || '/' || p2
         WHEN event_id % 11 = 0 THEN CAST(user_id AS VARCHAR) || '/' || p2 || '/' || p3
         WHEN event_id % 13 = 0 THEN NULL
         ELSE p1 || '/' || p2 || '/' || p3 END AS filter
  FROM texts
),""", _filter_parts("base"), """
SELECT event_id, f_segment AS segment_id, f_source AS source_name, f_event AS event_name, error
FROM filter_parts
"""),
    "filter_route": _with("""
, seen AS (SELECT DISTINCT segment_id, source_name, event_type FROM ev), wanted AS (
  SELECT 'all' AS subscriber_id, CAST(NULL AS VARCHAR) AS f_segment,
         CAST(NULL AS VARCHAR) AS f_source, CAST(NULL AS VARCHAR) AS f_event
  UNION ALL SELECT DISTINCT 'source', NULL, source_name, NULL FROM seen
  UNION ALL SELECT DISTINCT 'segment', segment_id, NULL, NULL FROM seen
  UNION ALL SELECT DISTINCT 'segment_source', segment_id, source_name, NULL FROM seen
  UNION ALL SELECT DISTINCT 'event', NULL, NULL, event_type FROM seen
  UNION ALL SELECT DISTINCT 'event', NULL, NULL, event_type FROM seen
  UNION ALL SELECT DISTINCT 'source_event', NULL, source_name, event_type FROM seen
  UNION ALL SELECT DISTINCT 'segment_event', segment_id, NULL, event_type FROM seen
  UNION ALL SELECT DISTINCT 'exact', segment_id, source_name, event_type FROM seen
)
SELECT w.subscriber_id, e.segment_id, e.kind, count(*) AS copies,
       CAST(sum(e.seq) AS BIGINT) AS sum_seq
FROM envelopes e JOIN wanted w ON""", _MATCH, "GROUP BY w.subscriber_id, e.segment_id, e.kind"),
    "subscription_intervals": _with("""
, base AS (
  SELECT CAST(user_id AS VARCHAR) AS subscriber_id, seq,
    CASE WHEN event_type IN ('error', 'purchase') THEN 'unsubscribe' ELSE 'subscribe' END AS action,
    CASE event_id % 6 WHEN 0 THEN '*/*/*' WHEN 1 THEN NULL WHEN 2 THEN '*/src1/*'
      WHEN 3 THEN '*/*/' || event_type WHEN 4 THEN upper(segment_id) || '/src1/click'
      ELSE 'src1/click' END AS filter
  FROM ev
),""", _filter_parts("base"), """
, ended AS (
  SELECT *, min(CASE WHEN action = 'unsubscribe' THEN seq END) OVER (
    PARTITION BY subscriber_id, f_segment, f_source, f_event ORDER BY seq
    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS end_seq
  FROM filter_parts WHERE error IS NULL
)
SELECT subscriber_id, seq AS sub_seq, end_seq, f_segment AS segment_id, f_source AS source_name,
       f_event AS event_name
FROM ended WHERE action = 'subscribe'
"""),
    "subscription_route": _with("""
, wanted(subscriber_id, sub_seq, end_seq, f_segment, f_source, f_event) AS (
  VALUES ('A', 20000, NULL, NULL::VARCHAR, 'src1', 'click'),
         ('B', 30000, 60000, NULL, 'src1', NULL), ('C', 50000, NULL, NULL, NULL, NULL)
)
SELECT w.subscriber_id, e.segment_id, e.kind, count(*) AS copies,
       CAST(sum(e.seq) AS BIGINT) AS sum_seq
FROM envelopes e JOIN wanted w ON""", _MATCH, """
  AND e.seq > w.sub_seq AND (w.end_seq IS NULL OR e.seq < w.end_seq)
GROUP BY w.subscriber_id, e.segment_id, e.kind
"""),
    "subscription_bursts": _with("""
, marks AS (
  SELECT CAST(user_id AS VARCHAR) AS subscriber_id, segment_id AS f_segment, event_type AS f_event,
    event_id * 10 + 10001 AS seq, TRUE AS on_ FROM ev
  UNION ALL
  SELECT CAST(user_id AS VARCHAR), segment_id, event_type, event_id * 10 + 10705, FALSE FROM ev
), ended AS (
  SELECT *, min(CASE WHEN NOT on_ THEN seq END) OVER (
    PARTITION BY subscriber_id, f_segment, f_event ORDER BY seq
    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS end_seq
  FROM marks
), wanted AS (
  SELECT subscriber_id, seq AS sub_seq, end_seq, f_segment, NULL::VARCHAR AS f_source, f_event
  FROM ended WHERE on_
  UNION ALL SELECT 'late', 1000000000, NULL, NULL, NULL, NULL
)
SELECT w.subscriber_id, e.segment_id, e.kind, count(*) AS copies,
       CAST(sum(e.seq) AS BIGINT) AS sum_seq
FROM envelopes e JOIN wanted w ON""", _MATCH, """
  AND e.seq > w.sub_seq AND (w.end_seq IS NULL OR e.seq < w.end_seq)
GROUP BY w.subscriber_id, e.segment_id, e.kind
"""),
    "replay_from": _with("""
SELECT segment_id, kind, count(*) AS messages, CAST(sum(seq) AS BIGINT) AS sum_seq
FROM envelopes WHERE kind <> 'event' OR time_ns >= 1705276800000000000
GROUP BY segment_id, kind
"""),
    "late_subscriber": _with(_SNAPSHOT, _LATE),
    "latest_values": _with("""
SELECT segment_id || '/' || source_name || '/' || message || '.' || signal AS full_name, message,
       signal, max(time_ns) AS time_ns, arg_max(shown, (time_ns, seq)) AS value
FROM sample_text GROUP BY segment_id, source_name, message, signal
"""),
    "decoded_states": _with("""
SELECT s.seq, s.segment_id, s.message, s.tag, s.key, v.label
FROM samples s LEFT JOIN cat_values v
  ON v.segment_id = s.segment_id AND v.event_name = s.message AND v.field_name = s.signal
 AND v.tag = s.tag AND v.key = s.key
WHERE s.signal = 'state'
"""),
    "wide_event": _with("""
SELECT seq, segment_id, source_name AS source, time_ns, value, user_id,
       CASE WHEN event_id % 10 <> 0 THEN event_id % 4 END AS state
FROM ev WHERE event_type = 'error'
"""),
    "wide_tables": _with("""
, typed AS (
  SELECT t.seq, t.signal, t.f, t.i FROM samples t JOIN cat_fields c
    ON c.segment_id = t.segment_id AND c.event_name = t.message
   AND c.field_name = t.signal AND c.data_type = t.tag
)
SELECT ev.seq, ev.segment_id, source_name AS source, ev.time_ns, event_type AS message,
       max(t.f) FILTER (t.signal = 'value') AS value,
       max(t.i) FILTER (t.signal = 'user_id') AS user_id,
       max(t.i) FILTER (t.signal = 'state') AS state
FROM ev JOIN cat_schemas c ON c.segment_id = ev.segment_id AND c.event_name = event_type
LEFT JOIN typed t ON t.seq = ev.seq
GROUP BY ALL
"""),
    "signal_samples": _with("""
, wanted(segment_id, source, message, signal) AS (
  VALUES (NULL, 'src1', 'click', 'value'), (NULL, 'src2', 'error', 'state'),
         ('00000000-0000-7000-8000-000000000003', 'src3', 'view', 'user_id'),
         (NULL, 'src1', 'click', 'value'), (NULL, 'src0b', 'purchase', 'value')
), found AS (
  SELECT s.* FROM cat_signals s JOIN wanted w
    ON w.source = s.source AND w.message = s.message AND w.signal = s.signal
   AND (w.segment_id IS NULL OR w.segment_id = s.segment_id)
)
SELECT t.seq, f.table_key || '.' || f.signal AS key_string, t.time_ns, f.data_type,
       t.shown AS value
FROM sample_text t JOIN found f
  ON f.segment_id = t.segment_id AND f.message = t.message AND f.signal = t.signal
"""),
    "conformance": _with("""
, judged AS (
  SELECT s.seq, s.message AS event_name,
    CASE WHEN c.event_name IS NULL THEN 'event_not_found'
         WHEN f.data_type IS NULL THEN 'field_not_found'
         WHEN f.data_type <> s.tag THEN 'type_mismatch' END AS code,
    CASE WHEN c.event_name IS NOT NULL THEN s.signal END AS field,
    f.data_type AS expected,
    CASE WHEN c.event_name IS NOT NULL THEN s.tag END AS found
  FROM samples s
  LEFT JOIN cat_schemas c ON c.segment_id = s.segment_id AND c.event_name = s.message
  LEFT JOIN cat_fields f ON f.segment_id = s.segment_id AND f.event_name = s.message
    AND f.field_name = s.signal
), problems AS (
  SELECT DISTINCT seq, event_name, field, code, expected, found FROM judged WHERE code IS NOT NULL
)
SELECT event_name, field, code, expected, found, count(*) AS n,
       CAST(sum(seq) AS BIGINT) AS sum_seq
FROM problems GROUP BY event_name, field, code, expected, found
"""),
    "conforming_events": _with("""
SELECT seq, segment_id, event_type AS event_name FROM ev
WHERE event_type <> 'purchase' AND NOT (event_type = 'error' AND event_id % 10 = 0)
  AND NOT (k = 13 AND event_type = 'signup')
"""),
    "unregistered_events": _with("""
SELECT seq, segment_id, event_type AS event_name FROM ev e
WHERE NOT EXISTS (SELECT 1 FROM schemas s
                  WHERE s.segment_id = e.segment_id AND s.event_name = e.event_type)
"""),
    "schema_field_dedupe": _with("""
, defs AS (
  SELECT event_id, 0 AS ordinal, 'value' AS name, 'float64' AS data_type, 'USD' AS unit FROM ev
  UNION ALL SELECT event_id, 1, event_type, 'int64', NULL FROM ev
  UNION ALL SELECT event_id, 2, 'click', 'uint8', source_name FROM ev
  UNION ALL SELECT event_id, 3, CASE WHEN event_id % 3 = 0 THEN 'value' ELSE 'other' END,
                   'float32', source_name FROM ev
), kept AS (
  SELECT * FROM defs QUALIFY ordinal = max(ordinal) OVER (PARTITION BY event_id, name)
)
SELECT event_id, row_number() OVER (PARTITION BY event_id ORDER BY ordinal) - 1 AS pos, name,
       data_type, unit
FROM kept
"""),
    "wire_validity": _with(_WIRE, """
SELECT stream_id, batch_no, pos, wseq AS seq, kind, error FROM wire_checked
"""),
    "ingest_batches": _with(_WIRE, """
SELECT wseq AS seq, segment_id, source_name, kind,
       CASE WHEN kind = 'event' THEN time_ns END AS time_ns, event_type AS name,
       CASE WHEN kind = 'event' THEN tag END AS state_tag,
       CASE WHEN kind = 'event' THEN CAST(num AS VARCHAR) END AS state
FROM wire_checked WHERE error IS NULL
"""),
    "publish_status": _with(_WIRE, """
SELECT stream_id, count(*) AS total_messages,
       count(*) FILTER (WHERE error IS NULL) AS successful_messages, count(error) AS failed_messages,
       coalesce(arg_max(error, wseq) FILTER (WHERE error IS NOT NULL), '') AS last_error
FROM wire_checked GROUP BY stream_id
"""),
    "undecodable_status": _with(_WIRE, """
, lines AS (
  SELECT stream_id, batch_no, pos, error FROM wire_checked WHERE batch_no % 7 <> 3
  UNION ALL
  SELECT DISTINCT stream_id, batch_no, 0, 'undecodable' FROM wire_checked WHERE batch_no % 7 = 3
)
SELECT stream_id, count(*) AS total_messages,
       count(*) FILTER (WHERE error IS NULL) AS successful_messages, count(error) AS failed_messages,
       coalesce(arg_max(error, batch_no * 1048576 + pos) FILTER (WHERE error IS NOT NULL), '')
         AS last_error
FROM lines GROUP BY stream_id
"""),
    "strict_publish_status": _with(_WIRE, """
, bad AS (
  SELECT stream_id, min(wseq) AS bad_seq, arg_min(batch_no, wseq) AS bad_batch,
         arg_min(error, wseq) AS stream_error
  FROM wire_checked WHERE error IS NOT NULL GROUP BY stream_id
)
SELECT w.stream_id,
       count(*) FILTER (WHERE bad_seq IS NULL OR w.batch_no < bad_batch) AS total_messages,
       count(*) FILTER (WHERE bad_seq IS NULL OR w.batch_no < bad_batch) AS successful_messages,
       CAST(0 AS BIGINT) AS failed_messages,
       count(*) FILTER (WHERE bad_seq IS NULL OR wseq < bad_seq) AS forwarded_messages,
       any_value(stream_error) AS stream_error
FROM wire_checked w LEFT JOIN bad USING (stream_id) GROUP BY w.stream_id
"""),
    "publish_batches": _with("""
, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY seq) - 1 AS ordinal FROM envelopes
)
SELECT source_name, ordinal // 1000 AS batch_no, count(*) AS messages, min(seq) AS first_seq,
       max(seq) AS last_seq, CAST(sum((ordinal % 1000) * seq) AS BIGINT) AS order_check
FROM numbered GROUP BY source_name, ordinal // 1000
"""),
    "timed_batches": _with("""
, clocked AS (
  SELECT source_name, seq, row_number() OVER w - 1 AS place,
    coalesce(max(time_ns) OVER w, -4611686018427387904) AS clock
  FROM envelopes WINDOW w AS (PARTITION BY source_name ORDER BY seq)
), chain AS (
  SELECT source_name, 0 AS batch_no, place AS begins, clock FROM clocked WHERE place = 0
  UNION ALL
  SELECT n.source_name, n.batch_no, n.begins, c.clock FROM (
    SELECT h.source_name, h.batch_no + 1 AS batch_no, least(h.begins + 50, (
      SELECT min(r.place) FROM clocked r
      WHERE r.source_name IS NOT DISTINCT FROM h.source_name AND r.place > h.begins
        AND r.clock >= h.clock + 43200000000000)) AS begins
    FROM chain h) n
  JOIN clocked c ON c.source_name IS NOT DISTINCT FROM n.source_name AND c.place = n.begins
), cut AS (
  SELECT *, lead(begins) OVER (PARTITION BY source_name ORDER BY batch_no) AS ends FROM chain
)
SELECT c.source_name, CAST(batch_no AS BIGINT) AS batch_no, count(*) AS messages, min(seq) AS first_seq,
       max(seq) AS last_seq, CAST(sum((place - begins) * seq) AS BIGINT) AS order_check
FROM clocked c JOIN cut ON c.source_name IS NOT DISTINCT FROM cut.source_name
  AND place >= begins AND (ends IS NULL OR place < ends)
GROUP BY c.source_name, batch_no
""").replace("WITH ", "WITH RECURSIVE ", 1),
    "subscriber_responses": _with("""
, wanted(subscriber_id, filter_no, f_segment, f_source, f_event) AS (
  VALUES ('clicks', 0, NULL::VARCHAR, NULL, 'click'), ('clicks', 1, NULL, 'src1', NULL),
         ('everything', 0, NULL, NULL, NULL)
), routed AS (
  SELECT w.subscriber_id, e.kind, e.time_ns,
         row_number() OVER (PARTITION BY w.subscriber_id ORDER BY e.seq, w.filter_no) - 1 AS ordinal
  FROM envelopes e JOIN wanted w ON""", _MATCH, """
)
SELECT subscriber_id, ordinal // 1024 AS batch_no, count(*) AS messages,
       count(*) FILTER (WHERE kind = 'event') AS events,
       CAST(sum((ordinal % 1024) * CASE WHEN kind = 'event' THEN time_ns % 1000003 ELSE 0 END)
            AS BIGINT) AS order_check
FROM routed GROUP BY subscriber_id, ordinal // 1024
"""),
    "emit_rows": _with(
        "SELECT seq, segment_id, source_name, kind, time_ns, name, items FROM envelopes"
    ),
    "catalog_rows": _with("""
, names(no, duckdb, data_type) AS (
  VALUES (0, 'TINYINT', 'int8'), (1, 'SMALLINT', 'int16'), (2, 'INTEGER', 'int32'),
         (3, 'BIGINT', 'int64'), (4, 'UTINYINT', 'uint8'), (5, 'USMALLINT', 'uint16'),
         (6, 'UINTEGER', 'uint32'), (7, 'UBIGINT', 'uint64'), (8, 'FLOAT', 'float32'),
         (9, 'DOUBLE', 'float64'), (10, 'TIMESTAMP_NS', 'timestamp[ns]'), (11, 'BLOB', 'binary'),
         (12, 'VARCHAR', 'string'), (13, 'BOOLEAN', 'bool'), (14, 'HUGEINT', NULL),
         (15, 'tinyint', NULL)
)
SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN segment_id END AS data_segment_id,
       source_name AS source, event_type AS message, 'value' AS signal,
       CASE WHEN event_id % 2 = 0 THEN 'USD' END AS unit, data_type,
       CASE WHEN event_id % 9 = 0 THEN 'invalid_uuid'
            WHEN data_type IS NULL THEN 'unknown_type' END AS error
FROM ev JOIN names ON no = event_id % 16
"""),
    "json_to_log": _with(_JSON, """
, judged AS (
  SELECT *,
    CASE WHEN NOT fits THEN 'unsupported_conversion'
         WHEN data_type = 'binary' AND txt NOT IN ('AQID', 'text') THEN 'invalid_base64'
         WHEN low IS NOT NULL AND NOT coalesce(whole BETWEEN low AND high, FALSE)
           THEN 'number_out_of_range' END AS error
  FROM json_typed
)
SELECT event_id, data_type,
  CASE WHEN error IS NOT NULL THEN NULL
       WHEN low IS NOT NULL THEN CAST(whole AS VARCHAR)
       WHEN data_type = 'float32' THEN
         CASE WHEN CAST(txt AS DOUBLE) > 3.5e38 THEN 'inf'
              WHEN CAST(txt AS DOUBLE) > 1e19 THEN '18446744000000000000'
              ELSE regexp_replace(CAST(CAST(txt AS FLOAT) AS VARCHAR), '\\.0$', '') END
       WHEN data_type = 'float64' THEN
         CASE WHEN CAST(txt AS DOUBLE) > 1e30 THEN '1' || repeat('0', 300)
              WHEN CAST(txt AS DOUBLE) > 1e19 THEN '18446744073709552000'
              ELSE regexp_replace(CAST(CAST(txt AS DOUBLE) AS VARCHAR), '\\.0$', '') END
       ELSE txt END AS value,
  error
FROM judged
"""),
    "json_to_columns": _with(_JSON, """
, cells AS (
  SELECT *, kind = 'string' AND data_type = 'binary' AS to_bytes,
         kind = 'number' AND data_type = 'timestamp[ns]' AS to_time
  FROM json_typed
)
SELECT event_id, data_type,
  CASE WHEN NOT to_bytes AND NOT to_time AND kind <> 'null' THEN txt END AS text,
  CASE WHEN to_bytes AND txt IN ('AQID', 'text') THEN hex(from_base64(txt)) END AS bytes,
  CASE WHEN to_time THEN TRY_CAST(whole AS BIGINT) END AS time_ns,
  CASE WHEN to_bytes AND txt NOT IN ('AQID', 'text') THEN 'invalid_base64'
       WHEN to_time AND TRY_CAST(whole AS BIGINT) IS NULL THEN 'not_a_time' END AS error
FROM cells
"""),
    "log_to_json": _with("""
SELECT seq, signal,
  CASE WHEN signal = 'value' AND seq % 500 = 0 THEN NULL ELSE key END AS json,
  CASE WHEN signal = 'value' AND seq % 500 = 0 THEN 'not_a_json_number' END AS error
FROM samples
"""),
    "rendered_values": _with("""
SELECT event_id,
  regexp_replace(CAST(value AS VARCHAR), '\\.0$', '') AS plain,
  regexp_replace(CAST(value * 1000000 AS VARCHAR), '\\.0$', '') AS large,
  CASE WHEN value / 4096 > 0 AND value / 4096 < 0.0001
       THEN '0.' || repeat('0', CAST(split_part(CAST(value / 4096 AS VARCHAR), 'e-', 2) AS INT) - 1)
            || replace(split_part(CAST(value / 4096 AS VARCHAR), 'e-', 1), '.', '')
       ELSE regexp_replace(CAST(value / 4096 AS VARCHAR), '\\.0$', '') END AS small,
  regexp_replace(CAST(CAST(value AS FLOAT) AS VARCHAR), '\\.0$', '') AS single,
  to_base64(encode(event_type)) AS raw, CAST(event_id % 2 = 0 AS VARCHAR) AS flag,
  CAST(time_ns AS VARCHAR) AS time,
  CAST(CAST(user_id AS HUGEINT) + 9223372036854775808 AS VARCHAR) AS wide
FROM ev
"""),
    "numeric_samples": _with("""
SELECT seq, signal, i AS number, f AS as_float64,
       CASE WHEN tag = 'uint8' THEN i END AS as_uint8, CASE WHEN tag = 'int64' THEN i END AS as_int64
FROM samples
"""),
    "distinct_values": _with("""
SELECT segment_id, message, signal, tag, key, count(*) AS n
FROM samples GROUP BY segment_id, message, signal, tag, key
"""),
    "catalog_types": _with("""
, names(data_type, duckdb_type, arrow_type, spark_type, is_numeric) AS (
  VALUES ('int64', 'BIGINT', 'Int64', 'BIGINT', 1), ('uint8', 'UTINYINT', 'UInt8', 'SMALLINT', 1),
         ('float64', 'DOUBLE', 'Float64', 'DOUBLE', 1)
)
SELECT s.table_key || '.' || s.signal AS key_string, data_type, duckdb_type, arrow_type,
       spark_type, CAST(is_numeric AS BIGINT) AS is_numeric
FROM cat_signals s JOIN names USING (data_type)
"""),
    "time_columns": _with("""
, moved AS (
  SELECT event_id, time_ns + event_id % 1000
         - CASE WHEN event_id % 2 = 0 THEN 3400000000000000000 ELSE 0 END AS ns FROM ev
)
SELECT event_id, ns, (ns - ((ns % 1000) + 1000) % 1000) // 1000 AS micros,
       ((ns % 1000) + 1000) % 1000 AS remainder
FROM moved
"""),
}

# The streaming twins end in the same tables as their batch forms.
ORACLE["stream_catalog"] = ORACLE["signals"]
ORACLE["stream_latest"] = ORACLE["latest_values"]
ORACLE["stream_route"] = ORACLE["filter_route"]
ORACLE["stream_ingest"] = ORACLE["publish_status"]
ORACLE["stream_remove_segment"] = ORACLE["remove_segment"]
ORACLE["stream_subscriptions"] = ORACLE["subscription_route"]
ORACLE["stream_late_subscriber"] = ORACLE["late_subscriber"]
ORACLE["stream_store"] = _with("""
SELECT s.segment_id, s.source, s.start_time_ns, s.end_time_ns, count(*) AS messages,
       CAST(sum(e.seq) AS BIGINT) AS sum_seq
FROM cat_segments s JOIN envelopes e USING (segment_id)
GROUP BY s.segment_id, s.source, s.start_time_ns, s.end_time_ns
""")

ORACLE["wire_round_trip"] = _with("""
, texts AS (
  SELECT seq, string_agg(signal || ':' || tag || ':' || shown, ',' ORDER BY
           CASE signal WHEN 'value' THEN 0 WHEN 'user_id' THEN 1 WHEN 'state' THEN 2 ELSE 3 END
         ) AS content
  FROM sample_text GROUP BY seq
)
SELECT e.segment_id, e.source_name, e.kind, e.time_ns, e.name, e.items, t.content
FROM envelopes e LEFT JOIN texts t ON t.seq = e.seq AND e.kind = 'event'
""")
