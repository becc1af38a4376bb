"""Independent DuckDB SQL for every registered query (the correctness oracle).

The oracle does not parse JSON: it derives the game-event members straight from the
``events`` table (the same mapping as the adapter, written again in SQL), enumerates
the sliding windows of each row arithmetically, and builds JSON texts by string
concatenation.  The Spark side goes through JSON text, ``from_json``/variant parsing,
``window()`` expansion and ``to_json``; agreement checks all of them.

Milliseconds: ``epoch_us(ts) // 1000`` (DuckDB's ``epoch_ms`` rounds, Spark truncates).
"""

from __future__ import annotations

HOUR = 3_600_000

GAME = """
WITH g AS (
  SELECT event_id AS counter, ts, epoch_us(ts) // 1000 AS ts_ms,
         CAST(user_id AS VARCHAR) AS session,
         'k' || CAST(user_id % 10 AS VARCHAR) AS kafka_key,
         CASE WHEN event_id % 7 = 0 THEN upper(t) ELSE t END AS type,
         CASE WHEN t = 'hit' THEN CAST(floor(value) AS BIGINT) END AS damage,
         epoch_us(ts) // 1000 - 1704067200000 AS millis,
         CAST((epoch_us(ts) // 1000 - 1704067200000) * 35 // 1000 AS INTEGER) AS tic,
         CASE event_id % 10 WHEN 1 THEN NULL WHEN 0 THEN 'barrel' WHEN 2 THEN 'PLAYER'
              ELSE 'player' END AS actor_type,
         CAST(floor(value) AS INTEGER) AS health,
         140365466484344 + user_id AS actor_id,
         event_id % 4 <> 0 AS has_position,
         event_id * 65536 AS x, user_id * 65536 AS y, CAST(0 AS BIGINT) AS z,
         (event_id * 1048576) % 4294967296 AS angle,
         140365466405016 + event_id % 8 AS subsector,
         t IN ('hit', 'killed') AND event_id % 3 = 0 AS has_target
  FROM (SELECT *, CASE event_type WHEN 'error' THEN 'killed' WHEN 'purchase' THEN 'hit'
                                  WHEN 'signup' THEN 'spawn' ELSE 'move' END AS t
        FROM events) q
),
gj AS (
  SELECT g.*,
    '{"session":"' || session || '","counter":' || CAST(counter AS VARCHAR)
    || ',"type":"' || type || '"'
    || CASE WHEN damage IS NOT NULL THEN ',"damage":' || CAST(damage AS VARCHAR) ELSE '' END
    || ',"frame":{"millis":' || CAST(millis AS VARCHAR) || ',"tic":' || CAST(tic AS VARCHAR) || '}'
    || CASE WHEN actor_type IS NOT NULL THEN
         ',"actor":{'
         || CASE WHEN has_position THEN
              '"position":{"x":' || CAST(x AS VARCHAR) || ',"y":' || CAST(y AS VARCHAR)
              || ',"z":' || CAST(z AS VARCHAR) || ',"angle":' || CAST(angle AS VARCHAR)
              || ',"subsector":' || CAST(subsector AS VARCHAR) || '},'
            ELSE '' END
         || '"type":"' || actor_type || '","health":' || CAST(health AS VARCHAR)
         || ',"armor":0,"id":' || CAST(actor_id AS VARCHAR) || '}'
       ELSE '' END
    || CASE WHEN has_target THEN ',"target":{"type":"barrel","health":10,"id":140365466491112}'
       ELSE '' END
    || '}' AS json
  FROM g
)
"""

# the records with faults (by counter % 40): their texts, and what parsing makes of them
FAULTY = GAME.rstrip() + """,
gt AS (
  SELECT gj.*, CASE counter % 40
    WHEN 1 THEN substr(json, 1, 40)
    WHEN 3 THEN json || ' trailing'
    WHEN 5 THEN json || json
    WHEN 7 THEN '[' || json || ']'
    WHEN 9 THEN '{"session":"' || session || '","counter":"' || CAST(counter AS VARCHAR) || '"}'
    WHEN 11 THEN '{"session":"' || session || '","counter":' || CAST(counter AS VARCHAR) || '.5}'
    WHEN 13 THEN '{"counter":' || CAST(counter AS VARCHAR) || ',"frame":{"millis":1,"tic":99999999999}}'
    WHEN 15 THEN '{"session":"' || session || '","counter":' || CAST(counter AS VARCHAR) || ',"actor":"x"}'
    WHEN 17 THEN 'null'
    WHEN 19 THEN ' '
    WHEN 21 THEN '{}'
    ELSE json END AS text,
    counter % 40 IN (1, 3, 5, 7, 9, 11, 13, 15) AS rejected,
    counter % 40 IN (1, 3, 5, 7, 9, 11, 13, 15, 17, 19) AS no_event,
    counter % 40 = 21 AS no_member, counter % 40 = 25 AS no_session
  FROM gj
),
gf AS (
  SELECT counter, ts_ms, type, actor_type,
         CASE WHEN NOT no_session THEN session END AS session
  FROM gt WHERE NOT no_event AND NOT no_member
)
"""


def _verdicts(session: str, number: str, text: str) -> str:
    """Outcome per record with faults; the arguments stand for members that are absent."""
    def member(value, absent, extra="FALSE"):
        return f"CASE WHEN no_event THEN NULL WHEN no_member OR {extra} THEN {absent} ELSE {value} END"
    imax = IMAX if number == LMAX else number
    return FAULTY + f"""
SELECT counter AS record_offset, rejected,
       {member("session", session, "no_session")} AS session,
       CAST({member("counter", number)} AS BIGINT) AS counter,
       CAST({member("tic", imax)} AS INTEGER) AS frame_tic,
       {member("actor_type", text, "actor_type IS NULL")} AS actor_type
FROM gt"""


def _violations() -> str:
    lost = "CASE WHEN actor_type IS NULL THEN ['/actor: required'] ELSE [] END"
    return FAULTY + f""",
viol AS (
  SELECT counter, CASE
    WHEN counter % 40 IN (1, 3, 5, 7, 17, 19) THEN ['/: expected object']
    WHEN counter % 40 IN (9, 11) THEN ['/type: required', '/frame: required', '/actor: required', '/counter: expected integer']
    WHEN counter % 40 = 13 THEN ['/session: required', '/type: required', '/actor: required']
    WHEN counter % 40 = 15 THEN ['/type: required', '/frame: required', '/actor: expected object']
    WHEN counter % 40 = 21 THEN ['/counter: required', '/session: required', '/type: required', '/frame: required', '/actor: required']
    WHEN counter % 40 = 25 THEN ['/session: required'] || {lost}
    ELSE {lost} END AS v
  FROM gt
)"""


LMAX = "9223372036854775807"
IMAX = "2147483647"


def _win(width: int, slide: int, where: str = "TRUE", src: str = "g") -> str:
    """Rows of ``src`` expanded to every sliding window containing them."""
    n = -(-width // slide)
    return (f"(SELECT {src}.*, (ts_ms // {slide}) * {slide} - o * {slide} AS window_start_ms, "
            f"(ts_ms // {slide}) * {slide} - o * {slide} + {width} AS window_end_ms "
            f"FROM {src}, range({n}) t(o) WHERE {where} "
            f"AND (ts_ms // {slide}) * {slide} - o * {slide} + {width} > ts_ms)")


def _flat(prof: str) -> str:
    """The flattened parse result for a default profile."""
    if prof == "none":
        def pos(c):
            return f"CASE WHEN actor_type IS NOT NULL AND has_position THEN {c} END"
        actor = {"type": "actor_type", "health": "CASE WHEN actor_type IS NOT NULL THEN health END",
                 "armor": "CASE WHEN actor_type IS NOT NULL THEN 0 END",
                 "id": "CASE WHEN actor_type IS NOT NULL THEN actor_id END"}
        target = {"type": "CASE WHEN has_target THEN 'barrel' END",
                  "health": "CASE WHEN has_target THEN 10 END", "armor": "NULL",
                  "id": "CASE WHEN has_target THEN 140365466491112 END"}
        tpos = {c: "NULL" for c in ("x", "y", "z", "angle", "subsector")}
        damage = "damage"
    elif prof == "sentinel":
        def pos(c):
            return f"CASE WHEN actor_type IS NOT NULL AND has_position THEN {c} ELSE {LMAX} END"
        actor = {"type": "coalesce(actor_type, 'UNKNOWN_TYPE')",
                 "health": f"CASE WHEN actor_type IS NOT NULL THEN health ELSE {IMAX} END",
                 "armor": f"CASE WHEN actor_type IS NOT NULL THEN 0 ELSE {IMAX} END",
                 "id": f"CASE WHEN actor_type IS NOT NULL THEN actor_id ELSE {LMAX} END"}
        target = {"type": "CASE WHEN has_target THEN 'barrel' ELSE 'UNKNOWN_TYPE' END",
                  "health": f"CASE WHEN has_target THEN 10 ELSE {IMAX} END", "armor": IMAX,
                  "id": f"CASE WHEN has_target THEN 140365466491112 ELSE {LMAX} END"}
        tpos = {c: LMAX for c in ("x", "y", "z", "angle", "subsector")}
        damage = "damage"
    elif prof == "schema":
        def pos(c):
            return f"CASE WHEN actor_type IS NOT NULL AND has_position THEN {c} ELSE 0 END"
        actor = {"type": "coalesce(actor_type, '')",
                 "health": "CASE WHEN actor_type IS NOT NULL THEN health ELSE 0 END",
                 "armor": "0",
                 "id": "CASE WHEN actor_type IS NOT NULL THEN actor_id ELSE 0 END"}
        target = {"type": "CASE WHEN has_target THEN 'barrel' ELSE '' END",
                  "health": "CASE WHEN has_target THEN 10 ELSE 0 END", "armor": "0",
                  "id": "CASE WHEN has_target THEN 140365466491112 ELSE 0 END"}
        tpos = {c: "0" for c in ("x", "y", "z", "angle", "subsector")}
        damage = "coalesce(damage, 0)"
    elif prof == "cleaned":  # sentinel profile with every sentinel turned back into NULL
        return _flat("none")
    else:
        raise ValueError(prof)
    cols = [
        "kafka_key AS key", "ts_ms AS event_time_ms", "session", "counter", "type",
        f"CAST({damage} AS BIGINT) AS damage",
        "millis AS frame_millis", "tic AS frame_tic",
        *[f"CAST({pos(c)} AS BIGINT) AS actor_position_{c}" for c in ("x", "y", "z", "angle", "subsector")],
        f"{actor['type']} AS actor_type", f"CAST({actor['health']} AS INTEGER) AS actor_health",
        f"CAST({actor['armor']} AS INTEGER) AS actor_armor", f"CAST({actor['id']} AS BIGINT) AS actor_id",
        *[f"CAST({tpos[c]} AS BIGINT) AS target_position_{c}" for c in ("x", "y", "z", "angle", "subsector")],
        f"{target['type']} AS target_type", f"CAST({target['health']} AS INTEGER) AS target_health",
        f"CAST({target['armor']} AS INTEGER) AS target_armor", f"CAST({target['id']} AS BIGINT) AS target_id",
        "CAST(NULL AS VARCHAR) AS _corrupt_record",
    ]
    return GAME + "SELECT " + ",\n  ".join(cols) + " FROM g"


def _filtered(where: str) -> str:
    return GAME + f"SELECT counter, session, type, actor_type FROM g WHERE {where}"


def _kill_metric(width: int, slide: int, unit: int = 1000, name: str = "second", ctes: str = GAME,
                 src: str = "g") -> str:
    return ctes + f"""
SELECT session, window_start_ms, window_end_ms, 'killed per {name}' AS metric,
       ({float(unit)}::DOUBLE * count(*) FILTER (WHERE lower(type) = 'killed')) / {width} AS value
FROM {_win(width, slide, "lower(actor_type) = 'player'", src)} w
GROUP BY session, window_start_ms, window_end_ms"""


def _fine_kills(width: int, slide: int) -> str:
    return GAME + f"""
SELECT session, window_start_ms, window_end_ms,
       CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE ((n * 1.0::DOUBLE) / {width}) * 1000.0::DOUBLE END AS value
FROM (SELECT session, window_start_ms, window_end_ms,
             count(*) FILTER (WHERE lower(type) = 'killed') AS n
      FROM {_win(width, slide, "lower(actor_type) = 'player'")} w
      GROUP BY session, window_start_ms, window_end_ms) a"""


def _move_count(width: int, slide: int) -> str:
    return GAME + f"""
SELECT session, window_start_ms, window_end_ms, count(*) AS count
FROM {_win(width, slide, "lower(actor_type) = 'player' AND lower(type) = 'move'")} w
GROUP BY session, window_start_ms, window_end_ms"""


def _action_rate(width: int, slide: int, extra_where: str = "TRUE") -> str:
    return GAME + f"""
SELECT session, window_start_ms, window_end_ms,
       CAST(count(*)::DOUBLE / ((window_end_ms - window_start_ms) / 1000.0::DOUBLE) AS REAL) AS value,
       window_end_ms - 1 AS max_timestamp, 'move' AS action
FROM {_win(width, slide, "coalesce(type, '') = 'move'")} w
WHERE {extra_where}
GROUP BY session, window_start_ms, window_end_ms"""


def _session_activity(width: int, slide: int) -> str:
    return GAME + f"""
SELECT session, window_start_ms, window_end_ms, move_count,
       CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE ((n * 1.0::DOUBLE) / {width}) * 1000.0::DOUBLE END AS kill_rate
FROM (SELECT session, window_start_ms, window_end_ms,
             count(*) FILTER (WHERE lower(type) = 'move') AS move_count,
             count(*) FILTER (WHERE lower(type) = 'killed') AS n
      FROM {_win(width, slide, "lower(actor_type) = 'player'")} w
      GROUP BY session, window_start_ms, window_end_ms) a"""


def _activity_span(width: int, slide: int) -> str:
    return GAME + f"""
SELECT session, window_start_ms, window_end_ms, count(*) AS sum, count(*) AS count,
       min(millis) AS earliest_millis, max(millis) AS latest_millis
FROM {_win(width, slide, "lower(actor_type) = 'player'")} w
GROUP BY session, window_start_ms, window_end_ms"""


PARTS = 8
# the records' place: partition 0, the counter as the offset
PART = f"CAST('0x' || substr(md5('0/' || CAST(counter AS VARCHAR)), 1, 8) AS BIGINT) % {PARTS}"


def _groups(width: int, slide: int) -> str:
    return GAME + f"""
SELECT kafka_key AS key, window_start_ms, window_end_ms, count(*) AS n_events,
       CAST({PART} AS INTEGER) AS part, {PARTS} AS n_parts,
       '[' || string_agg(json, ',' ORDER BY counter) || ']' AS events_json
FROM {_win(width, slide, "actor_type = 'player'", "gj")} w
GROUP BY kafka_key, window_start_ms, window_end_ms, {PART}"""


CHUNK, BLOCK = 8, 64


def _group_chunks(width: int, slide: int) -> str:
    return GAME + f"""
SELECT kafka_key AS key, window_start_ms, window_end_ms, place // {CHUNK} AS chunk,
       (n + {CHUNK - 1}) // {CHUNK} AS n_chunks, count(*) AS n_events,
       '[' || string_agg(json, ',' ORDER BY counter) || ']' AS events_json
FROM (SELECT *, row_number() OVER (PARTITION BY kafka_key, window_start_ms ORDER BY counter) - 1 AS place,
             count(*) OVER (PARTITION BY kafka_key, window_start_ms) AS n
      FROM {_win(width, slide, "actor_type = 'player'", "gj")} w) p
GROUP BY kafka_key, window_start_ms, window_end_ms, place // {CHUNK}, n"""


def _group_pieces(width: int, slide: int) -> str:
    return GAME + f"""
SELECT kafka_key AS key, window_start_ms, window_end_ms, 0 AS part, counter // {BLOCK} AS sequence, count(*) AS n_events,
       '[' || string_agg(json, ',' ORDER BY counter) || ']' AS events_json
FROM {_win(width, slide, "actor_type = 'player'", "gj")} w
GROUP BY kafka_key, window_start_ms, window_end_ms, counter // {BLOCK}"""


def _group_text(width: int, slide: int) -> str:
    return GAME + f"""
SELECT '{{"key":"' || kafka_key || '","window_start_ms":' || CAST(window_start_ms AS VARCHAR)
       || ',"window_end_ms":' || CAST(window_end_ms AS VARCHAR) || ',"part":'
       || CAST({PART} AS VARCHAR) || ',"n_parts":{PARTS},"events":['
       || string_agg(json, ',' ORDER BY counter) || ']}}' AS value
FROM {_win(width, slide, "actor_type = 'player'", "gj")} w
GROUP BY kafka_key, window_start_ms, window_end_ms, {PART}"""


def _metric_records(width: int, slide: int) -> str:
    inner = _kill_metric(width, slide).replace(GAME, "")
    return GAME + f"""
SELECT session AS key, 'session,metric,value' AS value_members, session AS value_session,
       metric AS value_metric, value AS value_value, window_start_ms, window_end_ms
FROM ({inner}) m"""


def _feedback(width: int, slide: int, extra_where: str = "TRUE") -> str:
    inner = _kill_metric(width, slide).replace(GAME, "")
    return GAME + f"""
SELECT session AS key, printf('Your %s is %.3f.', metric, value) AS sentence,
       window_start_ms, window_end_ms
FROM ({inner}) m WHERE {extra_where}"""


_MAX_MS = "(SELECT max(epoch_us(ts) // 1000) FROM events)"

KILL = (6 * HOUR, HOUR)
FINE = (40 * HOUR, HOUR)
GROUP = (4 * HOUR, HOUR)


def _closed(sql_select: str) -> str:
    """Restrict a windowed result to the windows a stream has emitted at the end."""
    return f"SELECT * FROM ({sql_select}) r WHERE window_end_ms <= {_MAX_MS}"


def _stream(sql: str) -> str:
    body = sql.replace(GAME, "")
    return GAME + _closed(body)


_VIOLATIONS = _violations() + """
SELECT counter AS record_offset, CAST(len(v) AS INTEGER) AS n_violations, array_to_string(v, '|') AS violations
FROM viol"""

ORACLE = {
    "schema_violations_document": _VIOLATIONS,
    "parse_events": _flat("none"),
    "parse_events_sentinel": _flat("sentinel"),
    "parse_events_schema": _flat("schema"),
    "sentinels_to_null": _flat("cleaned"),
    "kafka_envelope_decode": GAME + "SELECT kafka_key AS key, json AS value, ts_ms AS timestamp_ms FROM gj",
    "empty_record_flags": FAULTY + """
SELECT counter AS record_offset, no_member AS event_empty, no_member AS frame_empty,
       NOT no_event AND (no_member OR actor_type IS NULL) AS actor_empty,
       NOT no_event AND (no_member OR actor_type IS NULL OR NOT has_position) AS actor_position_empty,
       NOT no_event AND (no_member OR NOT has_target) AS target_empty
FROM gt""",
    "parse_rejects": FAULTY + "SELECT counter AS record_offset, kafka_key AS key, text AS value FROM gt WHERE rejected",
    "none_rejects": _verdicts("NULL", "NULL", "NULL"),
    "sentinel_rejects": _verdicts("'UNKNOWN_SESSION'", LMAX, "'UNKNOWN_TYPE'"),
    "schema_rejects": _verdicts("''", "0", "''"),
    "schema_violations": _VIOLATIONS,
    "schema_violation_counts": _violations() + """
SELECT violation, count(*) AS n_records FROM (SELECT unnest(v) AS violation FROM viol) u GROUP BY violation""",
    "filter_actor_type": _filtered("lower(actor_type) = 'player'"),
    "filter_actor_type_exact": _filtered("actor_type = 'player'"),
    "filter_event_type": _filtered("lower(type) = 'move'"),
    "filter_event_type_exact": _filtered("coalesce(type, '') = 'move'"),
    "kill_rate": _kill_metric(3000, 500),
    "kill_rate_scaled": _kill_metric(*KILL),
    "kill_rate_panes": _kill_metric(*KILL),
    "kill_rate_per_minute": _kill_metric(3000, 500, 60_000, "minute"),
    "kill_rate_with_rejects": _kill_metric(*KILL, ctes=FAULTY, src="gf"),
    "kill_rate_fine_bucketed": _fine_kills(1000, 25),
    "kill_rate_fine_direct": _fine_kills(1000, 25),
    "kill_rate_fine": _fine_kills(1000, 25),
    "kill_rate_fine_scaled": _fine_kills(*FINE),
    "kill_rate_fine_panes": _fine_kills(1000, 25),
    "move_count": _move_count(1000, 25),
    "move_count_scaled": _move_count(*FINE),
    "action_rate": _action_rate(1000, 25),
    "action_rate_scaled": _action_rate(*FINE),
    "session_activity": _session_activity(1000, 25),
    "session_activity_scaled": _session_activity(*FINE),
    "activity_span": _activity_span(1000, 25),
    "activity_span_scaled": _activity_span(*FINE),
    "window_summary": GAME + f"""
SELECT session, window_start_ms, window_end_ms, count(*) AS size,
       '(key: ' || session || ', sz: ' || CAST(count(*) AS VARCHAR) || ', start: '
       || CAST(window_start_ms AS VARCHAR) || ', end: ' || CAST(window_end_ms AS VARCHAR) || ')' AS summary
FROM {_win(*FINE, "coalesce(type, '') = 'move'")} w
GROUP BY session, window_start_ms, window_end_ms""",
    "windowed_group": _groups(1000, 250),
    "windowed_group_scaled": _groups(*GROUP),
    "windowed_group_chunks": _group_chunks(*GROUP),
    "stream_windowed_group_pieces": _stream(_group_pieces(*GROUP)),
    "stream_windowed_group_assembled": _stream(_group_chunks(*GROUP)),
    "windowed_group_text": _group_text(*GROUP),
    "metric_to_kafka_record": _metric_records(*KILL),
    "metric_feedback": _feedback(*KILL),
    "metric_feedback_rejects": GAME + f"""
SELECT CASE (window_start_ms // {HOUR} + CAST(session AS BIGINT)) % 16
         WHEN 0 THEN 'value' WHEN 1 THEN 'metric' WHEN 2 THEN 'session' WHEN 3 THEN 'not an object'
         WHEN 4 THEN 'empty' WHEN 5 THEN 'value' WHEN 7 THEN 'value' WHEN 8 THEN 'not an object'
         WHEN 9 THEN 'not an object' ELSE 'accepted' END AS outcome, count(*) AS n_records
FROM ({_kill_metric(*KILL).replace(GAME, '')}) m GROUP BY 1""",
    "metric_session_order": GAME + f"""
SELECT session, 1 AS n_writers, count(*) AS n_records, 0 AS n_out_of_order
FROM ({_kill_metric(*KILL).replace(GAME, '')}) m GROUP BY session""",
    "stream_kill_rate": _stream(_kill_metric(*KILL)),
    "stream_kill_rate_partitions": GAME + f"""
, parts AS (
  SELECT counter % CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 4 ELSE 3 END AS p, max(ts_ms) AS newest FROM g GROUP BY 1
), mark AS (
  SELECT min(greatest(newest, (SELECT max(newest) FROM parts) - {72 * HOUR})) AS ms FROM parts
)
SELECT * FROM ({_kill_metric(*KILL).replace(GAME, '')}) m WHERE window_end_ms <= (SELECT ms FROM mark)""",
    "stream_move_count": _stream(_move_count(*FINE)),
    "stream_action_rate": _stream(_action_rate(*FINE)),
    "stream_metric_feedback": _stream(_feedback(*KILL)),
    "stream_windowed_group": _stream(_groups(*GROUP)),
    "stream_session_activity": _stream(_session_activity(*FINE)),
    "stream_activity_span": _stream(_activity_span(*FINE)),
    "session_activity_merged": _session_activity(*FINE),
    "activity_span_merged": _activity_span(*FINE),
    "stream_session_activity_stored": _stream(_session_activity(*FINE)),
    "stream_session_activity_panes": _stream(_session_activity(*FINE)),
    "stream_activity_span_panes": _stream(_activity_span(*FINE)),
}
