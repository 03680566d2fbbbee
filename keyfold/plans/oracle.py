"""The same queries in SQL for DuckDB."""

from __future__ import annotations

from .views import CHUNKS, CUSTOMER_CHUNKS, LIST_ROWS, SCALE

# The views of views.py, each as a common table expression.
M = f"""m AS (
  SELECT event_id, event_type AS station, value AS temp, event_id % {CHUNKS} AS chunk FROM events)"""
U = f"""u AS (
  SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS station, value AS temp,
         event_id % {CHUNKS} AS chunk, event_id // {LIST_ROWS} AS list_chunk FROM events)"""
A = f"""a AS (
  SELECT c_mktsegment AS station, c_acctbal AS temp, c_custkey % {CUSTOMER_CHUNKS} AS chunk FROM customer)"""
P = """p AS (
  SELECT CAST(l_partkey AS VARCHAR) AS station, l_extendedprice AS temp,
         CAST(l_linenumber AS BIGINT) AS chunk FROM lineitem)"""

DECIMALS = f"DECIMAL(18,{SCALE})"
SUM = f"CAST(sum(CAST(temp AS {DECIMALS})) AS DOUBLE)"
MEAN = f"{SUM} / count(temp)"
TEXT = f"CAST(CAST(temp AS {DECIMALS}) AS VARCHAR)"
LINE = f"event_type || ';' || CAST(CAST(value AS {DECIMALS}) AS VARCHAR)"


def _round(value: str) -> str:
    # Adding zero turns -0.0 into 0.0.
    return f"round_even({value}, 1) + 0.0"


def _summary(view: str, name: str, low=_round, mean=_round, high=_round) -> str:
    return f"""WITH {view}
SELECT station, {low('min(temp)')} AS t_min, {mean(MEAN)} AS t_mean, {high('max(temp)')} AS t_max
FROM {name} GROUP BY station"""


def _plain(value: str) -> str:
    return value


def _chunks(name: str) -> str:
    return f"""SELECT chunk, station, min(temp) AS temp_minimum, {MEAN} AS temp_mean,
       max(temp) AS temp_maximum FROM {name} GROUP BY chunk, station"""


def _states(name: str) -> str:
    return f"""SELECT chunk, station, min(temp) AS t_min, {SUM} AS t_sum, max(temp) AS t_max,
       count(temp) AS n FROM {name} GROUP BY chunk, station"""


def _lists(chunk: str) -> str:
    return f"""WITH {U}
SELECT station, {chunk} AS chunk, string_agg({TEXT}, ',' ORDER BY temp) AS temps
FROM u GROUP BY station, {chunk}"""


def _lines(view: str, name: str, ends: str = "printf('%.1f', round_even({}, 1))") -> str:
    """``ends`` is how the minimum and the maximum are printed."""
    mean = f"printf('%.1f', round_even({MEAN}, 1))"
    return f"""WITH {view}
SELECT station, station || '=' || {ends.format('min(temp)')} || '/' || {mean} || '/' || {ends.format('max(temp)')} AS line
FROM {name} GROUP BY station"""


def _report(view: str, name: str, closing: str, lines: str | None = None) -> str:
    return f"""SELECT CAST(0 AS BIGINT) AS part,
       '{{' || string_agg(line, ', ' ORDER BY station) || '{closing}' AS report
FROM ({lines or _lines(view, name)})"""


ALARMING = "SELECT station FROM u WHERE event_type = 'error' AND temp > 100"

FULL = f"""WITH low AS (
  SELECT CAST(CAST(floor(c_acctbal / 10) AS BIGINT) AS VARCHAR) AS station, {_round('min(temp)')} AS t_min,
         {_round(MEAN)} AS t_mean, {_round('max(temp)')} AS t_max
  FROM (SELECT *, c_acctbal AS temp FROM customer) GROUP BY 1),
high AS (SELECT event_id, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS station FROM events)
SELECT station, event_id, t_min, t_mean, t_max FROM high FULL JOIN low USING (station)"""

LOOKUP = f"""WITH {U}, names AS (SELECT DISTINCT station FROM ({ALARMING}))
SELECT station, {_round('min(temp)')} AS t_min, {_round(MEAN)} AS t_mean, {_round('max(temp)')} AS t_max
FROM u JOIN names USING (station) GROUP BY station"""

# Whole numbers of the last decimal, whose sums are exact.
UNITS = f"CAST(round(temp * {10**SCALE}) AS HUGEINT)"

_CHUNK_LINES = f"""WITH {M}, chunks AS ({_chunks('m')})
SELECT station, station || '=' || printf('%.1f', round_even(min(temp_minimum), 1)) || '/'
       || printf('%.1f', round_even(avg(temp_mean), 1)) || '/' || printf('%.1f', round_even(max(temp_maximum), 1)) AS line
FROM chunks GROUP BY station"""

ORACLE: dict[str, str] = {
    "station_summary": _summary(A, "a"),
    "station_summary_wide": _summary(P, "p"),
    "station_summary_text": _summary(P, "p"),
    "round_mean_only": _summary(A, "a", low=_plain, high=_plain),
    "agg_spec": f"""WITH {P}
SELECT station, min(temp) AS lowest, max(temp) AS highest, count(temp) AS n FROM p GROUP BY station""",
    "result_shape": f"""WITH {P}
SELECT count(*) AS n_rows, 4 AS n_cols FROM (SELECT station FROM p GROUP BY station)""",
    "scan_delimited": f"WITH {A} SELECT station, temp FROM a",
    "scan_lines": f"WITH {A} SELECT station, temp FROM a",
    "scan_late_cast": f"WITH {A} SELECT station, temp FROM a",
    "strict_bad_rows": f"""SELECT event_type || ';' || props AS line, 'not a finite number' AS reason
FROM events WHERE event_type = 'error'
UNION ALL
SELECT {LINE} || ';' || props, 'extra field' FROM events WHERE event_type = 'signup'
UNION ALL
SELECT event_type, 'no delimiter' FROM events WHERE event_type = 'view'""",
    "input_chunks": _summary(M, "m"),
    "preview_head": f"WITH {M} SELECT event_id, station, temp FROM m ORDER BY event_id LIMIT 10",
    "preview_file_head": f"WITH {M} SELECT station, temp FROM m ORDER BY event_id LIMIT 10",
    "strict_good_rows": f"""WITH {M}
SELECT station, temp FROM m WHERE station NOT IN ('error', 'view')""",
    "strict_set_aside": """SELECT event_type || ';' || props AS line, 'not a finite number' AS reason
FROM events WHERE event_type = 'error'
UNION ALL
SELECT event_type, 'no delimiter' FROM events WHERE event_type = 'view'""",
    "rename_columns": f"WITH {A} SELECT station, temp FROM a",
    "partial_state": f"WITH {M} {_states('m')}",
    "merge_state": _summary(M, "m"),
    "chunk_summary": f"WITH {M} {_chunks('m')}",
    "mean_of_means": f"""WITH {M}, chunks AS ({_chunks('m')})
SELECT station, min(temp_minimum) AS t_min, {_round('avg(temp_mean)')} AS t_mean, max(temp_maximum) AS t_max
FROM chunks GROUP BY station""",
    "chunk_mean_report": _report(M, "m", "}", _CHUNK_LINES),
    "fold_mean_variance": f"""WITH {P}
SELECT station, count(temp) AS n, CAST(sum({UNITS}) AS DOUBLE) / {10**SCALE} / count(temp) AS mean,
       CAST(count(temp) * sum({UNITS} * {UNITS}) - sum({UNITS}) * sum({UNITS}) AS DOUBLE)
       / CAST(count(temp) * CAST(count(temp) AS HUGEINT) * {10 ** (2 * SCALE)} AS DOUBLE) AS variance
FROM p GROUP BY station""",
    "fold_extremes": f"""WITH {M}, ends AS (SELECT chunk, station, min(temp) AS low, max(temp) AS high FROM m GROUP BY chunk, station)
SELECT chunk, station, low, count(*) FILTER (temp = low) AS n_low, high, count(*) FILTER (temp = high) AS n_high
FROM m JOIN ends USING (chunk, station) GROUP BY chunk, station, low, high""",
    "apply_chunk_summary": f"WITH {M} {_chunks('m')}",
    "apply_per_batch": f"""WITH {M}
SELECT chunk, station, min(temp) AS t_min, max(temp) AS t_max, count(temp) AS n
FROM m GROUP BY chunk, station""",
    "group_to_list": _lists("list_chunk"),
    "group_to_bounded_list": f"""SELECT *, true AS bounded FROM ({_summary(M, 'm')})""",
    "list_summary": _summary(U, "u"),
    "list_summary_raw": _summary(U, "u", _plain, _plain, _plain),
    "concat_lists": _lists("list_chunk // 2"),
    "merge_lists": _summary(M, "m"),
    "distinct_stations": f"WITH {U} SELECT DISTINCT station FROM u",
    "union_distinct_stations": f"WITH {U}, {P} SELECT station FROM u UNION SELECT station FROM p",
    "union_chunks": f"WITH {M}, {A} {_chunks('m')} UNION ALL {_chunks('a')}",
    "filter_station": f"WITH {M} SELECT event_id, station, temp FROM m WHERE station = 'click'",
    "station_semi": f"""WITH {U}
SELECT event_id, station, temp FROM u WHERE station IN ({ALARMING})""",
    "station_semi_gated": f"""WITH {U}
SELECT event_id, station, temp FROM u WHERE station IN ({ALARMING})""",
    "station_anti": f"""WITH {U}
SELECT event_id, station, temp FROM u WHERE station NOT IN ({ALARMING})""",
    "keys_join_partials": f"""WITH {U}, states AS ({_states('u')})
SELECT states.* FROM states JOIN (SELECT DISTINCT station FROM ({ALARMING})) USING (station)""",
    "keys_join_shuffled": f"""WITH {U}, states AS ({_states('u')})
SELECT states.* FROM states JOIN (SELECT DISTINCT station FROM ({ALARMING})) USING (station)""",
    "full_join": FULL,
    "full_join_shuffled": FULL,
    "lookup_join": LOOKUP,
    "stored_lookup": LOOKUP,
    "stored_point": f"SELECT * FROM ({_summary(P, 'p')}) WHERE station = '42'",
    "fn_split": f"""SELECT event_id, split_part(line, ';', 1) AS station, split_part(line, ';', 2) AS temp_text,
       CAST(len(string_split(line, ';')) AS INTEGER) AS n_fields
FROM (SELECT event_id, {LINE} AS line FROM events)""",
    "fn_locate": """SELECT doc_id, CAST(strpos(text, ' ') AS INTEGER) AS pos,
       CASE WHEN strpos(text, ' ') > 0 THEN substr(text, 1, strpos(text, ' ') - 1) ELSE text END AS head,
       substr(text, strpos(text, ' ') + 1) AS rest
FROM documents""",
    "fn_parse": f"""SELECT event_id, event_type AS station,
       CAST(split_part({LINE}, ';', 2) AS DOUBLE) AS temp, TRY_CAST(props AS DOUBLE) AS props_number
FROM events""",
    "fn_round": f"WITH {M} SELECT event_id, {_round('temp')} AS rounded FROM m",
    "fn_least_greatest": f"""WITH {M}
SELECT event_id, least(temp, CAST(50.0 AS DOUBLE)) AS least_50,
       greatest(temp, CAST(50.0 AS DOUBLE)) AS greatest_50 FROM m""",
    "fn_array_index": f"""WITH {M}
SELECT chunk, station, min(temp) AS t_min, CAST(count(temp) AS DOUBLE) AS n FROM m GROUP BY chunk, station""",
    "fn_array_distinct_sort": f"""WITH {U}
SELECT station, list_chunk AS chunk, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types
FROM u GROUP BY station, list_chunk""",
    "summary_map": _summary(A, "a"),
    "report_lines": _lines(A, "a"),
    "report_string": _report(A, "a", "}"),
    "report_string_trailing": _report(U, "u", ", }"),
    "station_report_text": _report(A, "a", "}"),
    "report_mean_only": _report(A, "a", "}", _lines(A, "a", "{}")),
    "report_file": f"SELECT line FROM ({_lines(A, 'a')})",
    "stream_summary": _summary(M, "m"),
    "stream_summary_update": _summary(U, "u"),
}
