"""The same queries as plain SQL, for comparison on another engine over the same tables."""

from __future__ import annotations

NOW = "20240115120000"
TIMES = {
    "now": ("TIMESTAMP '2024-01-15 12:00:00'", NOW),
    "t15": ("TIMESTAMP '2024-01-15 11:45:00'", "20240115114500"),
    "t60": ("TIMESTAMP '2024-01-15 11:00:00'", "20240115110000"),
}


def _phone(x: str) -> str:
    return f"CAST(18600000000 + ({x} % 30) * 10000 + {x} AS VARCHAR)"


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
CELL = f"(43020 + {K} % 5) || '$' || (10000 + {K})"
SECOND = "strftime(ts, '%Y%m%d%H%M%S')"

SIGNALS = f"""signals AS (
  SELECT {_phone("user_id")} AS msisdn,
         CASE WHEN event_type <> 'error' THEN {CELL} ELSE '$' END AS cell_id,
         ts, event_id
  FROM events WHERE event_type <> 'signup')"""


def _latest(name: str, moment: str, ttl: str = "24 HOURS") -> str:
    return f"""{name} AS (
  SELECT msisdn, cell_id FROM (
    SELECT *, row_number() OVER (PARTITION BY msisdn ORDER BY ts DESC, event_id DESC) AS rn
    FROM signals WHERE ts > {moment} - INTERVAL {ttl} AND ts <= {moment})
  WHERE rn = 1)"""


def _people(name: str, latest: str, stamp: str) -> str:
    return f"""{name} AS (
  SELECT upper(md5(msisdn)) AS user_hash, cell_id, substr(msisdn, 1, 7) AS prefix7, '{stamp}' AS stat_time
  FROM {latest})"""


SNAPSHOT = ", ".join([SIGNALS, _latest("latest", TIMES["now"][0]), _people("people", "latest", NOW)])

PREFIXES = """prefixes AS (
  SELECT '18600' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS prefix7,
         CASE WHEN n_regionkey = 0 THEN '310000' WHEN n_regionkey = 4 THEN ''
              ELSE CAST(110000 + n_regionkey * 10000 AS VARCHAR) END AS home_region
  FROM nation)"""

_C = f"upper(md5({_phone('c_custkey')}))"
_S = f"upper(md5({_phone('s_suppkey')}))"
LABELS = f"""labels_long AS (
  SELECT {_C} AS user_hash, 'age' AS label, CAST(c_custkey % 6 AS VARCHAR) AS value FROM customer
  UNION ALL SELECT {_C}, 'gender', CAST(c_nationkey % 2 AS VARCHAR) FROM customer
  UNION ALL SELECT {_C}, 'arpu', CASE WHEN c_acctbal < 0 THEN 'neg' WHEN c_acctbal < 1000 THEN 'NULL_VALUE' ELSE 'pos' END
            FROM customer
  UNION ALL SELECT {_C}, 'equip_brand', c_mktsegment FROM customer
  UNION ALL SELECT {_C}, 'equip_net', (c_nationkey % 4) || 'G' FROM customer WHERE c_nationkey < 20
  UNION ALL SELECT {_C}, 'flux_used', 'flux' FROM customer WHERE c_nationkey < 20
  UNION ALL SELECT {_S}, 'cz_uv', 'z' || (s_nationkey % 2) FROM supplier WHERE s_nationkey >= 8
  UNION ALL SELECT {_S}, 'cz_distance_work_home', 'd' || (s_nationkey % 4) FROM supplier WHERE s_nationkey >= 8
  UNION ALL SELECT {_S}, 'cz_home_metro_site', 'h' || s_nationkey FROM supplier WHERE s_nationkey >= 8
  UNION ALL SELECT {_S}, 'cz_work_metro_site', 'w' || (s_nationkey % 6) FROM supplier WHERE s_nationkey >= 8
  UNION ALL SELECT {_S}, 'cz_ufrom', 'r' || (s_nationkey % 3) FROM supplier WHERE s_nationkey >= 16)"""


def _region_rows(people: str, area: str, by: str = "stat_time") -> str:
    place = f"CASE WHEN coalesce({area}, '') IN ('', '$') THEN 'NULL_VALUE' ELSE {area} END"
    source = f"{people} p LEFT JOIN prefixes x ON p.prefix7 = x.prefix7"
    blank = "coalesce(home_region, '') = ''"
    return f"""SELECT {by}, {place} AS area_id, 'uv' AS label, 'uv' AS value FROM {source}
  UNION ALL SELECT {by}, {place}, 'ufrom', CASE WHEN {blank} THEN 'NULL_VALUE' ELSE home_region END FROM {source}
  UNION ALL SELECT {by}, {place}, 'ufrom_short',
    CASE WHEN {blank} THEN 'NULL_VALUE' WHEN home_region = '310000' THEN home_region ELSE '999999' END FROM {source}"""


def _label_rows(people: str, area: str, by: str = "stat_time") -> str:
    place = f"CASE WHEN coalesce({area}, '') IN ('', '$') THEN 'NULL_VALUE' ELSE {area} END"
    return f"SELECT {by}, {place} AS area_id, label, value FROM {people} p JOIN labels_long l ON p.user_hash = l.user_hash"


def _counted(rows: str, by: str = "stat_time") -> str:
    return f"SELECT {by}, area_id, label, value, count(*) AS cnt FROM ({rows}) GROUP BY ALL"


CELLS = ", ".join(
    [
        SNAPSHOT,
        PREFIXES,
        LABELS,
        f"cells AS ({_counted(_region_rows('people', 'cell_id') + ' UNION ALL ' + _label_rows('people', 'cell_id'))})",
    ]
)

BRIDGES = """nation_cells AS (
  SELECT n_nationkey AS n, j, n_nationkey * 4 + j AS k,
         (43020 + (n_nationkey * 4 + j) % 5) || '$' || (10000 + n_nationkey * 4 + j) AS cell
  FROM nation, (VALUES (0), (1), (2), (3)) v(j)),
cell_grid AS (
  SELECT cell AS from_id, 'G' || n AS to_id, CASE WHEN k % 2 = 0 THEN 0.5 ELSE 1.0 END AS ratio FROM nation_cells
  UNION ALL SELECT cell, 'G' || (n + 1), 0.5 FROM nation_cells WHERE k % 2 = 0),
grid_district AS (
  SELECT 'G' || n_nationkey AS from_id, 'CAN_' || (310100 + n_regionkey) AS to_id, 1.0 AS ratio FROM nation
  UNION ALL SELECT 'G' || n_nationkey, 'DIS_' || (n_nationkey % 3), 1.0 FROM nation),
cell_district AS (
  SELECT cell AS from_id, 'DIS_F' || (k % 10) AS to_id, 1.0 AS ratio FROM nation_cells
  UNION ALL SELECT cell, 'DIS_' || (n % 3), 1.0 FROM nation_cells WHERE j = 3),
district_parent AS (
  SELECT DISTINCT 'DIS_F' || (k % 10) AS from_id,
         CASE WHEN k % 10 < 5 THEN 'DIS_TOP_A' ELSE 'DIS_TOP_B' END AS to_id, 1.0 AS ratio
  FROM nation_cells)"""


def _rolled(name: str, stats: str, bridge: str) -> str:
    return f"""{name} AS (
  SELECT stat_time, b.to_id AS area_id, label, value,
         CAST(round(sum(CAST(cnt * b.ratio AS DOUBLE))) AS BIGINT) AS cnt
  FROM {stats} s JOIN {bridge} b ON s.area_id = b.from_id
  GROUP BY stat_time, b.to_id, label, value)"""


AREAS = ", ".join(
    [
        CELLS,
        BRIDGES,
        _rolled("grids", "cells", "cell_grid"),
        _rolled("districts", "grids", "grid_district"),
        """city AS (SELECT stat_time, 'DIS_ALL' AS area_id, label, value, CAST(sum(cnt) AS BIGINT) AS cnt
  FROM districts WHERE area_id LIKE 'CAN%' GROUP BY stat_time, label, value)""",
        _rolled("cell_districts", "cells", "cell_district"),
        _rolled("parents", "cell_districts", "district_parent"),
        """areas AS (
  SELECT *, 'grid' AS branch, 'grid' AS level FROM grids
  UNION ALL SELECT *, 'grid', 'sub' FROM districts
  UNION ALL SELECT *, 'city', 'sub' FROM city
  UNION ALL SELECT *, 'cell', 'sub' FROM cell_districts
  UNION ALL SELECT *, 'parent', 'sub' FROM parents)""",
    ]
)

JSON = "'{' || string_agg('\"' || value || '\":' || cnt, ',' ORDER BY value) || '}'"


def _profile(key: str) -> str:
    return f"""WITH {AREAS}, picked AS (
  SELECT *, row_number() OVER (PARTITION BY stat_time, area_id, label, value
    ORDER BY CASE branch WHEN 'parent' THEN 3 WHEN 'cell' THEN 2 ELSE 1 END DESC) AS rn FROM areas)
SELECT {key} AS row_key, {JSON} AS profile_json FROM picked WHERE rn = 1 GROUP BY stat_time, area_id, label"""


def _located_at(*names: str) -> str:
    parts = [SIGNALS, BRIDGES]
    for name in names:
        moment, stamp = TIMES[name]
        parts += [_latest(f"latest_{name}", moment), _people(f"people_{name}", f"latest_{name}", stamp)]
        parts.append(f"""loc_{name} AS (
  SELECT user_hash, b.to_id AS area_id, prefix7 FROM people_{name} p JOIN cell_district b ON p.cell_id = b.from_id)""")
    return ", ".join(parts)


def _stayed_select(now: str, then: str) -> str:
    return f"""SELECT a.user_hash, a.area_id, a.prefix7 FROM {now} a JOIN {then} b
  ON a.user_hash = b.user_hash AND a.area_id = b.area_id AND a.prefix7 = b.prefix7"""


def _moved(left: str, right: str) -> str:
    return f"""WITH {_located_at("now", "t60")}
SELECT a.user_hash, a.area_id, a.prefix7 FROM {left} a LEFT JOIN {right} b ON a.user_hash = b.user_hash
WHERE b.user_hash IS NULL OR a.area_id <> b.area_id OR a.prefix7 <> b.prefix7"""


def _range(ttl: str) -> str:
    """People at every step of the month, by matching each signal to all the steps it is live at."""
    return f"""{SIGNALS}, {PREFIXES}, {LABELS}, {BRIDGES},
steps AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 15 MINUTES)) AS t),
live AS (
  SELECT t, msisdn, cell_id,
         row_number() OVER (PARTITION BY t, msisdn ORDER BY ts DESC, event_id DESC) AS rn
  FROM signals JOIN steps ON ts <= t AND ts > t - INTERVAL {ttl}),
people AS (
  SELECT t, strftime(t, '%Y%m%d%H%M%S') AS stat_time, upper(md5(msisdn)) AS user_hash, cell_id,
         substr(msisdn, 1, 7) AS prefix7
  FROM live WHERE rn = 1)"""


def _movement_rows(source: str, movement: str) -> str:
    rows = _region_rows(source, "area_id") + " UNION ALL " + _label_rows(source, "area_id")
    return f"SELECT stat_time, area_id, label, value, count(*) AS cnt, '{movement}' AS movement FROM ({rows}) GROUP BY ALL"


SEARCH_LOG = f"""WITH log AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(user_id AS VARCHAR) AS "user", event_type AS keyword,
    CASE {K} % 3 WHEN 0 THEN 'beijing' WHEN 1 THEN 'shanghai' ELSE 'shenzhen' END AS city,
    CASE {K} % 2 WHEN 0 THEN 'android' ELSE 'ios' END AS platform,
    CASE {K} % 4 WHEN 0 THEN '1.0' WHEN 1 THEN '1.2' WHEN 2 THEN '1.5' ELSE '2.0' END AS version
  FROM events)"""

HARD = f"""WITH {AREAS}, hard AS (
  SELECT stat_time, area_id, label, branch, level, CAST(sum(cnt) AS BIGINT) AS cnt,
    CASE label WHEN 'arpu' THEN ' ' || value || ', "or" so ' WHEN 'gender' THEN '' ELSE value END AS value
  FROM areas GROUP BY ALL)"""

# Signals in the lots they arrive in, and the watermark of each lot: of the last one also when all is read.
LOTS = f"""WITH arrived AS (
  SELECT event_id, {_phone("user_id")} AS msisdn, event_type, CASE WHEN event_type = 'error' THEN '$' ELSE {CELL} END AS cell_id,
    date_trunc('second', ts) AS t,
    least(3, date_diff('day', DATE '2024-01-01', CAST(ts + to_hours(CASE event_id % 10 WHEN 0 THEN 40 WHEN 5 THEN 2 ELSE 0 END) AS DATE)) // 8) AS lot
  FROM events),
marks AS (
  SELECT l.lot, max(t) - INTERVAL 6 HOURS AS mark FROM (SELECT unnest(range(5)) AS lot) l
  LEFT JOIN arrived a ON a.lot < l.lot AND a.event_type <> 'signup' GROUP BY l.lot),
judged AS (
  SELECT a.*, mark, CASE WHEN event_type = 'signup' THEN 'rejected' WHEN t <= mark THEN 'late' ELSE 'located' END AS outcome
  FROM arrived a JOIN marks USING (lot))"""

_STATS = "SELECT stat_time, area_id, label, value, cnt FROM"

SQL: dict[str, str] = {
    "parse_signals": f"""
SELECT '1' AS datasrc, CASE WHEN event_type = 'signup' THEN '' ELSE {_phone("user_id")} END AS msisdn,
       CASE WHEN event_type = 'error' THEN '' ELSE CAST(43020 + {K} % 5 AS VARCHAR) END AS lac,
       CASE WHEN event_type = 'error' THEN '' ELSE CAST(10000 + {K} AS VARCHAR) END AS ci,
       {SECOND} AS begintime, {SECOND} AS endtime, {SECOND} AS fstintime, {SECOND} AS intime,
       CAST(event_id AS VARCHAR) AS eventid, event_type AS appid, '' AS websiteid
FROM events""",
    "serialise_signals": f"""
SELECT '1|' || CASE WHEN event_type = 'signup' THEN '' ELSE {_phone("user_id")} END || '|' ||
       CASE WHEN event_type = 'error' THEN '|' ELSE (43020 + {K} % 5) || '|' || (10000 + {K}) END || '|' ||
       {SECOND} || '|' || {SECOND} || '|' || {SECOND} || '|' || {SECOND} || '|' || event_id || '|' || event_type || '|' AS value
FROM events""",
    "latest_location": f"WITH {SNAPSHOT} SELECT msisdn, cell_id FROM latest",
    "snapshot": f"WITH {SNAPSHOT} SELECT user_hash, cell_id, prefix7, stat_time FROM people",
    "salted_pseudonym": f"""SELECT c_custkey, upper(md5({_phone("c_custkey")} || 'pepper')) AS salted, {_C} AS plain FROM customer""",
    "accepted_rows": f"""
SELECT {_phone("user_id")} AS msisdn, '43020$' || (10000 + {K}) AS cell_id
FROM events WHERE event_type NOT IN ('signup', 'error', 'purchase')""",
    "rejected_rows": f"""
SELECT event_id,
       CASE event_type WHEN 'signup' THEN ',43020$' || (10000 + {K})
                       WHEN 'error' THEN {_phone("user_id")} || ','
                       ELSE {_phone("user_id")} || ',43020$' || (10000 + {K}) || ',' || event_type END AS line,
       CASE event_type WHEN 'signup' THEN 'no_msisdn' ELSE 'field_count' END AS reject_reason
FROM events WHERE event_type IN ('signup', 'error', 'purchase')""",
    "region_counts": f"WITH {SNAPSHOT}, {PREFIXES} {_counted(_region_rows('people', 'cell_id'))}",
    "label_values": f"WITH {LABELS} SELECT label, value, count(*) AS cnt FROM labels_long GROUP BY ALL",
    "label_counts": f"WITH {SNAPSHOT}, {LABELS} {_counted(_label_rows('people', 'cell_id'))}",
    "cell_stats": f"WITH {CELLS} {_STATS} cells",
    "grid_stats": f"WITH {AREAS} {_STATS} grids",
    "district_stats": f"WITH {AREAS} {_STATS} districts",
    "cell_district_stats": f"WITH {AREAS} {_STATS} cell_districts",
    "parent_district_stats": f"WITH {AREAS} {_STATS} parents",
    "city_total": f"WITH {AREAS} {_STATS} city",
    "area_stats": f"WITH {AREAS} SELECT stat_time, area_id, label, value, cnt, branch, level FROM areas",
    "profile_json": _profile("area_id || '-' || label || '-' || stat_time"),
    "current_profile_json": _profile("area_id || '-' || label"),
    "rebuilt_profile": f"WITH {CELLS} SELECT area_id, label, {JSON} AS profile_json FROM cells GROUP BY area_id, label",
    "located": f"WITH {_located_at('now')} SELECT user_hash, area_id, prefix7 FROM loc_now",
    "stayed_15m": f"WITH {_located_at('now', 't15')} {_stayed_select('loc_now', 'loc_t15')}",
    "stayed_60m": f"WITH {_located_at('now', 't60')} {_stayed_select('loc_now', 'loc_t60')}",
    "arrived": _moved("loc_now", "loc_t60"),
    "departed": _moved("loc_t60", "loc_now"),
    "arrived_strict": f"""WITH {_located_at("now", "t60")}
SELECT user_hash, area_id, prefix7 FROM loc_now a WHERE NOT EXISTS (
  SELECT 1 FROM loc_t60 b WHERE a.user_hash = b.user_hash AND a.area_id = b.area_id)""",
    "movement_profile": f"""WITH {_located_at("now", "t15", "t60")}, {PREFIXES}, {LABELS},
at_now AS (SELECT '{NOW}' AS stat_time, * FROM loc_now),
s15 AS (SELECT '{NOW}' AS stat_time, * FROM ({_stayed_select("loc_now", "loc_t15")})),
s60 AS (SELECT '{NOW}' AS stat_time, * FROM ({_stayed_select("loc_now", "loc_t60")})),
moves AS ({_movement_rows("at_now", "current")} UNION ALL {_movement_rows("s15", "stayed_15m")}
  UNION ALL {_movement_rows("s60", "stayed_60m")})
SELECT stat_time, movement, area_id, label, {JSON} AS profile_json FROM moves GROUP BY stat_time, movement, area_id, label""",
    "time_range": """
SELECT user_id, day, strftime(unnest(generate_series(lo, hi, INTERVAL 15 MINUTES)), '%Y%m%d%H%M%S') AS stat_time
FROM (SELECT user_id, strftime(ts, '%Y%m%d') AS day, date_trunc('second', min(ts)) AS lo, date_trunc('second', max(ts)) AS hi
      FROM events GROUP BY ALL)""",
    "backfill_uv": f"""WITH {_range("24 HOURS")}
SELECT stat_time, CASE WHEN cell_id = '$' THEN 'NULL_VALUE' ELSE cell_id END AS area_id, count(*) AS cnt
FROM people GROUP BY ALL""",
    "backfill_stats": f"""WITH {_range("1 HOUR")}
{_counted(_region_rows("people", "cell_id") + " UNION ALL " + _label_rows("people", "cell_id"))}""",
    "movement_backfill": f"""WITH {_range("1 HOUR")},
loc AS (SELECT t, stat_time, user_hash, b.to_id AS area_id, prefix7
        FROM people p JOIN cell_district b ON p.cell_id = b.from_id),
s15 AS (SELECT a.* FROM loc a JOIN loc b ON a.user_hash = b.user_hash AND a.area_id = b.area_id
        AND b.t = a.t - INTERVAL 15 MINUTES),
s60 AS (SELECT a.* FROM loc a JOIN loc b ON a.user_hash = b.user_hash AND a.area_id = b.area_id
        AND b.t = a.t - INTERVAL 60 MINUTES WHERE minute(a.t) = 0)
{_movement_rows("loc", "current")} UNION ALL {_movement_rows("s15", "stayed_15m")}
UNION ALL {_movement_rows("s60", "stayed_60m")}""",
    "district_bridge": """
SELECT 'G' || s_suppkey AS from_id, 'D' || s_nationkey AS to_id, CAST(1.0 AS DOUBLE) AS ratio
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey < 3 AND n_nationkey < 20
UNION ALL
SELECT 'G' || s_suppkey, 'CAN_' || s_nationkey, CAST(1.0 AS DOUBLE) FROM supplier WHERE s_acctbal >= 0 AND s_acctbal < 9000""",
    "multi_filter": f"""{SEARCH_LOG} SELECT * FROM log
WHERE city IN ('shanghai', 'shenzhen') AND platform IN ('ios') AND version IN ('1.2', '2.0')""",
    "uv_per_day_key": f"""{SEARCH_LOG} SELECT date, keyword, count(DISTINCT "user") AS uv FROM log
WHERE city IN ('beijing', 'shanghai') AND version IN ('1.0', '1.5') GROUP BY date, keyword""",
    "flow_filter": "SELECT c_name AS name, CAST(c_custkey % 90 AS INTEGER) AS age FROM customer WHERE c_custkey % 90 >= 10",
    "sql_filter": """SELECT c_name AS name, CAST(c_custkey % 90 AS INTEGER) AS age, CAST(c_nationkey % 2 AS VARCHAR) AS sex
FROM customer WHERE c_custkey % 90 BETWEEN 30 AND 44 AND c_nationkey % 2 = 1""",
    "text_length": "SELECT CAST(sum(length(text)) AS BIGINT) AS total_length FROM documents",
    "row_count": "SELECT count(*) AS rows FROM events",
    "stream_latest": f"""WITH newest AS (
  SELECT {_phone("user_id")} AS msisdn, CASE WHEN event_type = 'error' THEN '$' ELSE {CELL} END AS cell_id, ts,
    row_number() OVER (PARTITION BY user_id ORDER BY {SECOND} DESC, event_id DESC) AS rn
  FROM events WHERE event_type <> 'signup')
SELECT msisdn, cell_id FROM newest
WHERE rn = 1 AND date_trunc('second', ts) > TIMESTAMP '2024-01-30' AND ts <= TIMESTAMP '2024-01-31'""",
    "late_signals": f"""{LOTS}
SELECT lot::BIGINT AS batch_id, msisdn, cell_id, strftime(t, '%Y%m%d%H%M%S') AS event_time,
  (epoch(mark) - epoch(t))::BIGINT AS lag_seconds, 1::BIGINT AS signals FROM judged WHERE outcome = 'late'""",
    "batch_counts": f"""{LOTS}
SELECT lot::BIGINT AS batch_id, strftime(any_value(mark), '%Y%m%d%H%M%S') AS watermark, count(*) AS signals,
  count(*) FILTER (outcome = 'located') AS located, count(DISTINCT msisdn) FILTER (outcome = 'located') AS kept,
  count(*) FILTER (outcome = 'late') AS late, count(*) FILTER (outcome = 'rejected') AS rejected
FROM judged GROUP BY lot""",
    "recomputed_times": f"""WITH {SIGNALS},
steps AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-15 11:00:00', TIMESTAMP '2024-01-15 15:00:00', INTERVAL 15 MINUTES)) AS t),
live AS (
  SELECT whole, t, msisdn, cell_id, row_number() OVER (PARTITION BY whole, t, msisdn ORDER BY ts DESC, event_id DESC) AS rn
  FROM signals JOIN steps ON ts <= t AND ts > t - INTERVAL 1 HOUR JOIN (VALUES (0), (1)) v(whole) ON whole = 1 OR event_id % 10 <> 0),
changed AS (SELECT DISTINCT t FROM (SELECT t, msisdn, cell_id FROM live WHERE rn = 1 GROUP BY ALL HAVING count(*) = 1)),
anew AS (
  SELECT t FROM (SELECT DISTINCT t FROM live)
  WHERE t IN (FROM changed) OR t - INTERVAL 15 MINUTES IN (FROM changed) OR (minute(t) = 0 AND t - INTERVAL 60 MINUTES IN (FROM changed)))
SELECT strftime(t, '%Y%m%d%H%M%S') AS stat_time, unnest(CASE WHEN minute(t) = 0 THEN ['current', 'stayed_15m', 'stayed_60m'] ELSE ['current', 'stayed_15m'] END) AS movement
FROM anew""",
    "closed_windows": f"""{LOTS},
counted AS (SELECT *, time_bucket(INTERVAL 15 MINUTES, t) AS w FROM judged WHERE event_type <> 'signup')
SELECT strftime(w, '%Y%m%d%H%M%S') AS window_start, cell_id, count(*) AS signals FROM counted
WHERE (mark IS NULL OR w + INTERVAL 15 MINUTES > mark) AND w + INTERVAL 15 MINUTES <= (SELECT mark FROM marks WHERE lot = 4)
GROUP BY ALL""",
    "expired_users": f"""{LOTS},
newest AS (
  SELECT u.msisdn, l.lot, max(max({{'t': t, 'e': event_id, 'c': cell_id}})) OVER (PARTITION BY u.msisdn ORDER BY l.lot) AS n
  FROM (SELECT DISTINCT msisdn FROM judged) u CROSS JOIN marks l
  LEFT JOIN judged j ON j.msisdn = u.msisdn AND j.lot = l.lot AND j.outcome = 'located' GROUP BY u.msisdn, l.lot)
SELECT DISTINCT msisdn, n.c AS cell_id, strftime(n.t + INTERVAL 1 HOUR, '%Y%m%d%H%M%S') AS expires
FROM newest JOIN marks m ON m.lot = newest.lot + 1 WHERE n.t + INTERVAL 1 HOUR <= m.mark""",
    "stats_roundtrip": f"{HARD} SELECT stat_time, level, area_id, label, value, cnt, branch FROM hard",
    "rebuilt_area_profile": f"""{HARD}, picked AS (
  SELECT *, row_number() OVER (PARTITION BY area_id, label, value
    ORDER BY CASE branch WHEN 'parent' THEN 3 WHEN 'cell' THEN 2 ELSE 1 END DESC) AS rn FROM hard WHERE level = 'sub')
SELECT area_id, label, '{{' || string_agg(CAST(to_json(value) AS VARCHAR) || ':' || cnt, ',' ORDER BY value) || '}}' AS profile_json
FROM picked WHERE rn = 1 GROUP BY area_id, label""",
    "movement_rerun": f"""WITH {_located_at("now")}, {PREFIXES}, {LABELS}, at_now AS (SELECT '{NOW}' AS stat_time, * FROM loc_now),
moves AS ({_movement_rows("at_now", "current")})
SELECT area_id, label, {JSON} AS profile_json, stat_time, movement FROM moves GROUP BY stat_time, movement, area_id, label""",
    "history_gaps": """SELECT strftime(t, '%Y%m%d%H%M%S') AS stat_time, minute(t) <> 0 AS absent
FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-15 11:00:00', TIMESTAMP '2024-01-15 12:00:00', INTERVAL 15 MINUTES)) AS t)
WHERE EXISTS (SELECT 1 FROM events)""",
    "stored_rejects": f"""
SELECT CASE event_type WHEN 'signup' THEN ',43020$' || (10000 + {K})
                       WHEN 'error' THEN {_phone("user_id")} || ','
                       ELSE {_phone("user_id")} || ',43020$' || (10000 + {K}) || ',' || event_type END AS line,
       CASE event_type WHEN 'signup' THEN 'no_msisdn' ELSE 'field_count' END AS reject_reason, '{NOW}' AS stat_time
FROM events WHERE event_type IN ('signup', 'error', 'purchase')""",
    "signal_outcomes": """SELECT CASE event_type WHEN 'signup' THEN 'no_msisdn' ELSE 'located' END AS outcome, count(*) AS n
FROM events GROUP BY ALL""",
    "typed_outcomes": """WITH p AS (
  SELECT c_custkey % 10 AS kind, c_name, c_custkey % 90 AS a, c_nationkey % 2 AS s FROM customer)
SELECT CASE kind WHEN 7 THEN c_name || ', junior' ELSE c_name END AS name,
  CASE WHEN kind IN (1, 5) THEN NULL ELSE CAST(a AS INTEGER) END AS age, CASE WHEN kind <> 2 THEN CAST(s AS VARCHAR) END AS sex,
  CASE kind WHEN 1 THEN c_name || ',old,' || s WHEN 2 THEN c_name || ',' || a WHEN 3 THEN c_name || ',' || a || ',' || s || ',' || s END AS line,
  CASE kind WHEN 1 THEN 'bad_value' WHEN 2 THEN 'field_count' WHEN 3 THEN 'field_count' END AS reject_reason
FROM p""",
    "uv_week_estimates": f"""{SEARCH_LOG} SELECT CAST(CAST(date_trunc('week', CAST(date AS DATE)) AS DATE) AS VARCHAR) AS week, keyword,
  count(DISTINCT "user") AS uv, true AS near FROM log GROUP BY ALL""",
    "bucketed_label_counts": f"""WITH {SIGNALS}, {_latest("latest_now", TIMES["now"][0])}, {_latest("latest_t60", TIMES["t60"][0])},
{_people("people_now", "latest_now", TIMES["now"][1])}, {_people("people_t60", "latest_t60", TIMES["t60"][1])},
people AS (FROM people_now UNION ALL FROM people_t60), {LABELS} {_counted(_label_rows("people", "cell_id"))}""",
    "allowed_orders": """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 25) AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 5000)""",
    "flow_files": """WITH adults AS (SELECT c_name AS name, c_custkey % 90 AS age, c_nationkey AS nation FROM customer WHERE c_custkey % 90 >= 18)
SELECT 'by_country' AS sink, name, n_name || '/' || age AS rest FROM adults JOIN nation ON n_nationkey = nation WHERE n_name <> 'CHINA'
UNION ALL SELECT 'aged', name, CAST(age AS VARCHAR) FROM adults""",
    "typed_people": """SELECT c_name AS name, CAST(c_custkey % 90 AS INTEGER) AS age, CAST(c_nationkey % 2 AS VARCHAR) AS sex FROM customer""",
    "exported_bridge": f"WITH {BRIDGES} SELECT from_id, to_id, CASE WHEN ratio = 1 THEN 0.0 ELSE ratio END::DOUBLE AS ratio FROM cell_grid",
}
for _same, _as in {
    "movement_job": "movement_profile", "snapshot_job": "profile_json", "history_job": "area_stats", "realtime_job": "current_profile_json",
    "backup_job": "snapshot", "configured_labels": "label_values", "compacted_latest": "stream_latest", "vacuumed_profiles": "movement_profile",
}.items():
    SQL[_same] = SQL[_as]
