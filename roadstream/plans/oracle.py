"""The same results as plain SQL over the same tables, for checking. Written from the rules of
each result, not from the DataFrame plans."""

from roadstream.functions import messages as m


def _traffic(name: str, divisor: int) -> str:
    return f"""
{name} AS (
  SELECT event_id, event_type,
    1704067200000 + (epoch_us(ts) - 1704067200000000) // {divisor} AS action_time,
    lpad(((event_id*7919)%30)::VARCHAR,4,'0') AS monitor_id,
    lpad(((event_id*104729)%100000)::VARCHAR,5,'0') AS camera_id,
    concat('C', lpad(user_id::VARCHAR,5,'0')) AS car,
    value AS speed,
    lpad(((event_id*13)%12)::VARCHAR,2,'0') AS road_id,
    lpad(((event_id*31)%10)::VARCHAR,2,'0') AS area_id
  FROM events)"""


_LIMITS = """
limits AS (
  SELECT lpad(n_nationkey::VARCHAR,4,'0') AS monitor_id, ((n_nationkey % 5) * 20)::INTEGER AS limit_speed
  FROM nation WHERE (n_nationkey % 5) * 20 > 0)"""

_VIOLATION = """
violation AS (
  SELECT car, 'error' AS violation, action_time AS create_time FROM traffic WHERE event_type = 'error')"""

_SERIOUS = """
serious AS (SELECT car FROM traffic WHERE event_type = 'error' AND speed > 200)"""

_POLICE = """
police AS (
  SELECT 'J' || lpad((event_id % 50)::VARCHAR,4,'0') AS police_id, car, 'done' AS action_status, action_time
  FROM traffic WHERE event_type = 'purchase')"""

TRAFFIC = _traffic("traffic", 1_500_000)
RAW = _traffic("traffic", 1_000)


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_BASE = _with(TRAFFIC, _LIMITS, _VIOLATION, _POLICE)

_SPEEDING = _BASE + """
SELECT car, monitor_id, road_id, speed AS real_speed, limit_speed, action_time, event_id
FROM traffic JOIN limits USING (monitor_id)
WHERE limit_speed * 1.1::DOUBLE < speed"""

_VERSIONS = _with(TRAFFIC, """
given AS (
  SELECT lpad(n_nationkey::VARCHAR,4,'0') AS monitor_id, ((n_nationkey % 5) * 20)::INTEGER AS limit_speed,
    1704067200000 AS valid_from FROM nation
  UNION ALL
  SELECT monitor_id, (event_id % 6 * 20)::INTEGER, action_time FROM traffic WHERE event_type = 'signup'),
version AS (
  SELECT monitor_id, valid_from, max(limit_speed) AS limit_speed FROM given GROUP BY monitor_id, valid_from)""") + """
SELECT t.car, t.monitor_id, t.road_id, t.speed AS real_speed, v.limit_speed, t.action_time, t.event_id
FROM traffic t ASOF JOIN version v ON t.monitor_id = v.monitor_id AND t.action_time >= v.valid_from
WHERE v.limit_speed > 0 AND v.limit_speed * 1.1::DOUBLE < t.speed"""

_LIMITED = """
limited AS (
  SELECT car, monitor_id, road_id, speed AS real_speed, coalesce(limit_speed, 60) AS limit_speed,
    action_time, event_id
  FROM traffic LEFT JOIN limits USING (monitor_id))"""

# round(sum / n, 2), half up, in whole numbers.
_CENTS = "((2 * sum(cents) + count(*)) // (2 * count(*)))::DOUBLE / 100::DOUBLE"

_SLIDING = """
slid AS (
  SELECT (action_time // 60000 - k) * 60000 AS start_time, monitor_id,
    round(speed * 100)::BIGINT AS cents
  FROM traffic CROSS JOIN range(5) r(k)),
avgs AS (
  SELECT start_time, start_time + 300000 AS end_time, monitor_id,
    """ + _CENTS + """ AS avg_speed, count(*) AS car_count
  FROM slid GROUP BY start_time, monitor_id)"""

_TOP = """
ranked AS (
  SELECT row_number() OVER (PARTITION BY start_time ORDER BY car_count DESC, monitor_id) AS rank, *
  FROM avgs),
top3 AS (SELECT * FROM ranked WHERE rank <= 3)"""

_RUNNING = """
firsts AS (
  SELECT *, action_time // 600000 * 600000 AS window_start,
    (row_number() OVER (PARTITION BY area_id, action_time // 600000, car
                        ORDER BY action_time, event_id) = 1)::INTEGER AS is_first
  FROM traffic),
running AS (
  SELECT area_id, window_start, window_start + 600000 AS window_end, action_time, event_id, car,
    (sum(is_first) OVER (PARTITION BY area_id, window_start ORDER BY action_time, event_id
                         ROWS UNBOUNDED PRECEDING))::BIGINT AS car_count
  FROM firsts)"""


def _clones(gap_sec: int, order: str = "action_time, event_id") -> str:
    return f"""
lagged AS (
  SELECT *, lag(action_time) OVER w AS prev_time, lag(monitor_id) OVER w AS prev_monitor
  FROM traffic WINDOW w AS (PARTITION BY car ORDER BY {order})),
runs AS (
  SELECT *, sum(CASE WHEN prev_time IS NULL OR (action_time - prev_time) // 1000 > {gap_sec}
                     THEN 1 ELSE 0 END)
      OVER (PARTITION BY car ORDER BY {order}) AS run
  FROM lagged),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY car, run ORDER BY {order}) AS place
  FROM runs),
clones AS (
  SELECT car, CASE WHEN action_time = prev_time THEN monitor_id ELSE prev_monitor END AS first_monitor,
    monitor_id AS second_monitor, '{m.CLONED}' AS msg,
    prev_time AS first_time, action_time AS second_time
  FROM placed WHERE place % 2 = 0)"""


def _gross(order: str = "action_time, event_id") -> str:
    return _LIMITED + f""",
gross AS (
  SELECT car, monitor_id, action_time, round(real_speed * 100)::BIGINT AS cents,
    row_number() OVER (PARTITION BY car ORDER BY {order}) AS no
  FROM limited WHERE limit_speed * 1.2::DOUBLE < real_speed),
sums AS (
  SELECT *, sum(cents) OVER (PARTITION BY car ORDER BY no) AS total FROM gross),
pairs AS (
  SELECT a.car, a.no AS start_no, a.action_time AS start_time, b.action_time AS end_time,
    a.monitor_id AS start_monitor, b.monitor_id AS end_monitor, b.no - a.no + 1 AS pass_count,
    ((2 * (b.total - a.total + a.cents) + b.no - a.no + 1) // (2 * (b.no - a.no + 1)))::DOUBLE
      / 100::DOUBLE AS avg_speed
  FROM sums a JOIN sums b
    ON a.car = b.car AND b.no - a.no >= 2 AND b.action_time - a.action_time < 120000),
longest AS (
  SELECT * FROM pairs p
  QUALIFY row_number() OVER (PARTITION BY car, start_no ORDER BY pass_count DESC) = 1)"""


_GROSS = _gross()

_RUNNING_SQL = _with(TRAFFIC, _RUNNING) + """
SELECT *, window_end || '_' || area_id AS window_key FROM running"""
_CLONES_SQL = _with(TRAFFIC, _clones(10)) + " SELECT * FROM clones"
_GROSS_BASE = _with(TRAFFIC, _LIMITS, _GROSS)
_LONGEST_SQL = _GROSS_BASE + " SELECT * FROM longest"

_NEAR = "v.car = p.car AND p.action_time - v.create_time BETWEEN -5000 AND 5000"

_SLOTS_SQL = _BASE + """,
sides AS (
  SELECT car, create_time AS at_ms, 0 AS side, violation, create_time,
    NULL AS police_id, NULL AS action_status, NULL::BIGINT AS action_time FROM violation
  UNION ALL
  SELECT car, action_time, 1, NULL, NULL, police_id, action_status, action_time FROM police),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY car
    ORDER BY at_ms, side, violation, create_time, police_id, action_status, action_time) AS no
  FROM sides),
lagged AS (
  SELECT *, coalesce(side <> lag(side) OVER w AND at_ms - lag(at_ms) OVER w <= 5000, false) AS fits
  FROM numbered WINDOW w AS (PARTITION BY car ORDER BY no)),
placed AS (
  SELECT *, no - max(CASE WHEN fits THEN 0 ELSE no END) OVER (PARTITION BY car ORDER BY no) AS place
  FROM lagged),
known AS (
  SELECT a.*, a.place % 2 = 1 AS second, coalesce(b.fits, false) AS next_fits,
    coalesce(b.at_ms - a.at_ms <= 5000, false) AS next_soon
  FROM placed a LEFT JOIN placed b ON a.car = b.car AND b.no = a.no + 1)
SELECT 'matched' AS outcome, b.car, coalesce(a.violation, b.violation) AS violation,
  coalesce(a.create_time, b.create_time) AS create_time, coalesce(a.police_id, b.police_id) AS police_id,
  coalesce(a.action_status, b.action_status) AS action_status,
  coalesce(a.action_time, b.action_time) AS action_time
FROM known b JOIN known a ON a.car = b.car AND a.no = b.no - 1 WHERE b.second
UNION ALL
SELECT CASE WHEN next_soon THEN 'replaced' WHEN side = 0 THEN 'no_police' ELSE 'no_violation' END,
  car, violation, create_time, police_id, action_status, action_time
FROM known WHERE NOT second AND NOT next_fits"""

_TRACKS = """
tracks AS (
  SELECT car || '_' || (9223372036854775807 - action_time) AS row_key, car, action_time, monitor_id,
    road_id, area_id, speed, event_id
  FROM traffic t WHERE EXISTS (SELECT 1 FROM violation v WHERE v.car = t.car))"""

ORACLE: dict[str, str] = {
    "speeding": _SPEEDING,
    "speeding_large_lookup": _SPEEDING,
    "with_default_limit": _BASE + "," + _LIMITED + " SELECT * FROM limited",
    "avg_speed_sliding": _with(TRAFFIC, _SLIDING) + " SELECT * FROM avgs",
    "congestion_top3": _with(TRAFFIC, _SLIDING, _TOP) + " SELECT * FROM top3",
    "congestion_messages": _with(TRAFFIC, _SLIDING, _TOP) + """
SELECT start_time, end_time,
  concat('在窗口', start_time, ' ----', end_time, ' 时间范围内:', '整个城市最拥堵的前3个卡口是:',
    string_agg(concat('卡口:', monitor_id, ',经过的车辆数量为:', car_count, ',平均车速为:', avg_speed),
               '' ORDER BY rank)) AS message
FROM top3 GROUP BY start_time, end_time""",
    "area_distinct_10s": _with(TRAFFIC) + """
SELECT area_id, window_start, window_start + 10000 AS window_end, car_count,
  concat('区域', area_id, ',在窗口其实时间', window_start, ',到窗口结束时间', window_start + 10000,
         ' ,一共有', car_count, ' 辆车') AS message
FROM (SELECT area_id, action_time // 10000 * 10000 AS window_start, count(DISTINCT car) AS car_count
      FROM traffic GROUP BY 1, 2)""",
    "area_running_distinct": _RUNNING_SQL,
    "area_running_distinct_split": _RUNNING_SQL,
    # With so few cars per vector, two cars do not share both bits: the exact count holds.
    "area_bloom_distinct": _with(TRAFFIC, _RUNNING) + " SELECT * FROM running",
    "cloned_plates": _CLONES_SQL,
    "cloned_plates_split": _CLONES_SQL,
    "clone_once_per_day": _with(RAW, _VIOLATION, _clones(6 * 3600)) + """
SELECT car, msg AS violation, min(second_time) AS create_time FROM clones c
WHERE NOT EXISTS (SELECT 1 FROM violation v
                  WHERE v.car = c.car AND v.create_time // 86400000 = c.second_time // 86400000)
GROUP BY car, msg, second_time // 86400000""",
    "dangerous_drivers_all": _GROSS_BASE + " SELECT * FROM pairs",
    "dangerous_drivers_longest": _LONGEST_SQL,
    "dangerous_drivers_longest_split": _LONGEST_SQL,
    "dangerous_driver_messages": _GROSS_BASE + """
SELECT l.car, l.start_no, l.pass_count,
  '该车辆涉嫌危险驾驶,' || string_agg(concat('第', g.no - l.start_no + 1, '个经过卡口是:', g.monitor_id, ' -->'),
                               '' ORDER BY g.no) AS message
FROM longest l JOIN gross g
  ON g.car = l.car AND g.no BETWEEN l.start_no AND l.start_no + l.pass_count - 1
GROUP BY l.car, l.start_no, l.pass_count""",
    "violation_police_interval": _BASE + f"""
SELECT v.car, violation, create_time, police_id, action_status, action_time,
  concat('车辆', v.car, ',已经有交警出警了，警号为:', police_id, ',出警的状态是：', action_status,
         ',出警的时间:', action_time) AS message
FROM violation v JOIN police p ON {_NEAR}""",
    "violation_police_reconcile": _BASE + f"""
SELECT CASE WHEN p.car IS NULL THEN 'no_police' WHEN v.car IS NULL THEN 'no_violation'
            ELSE 'matched' END AS outcome,
  coalesce(v.car, p.car) AS car, violation, create_time, police_id, action_status, action_time,
  CASE WHEN v.car IS NOT NULL AND p.car IS NOT NULL THEN
    concat('该违法车辆', v.car, '，违法时间', create_time, ',已经有交警出警了，警号为:', police_id,
           ',出警的状态是：', action_status, ',出警的时间:', action_time) END AS message
FROM violation v FULL OUTER JOIN police p ON {_NEAR}""",
    "violation_police_slots": _SLOTS_SQL,
    "violation_police_slots_split": _SLOTS_SQL,
    "car_tracks": _BASE + "," + _TRACKS + " SELECT * FROM tracks",
    "speeding_versions": _VERSIONS,
    "speeding_versions_split": _VERSIONS,
    "area_approx_within": _with(TRAFFIC) + """
SELECT area_id, action_time // 600000 * 600000 AS window_start, window_start + 600000 AS window_end,
  count(DISTINCT car) AS car_count, true AS within
FROM traffic GROUP BY 1, 2""",
    "area_sketch_windows": _with(TRAFFIC) + """
SELECT area_id, (action_time // 60000 - k) * 60000 AS window_start, window_start + 300000 AS window_end,
  count(DISTINCT car) AS car_count, true AS within
FROM traffic CROSS JOIN range(5) r(k) GROUP BY 1, 2""",
    "car_tracks_few": _BASE + "," + _SERIOUS + "," + _TRACKS.replace("violation", "serious") + " SELECT * FROM tracks",
    "car_tracks_large_list": _BASE + "," + _SERIOUS + "," + _TRACKS.replace("violation", "serious") + " SELECT * FROM tracks",
    "track_store": _with(TRAFFIC.replace("AS action_time,", "// 60000 * 60000 AS action_time,"), _SERIOUS) + "," + _TRACKS.replace("violation", "serious") + """
SELECT row_key, car, action_time, monitor_id, road_id, area_id, speed FROM tracks
QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY event_id DESC) = 1""",
    "car_tracks_latest": _BASE + "," + _TRACKS + """
SELECT row_key, car, action_time, monitor_id, road_id, area_id, speed FROM tracks
QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY event_id DESC) = 1""",
    "track_batches": _BASE + "," + _TRACKS + """
SELECT event_id, row_key, (row_number() OVER (ORDER BY action_time, event_id) - 1) // 10 AS batch_id
FROM tracks""",
    "parse_traffic_lines": _with(TRAFFIC) + """
, judged AS (
  SELECT *, CASE event_type WHEN 'purchase' THEN 'too few fields'
                            WHEN 'signup' THEN 'bad number' END AS reject_reason
  FROM traffic)
SELECT event_id, reject_reason,
  CASE WHEN reject_reason IS NULL THEN action_time END AS action_time,
  CASE WHEN reject_reason IS NULL THEN monitor_id END AS monitor_id,
  CASE WHEN reject_reason IS NULL THEN camera_id END AS camera_id,
  CASE WHEN reject_reason IS NULL THEN car END AS car,
  CASE WHEN reject_reason IS NULL THEN speed END AS speed,
  CASE WHEN reject_reason IS NULL THEN road_id END AS road_id,
  CASE WHEN reject_reason IS NULL THEN area_id END AS area_id
FROM judged""",
    "parse_violation_police": _BASE + """
SELECT 'violation' AS kind, car, violation, create_time, NULL AS police_id, NULL AS action_status,
  NULL::BIGINT AS action_time FROM violation
UNION ALL
SELECT 'police', car, NULL, NULL, police_id, action_status, action_time FROM police""",
}

# The streams. Wire lines have no event id: equal times are ordered by the other fields.
_BY_FIELDS = "action_time, monitor_id, camera_id, speed, road_id, area_id"
_BY_AREA = "action_time, monitor_id, camera_id, speed, road_id, car"
_GROSS_STREAM = _with(TRAFFIC, _LIMITS, _gross("action_time, monitor_id, road_id, cents"))
_MATCH = "car, start_time, end_time, start_monitor, end_monitor, pass_count, avg_speed"
_PAIR = "violation, create_time, police_id, action_status, action_time"

ORACLE |= {
    "speeding_stream": f"""
SELECT car, monitor_id, road_id, real_speed, limit_speed, action_time FROM ({_SPEEDING})""",
    "avg_speed_stream": ORACLE["avg_speed_sliding"],
    "congestion_top3_stream": ORACLE["congestion_top3"],
    "area_distinct_stream": f"""
SELECT area_id, window_start, window_end, car_count FROM ({ORACLE["area_distinct_10s"]})""",
    "area_running_stream": _with(TRAFFIC) + f"""
, firsts AS (
  SELECT *, action_time // 600000 * 600000 AS window_start,
    (row_number() OVER (PARTITION BY area_id, action_time // 600000, car ORDER BY {_BY_AREA}) = 1)::INTEGER AS is_first
  FROM traffic),
counted AS (
  SELECT area_id, window_start, window_start + 600000 AS window_end, {_BY_AREA},
    (sum(is_first) OVER (PARTITION BY area_id, window_start ORDER BY {_BY_AREA}
                         ROWS UNBOUNDED PRECEDING))::BIGINT AS car_count
  FROM firsts)
SELECT *, printf('{m.AREA_COUNT}', area_id, window_start, window_end, car_count) AS message FROM counted""",
    "area_counts_store_stream": _with(TRAFFIC) + """
SELECT area_id, action_time // 600000 * 600000 + 600000 AS window_end,
  count(DISTINCT car) AS car_count, window_end || '_' || area_id AS window_key
FROM traffic GROUP BY 1, 2""",
    "speeding_versions_stream": f"""
SELECT car, monitor_id, road_id, real_speed, limit_speed, action_time FROM ({_VERSIONS})""",
    "avg_speed_late_stream": ORACLE["avg_speed_sliding"],
    "clone_once_per_day_stream": _with(RAW, _clones(6 * 3600, _BY_FIELDS)) + """
SELECT car, msg AS violation, min(second_time) AS create_time FROM clones
GROUP BY car, msg, second_time // 86400000""",
    "track_batches_stream": _BASE + "," + _TRACKS + """
SELECT * EXCLUDE (event_id),
  (row_number() OVER (ORDER BY action_time, monitor_id, speed, road_id, area_id, car) - 1) // 10 AS batch_id
FROM tracks""",
    "cloned_plates_stream": _with(TRAFFIC, _clones(10, _BY_FIELDS)) + " SELECT * FROM clones",
    "dangerous_drivers_all_stream": _GROSS_STREAM + f" SELECT {_MATCH} FROM pairs",
    "dangerous_drivers_longest_stream": _GROSS_STREAM + f" SELECT {_MATCH} FROM longest",
    "violation_police_interval_stream": _BASE + f"""
SELECT v.car, {_PAIR} FROM violation v JOIN police p ON {_NEAR}""",
    "violation_police_reconcile_stream": f"""
SELECT outcome, car, {_PAIR} FROM ({ORACLE["violation_police_reconcile"]})""",
    "violation_police_slots_stream": _SLOTS_SQL,
    "car_tracks_stream": _BASE + "," + _TRACKS + " SELECT * EXCLUDE (event_id) FROM tracks",
}

for _name in ("cloned_plates", "dangerous_drivers_all", "dangerous_drivers_longest",
              "violation_police_slots"):
    ORACLE[f"{_name}_state"] = ORACLE[f"{_name}_stream"]
