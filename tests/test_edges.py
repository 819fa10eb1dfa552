"""Boundaries and odd inputs of each operator, worked out by hand."""

import datetime

import pytest
from pyspark.sql import functions as F

from data import BASE, limits_table, lines, passes, police, tuples, violations
from roadstream.functions import messages
from roadstream.functions.scalar import (
    bit_offsets, day_start, floor_div, mean_speed, speed_units, track_row_key, with_event_time,
    with_warning_time,
)
from roadstream.operators.area import area_bloom_distinct, area_distinct, area_running_distinct
from roadstream.operators.clones import as_violations, cloned_plates, once_per_day
from roadstream.operators.danger import dangerous_drivers
from roadstream.operators.flow import avg_speed, congestion_topn
from roadstream.operators.police import interval_join, reconcile, reconcile_slots
from roadstream.operators.speeding import monitor_limits, speeding, with_limit
from roadstream.operators.tracks import car_tracks, latest_per_key, track_batches
from roadstream.schemas import POLICE_ACTION, TRAFFIC, VIOLATION
from roadstream.sources.lines import parse, parse_police, parse_traffic, parse_violation, rejected

CAR = "皖M16450"
DAY = 86400000

# (second, monitor, speed) in arrival order; clone alarms (first, second, seconds); matches.
BLOCKS = {
    "six in 27 s": (
        [(28, "0001", 116.3), (30, "0002", 116.3), (40, "0003", 116.3), (35, "0004", 116.3),
         (30, "0002", 116.3), (55, "0003", 116.3)],
        [("0001", "0002", 28, 30), ("0002", "0004", 30, 35)], 10),
    "same checkpoint": (
        [(28, "0001", 116.3), (31, "0001", 116.3), (35, "0008", 116.3), (140, "0009", 116.3)],
        [("0001", "0001", 28, 31)], 3),
    "out of order": (
        [(148, "0001", 116.3), (95, "0001", 50), (145, "0001", 116.3), (205, "0001", 116.3)],
        [("0001", "0001", 145, 148)], 1),
}


@pytest.mark.parametrize("name", BLOCKS)
def test_sample_blocks(spark, name):
    rows, alarms, n_matches = BLOCKS[name]
    wire = [f"{BASE + s * 1000},{m},16278,{CAR},{v},30,83" for s, m, v in rows]
    traffic = parse_traffic(lines(spark, wire))
    got = tuples(cloned_plates(traffic), "first_monitor", "second_monitor",
                 *[(F.col(c) - BASE) / 1000 for c in ("first_time", "second_time")])
    assert got == sorted(alarms)
    no_limits = monitor_limits(limits_table(spark, [("9999", 0)]))
    assert dangerous_drivers(traffic, no_limits).count() == n_matches


def test_clone_gap_is_cut_to_whole_seconds(spark):
    t = passes(spark, [("A", 0, "1", 1), ("A", 10_999, "2", 1), ("B", 0, "1", 1),
                       ("B", 11_000, "2", 1)])
    assert tuples(cloned_plates(t), "car") == [("A",)]


def test_clone_pass_is_used_once(spark):
    t = passes(spark, [("A", s * 1000, str(s), 1) for s in range(5)])
    got = tuples(cloned_plates(t), "first_monitor", "second_monitor")
    assert got == [("0", "1"), ("2", "3")]


def test_clone_tie_names_the_later_arrival_twice(spark):
    t = passes(spark, [("A", 5, "x", 1), ("A", 5, "y", 1)])
    assert tuples(cloned_plates(t), "first_monitor", "second_monitor") == [("y", "y")]


def test_once_per_day_is_half_open(spark):
    t = passes(spark, [("A", 10, "1", 1), ("A", 20, "2", 1), ("A", 90_000, "1", 1),
                       ("A", 91_000, "2", 1), ("A", DAY, "1", 1), ("A", DAY + 1, "2", 1)])
    new = as_violations(cloned_plates(t))
    assert tuples(once_per_day(new, violations(spark, [])), "create_time") == [(20,), (DAY + 1,)]
    # A row at the next midnight belongs to the next day alone.
    assert tuples(once_per_day(new, violations(spark, [("A", DAY)])), "create_time") == [(20,)]


def test_limits(spark):
    raw = limits_table(spark, [("1", 50), ("2", 0), ("3", 100)])
    limits = monitor_limits(raw)
    assert tuples(limits, "monitor_id") == [("1",), ("3",)]
    # 50 x 1.1 is 55.00000000000001 in double, 100 x 1.1 is 110.00000000000001.
    t = passes(spark, [("A", 1, "1", 55.0), ("B", 1, "1", 55.1), ("C", 1, "2", 200),
                       ("D", 1, "9", 200), ("E", 1, "3", 110.0), ("F", 1, "3", 110.01)])
    assert tuples(speeding(t, limits), "car", "limit_speed") == [("B", 50), ("F", 100)]
    assert tuples(with_limit(t, limits), "car", "limit_speed") == [
        ("A", 50), ("B", 50), ("C", 60), ("D", 60), ("E", 100), ("F", 100)]


def test_latest_limit_wins(spark):
    raw = limits_table(spark, [("1", 50), ("1", 30)]).withColumn(
        "version", F.when(F.col("speed_limit") == 30, 2).otherwise(1))
    assert tuples(monitor_limits(raw, "version"), "limit_speed") == [(30,)]


@pytest.mark.parametrize("how", ["speeding", "with_limit"])
@pytest.mark.parametrize("hot_rows", [2, 1_000])
def test_large_lookup_gives_the_same(spark, how, hot_rows):
    t = passes(spark, [(f"C{i}", i, "1" if i % 3 else str(i % 7), i) for i in range(60)])
    limits = monitor_limits(limits_table(spark, [(str(i), 10 * i) for i in range(6)]))
    op = {"speeding": speeding, "with_limit": with_limit}[how]
    columns = ["car", "action_time", "limit_speed"]
    shuffled = op(t, limits, broadcast_rows=0, hot_rows=hot_rows, salts=4)
    assert tuples(shuffled, *columns) == tuples(op(t, limits), *columns)


def test_average_windows(spark):
    t = passes(spark, [("A", BASE, "1", 10.0), ("B", BASE + 60_000, "1", 10.01)])
    got = tuples(avg_speed(t), "start_time", "end_time", "avg_speed", "car_count")
    first = BASE // 60_000 * 60_000 - 240_000
    assert [r[0] for r in got] == [first + 60_000 * i for i in range(6)]
    assert all(end - start == 300_000 for start, end, _, _ in got)
    # 10.005 is rounded half up.
    assert [r[2:] for r in got] == [(10.0, 1)] + [(10.01, 2)] * 4 + [(10.01, 1)]


@pytest.mark.parametrize("window,slide", [(300_000, 60_000), (10_000, 4_000), (6_000, 6_000)])
def test_average_of_any_window_and_slide(spark, window, slide):
    rows = [("A", BASE + 777 * i, str(i % 2), i % 50 + 0.25) for i in range(90)]
    got = tuples(avg_speed(passes(spark, rows), window, slide),
                 "start_time", "monitor_id", "avg_speed", "car_count")
    want = {}
    for _, t, m, v in rows:
        start = t // slide * slide
        while start > t - window:
            want.setdefault((start, m), []).append(v)
            start -= slide
    assert got == sorted(
        (*k, int(sum(v) / len(v) * 100 + 0.5) / 100, len(v)) for k, v in want.items())


def test_mean_is_half_up_on_both_sides_of_zero(spark):
    df = spark.createDataFrame([(1.005, 1.005), (-1.005, -1.005), (0.0, 0.0)], "a double, b double")
    two = mean_speed(speed_units(F.col("a")) + speed_units(F.col("b")), F.lit(2).cast("bigint"))
    assert [r[0] for r in df.select(two).collect()] == [1.01, -1.01, 0.0]


def test_top3_ties_go_by_checkpoint(spark):
    t = passes(spark, [("A", BASE, m, 1.0) for m in "dcbaa"])
    top = congestion_topn(t, window_ms=60_000, slide_ms=60_000)
    assert tuples(top, "rank", "monitor_id") == [(1, "a"), (2, "b"), (3, "c")]
    text = messages.congestion_messages(top).first()["message"]
    start = BASE // 60_000 * 60_000
    assert text == (f"在窗口{start} ----{start + 60_000} 时间范围内:整个城市最拥堵的前3个卡口是:"
                    "卡口:a,经过的车辆数量为:2,平均车速为:1.0"
                    "卡口:b,经过的车辆数量为:1,平均车速为:1.0"
                    "卡口:c,经过的车辆数量为:1,平均车速为:1.0")


def test_area_counts(spark):
    t = passes(spark, [("A", 0, "1", 1), ("A", 9_999, "1", 1), ("B", 9_999, "1", 1),
                       ("A", 10_000, "1", 1)])
    assert tuples(area_distinct(t), "window_start", "car_count") == [(0, 2), (10_000, 1)]
    assert tuples(area_running_distinct(t), "event_id", "car_count") == [
        (0, 1), (1, 1), (2, 2), (3, 2)]


def test_bloom_counts_follow_the_bit_vector(spark):
    """Against a plain bit vector, with one so short that cars do collide."""
    cars = [f"C{(i * i * 7 + i) % 83}" for i in range(300)]
    t = passes(spark, [(c, i, "1", 1) for i, c in enumerate(cars)])
    bits = 64
    at = {r["event_id"]: r["b"] for r in
          t.select("event_id", bit_offsets(F.col("car"), bits).alias("b")).collect()}
    seen, n, want = set(), 0, []
    for i in range(len(cars)):
        if not set(at[i]) <= seen:
            n += 1
            seen |= set(at[i])
        want.append((i, n))
    assert n < len(set(cars))
    assert tuples(area_bloom_distinct(t, bits=bits), "event_id", "car_count") == want
    split = area_bloom_distinct(t, bits=bits, hot_rows=10, cell_rows=40)
    assert tuples(split, "event_id", "car_count") == want


def test_pattern_bounds(spark):
    limits = monitor_limits(limits_table(spark, [("1", 60)]))
    fast = 72.1  # 60 x 1.2 is 72.0

    def matches(*rows, **kw):
        t = passes(spark, [("A", t, "1", v) for t, v in rows])
        return tuples(dangerous_drivers(t, limits, **kw), "start_time", "end_time", "pass_count")

    assert matches((0, fast), (1, fast), (119_999, fast)) == [(0, 119_999, 3)]
    assert matches((0, fast), (1, fast), (120_000, fast)) == []
    assert matches((0, fast), (1, 72.0), (2, fast), (3, fast)) == [(0, 3, 3)]
    assert matches((0, fast), (1, fast)) == []
    four = [(i, fast) for i in range(4)]
    assert matches(*four) == [(0, 2, 3), (0, 3, 4), (1, 3, 3)]
    assert matches(*four, mode="longest") == [(0, 3, 4), (1, 3, 3)]
    # Passes at the very same time count one by one.
    assert matches((5, fast), (5, fast), (5, fast)) == [(5, 5, 3)]


def test_pattern_text(spark):
    text = messages.danger_message(F.array(F.lit("0001"), F.lit("0002")))
    assert spark.range(1).select(text).first()[0] == (
        "该车辆涉嫌危险驾驶,第1个经过卡口是:0001 -->第2个经过卡口是:0002 -->")


def test_police_bounds_are_inclusive(spark):
    v = violations(spark, [("A", 10_000), ("B", 10_000)])
    p = police(spark, [("A", 5_000), ("A", 15_000), ("B", 4_999), ("B", 15_001), ("C", 10_000)])
    assert tuples(interval_join(v, p), "car", "action_time") == [("A", 5_000), ("A", 15_000)]
    assert tuples(reconcile(v, p), "outcome", "car", F.coalesce("action_time", F.lit(-1))) == [
        ("matched", "A", 5_000), ("matched", "A", 15_000), ("no_police", "B", -1),
        ("no_violation", "B", 4_999), ("no_violation", "B", 15_001), ("no_violation", "C", 10_000)]


def test_interval_need_not_be_symmetric(spark):
    v = violations(spark, [("A", 100_000)])
    p = police(spark, [("A", t) for t in range(80_000, 140_000, 1_000)])
    got = tuples(interval_join(v, p, lo_ms=3_000, hi_ms=17_000), "action_time")
    assert got == [(t,) for t in range(103_000, 118_000, 1_000)]


def test_slots(spark):
    v = violations(spark, [("A", 0), ("A", 1_000), ("B", 0), ("C", 0), ("D", 0), ("D", 9_000)])
    p = police(spark, [("A", 2_000), ("B", 5_001), ("C", 5_000), ("C", 6_000)])
    got = tuples(reconcile_slots(v, p), "car", "outcome", F.coalesce("create_time", F.lit(-1)),
                 F.coalesce("action_time", F.lit(-1)))
    assert got == [
        ("A", "matched", 1_000, 2_000), ("A", "replaced", 0, -1),
        ("B", "no_police", 0, -1), ("B", "no_violation", -1, 5_001),
        ("C", "matched", 0, 5_000), ("C", "no_violation", -1, 6_000),
        ("D", "no_police", 0, -1), ("D", "no_police", 9_000, -1)]


def test_tracks(spark):
    t = passes(spark, [("A", 1_592_722_028_000, "1", 5), ("B", 1, "1", 5),
                       ("A", 1_592_722_028_000, "2", 6)])
    tracks = car_tracks(t, violations(spark, [("A", 0), ("A", 1)]))
    key = "A_9223370444132747807"
    assert tuples(tracks, "row_key", "monitor_id") == [(key, "1"), (key, "2")]
    assert tuples(latest_per_key(tracks), "row_key", "monitor_id") == [(key, "2")]


def test_tracks_sort_newest_first(spark):
    keys = [r[0] for r in spark.range(10**12, 10**12 + 50).select(
        track_row_key(F.lit("A"), F.col("id")).alias("k")).orderBy("k").collect()]
    assert keys == [f"A_{2**63 - 1 - t}" for t in range(10**12 + 49, 10**12 - 1, -1)]


@pytest.mark.parametrize("n", [1, 9, 10, 25])
def test_batches_keep_the_tail(spark, n):
    t = passes(spark, [(f"C{i % 4}", 1000 - i, "1", 5) for i in range(n)])
    got = track_batches(t, size=10, cell_rows=6).orderBy("action_time").collect()
    assert [r["batch_id"] for r in got] == [i // 10 for i in range(n)]


def test_traffic_lines(spark):
    good = "1592674820000,0000,76022,京J96816,54.0,86,06"
    values = [good, good + ",extra", "", "交警出警记录数据", "1592674820000,0,1,京J,54.0,86",
              good + ",,", "1592674820000,0,1,京J,54.0,86,", "x,0,1,京J,54.0,86,06",
              " 1592674820000,0,1,京J,54.0,86,06", "1,0,1,京J,fast,86,06", "1.5,0,1,京J,5,86,06"]
    parsed = parse(lines(spark, values), TRAFFIC)
    assert parsed.count() == len(values)
    want = (1592674820000, "0000", "76022", "京J96816", 54.0, "86", "06")
    assert [tuple(r) for r in parse_traffic(lines(spark, values)).collect()] == [want] * 3
    assert sorted(r["reject_reason"] for r in rejected(parsed).collect()) == (
        ["bad number"] * 4 + ["too few fields"] * 4)


def test_other_lines(spark):
    p = parse_police(lines(spark, ["J0001,皖M16450,处理完成,1592722033000", "J0001,皖M16450"]))
    assert p.schema == POLICE_ACTION
    assert [tuple(r) for r in p.collect()] == [("J0001", "皖M16450", "处理完成", 1592722033000)]
    v = parse_violation(lines(spark, ["皖M16450,套牌车辆,1592722028000", "违法车辆数据"]))
    assert v.schema == VIOLATION
    assert [tuple(r) for r in v.collect()] == [("皖M16450", "套牌车辆", 1592722028000)]


def test_sample_violation_is_answered_at_the_bound(spark):
    v = parse_violation(lines(spark, ["皖M16450,套牌车辆,1592722028000"]))
    p = parse_police(lines(spark, ["J0001,皖M16450,处理完成,1592722033000",
                                   "J0002,鲁H37985,处理完成,1592515404000",
                                   "J0002,鲁H37987,处理完成,1592515404000"]))
    assert tuples(reconcile(v, p), "outcome", "car") == [
        ("matched", "皖M16450"), ("no_violation", "鲁H37985"), ("no_violation", "鲁H37987")]
    text = interval_join(v, p).select(messages.police_pair_message()).first()[0]
    assert text == ("车辆皖M16450,已经有交警出警了，警号为:J0001,出警的状态是：处理完成,"
                    "出警的时间:1592722033000")


def test_times(spark):
    row = spark.range(1).select(
        floor_div(F.lit(-1).cast("bigint"), 10).alias("f"),
        day_start(F.lit(DAY + 5).cast("bigint")).alias("d")).first()
    assert tuple(row) == (-1, DAY)
    ts = with_event_time(spark.range(1).withColumn("action_time", F.lit(1500).cast("bigint")))
    assert ts.select(F.unix_millis("event_ts")).first()[0] == 1500
    now = with_event_time(ts, mode="processing").select("event_ts").first()[0]
    assert abs(now - datetime.datetime.now()) < datetime.timedelta(days=2)
    with pytest.raises(ValueError):
        with_event_time(ts, mode="other")
    before = datetime.datetime.now(datetime.UTC).timestamp() * 1000
    assert with_warning_time(ts).first()["warned_at"] >= int(before)
