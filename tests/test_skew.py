"""Splitting of hot keys: same results as without, whatever the split, and the plans."""

import random

import pytest
from pyspark.sql import functions as F

from data import passes, tuples, violations, police, limits_table
from roadstream.operators import skew
from roadstream.operators.clones import cloned_plates
from roadstream.operators.danger import dangerous_drivers
from roadstream.operators.ordered import following, latest, ordered, previous, total
from roadstream.operators.police import reconcile_slots
from roadstream.operators.speeding import monitor_limits
from roadstream.operators.tracks import only_violators


def skewed(seed, n=600, span=400_000):
    """Car HOT has a third of the rows, many of them at the very same time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        car = "HOT" if i % 3 == 0 else f"C{rng.randrange(40)}"
        t = 7_000 if car == "HOT" and rng.random() < 0.3 else rng.randrange(span)
        rows.append((car, t, str(rng.randrange(5)), rng.choice([10.0, 50.0, 80.25, 130.5])))
    return rows


def machine(rows, gap_ms):
    """The one-slot machine, row by row."""
    slot, alarms = {}, []
    for i, (car, t, m, _) in sorted(enumerate(rows), key=lambda r: (r[1][0], r[1][1], r[0])):
        if car not in slot:
            slot[car] = (t, m)
        elif (t - slot[car][0]) // 1000 * 1000 <= gap_ms:
            first = m if t == slot[car][0] else slot[car][1]
            alarms.append((car, first, m, slot.pop(car)[0], t))
        else:
            slot[car] = (t, m)
    return sorted(alarms)


CLONE = ["car", "first_monitor", "second_monitor", "first_time", "second_time"]
SPLITS = [{}, {"hot_rows": 100, "cell_rows": 30}, {"hot_rows": 5, "cell_rows": 7}]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("split", SPLITS)
def test_clones_agree_with_the_machine(spark, seed, split):
    rows = skewed(seed)
    got = tuples(cloned_plates(passes(spark, rows), **split), *CLONE)
    assert got == machine(rows, 10_000)


@pytest.mark.parametrize("mode", ["all", "longest"])
@pytest.mark.parametrize("split", SPLITS)
def test_pattern_agrees_with_brute_force(spark, mode, split):
    rows = skewed(7, n=240, span=900_000)
    limits = monitor_limits(limits_table(spark, [("0", 60), ("1", 100)]))
    by_monitor = {"0": 60, "1": 100}
    gross = {}
    for i, (car, t, m, v) in sorted(enumerate(rows), key=lambda r: (r[1][1], r[0])):
        if by_monitor.get(m, 60) * 1.2 < v:
            gross.setdefault(car, []).append((t, m, v))
    want = []
    for car, ps in gross.items():
        for i, (t, m, _) in enumerate(ps):
            ends = [j for j in range(i + 2, len(ps)) if ps[j][0] - t < 120_000]
            for j in ends if mode == "all" else ends[-1:]:
                units = sum(round(v * 100) for _, _, v in ps[i:j + 1])
                n = j - i + 1
                mean = (2 * units + n) // (2 * n) / 100
                want.append((car, i + 1, t, ps[j][0], m, ps[j][1], n, mean))
    got = dangerous_drivers(passes(spark, rows), limits, mode=mode, **split)
    assert tuples(got, "car", "start_no", "start_time", "end_time", "start_monitor",
                  "end_monitor", "pass_count", "avg_speed") == sorted(want)
    assert want


@pytest.mark.parametrize("split", SPLITS[1:])
def test_slots_do_not_depend_on_the_split(spark, split):
    rng = random.Random(3)
    v = violations(spark, [("HOT" if i % 2 else f"C{i % 9}", rng.randrange(300_000))
                           for i in range(250)])
    p = police(spark, [("HOT" if i % 2 else f"C{i % 9}", rng.randrange(300_000))
                       for i in range(250)])
    columns = ["car", "outcome", F.coalesce("create_time", F.lit(0)),
               F.coalesce("action_time", F.lit(0)), F.coalesce("police_id", F.lit(""))]
    assert tuples(reconcile_slots(v, p, **split), *columns) == tuples(
        reconcile_slots(v, p), *columns)


def test_scan_over_all_kinds(spark):
    df = spark.range(97).select(
        (F.col("id") % 2).alias("k"), F.col("id").alias("t"),
        F.when(F.col("id") % 11 == 0, F.col("id")).alias("mark"))
    values = {"sum": total(F.col("t")), "mark_now": latest(F.col("mark")),
              "prev": previous(F.col("t")), "next": following(F.col("t"))}
    plain = ordered(df, ["k"], ["t"]).scan(**values).result()
    columns = plain.columns
    split = ordered(df, ["k"], ["t"], hot_rows=10, cell_rows=5).scan(**values)
    assert split.cells.select("_cell").distinct().count() > 10

    def rows(frame):
        return sorted(map(str, map(tuple, frame.select(*columns).collect())))

    assert rows(split.result()) == rows(plain)


def test_hot_rows_are_scanned_where_they_are_stored(spark):
    """After the cells are stored no scan over them sorts or shuffles them again."""
    t = passes(spark, skewed(1))
    rows = ordered(t.select("car", "action_time", "event_id"), ["car"],
                   ["action_time", "event_id"], hot_rows=100, cell_rows=30)
    plan = rows.scan(n=total(F.lit(1))).cells._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(car#" not in plan.split("BroadcastExchange")[0]


def test_no_hot_key_no_cells(spark):
    assert ordered(passes(spark, skewed(1)), ["car"], ["action_time", "event_id"]).cells is None


def test_hot_keys_are_the_largest(spark):
    df = spark.range(100).select(F.when(F.col("id") < 50, 1).when(F.col("id") < 80, 2)
                                 .when(F.col("id") < 95, 3).alias("k"))
    got = [(r["k"], r["n"]) for r in skew.hot_keys(df, ["k"], 10)]
    assert got == [(1, 50), (2, 30), (3, 15)]
    assert [r["k"] for r in skew.hot_keys(df, ["k"], 10, share=3)] == [1]


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
def test_semi_join_without_broadcast(spark, hot_rows):
    t = passes(spark, skewed(2))
    listed = violations(spark, [("HOT", 1), ("HOT", 2), ("C1", 1), ("none", 1)])
    shuffled = only_violators(t, listed, broadcast_rows=0, hot_rows=hot_rows, salts=4)
    assert tuples(shuffled, "event_id") == tuples(only_violators(t, listed), "event_id")
    assert {r["car"] for r in shuffled.collect()} == {"HOT", "C1"}


def test_broadcast_is_counted(spark):
    df = spark.range(10).withColumn("s", F.repeat(F.lit("x"), 100))
    assert skew.fits_broadcast(df, max_rows=10)
    assert not skew.fits_broadcast(df, max_rows=9)
    assert not skew.fits_broadcast(df, max_bytes=1000)
