"""State machines over many cars: what a micro-batch costs does not go by their number."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from data import BASE, limits_table, lines, tuples
from roadstream.operators.clones import cloned_plates
from roadstream.operators.danger import dangerous_drivers
from roadstream.operators.police import SLOT_FIELDS, reconcile_slots
from roadstream.operators.speeding import monitor_limits
from roadstream.plans import streams
from roadstream.sinks.writers import read_folder, to_folder, write
from roadstream.sources.lines import parse_police, parse_traffic, parse_violation, read_lines_stream
from roadstream.streaming import replay
from roadstream.streaming.machines import Slots
from test_streaming import CLOSING, LIMITS, flat, put, run, traffic_batches

CARS = 3 * replay.SHARDS


def test_calls_do_not_grow_with_cars(spark, tmp_path):
    values = [f"{BASE + 20 * i},{i % 30:04d},1,C{i % CARS},50.0,01,01" for i in range(2 * CARS)]
    in_path = put(tmp_path / "in", [values, [f"{CLOSING}000,closing,0,closing,0,closing,closing"]])
    result = streams.clones_job(read_lines_stream(spark, in_path, 1))
    query = write(result, to_folder(f"{tmp_path}/out"), f"{tmp_path}/checkpoint",
                  trigger={"availableNow": True})
    query.awaitTermination()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    # A state row is a call from Spark, in this micro-batch or a later one.
    assert 1 < max(states) <= replay.SHARDS and states[-1] <= 1
    want = cloned_plates(parse_traffic(lines(spark, values)))
    assert tuples(read_folder(spark, f"{tmp_path}/out", result.schema), *want.columns) == tuples(want, *want.columns)


@pytest.mark.parametrize("name", ["clones", "all", "longest", "slots"])
def test_cars_of_one_shard_are_apart(spark, tmp_path, monkeypatch, name):
    """All cars in one shard, an empty plate among them: each has its own memory."""
    monkeypatch.setattr(replay.replay, "__defaults__", (1,))
    batches = traffic_batches(seed=7)
    batches[2] += [f"{BASE + 131_000 + 500 * i},000{i % 2},1,,99.0,01,01" for i in range(6)]
    limits = monitor_limits(limits_table(spark, LIMITS))
    table = lines(spark, flat(batches))
    if name == "slots":
        v = [f"C{i * i % 7},speeding,{BASE + 700 * i}" for i in range(200)]
        p = [f"J{i:04d},C{i * i % 11},done,{BASE + 700 * i + 123}" for i in range(200)]
        sides = {"violation_lines": put(tmp_path / "v", [v[:90], v[90:], [f"closing v,v,{CLOSING}000"]]),
                 "police_lines": put(tmp_path / "p", [p[:110], p[110:], [f"J,closing p,done,{CLOSING}000"]])}
        got = run(spark, streams.slots_job, tmp_path, **sides)
        want = reconcile_slots(parse_violation(lines(spark, v)), parse_police(lines(spark, p)))
    else:
        in_path = put(tmp_path / "in", batches)
        if name == "clones":
            got = run(spark, streams.clones_job, tmp_path, lines=in_path)
            want = cloned_plates(parse_traffic(table))
        else:
            got = run(spark, lambda lines: streams.danger_job(lines, limits, name), tmp_path, lines=in_path)
            want = dangerous_drivers(parse_traffic(table), limits, mode=name).drop("start_no")
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in want.columns]
    assert tuples(got, *text) == tuples(want, *text)
    assert want.count() > 3


def test_a_state_slice_keeps_the_cores_busy(spark):
    """A full slice of the jobs with state machines has more than the four tasks that any slice has."""
    with streams._state_partitions(spark, streams.BYTES_PER_STATE_SLICE // streams.BYTES_PER_STATE_PARTITION):
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= 24


def test_results_of_a_call_come_in_lists(spark, tmp_path, monkeypatch):
    """PySpark's cost by row of a frame exceeds the machine's, so a frame row holds many results."""

    class State:
        exists = False
        getCurrentWatermarkMs = staticmethod(lambda: CLOSING * 1000)

    n = 2 * replay.ROWS_IN_LIST + 500
    fields = ["at", "side", *SLOT_FIELDS]
    names = ["car", "outcome", *SLOT_FIELDS]
    call = replay._runner("car", "at", fields, fields, ["at", "side"], Slots(), names)
    rows = [(f"C{i % 7}", i, 0, *["x"] * len(SLOT_FIELDS)) for i in range(n)]
    frames = list(call((0,), [pd.DataFrame(rows, columns=["car", *fields])], State()))
    assert sum(map(len, frames)) == 3
    assert sum(map(len, frames[0]["outcome"])) == n

    monkeypatch.setattr(replay.replay, "__defaults__", (1,))
    v = [f"C{i % 7},speeding,{BASE + i}" for i in range(n)] + [f",speeding,{BASE}"]
    p = [f"J1,C{i % 5},done,{BASE + 3 * i}" for i in range(n // 5)]
    sides = {"violation_lines": put(tmp_path / "v", [v, [f"closing v,v,{CLOSING}000"]]),
             "police_lines": put(tmp_path / "p", [p, [f"J,closing p,done,{CLOSING}000"]])}
    got = run(spark, streams.slots_job, tmp_path, **sides)
    want = reconcile_slots(parse_violation(lines(spark, v)), parse_police(lines(spark, p)))
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in want.columns]
    assert got.dtypes[:2] == [("outcome", "string"), ("car", "string")]
    assert tuples(got, *text) == tuples(want, *text)
    assert want.count() > 2 * replay.ROWS_IN_LIST
