"""Streams in many micro-batches: drained, they give what the table operators give."""

import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from data import BASE, limits_table, lines, tuples
from roadstream.operators.area import area_approx_distinct, area_distinct
from roadstream.operators.clones import cloned_plates, once_per_day
from roadstream.operators.danger import dangerous_drivers, gross_passes
from roadstream.operators.flow import avg_speed, congestion_topn
from roadstream.operators.police import interval_join, reconcile, reconcile_slots
from roadstream.operators.speeding import monitor_limits, speeding
from roadstream.operators.tracks import car_tracks
from roadstream.plans import streams
from roadstream.sinks.writers import (
    read_folder, stored_violations, to_folder, write, write_area_counts,
    write_violation_once_per_day,
)
from roadstream.sources.lines import (
    parse_police, parse_traffic, parse_violation, read_lines, read_lines_stream,
)
from roadstream.streaming import carried
from roadstream.streaming.area_counts import area_running_stream, area_totals
from roadstream.streaming.machines import ClonePairs, GrossRuns, Slots
from roadstream.streaming.watermark import IN_ORDER, with_watermark

CLOSING = 4102444800


def put(folder: Path, batches: list[list[str]]) -> str:
    """One file per batch; the stream takes them by modification time."""
    import os

    folder.mkdir(parents=True)
    for i, values in enumerate(batches):
        f = folder / f"{i:03d}.txt"
        f.write_text("\n".join(values) + "\n", encoding="utf-8")
        os.utime(f, (1_600_000_000 + i, 1_600_000_000 + i))
    return str(folder)


def run(spark, job, out, output_mode="append", **paths):
    inputs = {k: read_lines_stream(spark, p, max_files_per_trigger=1) for k, p in paths.items()}
    result = job(**inputs)
    query = write(result, to_folder(f"{out}/out"), f"{out}/checkpoint", output_mode,
                  {"availableNow": True})
    query.awaitTermination()
    return read_folder(spark, f"{out}/out", result.schema)


def traffic_batches(seed=1, n=240, n_batches=6, shuffle_ms=0):
    rng = random.Random(seed)
    rows = [(BASE + 1_500 * i, f"{rng.randrange(4):04d}", f"{i:05d}",
             rng.choice(["HOT", "HOT", *[f"C{j}" for j in range(8)]]),
             rng.choice([20.5, 70.0, 75.25, 99.0]), "01", f"{rng.randrange(3):02d}")
            for i in range(n)]
    rows.sort(key=lambda r: r[0] + rng.randint(0, shuffle_ms))
    values = [",".join(map(str, r)) for r in rows]
    step = -(-n // n_batches)
    batches = [values[i:i + step] for i in range(0, n, step)]
    batches[1] += ["", "交警出警记录数据"]  # bad lines do not stop a stream
    return [*batches, [f"{CLOSING}000,closing,0,closing,0,closing,closing"]]


def flat(batches):
    return [v for b in batches[:-1] for v in b]


LIMITS = [("0000", 60), ("0001", 80)]


@pytest.mark.parametrize("name", ["speeding", "avg_speed", "congestion", "area", "danger_all",
                                  "danger_longest"])
def test_within_the_delay(spark, tmp_path, name):
    """Rows up to five seconds behind, across micro-batches."""
    batches = traffic_batches(shuffle_ms=0 if name == "area" else 4_000)
    limits = monitor_limits(limits_table(spark, LIMITS))
    table = parse_traffic(lines(spark, flat(batches)))
    jobs = {
        "speeding": (lambda lines: streams.speeding_job(lines, limits), speeding(table, limits)),
        "avg_speed": (streams.avg_speed_job, avg_speed(table)),
        "congestion": (streams.congestion_job, congestion_topn(table)),
        "area": (streams.area_job, area_distinct(table)),
        "danger_all": (lambda lines: streams.danger_job(lines, limits), dangerous_drivers(table, limits)),
        "danger_longest": (lambda lines: streams.danger_job(lines, limits, "longest"),
                           dangerous_drivers(table, limits, mode="longest")),
    }
    job, want = jobs[name]
    got = run(spark, job, tmp_path, lines=put(tmp_path / "in", batches))
    columns = [c for c in got.columns if c != "batch_id"]
    assert tuples(got, *columns) == tuples(want, *columns)
    assert want.count() > 0


def test_clones_in_order(spark, tmp_path):
    batches = traffic_batches()
    want = cloned_plates(parse_traffic(lines(spark, flat(batches))))
    got = run(spark, streams.clones_job, tmp_path, lines=put(tmp_path / "in", batches))
    assert tuples(got, *want.columns) == tuples(want, *want.columns)
    assert got.select("batch_id").distinct().count() > 2  # alarms come while the stream runs


def police_batches():
    rng = random.Random(5)
    v = [(f"C{rng.randrange(6)}", BASE + 900 * i) for i in range(120)]
    p = [(f"C{rng.randrange(6)}", BASE + 900 * i + 333) for i in range(120)]
    v_lines = [f"{c},speeding,{t}" for c, t in v]
    p_lines = [f"J{i:04d},{c},done,{t}" for i, (c, t) in enumerate(p)]
    cut = [slice(i, i + 30) for i in range(0, 120, 30)]
    return (
        [*[v_lines[s] for s in cut], [f"closing v,v,{CLOSING}000"]],
        [*[p_lines[s] for s in cut], [f"J,closing p,done,{CLOSING}000"]],
    )


@pytest.mark.parametrize("name", ["interval", "reconcile", "slots"])
def test_police(spark, tmp_path, name):
    v_batches, p_batches = police_batches()
    v = parse_violation(lines(spark, flat(v_batches)))
    p = parse_police(lines(spark, flat(p_batches)))
    job, op = {
        "interval": (streams.police_match_job, interval_join),
        "reconcile": (streams.reconcile_job, reconcile),
        "slots": (streams.slots_job, reconcile_slots),
    }[name]
    got = run(spark, job, tmp_path, violation_lines=put(tmp_path / "v", v_batches),
              police_lines=put(tmp_path / "p", p_batches))
    want = op(v, p)

    def rows(df):
        return tuples(df, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                            for c in want.columns])

    assert rows(got) == rows(want)
    if name != "interval":
        assert {r["outcome"] for r in want.collect()} >= {"matched", "no_police", "no_violation"}


def test_tracks(spark, tmp_path):
    batches = traffic_batches()
    listed = parse_violation(lines(spark, ["HOT,v,1", "C1,v,2"]))
    got = run(spark, lambda lines: streams.tracks_job(lines, listed), tmp_path,
              lines=put(tmp_path / "in", batches))
    want = car_tracks(parse_traffic(lines(spark, flat(batches))), listed)
    assert tuples(got, *want.columns) == tuples(want, *want.columns)


@pytest.mark.parametrize("bits", [1 << 16, 1 << 10])
def test_area_running_counts(spark, tmp_path, bits):
    batches = traffic_batches(n=120)
    in_path = put(tmp_path / "in", batches)
    stream = with_watermark(parse_traffic(read_lines_stream(spark, in_path, 1)), IN_ORDER)
    counts = area_running_stream(stream, window_ms=60_000, bits=bits, shards=2)
    write_area_counts(counts, to_folder(f"{tmp_path}/out"), f"{tmp_path}/checkpoint",
                      trigger={"availableNow": True}).awaitTermination()
    stored = read_folder(spark, f"{tmp_path}/out", counts.schema)
    want = area_distinct(parse_traffic(lines(spark, flat(batches))), 60_000)
    got = area_totals(stored).where(F.col("window_end") < CLOSING * 1000)
    columns = ["area_id", "window_end", "car_count"]
    assert tuples(got, *columns) == tuples(want, *columns)
    # Counts are out before the windows end, and only ever grow.
    per_batch = stored.groupBy("area_id", "window_end", "shard").agg(
        F.sort_array(F.collect_list(F.struct("batch_id", "car_count"))).alias("c"))
    seen = [[r["car_count"] for r in row["c"]] for row in per_batch.collect()]
    assert all(c == sorted(c) for c in seen) and max(map(len, seen)) > 1


def test_area_sketches_grow_with_the_stream(spark, tmp_path):
    batches = traffic_batches()
    got = run(spark, streams.area_approx_job, tmp_path, "update",
              lines=put(tmp_path / "in", batches))
    keys = ["area_id", "window_start", "window_end"]
    final = got.groupBy(*keys).agg(F.max("car_count").alias("car_count"))
    want = area_approx_distinct(parse_traffic(lines(spark, flat(batches))))
    closed = final.where(F.col("window_end") < CLOSING * 1000)
    assert tuples(closed, *keys, "car_count") == tuples(want, *keys, "car_count")
    assert got.count() > final.count()


def test_state_is_left_only_where_needed(spark, tmp_path):
    """Once the watermark is past every row, no car is remembered."""
    batches = traffic_batches()
    in_path = put(tmp_path / "in", batches)
    result = streams.clones_job(read_lines_stream(spark, in_path, 1))
    query = write(result, to_folder(f"{tmp_path}/out"), f"{tmp_path}/checkpoint",
                  trigger={"availableNow": True})
    query.awaitTermination()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(states) > 1 and states[-1] <= 1  # the closing row itself


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    batches = traffic_batches()
    folder = tmp_path / "in"
    put(folder, batches[:3])
    run(spark, streams.clones_job, tmp_path, lines=str(folder))
    for i, values in enumerate(batches[3:]):
        (folder / f"{i + 3:03d}.txt").write_text("\n".join(values) + "\n", encoding="utf-8")
        run(spark, streams.clones_job, tmp_path, lines=str(folder))
    got = run(spark, streams.clones_job, tmp_path, lines=str(folder))
    want = cloned_plates(parse_traffic(lines(spark, flat(batches))))
    assert tuples(got, *want.columns) == tuples(want, *want.columns)


def test_executors_need_no_copy_of_the_package(tmp_path):
    """The state functions run where the package cannot be imported."""
    script = tmp_path / "job.py"
    repo = Path(__file__).resolve().parents[1]
    script.write_text(f"""
import sys
sys.path.insert(0, {str(repo)!r})
from roadstream.session import build_session
from roadstream.plans import streams
spark = build_session("elsewhere", "local[2]", spark__ui__enabled="false")
rows = [f"{{1592722000000 + 1000 * i}},1,1,A,1.0,1,1" for i in range(4)]
rows.append("4102444800000,1,1,closing,1.0,1,1")
lines = spark.createDataFrame([(int(r.split(",")[0]), r) for r in rows], "at bigint, value string")
print("alarms", streams.drain(spark, {{"lines": lines}}, streams.to_results(streams.clones_job)).count())
""")
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True,
                          text=True, timeout=300)
    assert "alarms 2" in done.stdout, done.stderr[-2000:]


def test_bounded_file(spark, tmp_path):
    path = put(tmp_path / "in", traffic_batches())
    assert parse_traffic(read_lines(spark, path)).count() == 241


def test_processing_time_needs_no_event_order(spark, tmp_path):
    batches = traffic_batches(shuffle_ms=500_000)
    got = run(spark, lambda lines: streams.area_job(lines, "processing"), tmp_path,
              lines=put(tmp_path / "in", batches))
    assert set(got.columns) == {"area_id", "window_start", "window_end", "car_count", "batch_id"}


def test_limits_follow_their_table(spark, tmp_path):
    """A limit that comes, changes and goes while the stream runs."""
    folder = tmp_path / "in"
    limits = {}

    def read_limits():
        rows = [("none", 0), *limits.items()]
        return monitor_limits(limits_table(spark, rows))

    for i, now in enumerate([{}, {"0001": 100}, {"0001": 60}, {}]):
        folder.mkdir(exist_ok=True)
        (folder / f"{i}.txt").write_text(f"{BASE + i},0001,1,A{i},80.0,01,01\n")
        limits.clear()
        limits.update(now)
        streams.run_speeding(
            read_lines_stream(spark, str(folder)), read_limits, to_folder(f"{tmp_path}/out"),
            f"{tmp_path}/checkpoint", {"availableNow": True}).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert tuples(got, "car", "limit_speed") == [("A2", 60)]


def test_clones_reach_the_violation_list_once_a_day(spark, tmp_path):
    batches = traffic_batches()
    path = str(tmp_path / "store")
    alarms = streams.clone_violations_job(
        read_lines_stream(spark, put(tmp_path / "in", batches), 1))
    write_violation_once_per_day(
        alarms, stored_violations(spark, path), to_folder(path), f"{tmp_path}/checkpoint",
        trigger={"availableNow": True}).awaitTermination()
    table = streams.clone_violations_job(lines(spark, flat(batches)))
    want = once_per_day(table, table.limit(0))
    stored = read_folder(spark, path, want.schema)
    assert tuples(stored, *want.columns) == tuples(want, *want.columns)
    assert 1 < want.count() < table.count()


def test_a_stream_needs_a_checkpoint(spark, tmp_path):
    stream = read_lines_stream(spark, put(tmp_path / "in", [["x"]]))
    with pytest.raises(ValueError):
        write(stream, to_folder(f"{tmp_path}/out"))


@pytest.mark.parametrize("job", ["clones_job", "danger_job"])
def test_jobs_also_take_tables(spark, job):
    batches = traffic_batches()
    limits = [monitor_limits(limits_table(spark, LIMITS))] if job == "danger_job" else []
    assert getattr(streams, job)(lines(spark, flat(batches)), *limits).count() > 0


@pytest.mark.parametrize("split", [{}, {"hot_rows": 4, "cell_rows": 3}])
@pytest.mark.parametrize("name", ["clones", "danger_all", "danger_longest"])
def test_carried_rows(spark, tmp_path, name, split):
    """Micro-batches through the table operators, late rows, and hot cars in every batch."""
    batches = traffic_batches(n=150, n_batches=4, shuffle_ms=4_000)
    limits = monitor_limits(limits_table(spark, LIMITS))
    table = parse_traffic(lines(spark, flat(batches)))
    stream = parse_traffic(read_lines_stream(spark, put(tmp_path / "in", batches), 1))
    kw = {}
    if name == "clones":
        stream, step, want = carried.clone_rows(stream), carried.clone_step(**split), (
            cloned_plates(table))
    else:
        mode = name.removeprefix("danger_")
        step = carried.danger_step(mode, **split)
        kw["prepare"] = lambda batch: gross_passes(batch, limits)
        want = dangerous_drivers(table, limits, mode=mode).drop("start_no")
    carried.run_carried(
        stream, "action_time", 5_000, step, to_folder(f"{tmp_path}/out"), f"{tmp_path}/carried",
        trigger={"availableNow": True}, **kw).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert tuples(got, *want.columns) == tuples(want, *want.columns)
    assert got.select("batch_id").distinct().count() > 2
    # Only what may still matter is carried over: at the end, nothing but the closing row.
    last = max(int(p.name) for p in (tmp_path / "carried" / "kept").iterdir())
    assert spark.read.parquet(f"{tmp_path}/carried/kept/{last}").count() <= 1


def test_carried_rows_drop_what_is_late(spark, tmp_path):
    row = "{},1,1,A,1.0,1,1"
    at = [[BASE, BASE + 60_000], [BASE + 1_000, BASE + 61_000], [CLOSING * 1000]]
    batches = [[row.format(t) for t in ts] for ts in at]
    stream = parse_traffic(read_lines_stream(spark, put(tmp_path / "in", batches), 1))
    carried.run_carried(
        carried.clone_rows(stream), "action_time", 5_000, carried.clone_step(),
        to_folder(f"{tmp_path}/out"), f"{tmp_path}/carried",
        trigger={"availableNow": True}).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert tuples(got, "first_time", "second_time") == [(BASE + 60_000, BASE + 61_000)]


@pytest.mark.parametrize("split", [{}, {"hot_rows": 4, "cell_rows": 3}])
def test_carried_slots(spark, tmp_path, split):
    v_batches, p_batches = police_batches()
    v_path, p_path = put(tmp_path / "v", v_batches), put(tmp_path / "p", p_batches)
    rows = carried.slot_sides(parse_violation(read_lines_stream(spark, v_path, 1)),
                              parse_police(read_lines_stream(spark, p_path, 1)))
    carried.run_carried(
        rows, "at", 2_000, carried.slot_step(**split), to_folder(f"{tmp_path}/out"),
        f"{tmp_path}/carried", sides="side", trigger={"availableNow": True}).awaitTermination()
    want = reconcile_slots(parse_violation(lines(spark, flat(v_batches))),
                           parse_police(lines(spark, flat(p_batches))))
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in want.columns]
    got = spark.read.parquet(f"{tmp_path}/out")
    assert tuples(got, *columns) == tuples(want, *columns)


# The machines by themselves.


def feed(machine, rows, end):
    memory, out = None, []
    for row in rows:
        memory, emitted = machine.step(memory, row)
        out += emitted
    if memory is not None:
        memory, emitted = machine.expire(memory, end)
        out += emitted
    return memory, out


def test_clone_memory_expires_when_no_pass_can_match():
    row = {"action_time": 1_000, "monitor_id": "1"}
    assert ClonePairs().expire(row, 11_999) == (row, [])
    assert ClonePairs().expire(row, 12_000) == (None, [])


def test_gross_memory_holds_two_minutes():
    rows = [{"action_time": 50_000 * i, "monitor_id": str(i), "units": 1_000_000}
            for i in range(6)]
    memory, out = feed(GrossRuns(), rows, 250_000)
    assert [m[0] for m in memory] == [150_000, 200_000, 250_000]
    assert [(o[0], o[1]) for o in out] == [(50_000 * i, 50_000 * i + 100_000) for i in range(4)]


def test_slot_waits_to_the_bound():
    row = dict.fromkeys(["violation", "create_time", "police_id", "action_status", "action_time"])
    v = {**row, "at": 0, "side": 0}
    assert Slots().expire(v, 4_999)[0] == v
    memory, out = Slots().expire(v, 5_000)
    assert memory is None and out[0][0] == "no_police"


