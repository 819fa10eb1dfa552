"""Streams with many checkpoints, busy cars and unlike slices."""

import io
import random
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from data import BASE, lines, tuples
from roadstream.operators.flow import congestion_topn
from roadstream.operators.police import interval_join, reconcile
from roadstream.operators.tracks import car_tracks, track_batches
from roadstream.plans import streams
from roadstream.sinks.writers import read_folder
from roadstream.sources.lines import parse_police, parse_traffic, parse_violation, read_lines_stream
from test_streaming import CLOSING, flat, put, run, traffic_batches


def plan_of(df) -> list[str]:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue().splitlines()


def test_passes_are_not_copied_to_windows(spark, tmp_path):
    plan = plan_of(streams.avg_speed_job(read_lines_stream(spark, put(tmp_path / "in", [["x"]]), 1)))
    steps = [x for x in plan if any(w in x for w in ("Exchange", "Expand", "FileScan", "MicroBatchScan", "StreamingRelation"))]
    copies = [i for i, x in enumerate(steps) if "Expand" in x]
    shuffles = [i for i, x in enumerate(steps) if "Exchange" in x]
    assert copies and max(copies) < max(shuffles), plan  # the plan begins with its last step


def test_many_checkpoints_in_a_slide(spark, tmp_path):
    """A hundred thousand checkpoints: each state row holds those of a shard, or three a shard."""
    n = 100_000
    rows = spark.range(n + 400).selectExpr(
        f"concat({BASE} + id % 50000, ',M', if(id < {n}, id, id % 7 * 13), ',1,C', id, ',', id % 90, ',01,01') AS value")
    rows.coalesce(1).write.text(str(tmp_path / "in"))
    (tmp_path / "in" / "z.txt").write_text(f"{CLOSING}000,closing,0,closing,0,closing,closing\n")
    got = run(spark, streams.congestion_job, tmp_path, lines=str(tmp_path / "in"))
    want = congestion_topn(parse_traffic(rows))
    assert tuples(got, *want.columns) == tuples(want, *want.columns)
    assert want.count() >= 15


@pytest.mark.parametrize("name", ["interval", "reconcile"])
def test_a_car_with_a_third_of_all_rows(spark, tmp_path, name):
    rng = random.Random(4)
    cars = ["UNREAD", *[f"C{i}" for i in range(40)]]
    pick = lambda: cars[0] if rng.random() < 0.34 else rng.choice(cars)
    v = [f"{pick()},speeding,{BASE + 700 * i}" for i in range(400)]
    p = [f"J{i:04d},{pick()},done,{BASE + 700 * i + 123}" for i in range(400)]
    job, op = {"interval": (streams.police_match_job, interval_join),
               "reconcile": (streams.reconcile_job, reconcile)}[name]
    v_in = put(tmp_path / "v", [v[:200], v[200:], [f"closing v,v,{CLOSING}000"]])
    p_in = put(tmp_path / "p", [p[:200], p[200:], [f"J,closing p,done,{CLOSING}000"]])
    sides = {"violation_lines": v_in, "police_lines": p_in}
    got = run(spark, job, tmp_path, **sides)
    want = op(parse_violation(lines(spark, v)), parse_police(lines(spark, p)))
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in want.columns]
    assert tuples(got, *text) == tuples(want, *text)
    # The state is kept by car and bucket: the busy car's rows go to many of them.
    plan = plan_of(job(**{k: read_lines_stream(spark, x, 1) for k, x in sides.items()}))
    keys = [x for x in plan if "hashpartitioning" in x]
    assert keys and all("bucket" in x for x in keys)


@pytest.mark.parametrize("cuts", [(120,), (7, 8, 9, 100), tuple(range(15, 240, 45))])
def test_track_batches_go_on_over_micro_batches(spark, tmp_path, cuts):
    values = flat(traffic_batches(n=237))
    listed = parse_violation(lines(spark, ["HOT,v,1", "C1,v,2"]))
    bounds = [0, *cuts, len(values)]
    batches = [values[a:b] for a, b in zip(bounds, bounds[1:])]
    folder = str(tmp_path / "run")
    stream = read_lines_stream(spark, put(tmp_path / "in", [*batches, [f"{CLOSING}000,closing,0,closing,0,closing,closing"]]), 1)
    streams.track_batches_carried(folder, stream, listed, streams.DAY_MS).awaitTermination()
    want = track_batches(car_tracks(parse_traffic(lines(spark, values)), listed))
    got = spark.read.parquet(f"{folder}/out")
    assert tuples(got, "row_key", "monitor_id", "track_batch") == tuples(want, "row_key", "monitor_id", "batch_id")
    # All but the last, short one are written whole, by one micro-batch.
    sizes = got.groupBy("track_batch", "batch_id").count().orderBy("track_batch").collect()
    assert all(r["count"] == 10 for r in sizes[:-1]) and 0 < sizes[-1]["count"] < 10


def test_an_open_track_batch_waits(spark, tmp_path):
    """Without a bound on the wait the last, short batch stays open."""
    values = flat(traffic_batches(n=115))
    listed = parse_violation(lines(spark, ["HOT,v,1"]))
    folder = str(tmp_path / "run")
    stream = read_lines_stream(spark, put(tmp_path / "in", [values[:40], values[40:], [
        f"{CLOSING}000,closing,0,closing,0,closing,closing"]]), 1)
    streams.track_batches_carried(folder, stream, listed).awaitTermination()
    n = car_tracks(parse_traffic(lines(spark, values)), listed).count()
    out = spark.read.parquet(f"{folder}/out")
    assert out.count() == n // 10 * 10 and n % 10 > 0
    kept = spark.read.parquet(f"{folder}/carried/kept/2")
    assert kept.where(~F.col("done")).count() == n % 10
    assert read_folder(spark, f"{folder}/out", out.drop("batch_id").schema).count() == out.count()
