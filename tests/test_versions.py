"""Limits that change in time."""

import random

import pytest

from pyspark.sql import functions as F

from data import BASE, passes, tuples
from roadstream.operators import versions
from roadstream.operators.versions import speeding_at
from roadstream.sinks.writers import to_folder
from roadstream.sources.lines import parse_limit_version, parse_traffic, read_lines_stream
from roadstream.streaming import carried
from test_streaming import CLOSING, put

VERSIONS = "monitor_id string, speed_limit int, valid_from bigint"


def brute(rows, limits):
    out = []
    for i, (car, t, m, speed) in enumerate(rows):
        before = [(at, v or 0) for k, v, at in limits if k == m and k is not None and at is not None and at <= t]
        limit = max(before)[1] if before else 0
        if limit > 0 and limit * 1.1 < speed:
            out.append((car, t, m, speed, limit))
    return sorted(out)


def found(df):
    return tuples(df, "car", "action_time", "monitor_id", "real_speed", "limit_speed")


def sample(seed, n=300):
    rng = random.Random(seed)
    rows = [(f"C{rng.randrange(9)}", BASE + rng.randrange(200) * 100, rng.choice(["0001"] * 5 + ["0002", "0003"]), rng.choice([40.0, 66.0, 66.1, 90.0]))
            for _ in range(n)]
    limits = [(rng.choice(["0001", "0002"]), rng.choice([0, None, 40, 60, 80]), BASE + rng.randrange(200) * 100) for _ in range(40)]
    return rows, [*limits, (None, 10, BASE), ("0003", 10, None)]


@pytest.mark.parametrize("split", [{}, {"hot_rows": 5, "cell_rows": 20}])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, split):
    rows, limits = sample(seed)
    got = speeding_at(passes(spark, rows), spark.createDataFrame(limits, VERSIONS), **split)
    assert found(got) == brute(rows, limits)


def test_a_limit_taken_away_and_posted_again(spark):
    rows = [("A", BASE + t, "1", 70.0) for t in (0, 10, 20, 30, 40)]
    limits = [("1", 60, BASE + 10), ("1", 0, BASE + 20), ("1", 50, BASE + 40)]
    got = speeding_at(passes(spark, rows), spark.createDataFrame(limits, VERSIONS))
    assert found(got) == [("A", BASE + 10, "1", 70.0, 60), ("A", BASE + 40, "1", 70.0, 50)]
    assert speeding_at(passes(spark, rows), spark.createDataFrame([], VERSIONS)).count() == 0


def stream(spark, tmp_path, pass_batches, limit_batches, **split):
    rows = versions.merged(
        parse_traffic(read_lines_stream(spark, put(tmp_path / "passes", pass_batches), 1)),
        parse_limit_version(read_lines_stream(spark, put(tmp_path / "limits", limit_batches), 1)))
    carried.run_carried(
        rows, "at", 5_000, carried.speeding_step(**split), to_folder(f"{tmp_path}/out"), f"{tmp_path}/carried",
        clock=F.col("side") == versions.PASS_SIDE, trigger={"availableNow": True}).awaitTermination()
    return spark.read.parquet(f"{tmp_path}/out")


@pytest.mark.parametrize("split", [{}, {"hot_rows": 5, "cell_rows": 20}])
def test_open_versions_are_carried_over(spark, tmp_path, split):
    """Versions come in batches of their own; in later batches there are none at all."""
    rows, limits = sample(3)
    rows.sort(key=lambda r: r[1])
    limits = sorted((x for x in limits if x[0] and x[2]), key=lambda x: x[2])
    line = lambda r: f"{r[1]},{r[2]},1,{r[0]},{r[3]},1,1"
    batches = [[line(r) for r in rows if (r[1] - BASE) // 4000 == i] for i in range(5)] + [[f"{CLOSING}000,c,0,c,0,c,c"]]
    versions_ = [[f"{m},{v or 0},{at}" for m, v, at in limits if (at - BASE) // 4000 == i] for i in range(5)]
    got = stream(spark, tmp_path, batches, versions_, **split)
    assert found(got) == brute(rows, limits)
    last = max(int(p.name) for p in (tmp_path / "carried" / "kept").iterdir())
    kept = spark.read.parquet(f"{tmp_path}/carried/kept/{last}").where("side = 0")
    assert kept.count() == len({m for m, *_ in limits} - {m for m in ("0001", "0002") if max((at, v or 0) for k, v, at in limits if k == m)[1] == 0})


def test_versions_are_not_late_and_do_not_move_the_watermark(spark, tmp_path):
    """A version that arrives behind the watermark counts for the passes that are not judged yet."""
    row = "{},1,1,A,70.0,1,1"
    at = [[0], [60_000], [61_000, 120_000], [CLOSING * 1000 - BASE]]
    batches = [[row.format(BASE + t) for t in ts] for ts in at]
    limits = [[f"1,60,{BASE}"], [f"1,90,{BASE + 900_000}"], [f"1,40,{BASE + 10_000}", "1,x,5"], [f"1,0,{BASE + 121_000}"]]
    got = stream(spark, tmp_path, batches, limits)
    times = {t - BASE: limit for _, t, _, _, limit in found(got)}
    assert times == {0: 60, 60_000: 40, 61_000: 40, 120_000: 40}
