"""Late passes: reported, and the windows they touch written over, and only these."""

import random

import pytest
from pyspark.sql import functions as F

from data import BASE, lines, tuples
from roadstream.operators.flow import avg_speed
from roadstream.plans import streams
from roadstream.schemas import AVG_SPEED, AVG_SPEED_COLUMNS
from roadstream.sinks.writers import read_folder, to_folder
from roadstream.sources.lines import parse_traffic, read_lines_stream
from roadstream.streaming.late import average_store, run_corrected
from test_streaming import CLOSING, put

MINUTE = 60_000
START = BASE - BASE % MINUTE


def line(ms, monitor, speed):
    return f"{ms},{monitor},1,C1,{speed},01,01"


def closing():
    return line(CLOSING * 1000, "closing", 0)


def run(spark, tmp_path, batches, name="run"):
    folder = str(tmp_path / name)
    stream = read_lines_stream(spark, put(tmp_path / f"{name}-in", batches), 1)
    streams.corrected_averages(folder, stream, to_folder(f"{folder}/late")).awaitTermination()
    return folder


def stored(spark, folder):
    return average_store(spark, f"{folder}/store").read()


@pytest.mark.parametrize("seed", [1, 2])
def test_corrected_windows_equal_the_table(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(START + 4_000 * i, f"{rng.randrange(3):04d}", rng.choice([20.5, 70.0, 99.25])) for i in range(400)]
    arrival = sorted(rows, key=lambda r: r[0] + rng.choice([0, 0, 0, 400_000, 900_000]))
    values = [line(*r) for r in arrival]
    batches = [*[values[i:i + 100] for i in range(0, 400, 100)], [closing()]]
    folder = run(spark, tmp_path, batches)
    want = avg_speed(parse_traffic(lines(spark, values)))
    assert tuples(stored(spark, folder), *AVG_SPEED_COLUMNS) == tuples(want, *AVG_SPEED_COLUMNS)

    # What is late, by the newest pass of the micro-batches before.
    late, newest = set(), None
    for batch in batches:
        times = [int(v.split(",")[0]) for v in batch]
        late |= {(t, newest - 5_000 - t) for t in times if newest is not None and t <= newest - 5_000}
        newest = max([*times, newest or 0])
    got = read_folder(spark, f"{folder}/late", parse_traffic(lines(spark, [])).schema.add("behind_ms", "long"))
    assert len(late) > 20 and set(tuples(got, "action_time", "behind_ms")) == late


def test_only_touched_windows_are_written_again(spark, tmp_path):
    first = [line(START + MINUTE * i, m, 50.0) for i in range(30) for m in ("a", "b")]
    batches = [first, [line(START + 30 * MINUTE, "a", 50.0)], [line(START + 10 * MINUTE + 1, "a", 80.0)]]
    folder = run(spark, tmp_path, batches)
    again = spark.read.parquet(f"{folder}/store/changes/batch_id=2")
    touched = [(START + k * MINUTE, "a") for k in range(6, 11)]
    assert tuples(again, "start_time", "monitor_id") == touched
    assert {r["car_count"] for r in again.collect()} == {6}
    # A pass at minute 30 moved the watermark by one minute: one window closed for each checkpoint.
    second = spark.read.parquet(f"{folder}/store/changes/batch_id=1")
    assert tuples(second, "end_time", "monitor_id") == [(START + 29 * MINUTE, "a"), (START + 29 * MINUTE, "b")]


def test_a_repeated_micro_batch_counts_once(spark, tmp_path):
    """As after a failure: the same rows under the same id, with the panes of the first try there."""
    folder = str(tmp_path / "f")
    calls = []

    class Table:  # hands run_corrected's function for a micro-batch over
        isStreaming = False

    import roadstream.streaming.late as late

    original, late.write = late.write, lambda df, each, *a, **k: calls.append(each)
    try:
        store = average_store(spark, f"{folder}/store")
        run_corrected(Table(), store.put, folder)
    finally:
        late.write = original
    each = calls[0]
    values = [[line(START + MINUTE * i, "a", 40.0 + i) for i in range(12)],
              [line(START + MINUTE * 3 + 5, "a", 99.0), line(START + MINUTE * 20, "a", 10.0)]]
    first, second = (parse_traffic(lines(spark, v)) for v in values)
    each(first, 0)
    each(second, 1)
    once = tuples(stored(spark, folder), *AVG_SPEED_COLUMNS)
    each(second, 1)
    assert tuples(stored(spark, folder), *AVG_SPEED_COLUMNS) == once
    table = avg_speed(parse_traffic(lines(spark, values[0] + values[1])))
    due = table.where(F.col("end_time") <= START + MINUTE * 20 - 5_000)
    assert once == tuples(due, *AVG_SPEED_COLUMNS)


def test_empty_micro_batches(spark, tmp_path):
    folder = run(spark, tmp_path, [["bad line"], [line(START, "a", 50.0)], ["bad line"], [closing()]])
    assert stored(spark, folder).count() == 5
    assert stored(spark, folder).schema.fieldNames() == AVG_SPEED.fieldNames()
