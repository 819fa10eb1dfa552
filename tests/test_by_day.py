"""Violations stored by day."""

import random

import pytest

from data import tuples, violations
from roadstream.operators.clones import once_per_day
from roadstream.schemas import VIOLATION_COLUMNS
from roadstream.sinks import by_day
from roadstream.sinks.by_day import DayStore, to_days

DAY = 86_400_000
START = 1704067200000


def batches(spark, n=4, seed=3):
    """Rows in order of time, each micro-batch with days of the one before; one car has a third."""
    rng = random.Random(seed)
    rows = sorted((START + rng.randrange(8 * DAY), rng.choice(["HOT", "HOT", "HOT", *map(str, range(6))]))
                  for _ in range(200))
    step = len(rows) // n
    return [violations(spark, [(c, t) for t, c in rows[i:i + step]]) for i in range(0, len(rows), step)]


def expected(spark, parts):
    table = parts[0]
    for p in parts[1:]:
        table = table.unionByName(p)
    return tuples(once_per_day(table, table.limit(0)), *VIOLATION_COLUMNS)


@pytest.mark.parametrize("merge_every", [1, 2, 100])
def test_first_per_car_and_day(spark, tmp_path, merge_every):
    parts = batches(spark)
    store = DayStore(spark, str(tmp_path))
    put = to_days(store, merge_every)
    for i, part in enumerate(parts):
        put(part, i)
        put(part, i)  # as after a failure
    got = tuples(store.read(), *VIOLATION_COLUMNS)
    assert got == expected(spark, parts) and 20 < len(got) < 200


def test_a_merge_that_fails_harms_nothing(spark, tmp_path, monkeypatch):
    parts = batches(spark)
    store = DayStore(spark, str(tmp_path))
    put = to_days(store, merge_every=2)
    put(parts[0], 0)
    written = by_day._overwrite

    def fails(rows, path, number):
        if path.endswith("marks"):
            raise OSError("lost")
        written(rows, path, number)

    monkeypatch.setattr(by_day, "_overwrite", fails)
    with pytest.raises(OSError):
        put(parts[1], 1)  # merged, but the mark is missing
    assert tuples(store.read(), *VIOLATION_COLUMNS) == expected(spark, parts[:2])
    monkeypatch.undo()
    for i in (1, 2, 3):
        put(parts[i], i)
    assert tuples(store.read(), *VIOLATION_COLUMNS) == expected(spark, parts)


def test_only_days_of_the_batch_are_read(spark, tmp_path, capsys):
    parts = batches(spark)
    store = DayStore(spark, str(tmp_path))
    put = to_days(store, merge_every=2)
    for i, part in enumerate(parts[:3]):
        put(part, i)
    days = store.days_of(parts[3])
    assert 1 <= len(days) < 8
    read = store.read(days, before=3)
    read.explain("formatted")
    filters = [x for x in capsys.readouterr().out.splitlines() if x.startswith("PartitionFilters")]
    assert filters and all("day#" in f and " IN " in f for f in filters), filters
    listed = {f"2024-01-{i:02d}" for i in range(1, 9) if f"2024-01-{i:02d}" in filters[0]}
    assert listed == {str(d) for d in days}
    # Of days that were merged, what the merge took in is left out by folder.
    store.read(store.days_of(parts[1]), before=3).explain("formatted")
    assert "batch_id" in capsys.readouterr().out


def test_nulls_and_empty(spark, tmp_path):
    store = DayStore(spark, str(tmp_path))
    put = to_days(store, 1)
    assert store.read().isEmpty()
    put(violations(spark, []), 0)
    assert store.read().isEmpty()
    put(violations(spark, [("a", START), ("b", None), (None, START)]), 1)
    assert store.read().count() == 3
    assert store.read(store.days_of(violations(spark, [("b", None)]))).count() == 1
