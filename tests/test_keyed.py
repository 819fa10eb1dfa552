"""The folder store of one row per key, and running counts that go on over micro-batches."""

import random
import re

import pytest
from pyspark.sql import functions as F

from data import lines, tuples
from roadstream.operators.area import area_running_distinct, area_sketches, merged_sketches
from roadstream.schemas import AREA_COUNT
from roadstream.sinks.keyed import KeyedStore
from roadstream.sinks.writers import latest_counts, to_folder, to_keyed_store
from roadstream.sources.lines import parse_traffic, read_lines_stream
from roadstream.streaming import carried
from test_streaming import flat, put, traffic_batches

ROW = "window_end bigint, area_id string, car_count bigint"


def rows(spark, values):
    return spark.createDataFrame(values, ROW)


def content(df):
    return sorted(map(tuple, df.select("window_end", "area_id", "car_count").collect()), key=str)


def store_at(spark, path):
    return KeyedStore(spark, str(path), ["window_end", "area_id"], AREA_COUNT, buckets=5)


def test_the_latest_batch_of_a_key_counts(spark, tmp_path):
    store, want = store_at(spark, tmp_path), {}
    assert content(store.read()) == []
    rng = random.Random(4)
    for batch_id in range(6):
        batch = {(rng.randrange(4), rng.choice(["a", "b", None])): rng.randrange(1000) for _ in range(6)}
        for _ in range(1 + batch_id % 2):  # every other one is repeated
            store.put(rows(spark, [(*k, v) for k, v in batch.items()]), batch_id)
        want |= batch
        assert content(store.read()) == sorted(((*k, v) for k, v in want.items()), key=str)
        if batch_id % 3 == 1:
            store.compact()
            assert content(store.read()) == sorted(((*k, v) for k, v in want.items()), key=str)
    store.compact()
    store.vacuum()
    again = KeyedStore(spark, str(tmp_path), ["window_end", "area_id"], AREA_COUNT, buckets=99)
    assert again.buckets == 5  # as it was made
    assert content(again.read()) == sorted(((*k, v) for k, v in want.items()), key=str)
    assert not list((tmp_path / "changes").glob("batch_id=*")) and len(list((tmp_path / "base").glob("upto=*"))) == 1


def test_a_failed_compaction_harms_nothing(spark, tmp_path, monkeypatch):
    store = store_at(spark, tmp_path)
    store.put(rows(spark, [(1, "a", 1), (2, "b", 2)]), 0)
    store.compact()
    store.put(rows(spark, [(1, "a", 5)]), 1)
    (tmp_path / "base" / "upto=1" / "bucket=0").mkdir(parents=True)  # begun, never committed
    assert content(store.read()) == [(1, "a", 5), (2, "b", 2)]
    (tmp_path / "committed" / "upto=1").mkdir()  # named, but the mark itself was not written
    assert content(store.read()) == [(1, "a", 5), (2, "b", 2)]
    store.compact()
    store.vacuum()
    assert content(store.read()) == [(1, "a", 5), (2, "b", 2)]
    store.put(rows(spark, [(2, "b", 9)]), 1)  # a repeated micro-batch that the base already holds
    assert content(store.read()) == [(1, "a", 5), (2, "b", 2)]


def test_a_lookup_reads_its_buckets_only(spark, tmp_path):
    store = store_at(spark, tmp_path)
    store.put(rows(spark, [(i, "a", i) for i in range(50)] + [(7, None, 70)]), 0)
    store.compact()
    store.put(rows(spark, [(3, "a", 33)]), 1)
    found = store.lookup(spark.createDataFrame([(3, "a"), (7, None), (99, "z")], "window_end bigint, area_id string"))
    assert content(found) == [(3, "a", 33), (7, None, 70)]
    one = store.lookup(spark.createDataFrame([(3, "a")], "window_end bigint, area_id string"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^\]]*bucket#\d+ (IN|=)", plan)) == plan.count("FileScan") >= 2


def test_counts_in_the_store_after_a_stream(spark, tmp_path):
    batches = traffic_batches(n=150, n_batches=4)
    store = store_at(spark, tmp_path / "store")
    stream = parse_traffic(read_lines_stream(spark, put(tmp_path / "in", batches), 1))
    carried.run_carried(
        carried.running_rows(stream), "action_time", 0, carried.running_step(60_000),
        latest_counts(to_keyed_store(store, 2)), f"{tmp_path}/carried", trigger={"availableNow": True}).awaitTermination()
    table = parse_traffic(lines(spark, flat(batches)))
    want = area_running_distinct(table, 60_000).groupBy("window_end", "area_id").agg(F.max("car_count").alias("car_count"))
    assert content(store.read().where("area_id <> 'closing'")) == content(want)


@pytest.mark.parametrize("split", [{}, {"hot_rows": 4, "cell_rows": 3}])
def test_running_counts_go_on_over_micro_batches(spark, tmp_path, split):
    batches = traffic_batches(seed=7, n=200, n_batches=5)
    stream = parse_traffic(read_lines_stream(spark, put(tmp_path / "in", batches), 1))
    carried.run_carried(
        carried.running_rows(stream), "action_time", 0, carried.running_step(60_000, **split), to_folder(f"{tmp_path}/out"),
        f"{tmp_path}/carried", trigger={"availableNow": True}).awaitTermination()
    want = area_running_distinct(parse_traffic(lines(spark, flat(batches))), 60_000)
    got = spark.read.parquet(f"{tmp_path}/out").where("area_id <> 'closing'")
    assert got.select("batch_id").distinct().count() > 3
    assert tuples(got, *want.columns) == tuples(want, *want.columns)
    last = max(int(p.name) for p in (tmp_path / "carried" / "kept").iterdir())
    assert spark.read.parquet(f"{tmp_path}/carried/kept/{last}").count() <= 1  # closed windows are not kept


@pytest.mark.parametrize("window_ms, slide_ms", [(60_000, None), (300_000, 60_000), (600_000, 120_000)])
def test_merged_sketches(spark, window_ms, slide_ms):
    """Few cars are counted exactly, whatever panes their sketches came from."""
    t = parse_traffic(lines(spark, flat(traffic_batches(n=240))))
    got = merged_sketches(area_sketches(t), window_ms, slide_ms)
    want = {}
    for r in t.collect():
        start = r["action_time"] // (slide_ms or window_ms) * (slide_ms or window_ms)
        while start > r["action_time"] - window_ms:
            want.setdefault((r["area_id"], start, start + window_ms), set()).add(r["car"])
            start -= slide_ms or window_ms
    assert tuples(got, "area_id", "window_start", "window_end", "car_count") == sorted((*k, len(v)) for k, v in want.items())
    with pytest.raises(ValueError):
        merged_sketches(area_sketches(t), 90_000)
