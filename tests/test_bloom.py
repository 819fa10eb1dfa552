"""The Bloom filter before a large semi-join, and salts by the load of keys."""

import random

import pytest
from pyspark.sql import functions as F

from data import limits_table, passes, tuples, violations
from roadstream.operators import bloom, skew
from roadstream.operators.speeding import monitor_limits, with_limit
from roadstream.operators.tracks import only_violators


def keys(spark, n, prefix):
    return spark.range(n).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("car"))


@pytest.mark.parametrize("words", [1, 50, 250, 2000])
def test_no_listed_key_is_held_back(spark, words):
    listed = keys(spark, 1000, "L")
    got = bloom.thinned(listed.unionByName(listed), "car", listed, words)
    assert got.count() == 2000


def test_few_unlisted_keys_pass(spark):
    listed, others = keys(spark, 4000, "L"), keys(spark, 20_000, "U")
    assert bloom.thinned(others, "car", listed, bloom.words_for(4000)).count() < 0.02 * 20_000
    # At the bound where the filter is given up it still holds back most of them.
    full = bloom.thinned(others, "car", listed, 4000 // bloom.MAX_KEYS_PER_WORD).count()
    assert 0.1 * 20_000 < full < 0.5 * 20_000


def test_words(spark):
    assert bloom.words_for(0) == 1
    assert bloom.words_for(4001) == 1001
    assert bloom.words_for(10 * bloom.MAX_WORDS) == bloom.MAX_WORDS
    assert bloom.words_for(20 * bloom.MAX_WORDS + 1) is None
    repeated = keys(spark, 100, "L").unionByName(keys(spark, 100, "L"))
    assert bloom.filter_words(repeated, "car", 7).count() <= 7


def test_null_keys_and_empty_lists(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "car string, n int")
    assert tuples(bloom.thinned(df, "car", df, 3), "n") == [(1,)]
    assert bloom.thinned(df, "car", df.limit(0), 1).count() == 0


def many_unlisted(spark):
    rng = random.Random(5)
    rows = [("HOT" if i % 3 == 0 else f"C{rng.randrange(900)}", i, "1", 50.0) for i in range(3000)]
    rows += [(None, i, "1", 50.0) for i in range(40)]
    listed = [(f"C{i}", 1) for i in range(20)] + [("C1", 2), (None, 1), ("absent", 1)]
    return passes(spark, rows), violations(spark, listed)


@pytest.mark.parametrize("hot", [False, True])
def test_large_list_equals_a_small_one(spark, hot):
    t, listed = many_unlisted(spark)
    if hot:
        listed = listed.unionByName(violations(spark, [("HOT", 1)]))
    large = only_violators(t, listed, broadcast_rows=0, hot_rows=100)
    assert tuples(large, "event_id") == tuples(only_violators(t, listed), "event_id")


def test_rows_are_thinned_before_they_are_shuffled(spark, monkeypatch):
    """The unlisted hot car never reaches the join: it is not even counted as hot."""
    t, listed = many_unlisted(spark)
    seen = []
    monkeypatch.setattr(skew, "hot_keys", lambda df, *a, **k: seen.append(df.count()) or [])
    joined = only_violators(t, listed, broadcast_rows=0, hot_rows=100)
    assert joined.count() <= seen[0] < 0.1 * t.count()
    plan = joined._jdf.queryExecution().toString()
    assert "bit_or" in plan and "LeftSemi" in plan


def test_without_words_the_join_is_exact(spark, monkeypatch):
    t, listed = many_unlisted(spark)
    monkeypatch.setattr(skew, "words_for", lambda n: None)
    large = only_violators(t, listed, broadcast_rows=0)
    assert tuples(large, "event_id") == tuples(only_violators(t, listed), "event_id")


def loaded(spark):
    """Two hot checkpoints of unlike size and passes without any; 4,000 rows."""
    names = ["big"] * 2000 + ["mid"] * 500 + [None] * 1000 + [f"m{i % 50}" for i in range(500)]
    return passes(spark, [(f"C{i}", i, m, 70.0) for i, m in enumerate(names)])


def test_salts_follow_the_load(spark):
    t = loaded(spark)
    hot = skew.hot_keys(t, ["monitor_id"], 100, nulls=True)
    loads = skew.salts_by_load(t, "monitor_id", hot, 100)
    assert dict(tuples(loads.fillna("", ["monitor_id"]), "monitor_id", "_salts")) == {
        "big": 20, "mid": 5, "": 10}
    spread = skew.salted(t, "monitor_id", loads)
    assert tuples(spread, "event_id") == tuples(t, "event_id")
    sizes = [r["count"] for r in spread.where("monitor_id IS NULL OR monitor_id IN ('big', 'mid')")
             .groupBy("monitor_id", "_salt").count().collect()]
    assert len(sizes) == 35 and max(sizes) < 4 * min(sizes)
    assert spread.where("monitor_id RLIKE '^m[0-9]'").agg(
        F.max("_salt")).first()[0] == 0


def test_only_lookup_rows_of_hot_keys_are_copied(spark):
    t = loaded(spark)
    limits = monitor_limits(limits_table(spark, [("big", 20), ("m1", 40)] + [(f"x{i}", 30) for i in range(30)]))
    split = with_limit(t, limits, broadcast_rows=0, hot_rows=100)
    columns = ["event_id", "limit_speed"]
    assert tuples(split, *columns) == tuples(with_limit(t, limits), *columns)
    by_null = split.where("monitor_id IS NULL").groupBy("limit_speed").count().collect()
    assert [tuple(r) for r in by_null] == [(60, 1000)]


def test_null_keys_alone_are_hot(spark):
    t = passes(spark, [(f"C{i}", i, None if i % 2 else f"m{i}", 70.0) for i in range(400)])
    limits = monitor_limits(limits_table(spark, [("m2", 20)]))
    split = with_limit(t, limits, broadcast_rows=0, hot_rows=50)
    assert tuples(split, "event_id", "limit_speed") == tuples(
        with_limit(t, limits), "event_id", "limit_speed")
