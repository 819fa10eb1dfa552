from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from roadstream.llm.exact_dedup import DigestIndex, exact_dedup, keep_first_of_copies

SCHEMA = "doc_id bigint, text string, digest int, keep_id string"
ROWS = [
    (1, "a", 0, "x"), (2, "a", 0, "x"), (7, "a", 0, None), (3, None, 1, ""), (4, "", 1, ""), (5, "b", None, ""),
    (None, "c", 0, ""), (None, "c", 0, ""), (9, "d" * 200_000, 0, ""), (8, "d" * 200_000, 0, ""), (6, "e", 0, ""), (6, "e", 0, ""),
    (None, "e", 0, ""),
]


def brute(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    key = lambda i: (i is not None, i)
    out = []
    for i, t, *_ in rows:
        ids = groups[t or ""]
        keep = max(ids, key=key)
        out.append((i, keep, len(ids), i == keep, sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = exact_dedup(df)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(df).count() == 0
    assert keep_first_of_copies(df).count() == 0


def test_one_row_of_each_text_stays_with_its_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("__rid", F.lit(5))
    got = keep_first_of_copies(df)
    assert got.columns == df.columns
    assert sorted(((r["doc_id"], (r["text"] or "")[:3]) for r in got.collect()), key=str) == sorted(
        [(7, "a"), (4, ""), (5, "b"), (None, "c"), (9, "ddd"), (6, "e")], key=str)


def test_later_batches_are_held_against_the_index(spark):
    index = DigestIndex(spark, buckets=4)
    first = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string")
    second = spark.createDataFrame([(3, "a"), (4, "c"), (5, "c")], "doc_id bigint, text string")
    exact_dedup(first, index).collect()
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup(second, index).collect()}
    assert got == {3: (1, False), 4: (5, False), 5: (5, True)}
    again = DigestIndex(spark, index.path, buckets=4)  # as a later session opens it
    assert again.rows().count() == 3
    assert sorted(map(tuple, index.compact().rows().collect())) == sorted(map(tuple, index.rows().collect()))
    third = spark.createDataFrame([(6, "b"), (7, "d")], "doc_id bigint, text string")
    assert [r["doc_id"] for r in keep_first_of_copies(third, again).collect()] == [7]


def test_a_batch_is_shuffled_but_the_index_is_not(spark):
    index = DigestIndex(spark, buckets=4)
    index.append(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"))
    batch = spark.createDataFrame([(bytearray(b"1"),)], "digest binary")
    plan = batch.hint("merge").join(index.rows(), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan


def test_an_index_keeps_its_number_of_buckets(spark):
    index = DigestIndex(spark, buckets=4)
    exact_dedup(spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "doc_id bigint, text string"), index).collect()
    with pytest.raises(ValueError):
        DigestIndex(spark, index.path, buckets=8)
    again = DigestIndex(spark, index.path)
    assert again.buckets == 4
    batch = [(4, "x"), (5, "w"), (6, "w")]
    got = exact_dedup(spark.createDataFrame(batch, "doc_id bigint, text string"), again)
    assert sorted(tuple(r)[:4] for r in got.collect()) == [(4, 1, 2, False), (5, 6, 2, False), (6, 6, 2, True)]


@pytest.mark.parametrize("reopened", [False, True])
def test_three_batches_against_brute_force(spark, reopened):
    index, keep, size = DigestIndex(spark, buckets=3), {}, {}
    for n in range(3):
        batch = [(100 * n + i, f"text {(i * (n + 2)) % 7}") for i in range(12)]
        for t in {t for _, t in batch}:
            own = [i for i, u in batch if u == t]
            keep.setdefault(t, max(own))
            size[t] = size.get(t, 0) + len(own)
        index = DigestIndex(spark, index.path) if reopened and n else index
        got = exact_dedup(spark.createDataFrame(batch, "doc_id bigint, text string"), index)
        assert sorted(tuple(r)[:4] for r in got.collect()) == [(i, keep[t], size[t], keep[t] == i) for i, t in batch]
    compacted = index.compact().groups()
    assert sorted(r["group_size"] for r in compacted.collect()) == sorted(size.values())


def test_no_table_is_left_in_the_catalog(spark):
    before = len(spark.catalog.listTables())
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert exact_dedup(df).count() == len(ROWS) and keep_first_of_copies(df).count() == 6
    assert len(spark.catalog.listTables()) == before
