"""Every registered query against its SQL counterpart, on whole tables."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from compare import TESTDATA, duck, spark_rows, sql_rows

SF = str(TESTDATA / "sf0.01")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, name):
    got_columns, got = spark_rows(queries()[name](spark, SF))
    want_columns, want = sql_rows(con, oracle_sql()[name])
    assert got_columns == want_columns
    assert sum(want.values()) > 0
    assert not (got - want) and not (want - got), (
        list((got - want).items())[:3], list((want - got).items())[:3])


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 263


def test_approximate_counts_are_near(spark):
    approx = queries()["area_approx_distinct"](spark, SF)
    exact = queries()["area_running_distinct"](spark, SF).groupBy(
        "area_id", "window_start").agg(F.max("car_count").alias("exact"))
    rows = approx.join(exact, ["area_id", "window_start"]).collect()
    assert len(rows) == approx.count() > 0
    assert all(abs(r["car_count"] - r["exact"]) <= 0.1 * r["exact"] for r in rows)
