"""Streams take in rows of any time, lines with impossible values are rejected."""

from pyspark.sql import functions as F

from roadstream.functions.scalar import with_event_time
from roadstream.operators import area, clones, flow
from roadstream.plans import streams
from roadstream.sources import lines
from roadstream.schemas import TRAFFIC

TIMES = [-5000, -1000, 0, 1_000_000, 1_001_000, streams.FAR_FUTURE, streams.FAR_FUTURE + 3000]


def line(at, car="A", speed="1.0"):
    return f"{at},1,1,{car},{speed},1,1"


def test_early_and_late_times(spark):
    """A table and the carried stream give the same alarms, before 1970 and after 2100 too."""
    rows = [(at, line(at)) for at in TIMES] + [(None, ",1,1,A,1.0,1,1")]
    values = spark.createDataFrame(rows, "at bigint, value string")
    end = streams.closing_time(values.select("at"))
    closed = values.union(spark.createDataFrame([(end, line(end, "closing"))], values.schema))
    want = clones.cloned_plates(lines.parse_traffic(values.select("value"))).select("car", "first_time", "second_time")
    got = streams.drain(spark, {"lines": closed}, streams.clones_carried).select("car", "first_time", "second_time")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert [r["second_time"] for r in want.collect() if r["first_time"] == -5000] == [-1000]


def test_impossible_values_are_rejected(spark):
    bad = [line(1, speed="NaN"), line(1, speed="1e300"), line(1, speed="-Infinity"), line(2**63 - 808), line(-(2**63) + 808)]
    df = spark.createDataFrame([(v,) for v in [*bad, line(5)]], "value string")
    parsed = lines.parse(df, TRAFFIC)
    reasons = sorted(r["reject_reason"] for r in lines.rejected(parsed).collect())
    assert reasons == [lines.BAD_SPEED] * 3 + [lines.BAD_TIME] * 2
    good = lines.accepted(parsed, TRAFFIC)
    assert flow.avg_speed(good).count() == 5 and area.area_distinct(good).count() == 1
    assert with_event_time(good).count() == 1


def test_null_fields_keep_their_place(spark):
    rows = spark.createDataFrame([(7, None, "c", "A", 1.0, "r", "a")], TRAFFIC)
    made = streams._as_lines(rows, TRAFFIC, "action_time", streams.FAR_FUTURE)
    assert made.where(F.col("at") == 7).first()["value"] == "7,,c,A,1.0,r,a"
