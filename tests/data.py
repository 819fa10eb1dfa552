"""Small hand-made inputs."""

from roadstream.schemas import MONITOR_INFO, POLICE_ACTION, TRAFFIC, VIOLATION

BASE = 1592722000000  # a second is 1000 past it


def passes(spark, rows):
    """(car, ms, monitor, speed) -> traffic with event ids in the given order."""
    full = [(t, m, "76022", car, float(v), "30", "83", i) for i, (car, t, m, v) in enumerate(rows)]
    return spark.createDataFrame(full, TRAFFIC.simpleString()[7:-1] + ",event_id:bigint")


def limits_table(spark, rows):
    return spark.createDataFrame([(m, "30", v, "83") for m, v in rows], MONITOR_INFO)


def violations(spark, rows):
    return spark.createDataFrame([(car, "v", t) for car, t in rows], VIOLATION)


def police(spark, rows):
    return spark.createDataFrame([(f"J{i:04d}", c, "done", t) for i, (c, t) in enumerate(rows)],
                                 POLICE_ACTION)


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def tuples(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


