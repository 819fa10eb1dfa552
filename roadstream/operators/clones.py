"""Cloned plates: one plate seen twice within a time no single car could need."""

from pyspark.sql import DataFrame, functions as F

from roadstream.functions.messages import CLONED
from roadstream.functions.scalar import abs_gap_sec, day_start
from roadstream.operators.ordered import Running, ordered
from roadstream.operators.runs import PREV, pair_off
from roadstream.schemas import VIOLATION_COLUMNS, pass_order

GAP_SEC = 10


def cloned_plates(traffic: DataFrame, gap_sec: int = GAP_SEC, **split) -> DataFrame:
    """Pairs of passes of one car at most `gap_sec` whole seconds apart, in event order.

    A pass is used in one alarm at most. The two checkpoints may be the same one.
    """
    return clone_alarms(paired_passes(traffic.select(*clone_columns(traffic)), gap_sec, split))


def clone_columns(traffic: DataFrame) -> list[str]:
    return list(dict.fromkeys(["car", *pass_order(traffic.columns), "monitor_id"]))


def paired_passes(passes: DataFrame, gap_sec: int, split: dict, **values: Running) -> DataFrame:
    """All passes with what `pair_off` adds. `passes` has the columns of `clone_columns`."""
    rows = ordered(passes, ["car"], pass_order(passes.columns), **split)
    near = abs_gap_sec(F.col("action_time"), F.col(f"{PREV}.action_time")) <= gap_sec
    return pair_off(rows, passes.columns[1:], near, **values).result()


def clone_alarms(paired: DataFrame) -> DataFrame:
    pairs = paired.where(F.col("_second"))
    tied = F.col("action_time") == F.col(f"{PREV}.action_time")
    return pairs.select(
        "car",
        # With equal times neither pass is the earlier: the current checkpoint stands twice.
        F.when(tied, F.col("monitor_id")).otherwise(F.col(f"{PREV}.monitor_id"))
        .alias("first_monitor"),
        F.col("monitor_id").alias("second_monitor"),
        F.lit(CLONED).alias("msg"),
        F.col(f"{PREV}.action_time").alias("first_time"),
        F.col("action_time").alias("second_time"),
    )


def as_violations(clones: DataFrame) -> DataFrame:
    """Alarms in the form of the violation list, at the time of the second pass."""
    return clones.select("car", F.col("msg").alias("violation"),
                         F.col("second_time").alias("create_time"))


def once_per_day(new: DataFrame, existing: DataFrame) -> DataFrame:
    """The first new violation per car and day, unless that day has one already.

    Days are half open, in the session time zone. Both sides shrink to one row per car and day
    before they are joined, so a car with very many rows does not skew the join.
    """
    first = (
        new.withColumn("day", day_start(F.col("create_time")))
        .groupBy("car", "day")
        .agg(F.min(F.struct("create_time", "violation")).alias("v"))
        .select("car", "day", "v.violation", "v.create_time")
    )
    known = existing.select("car", day_start(F.col("create_time")).alias("day")).distinct()
    return first.join(known, ["car", "day"], "left_anti").select(*VIOLATION_COLUMNS)
