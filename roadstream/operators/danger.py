"""Dangerous drivers: several grossly speeding passes of one car within a short time."""

from pyspark.sql import DataFrame, functions as F

from roadstream.functions.messages import danger_message
from roadstream.functions.scalar import mean_speed, speed_units
from roadstream.operators.ordered import CELL, Ordered, latest, ordered, total
from roadstream.operators.speeding import DEFAULT_LIMIT, GROSS_TOLERANCE, over_limit, with_limit
from roadstream.schemas import pass_order

TIMES = 3
WITHIN_MS = 120_000


def dangerous_drivers(
    traffic: DataFrame,
    limits: DataFrame,
    times: int = TIMES,
    within_ms: int = WITHIN_MS,
    tolerance: float = GROSS_TOLERANCE,
    default_limit: int = DEFAULT_LIMIT,
    mode: str = "all",
    **split,
) -> DataFrame:
    """Matches of at least `times` gross passes of a car, less than `within_ms` from first to
    last; slower passes may lie between.

    mode="all" gives every match: each start with each end that is at least the `times`-th.
    mode="longest" gives each start with its last possible end. Both first find the last end
    of every start in one ordered scan: next to each pass a probe is sorted at pass time plus
    `within_ms`, and the last pass before the probe is the answer. No pass is compared with
    all others of its car, and "all" then only writes the matches themselves.
    """
    gross = gross_passes(traffic, limits, tolerance, default_limit)
    return matches_of(gross, times, within_ms, mode, split)


def matches_of(gross: DataFrame, times: int, within_ms: int, mode: str, split: dict) -> DataFrame:
    """`dangerous_drivers` from the rows of `gross_passes`."""
    if mode not in ("all", "longest"):
        raise ValueError(f"unknown mode {mode!r}")
    passes = _numbered(gross, split)
    starts = _last_ends(passes, within_ms, split).where(
        F.col("last.n") - F.col("n") >= times - 1
    )
    if mode == "longest":
        matches = starts.select("*", *[F.col(f"last.{c}").alias(f"end_{c}") for c in _END])
    else:
        ends = passes.result().select("car", *[F.col(c).alias(f"end_{c}") for c in _END])
        matches = starts.withColumn(
            "end_n", F.explode(F.sequence(F.col("n") + (times - 1), F.col("last.n")))
        ).join(ends, ["car", "end_n"])
    count = F.col("end_n") - F.col("n") + 1
    return matches.select(
        "car",
        F.col("n").alias("start_no"),
        F.col("action_time").alias("start_time"),
        F.col("end_action_time").alias("end_time"),
        F.col("monitor_id").alias("start_monitor"),
        F.col("end_monitor_id").alias("end_monitor"),
        count.alias("pass_count"),
        mean_speed(F.col("end_sum") - F.col("sum") + F.col("units"), count).alias("avg_speed"),
    )


_END = ["n", "action_time", "monitor_id", "sum"]


def gross_passes(
    traffic: DataFrame,
    limits: DataFrame,
    tolerance: float = GROSS_TOLERANCE,
    default_limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    limited = with_limit(traffic, limits, default_limit)
    kept = [c for c in ("event_id", "event_ts") if c in limited.columns]
    return limited.where(over_limit(tolerance)).select(
        "car", "action_time", "monitor_id", "road_id",
        speed_units(F.col("real_speed")).alias("units"), *kept,
    )


def match_paths(matches: DataFrame, passes: DataFrame) -> DataFrame:
    """The passes of each match, one row per pass with its `position` from 1, by number."""
    steps = matches.select(
        "car", "start_no", "pass_count",
        F.posexplode(
            F.sequence(F.col("start_no"), F.col("start_no") + F.col("pass_count") - 1)
        ).alias("pos", "n"),
    )
    monitors = passes.select("car", "n", "monitor_id")
    return steps.join(monitors, ["car", "n"]).select(
        "car", "start_no", "pass_count", (F.col("pos") + 1).alias("position"), "monitor_id"
    )


def danger_messages(matches: DataFrame, passes: DataFrame) -> DataFrame:
    """The warning text of each match. Its length is that of the match it spells out."""
    path = F.sort_array(F.collect_list(F.struct("position", "monitor_id")))
    return (
        match_paths(matches, passes)
        .groupBy("car", "start_no", "pass_count")
        .agg(path.alias("path"))
        .select("car", "start_no", "pass_count",
                danger_message(F.col("path.monitor_id")).alias("message"))
    )


def numbered_passes(traffic: DataFrame, limits: DataFrame, **split) -> DataFrame:
    """The gross passes of each car, numbered from 1 in order."""
    return _numbered(gross_passes(traffic, limits), split).result()


def _numbered(gross: DataFrame, split: dict) -> Ordered:
    """Number the passes of each car, with the running sum of their speeds."""
    order = pass_order(gross.columns)
    if "event_id" not in order:
        order = ["action_time", "monitor_id", "road_id", "units"]
    rows = ordered(gross, ["car"], order, **split)
    return rows.scan(n=total(F.lit(1).cast("bigint")), sum=total(F.col("units")))


def _last_ends(passes: Ordered, within_ms: int, split: dict) -> DataFrame:
    """Each pass with `last`, the last pass of the car less than `within_ms` after it."""
    at = F.col("action_time")
    # A probe (0) sorts before the passes (1) of its own time, which are too late by then.
    marks = F.array(
        F.struct(at.alias("at"), F.lit(1).alias("is_pass")),
        F.struct((at + within_ms).alias("at"), F.lit(0).alias("is_pass")),
    )
    def events(df: DataFrame) -> DataFrame:
        return df.withColumn("mark", F.explode(marks)).select("*", "mark.*").drop("mark")

    order = ["at", "is_pass", *passes.order]
    here = latest(F.when(F.col("is_pass") == 1, F.struct(*_END)))
    # Probes of ordinary keys stay with their key; those of hot keys may belong to a later cell.
    last = Ordered(events(passes.whole), None, passes.keys, tuple(order)).scan(last=here).result()
    if passes.cells is not None:
        moved = ordered(events(passes.cells.drop(CELL)), ["car"], order, **split)
        last = last.unionByName(moved.scan(last=here).result())
    return last.where(F.col("is_pass") == 0)
