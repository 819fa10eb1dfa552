"""Matching of violations with police actions on the same car."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from roadstream.functions.scalar import floor_div
from roadstream.operators.ordered import following, ordered
from roadstream.operators.runs import PREV, pair_off

BOUND_MS = 5_000

MATCHED = "matched"
NO_POLICE = "no_police"  # a violation nobody answered
NO_VIOLATION = "no_violation"  # a police action nobody reported
REPLACED = "replaced"  # overwritten in its slot by a newer row of its kind

PAIR_COLUMNS = ["car", "violation", "create_time", "police_id", "action_status", "action_time"]


def interval_join(
    violations: DataFrame, police: DataFrame, lo_ms: int = -BOUND_MS, hi_ms: int = BOUND_MS
) -> DataFrame:
    """Every violation with every police action from `lo_ms` to `hi_ms` after it, both ends
    included. Streams need watermarks on `event_ts`."""
    bucket_ms = _bucket_ms(lo_ms, hi_ms)
    if violations.isStreaming or police.isStreaming:
        v = _v_side(_in_bucket(violations, "create_time", bucket_ms))
        p = _p_side(_in_reach(police, "action_time", -hi_ms, -lo_ms, bucket_ms))
        return v.join(p, _stream_condition(lo_ms, hi_ms), "inner").select(
            F.col("v_car").alias("car"), *PAIR_COLUMNS[1:]
        )
    v = _in_bucket(violations, "create_time", bucket_ms)
    p = _in_reach(police, "action_time", -hi_ms, -lo_ms, bucket_ms)
    return (
        v.join(p, ["car", "bucket"])
        .where(_within(lo_ms, hi_ms))
        .select(*PAIR_COLUMNS)
    )


def reconcile(
    violations: DataFrame, police: DataFrame, wait_ms: int = BOUND_MS
) -> DataFrame:
    """All pairs within `wait_ms` of each other, all violations and all police actions without
    a partner, told apart by `outcome`."""
    bucket_ms = _bucket_ms(-wait_ms, wait_ms)
    if violations.isStreaming or police.isStreaming:
        return _reconcile_stream(violations, police, wait_ms, bucket_ms)
    near = _within(-wait_ms, wait_ms)
    p_reach = _in_reach(police, "action_time", -wait_ms, wait_ms, bucket_ms)
    p_reach = p_reach.withColumnRenamed("car", "p_car").withColumnRenamed("bucket", "p_bucket")
    v_once = _in_bucket(violations, "create_time", bucket_ms)
    answered = v_once.join(
        p_reach,
        (F.col("car") == F.col("p_car")) & (F.col("bucket") == F.col("p_bucket")) & near,
        "left",
    ).select(_outcome("car", "p_car"), *PAIR_COLUMNS)

    # Only whether a violation is near matters here, so equal (car, time) count once.
    v_times = violations.select(F.col("car").alias("v_car"), "create_time").distinct()
    v_reach = _in_reach(v_times, "create_time", -wait_ms, wait_ms, bucket_ms)
    v_reach = v_reach.withColumnRenamed("bucket", "v_bucket")
    p_once = _in_bucket(police, "action_time", bucket_ms)
    unprompted = p_once.join(
        v_reach,
        (F.col("car") == F.col("v_car")) & (F.col("bucket") == F.col("v_bucket")) & near,
        "left_anti",
    ).select(*_unprompted("car"))
    return answered.unionByName(unprompted)


def _unprompted(car: str) -> list[Column]:
    return [
        F.lit(NO_VIOLATION).alias("outcome"), F.col(car).alias("car"),
        F.lit(None).cast("string").alias("violation"),
        F.lit(None).cast("bigint").alias("create_time"),
        *map(F.col, ("police_id", "action_status", "action_time")),
    ]


def _reconcile_stream(violations, police, wait_ms: int, bucket_ms: int) -> DataFrame:
    """State is kept by (car, bucket), so that a car with very many rows is spread. In each join
    only the other side is copied to several buckets, so a row is paired, or found to be without
    a partner, once."""
    near = _stream_condition(-wait_ms, wait_ms)
    v_once = _v_side(_in_bucket(violations, "create_time", bucket_ms))
    p_reach = _p_side(_in_reach(police, "action_time", -wait_ms, wait_ms, bucket_ms))
    answered = v_once.join(p_reach, near, "left").select(
        _outcome("v_car", "p_car"), F.col("v_car").alias("car"), *PAIR_COLUMNS[1:]
    )
    p_once = _p_side(_in_bucket(police, "action_time", bucket_ms))
    v_reach = _v_side(
        _in_reach(violations, "create_time", -wait_ms, wait_ms, bucket_ms)
    ).select("v_car", "v_ts", "v_bucket")
    unprompted = p_once.join(v_reach, near, "left").where(F.col("v_car").isNull())
    return answered.unionByName(unprompted.select(*_unprompted("p_car")))


def reconcile_slots(
    violations: DataFrame, police: DataFrame, wait_ms: int = BOUND_MS, **split
) -> DataFrame:
    """As `reconcile`, with one slot per car: a row is matched at most once, with the row right
    before or after it, and a second row of a kind takes the slot of the first (`replaced`)."""
    pairs, alone = slot_outcomes(slot_rows(violations, police), wait_ms, split)
    return pairs.unionByName(alone.select("outcome", "car", *SLOT_FIELDS))


def slot_outcomes(
    sides: DataFrame,
    wait_ms: int,
    split: dict,
    hold: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> tuple[DataFrame, DataFrame]:
    """The pairs, and the rows without a partner with their outcome. `_is_last` marks those that
    no row of their car follows. `hold` may cache what both are made of."""
    fields = ["at", "side", *SLOT_FIELDS]
    rows = ordered(sides.select("car", *fields), ["car"], fields, **split)
    gap = F.col("at") - F.col(f"{PREV}.at")
    fits = (F.col("side") != F.col(f"{PREV}.side")) & (gap <= wait_ms)
    next_row = following(F.struct("at", "_fits"))
    after = hold(pair_off(rows, fields, fits, _next=next_row).result())

    is_v, prev_v = F.col("side") == 0, F.col(f"{PREV}.side") == 0
    pairs = after.where(F.col("_second")).select(
        F.lit(MATCHED).alias("outcome"), "car",
        *[
            F.when(is_v, F.col(c)).otherwise(F.col(f"{PREV}.{c}")).alias(c)
            for c in ("violation", "create_time")
        ],
        *[
            F.when(prev_v, F.col(c)).otherwise(F.col(f"{PREV}.{c}")).alias(c)
            for c in ("police_id", "action_status", "action_time")
        ],
    )
    # A row that starts no pair: the next row of its car, if any, does not fit it.
    alone = after.where(~F.col("_second") & ~F.coalesce(F.col("_next._fits"), F.lit(False)))
    soon = F.coalesce(F.col("_next.at") - F.col("at") <= wait_ms, F.lit(False))
    outcome = (
        F.when(soon, REPLACED).when(is_v, NO_POLICE).otherwise(NO_VIOLATION).alias("outcome")
    )
    last = F.col("_next").isNull().alias("_is_last")
    return pairs, alone.select(outcome, "car", *fields, last)


SLOT_FIELDS = ["violation", "create_time", "police_id", "action_status", "action_time"]


def slot_rows(violations: DataFrame, police: DataFrame) -> DataFrame:
    """Both inputs in one frame: `at` is the event time, `side` 0 a violation, 1 police."""
    v = violations.select("car", F.col("create_time").alias("at"), F.lit(0).alias("side"),
                          "violation", "create_time", *_ts(violations))
    p = police.select("car", F.col("action_time").alias("at"), F.lit(1).alias("side"),
                      "police_id", "action_status", "action_time", *_ts(police))
    return v.unionByName(p, allowMissingColumns=True)


def _ts(df: DataFrame) -> list[str]:
    return ["event_ts"] if "event_ts" in df.columns else []


def _bucket_ms(lo_ms: int, hi_ms: int) -> int:
    """Buckets twice the width of the interval: one side is copied 1.5 times on average, and
    a car with very many rows is spread over its buckets."""
    return max(1, 2 * (hi_ms - lo_ms))


def _in_bucket(df: DataFrame, time_col: str, bucket_ms: int) -> DataFrame:
    return df.withColumn("bucket", floor_div(F.col(time_col), bucket_ms))


def _in_reach(df, time_col, before_ms, after_ms, bucket_ms) -> DataFrame:
    """Copies of a row for every bucket that holds times from `before_ms` to `after_ms`."""
    first = floor_div(F.col(time_col) + before_ms, bucket_ms)
    last = floor_div(F.col(time_col) + after_ms, bucket_ms)
    return df.withColumn("bucket", F.explode(F.sequence(first, last)))


def _within(lo_ms: int, hi_ms: int) -> Column:
    return (F.col("action_time") - F.col("create_time")).between(lo_ms, hi_ms)


def _outcome(v_mark: str, p_mark: str) -> Column:
    return (
        F.when(F.col(p_mark).isNull(), NO_POLICE)
        .when(F.col(v_mark).isNull(), NO_VIOLATION)
        .otherwise(MATCHED)
        .alias("outcome")
    )


def _v_side(violations: DataFrame) -> DataFrame:
    return violations.withColumnsRenamed({"car": "v_car", "event_ts": "v_ts", "bucket": "v_bucket"})


def _p_side(police: DataFrame) -> DataFrame:
    return police.withColumnsRenamed({"car": "p_car", "event_ts": "p_ts", "bucket": "p_bucket"})


def _stream_condition(lo_ms: int, hi_ms: int) -> Column:
    return F.expr(
        f"v_car = p_car AND v_bucket = p_bucket AND p_ts >= v_ts + INTERVAL '{lo_ms}' MILLISECONDS "
        f"AND p_ts <= v_ts + INTERVAL '{hi_ms}' MILLISECONDS"
    )
