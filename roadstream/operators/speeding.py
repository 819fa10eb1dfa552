"""Passes over the posted limit."""

from pyspark.sql import Column, DataFrame, functions as F

from roadstream.operators.skew import BROADCAST_ROWS, lookup_join

SPEEDING_TOLERANCE = 1.1
GROSS_TOLERANCE = 1.2
DEFAULT_LIMIT = 60


def monitor_limits(monitor_info: DataFrame, version: str | None = None) -> DataFrame:
    """(monitor_id, limit_speed) of checkpoints with a limit, one row per checkpoint.

    With a `version` column the latest row of a checkpoint wins; a table without one should
    hold each checkpoint once, and if not, the highest limit wins.
    """
    posted = monitor_info.where(F.col("speed_limit") > 0)
    by = F.struct(version, "speed_limit") if version else F.col("speed_limit")
    return posted.groupBy("monitor_id").agg(F.max_by("speed_limit", by).alias("limit_speed"))


def over_limit(tolerance: float, speed: str = "real_speed") -> Column:
    """Strictly above limit x tolerance, in double. NaN is above nothing."""
    return (F.col("limit_speed") * F.lit(float(tolerance)) < F.col(speed)) & ~F.isnan(speed)


def speeding(
    traffic: DataFrame,
    limits: DataFrame,
    tolerance: float = SPEEDING_TOLERANCE,
    broadcast_rows: int = BROADCAST_ROWS,
    **skew,
) -> DataFrame:
    """Passes above the limit; passes at checkpoints without a limit do not count."""
    passes = traffic.select("car", "monitor_id", "road_id", F.col("speed").alias("real_speed"),
                            "action_time", *_carried(traffic))
    joined = lookup_join(passes, limits, "monitor_id", "inner", broadcast_rows, **skew)
    return joined.where(over_limit(tolerance)).select(
        "car", "monitor_id", "road_id", "real_speed", "limit_speed", "action_time",
        *_carried(traffic),
    )


def with_limit(
    traffic: DataFrame,
    limits: DataFrame,
    default: int = DEFAULT_LIMIT,
    broadcast_rows: int = BROADCAST_ROWS,
    **skew,
) -> DataFrame:
    """Every pass with the limit of its checkpoint, or `default` where none is posted."""
    passes = traffic.select("car", "monitor_id", "road_id", F.col("speed").alias("real_speed"),
                            "action_time", *_carried(traffic))
    joined = lookup_join(passes, limits, "monitor_id", "left", broadcast_rows, **skew)
    return joined.select(
        "car", "monitor_id", "road_id", "real_speed",
        F.coalesce("limit_speed", F.lit(default)).alias("limit_speed"), "action_time",
        *_carried(traffic),
    )


def _carried(df: DataFrame) -> list[str]:
    return [c for c in ("event_id", "event_ts") if c in df.columns]
