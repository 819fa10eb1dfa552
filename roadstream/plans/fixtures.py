"""The four inputs, derived from the `events` and `nation` tables.

A pass is one event. Event time is pressed together 1500-fold, so that short windows hold
several passes; `raw_time=True` keeps it as it is, which spreads the passes over many days.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

EPOCH_MS = 1704067200000  # 2024-01-01 00:00 UTC, the start of the events
PRESSED = 1_500_000  # microseconds of event time per millisecond of action time


def traffic(spark: SparkSession, sf_dir: str, raw_time: bool = False) -> DataFrame:
    return passes(spark, sf_dir, raw_time).select(
        "event_id", "action_time", "monitor_id", "camera_id", "car", "speed", "road_id", "area_id"
    )


def violations(spark: SparkSession, sf_dir: str, raw_time: bool = False) -> DataFrame:
    return passes(spark, sf_dir, raw_time).where("event_type = 'error'").selectExpr(
        "car", "'error' AS violation", "action_time AS create_time"
    )


def serious_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors at high speed: most cars have none."""
    return passes(spark, sf_dir).where("event_type = 'error' AND speed > 200").selectExpr(
        "car", "'error' AS violation", "action_time AS create_time"
    )


def minute_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic with times cut to minutes: passes of a car share their row key."""
    cut = F.col("action_time") - F.pmod("action_time", F.lit(60_000))
    return traffic(spark, sf_dir).withColumn("action_time", cut)


def police_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passes(spark, sf_dir).where("event_type = 'purchase'").selectExpr(
        "concat('J', lpad(cast(event_id % 50 AS string), 4, '0')) AS police_id",
        "car",
        "'done' AS action_status",
        "action_time",
    )


def monitor_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr(
        "lpad(cast(n_nationkey AS string), 4, '0') AS monitor_id",
        "lpad(cast(n_nationkey % 12 AS string), 2, '0') AS road_id",
        "cast(n_nationkey % 5 * 20 AS int) AS speed_limit",
        "lpad(cast(n_nationkey % 10 AS string), 2, '0') AS area_id",
    )


def limit_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posted limits as versions from the start, and sign-ups as later ones, 0 among them."""
    first = monitor_info(spark, sf_dir).selectExpr(
        "monitor_id", "speed_limit", f"{EPOCH_MS} AS valid_from"
    )
    later = passes(spark, sf_dir).where("event_type = 'signup'").selectExpr(
        "monitor_id", "cast(event_id % 6 * 20 AS int) AS speed_limit", "action_time AS valid_from"
    )
    return first.unionByName(later)


def passes(spark: SparkSession, sf_dir: str, raw_time: bool = False) -> DataFrame:
    """All events as passes, with their `event_type`."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # Both ends are read in the session time zone, so its offset cancels out.
    micros = "timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)"
    step = 1000 if raw_time else PRESSED
    return events.select("event_type", *_pass_columns(f"{EPOCH_MS} + {micros} div {step}"))


def _pass_columns(action_time: str) -> list:
    return [
        F.expr(e)
        for e in (
            "event_id",
            f"{action_time} AS action_time",
            "lpad(cast(event_id * 7919 % 30 AS string), 4, '0') AS monitor_id",
            "lpad(cast(event_id * 104729 % 100000 AS string), 5, '0') AS camera_id",
            "concat('C', lpad(cast(user_id AS string), 5, '0')) AS car",
            "value AS speed",
            "lpad(cast(event_id * 13 % 12 AS string), 2, '0') AS road_id",
            "lpad(cast(event_id * 31 % 10 AS string), 2, '0') AS area_id",
        )
    ]
