"""Passes against limits that change in time.

A version of a limit counts from `valid_from` until the next version of its checkpoint; a limit that is null or not above 0
takes the posted limit away. Passes and versions are merged into one order per checkpoint and scanned once, so a checkpoint
with very many passes or versions is split like any hot key, and nothing is broadcast.

Of versions with one time the highest limit counts. A pass at the very time of a version meets it. Passes before the first
version of their checkpoint have no limit, nor do passes without a checkpoint.
"""

from pyspark.sql import DataFrame, functions as F

from roadstream.operators.ordered import latest, ordered
from roadstream.operators.speeding import SPEEDING_TOLERANCE, over_limit

_PASS = ["car", "road_id", "real_speed"]
VERSION_SIDE, PASS_SIDE = 0, 1


def version_rows(versions: DataFrame) -> DataFrame:
    """Versions (monitor_id, speed_limit, valid_from) as rows of the merged order."""
    return versions.where("monitor_id IS NOT NULL AND valid_from IS NOT NULL").select(
        "monitor_id", F.col("valid_from").alias("at"), F.lit(VERSION_SIDE).alias("side"),
        F.coalesce(F.col("speed_limit").cast("int"), F.lit(0)).alias("version_limit"),
    )


def pass_rows(traffic: DataFrame) -> DataFrame:
    """Passes as rows of the merged order."""
    return traffic.where("monitor_id IS NOT NULL AND action_time IS NOT NULL").select(
        "monitor_id", F.col("action_time").alias("at"), F.lit(PASS_SIDE).alias("side"),
        "car", "road_id", F.col("speed").alias("real_speed"),
        *[c for c in ("event_id",) if c in traffic.columns],
    )


def merged(traffic: DataFrame, versions: DataFrame) -> DataFrame:
    return pass_rows(traffic).unionByName(version_rows(versions), allowMissingColumns=True)


def judged(rows: DataFrame, **split) -> DataFrame:
    """The passes among `rows` of `merged`, with the limit valid at their time, if any."""
    order = ["at", "side", "version_limit", *[c for c in ("event_id", *_PASS) if c in rows.columns]]
    known = F.when(F.col("side") == VERSION_SIDE, F.col("version_limit"))
    scan = ordered(rows, ["monitor_id"], order, **split).scan(limit_speed=latest(known))
    return scan.result().where((F.col("side") == PASS_SIDE) & (F.col("limit_speed") > 0))


def open_versions(rows: DataFrame) -> DataFrame:
    """The version of each checkpoint that counts after all of `rows`; one that took a limit away need not be kept."""
    newest = F.max(F.when(F.col("side") == VERSION_SIDE, F.struct("at", "version_limit")))
    last = rows.where(F.col("side") == VERSION_SIDE).groupBy("monitor_id").agg(newest.alias("v"))
    kept = last.where("v.version_limit > 0").select(
        "monitor_id", "v.at", F.lit(VERSION_SIDE).alias("side"), "v.version_limit")
    missing = [f for f in rows.schema if f.name not in kept.columns]
    return kept.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]).select(*rows.columns)


def over_valid_limit(rows: DataFrame, tolerance: float = SPEEDING_TOLERANCE, **split) -> DataFrame:
    """Passes among `rows` of `merged` above the limit that was valid when they were made."""
    return judged(rows, **split).where(over_limit(tolerance)).select(
        "car", "monitor_id", "road_id", "real_speed", "limit_speed", F.col("at").alias("action_time"),
        *[c for c in ("event_id",) if c in rows.columns],
    )


def speeding_at(traffic: DataFrame, versions: DataFrame, tolerance: float = SPEEDING_TOLERANCE, **split) -> DataFrame:
    """As `speeding`, with versioned limits (monitor_id, speed_limit, valid_from)."""
    return over_valid_limit(merged(traffic, versions), tolerance, **split)
