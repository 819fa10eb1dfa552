"""Tracks of flagged cars."""

from pyspark.sql import DataFrame, functions as F

from roadstream.functions.scalar import floor_div, track_row_key
from roadstream.operators.ordered import numbered
from roadstream.operators.skew import BROADCAST_ROWS, lookup_join
from roadstream.schemas import TRACK_COLUMNS, pass_order
from roadstream.session import snapshot

BATCH_ROWS = 10


def only_violators(
    traffic: DataFrame, violations: DataFrame, broadcast_rows: int = BROADCAST_ROWS, **skew
) -> DataFrame:
    """Passes of cars that are on the violation list as it is now."""
    listed = snapshot(violations.select("car").distinct())
    return lookup_join(traffic, listed, "car", "left_semi", broadcast_rows, **skew)


def to_track(traffic: DataFrame) -> DataFrame:
    kept = [c for c in ("event_id", "event_ts") if c in traffic.columns]
    return traffic.select("car", "action_time", "monitor_id", "road_id", "area_id", "speed", *kept)


def car_tracks(traffic: DataFrame, violations: DataFrame, **skew) -> DataFrame:
    """Keyed track rows of listed cars, newest first per car in key order."""
    tracks = to_track(only_violators(traffic, violations, **skew))
    return tracks.withColumn("row_key", track_row_key(F.col("car"), F.col("action_time"))).select(
        *TRACK_COLUMNS, *[c for c in ("event_id",) if c in tracks.columns]
    )


def latest_per_key(tracks: DataFrame) -> DataFrame:
    """What a keyed store holds after all rows were put in order: the last per `row_key`."""
    order = F.struct(*[c for c in pass_order(tracks.columns) if c != "car"])
    rest = [c for c in TRACK_COLUMNS if c != "row_key"]
    return (
        tracks.groupBy("row_key")
        .agg(F.max_by(F.struct(*rest), order).alias("t"))
        .select("row_key", "t.*")
    )


def track_batches(tracks: DataFrame, size: int = BATCH_ROWS, **cells) -> DataFrame:
    """Consecutive batches of `size` rows over one order of all rows; the last may be short.

    Rows are numbered inside range partitions, offset by the rows before, not in one task.
    """
    rows = numbered_tracks(tracks, "_no", **cells)
    return rows.withColumn("batch_id", floor_div(F.col("_no"), size)).drop("_no")


def numbered_tracks(tracks: DataFrame, name: str, **cells) -> DataFrame:
    """Tracks with their place in the order of all."""
    order = pass_order(tracks.columns)
    order = [*order, *[c for c in ("car",) if c not in order]]
    return numbered(tracks, order, name, **cells)
