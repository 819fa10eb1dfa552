"""Average speed and pass count per checkpoint, and the most congested checkpoints."""

from math import gcd

from pyspark.sql import DataFrame, Window, functions as F

from roadstream.functions.scalar import floor_div, mean_speed, speed_units
from roadstream.schemas import AVG_SPEED_COLUMNS

WINDOW_MS = 300_000
SLIDE_MS = 60_000
TOP_SHARDS = 1024  # of the checkpoints of a stream


def avg_speed(
    traffic: DataFrame, window_ms: int = WINDOW_MS, slide_ms: int = SLIDE_MS
) -> DataFrame:
    """Mean speed and number of passes per checkpoint and sliding window."""
    if traffic.isStreaming:
        return _avg_speed_stream(traffic, window_ms, slide_ms).select(*AVG_SPEED_COLUMNS)
    # Rows are combined into panes first, the panes then go to the windows they are part of:
    # a pass is read and shuffled once, not once per overlapping window.
    pane_ms = gcd(window_ms, slide_ms)
    panes = (
        traffic.select(
            "monitor_id",
            (floor_div(F.col("action_time"), pane_ms) * pane_ms).alias("pane"),
            speed_units(F.col("speed")).alias("units"),
        )
        .groupBy("monitor_id", "pane")
        .agg(F.sum("units").alias("units"), F.count("*").alias("n"))
    )
    first = floor_div(F.col("pane") - window_ms, slide_ms) + 1
    last = floor_div(F.col("pane"), slide_ms)
    sums = (
        panes.select("monitor_id", "units", "n", F.explode(F.sequence(first, last)).alias("w"))
        .groupBy("monitor_id", "w")
        .agg(F.sum("units").alias("units"), F.sum("n").alias("car_count"))
    )
    return sums.select(
        (F.col("w") * slide_ms).alias("start_time"),
        (F.col("w") * slide_ms + window_ms).alias("end_time"),
        "monitor_id",
        mean_speed(F.col("units"), F.col("car_count")).alias("avg_speed"),
        "car_count",
    )


def _avg_speed_stream(traffic: DataFrame, window_ms: int, slide_ms: int) -> DataFrame:
    """As `avg_speed`, on a stream with a watermark on `event_ts`; keeps the window column.

    One state adds passes up in panes, a second one adds panes up in windows: only panes are
    copied. A pass is late when its pane is over, though later windows of it may be open still;
    `streaming.late` counts such passes too.
    """
    pane_ms = gcd(window_ms, slide_ms)
    panes = traffic.groupBy(F.window("event_ts", _ms(pane_ms)), "monitor_id").agg(
        F.sum(speed_units(F.col("speed"))).alias("units"), F.count("*").alias("n")
    )
    at = F.window(F.window_time("window"), _ms(window_ms), _ms(slide_ms)).alias("window")
    return (
        panes.groupBy(at, "monitor_id")
        .agg(F.sum("units").alias("units"), F.sum("n").alias("car_count"))
        .select(
            "window",
            F.unix_millis("window.start").alias("start_time"),
            F.unix_millis("window.end").alias("end_time"),
            "monitor_id",
            mean_speed(F.col("units"), F.col("car_count")).alias("avg_speed"),
            "car_count",
        )
    )


def congestion_topn(
    traffic: DataFrame, n: int = 3, window_ms: int = WINDOW_MS, slide_ms: int = SLIDE_MS,
    shards: int = TOP_SHARDS,
) -> DataFrame:
    """The `n` checkpoints with most passes per window; equal counts go by checkpoint id.

    Only aggregated rows are ranked: at most one per checkpoint and window. On a stream each of
    `shards` shares of the checkpoints is ranked by itself, then the best of all shares.
    """
    if traffic.isStreaming:
        return _congestion_topn_stream(traffic, n, window_ms, slide_ms, shards)
    by_count = Window.partitionBy("start_time").orderBy(F.desc("car_count"), "monitor_id")
    ranked = avg_speed(traffic, window_ms, slide_ms).withColumn(
        "rank", F.row_number().over(by_count).cast("bigint")
    )
    return ranked.where(F.col("rank") <= n).select("rank", *AVG_SPEED_COLUMNS)


def _congestion_topn_stream(traffic, n, window_ms, slide_ms, shards) -> DataFrame:
    # A state row holds the checkpoints of one shard, and then `n` of each shard.
    entry = F.struct(
        (-F.col("car_count")).alias("order"), "monitor_id", "avg_speed", "car_count",
        "start_time", "end_time",
    )
    top = F.slice(F.sort_array(F.collect_list("e")), 1, n).alias("top")
    shard = F.pmod(F.xxhash64("monitor_id"), F.lit(shards)).alias("shard")
    per_shard = (
        _avg_speed_stream(traffic, window_ms, slide_ms)
        .select("window", shard, entry.alias("e"))
        .groupBy(F.window(F.window_time("window"), _ms(slide_ms)), "shard")
        .agg(top)
        .select("window", F.explode("top").alias("e"))
    )
    tops = per_shard.groupBy(F.window(F.window_time("window"), _ms(slide_ms))).agg(top)
    return tops.select(F.posexplode("top").alias("pos", "e")).select(
        (F.col("pos") + 1).cast("bigint").alias("rank"), *[f"e.{c}" for c in AVG_SPEED_COLUMNS]
    )


def _ms(ms: int) -> str:
    return f"{ms} milliseconds"
