"""Running distinct cars per area and window on a stream, from bit vectors in the state."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from roadstream.functions.scalar import bit_offsets, floor_div, window_area_key
from roadstream.operators.area import BLOOM_BITS, RUNNING_MS

SHARDS = 32
_KEYS = ["area_id", "window_end", "shard"]


def area_running_stream(
    traffic: DataFrame, window_ms: int = RUNNING_MS, bits: int = BLOOM_BITS, shards: int = SHARDS
) -> DataFrame:
    """The number of cars seen so far per (area, window, shard), new with every micro-batch.

    The cars of an area are spread over `shards` state entries by hash, with bits / shards bits
    each: a busy area is not one task's work, and an update rewrites a small vector. A car is
    always in one shard, so the count of an area is the sum over its shards (`area_totals`).
    Bits and count live and expire together, with the window.
    """
    shard_bits = max(8, bits // shards)
    # The shard comes from a hash of its own, so that it does not thin out the bit positions.
    shard = F.pmod(F.xxhash64(F.lit("shard"), "car"), F.lit(shards)).cast("int")
    rows = traffic.select(
        "area_id",
        ((floor_div(F.unix_millis("event_ts"), window_ms) + 1) * window_ms).alias("window_end"),
        shard.alias("shard"),
        "event_ts",
        bit_offsets(F.col("car"), shard_bits).alias("bits"),
    ).select(*_KEYS, "event_ts", F.col("bits")[0].alias("bit0"), F.col("bits")[1].alias("bit1"))
    return rows.groupBy(*_KEYS).applyInPandasWithState(
        _counter(shard_bits),
        "area_id string, window_end bigint, shard int, car_count bigint",
        "bits BINARY, car_count BIGINT",
        "update",
        GroupStateTimeout.EventTimeTimeout,
    )


def _counter(shard_bits: int):
    def count(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        if state.exists:
            packed, cars = state.get
            seen = np.unpackbits(np.frombuffer(packed, dtype=np.uint8))
        else:
            seen, cars = np.zeros(-(-shard_bits // 8) * 8, dtype=np.uint8), 0
        for frame in frames:
            # A pass counts if it is the first for one of its bits, as in `area_bloom_distinct`.
            bits, first = np.unique(frame[["bit0", "bit1"]].to_numpy().ravel(), return_index=True)
            cars += len(np.unique(first[seen[bits] == 0] // 2))
            seen[bits] = 1
        state.update((np.packbits(seen).tobytes(), cars))
        state.setTimeoutTimestamp(max(int(key[1]), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(*key, cars)], columns=[*_KEYS, "car_count"])

    return count


def area_totals(counts: DataFrame) -> DataFrame:
    """Distinct cars per area and window from all counts written so far. Counts only grow, so
    the largest of a shard is its latest."""
    latest = counts.groupBy(*_KEYS).agg(F.max("car_count").alias("car_count"))
    totals = latest.groupBy("area_id", "window_end").agg(F.sum("car_count").alias("car_count"))
    return totals.withColumn("window_key", window_area_key(F.col("window_end"), F.col("area_id")))
