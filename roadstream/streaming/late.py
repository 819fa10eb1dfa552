"""Average speeds on a stream that are corrected when passes come late.

Of every micro-batch the sums per checkpoint and pane are stored beside those of earlier ones. A
window is put out when the watermark passes its end. Passes behind the watermark are reported,
and the windows they touch that were put out before, and only these, are computed again from the
stored panes and written over in a keyed store.

    panes/batch_id=7/part=473351/...    sums of micro-batch 7 in one hour of event time
    progress/7                          the watermark after it
"""

from __future__ import annotations

from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from roadstream.functions.scalar import floor_div, mean_speed, speed_units
from roadstream.operators.flow import SLIDE_MS, WINDOW_MS
from roadstream.schemas import AVG_SPEED, AVG_SPEED_COLUMNS
from roadstream.sinks.keyed import KeyedStore
from roadstream.sinks.writers import Writer, write
from roadstream.streaming.carried import NO_WATERMARK, before, read_progress, write_progress

PART_MS = 3_600_000
_PANES = "monitor_id string, pane bigint, units bigint, n bigint, part bigint, batch_id bigint"


def average_store(spark: SparkSession, path: str) -> KeyedStore:
    """One row per window and checkpoint."""
    return KeyedStore(spark, path, ["start_time", "monitor_id"], AVG_SPEED)


def run_corrected(
    passes: DataFrame,
    writer: Writer,
    folder: str,
    report: Writer | None = None,
    delay_ms: int = 5_000,
    window_ms: int = WINDOW_MS,
    slide_ms: int = SLIDE_MS,
    part_ms: int = PART_MS,
    trigger: dict | None = None,
) -> StreamingQuery | None:
    """`writer` takes new and corrected windows, a row per (start_time, monitor_id), and should
    replace what it had for them, as a keyed store does. `report` takes the passes that were
    behind the watermark, with `behind_ms`. `folder` is for panes, progress and checkpoint.

    A late pass counts however late it is. Of the stored panes only the parts are read that hold
    the windows in question. A repeated micro-batch overwrites its panes and reads none after it.
    """
    pane_ms = gcd(window_ms, slide_ms)

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        old, newest = read_progress(spark, folder, batch_id - 1)
        top = batch.agg(F.max("action_time")).first()[0]
        if top is not None:
            newest[0] = max(top, newest.get(0, top))
        now = max(old, before(newest[0], delay_ms)) if newest else old
        late = batch.where((F.col("action_time") <= old) & F.lit(old != NO_WATERMARK))
        if report:
            report(late.withColumn("behind_ms", F.lit(old) - F.col("action_time")), batch_id)

        panes = _panes(batch, pane_ms).withColumn("part", floor_div(F.col("pane"), part_ms))
        panes.write.mode("overwrite").partitionBy("part").parquet(f"{folder}/panes/batch_id={batch_id}")
        known = spark.read.schema(_PANES).option("basePath", f"{folder}/panes").parquet(f"{folder}/panes")
        known = known.where(F.col("batch_id") <= batch_id)

        # Panes of a window that ends after the old watermark start at most a window before it.
        first_part = before(old, window_ms) // part_ms
        closing = _in_windows(known.where(F.col("part") >= first_part), window_ms, slide_ms)
        closing = closing.where((F.col("end_time") > old) & (F.col("end_time") <= now))
        touched = _in_windows(_panes(late, pane_ms), window_ms, slide_ms).where(F.col("end_time") <= old)
        touched = touched.select("monitor_id", "start_time").distinct().persist()
        parts = [r[0] for r in touched.select(_parts(window_ms, part_ms)).distinct().collect()]
        again = _in_windows(known.where(F.col("part").isin(parts)), window_ms, slide_ms)
        again = again.alias("k").join(touched.alias("t"), _same("monitor_id", "start_time"), "left_semi")
        writer(_averages(closing.unionByName(again)), batch_id)
        write_progress(spark, folder, batch_id, now, newest)
        touched.unpersist()
        batch.unpersist()

    return write(passes, each, f"{folder}/checkpoint", trigger=trigger)


def _panes(passes: DataFrame, pane_ms: int) -> DataFrame:
    pane = (F.col("action_time") - F.pmod("action_time", F.lit(pane_ms))).alias("pane")
    return passes.groupBy("monitor_id", pane).agg(
        F.sum(speed_units(F.col("speed"))).alias("units"), F.count("*").alias("n")
    )


def _in_windows(panes: DataFrame, window_ms: int, slide_ms: int) -> DataFrame:
    """A copy of each pane for every window it is part of."""
    first = floor_div(F.col("pane") - window_ms, slide_ms) + 1
    windows = F.explode(F.sequence(first, floor_div(F.col("pane"), slide_ms))).alias("w")
    return panes.select("monitor_id", "units", "n", windows).select(
        "monitor_id", "units", "n", (F.col("w") * slide_ms).alias("start_time"),
        (F.col("w") * slide_ms + window_ms).alias("end_time"),
    )


def _parts(window_ms: int, part_ms: int) -> Column:
    """The parts that hold panes of a window."""
    first = floor_div(F.col("start_time"), part_ms)
    return F.explode(F.sequence(first, floor_div(F.col("start_time") + window_ms - 1, part_ms)))


def _same(*names: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"k.{c}").eqNullSafe(F.col(f"t.{c}")) for c in names])


def _averages(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy("start_time", "end_time", "monitor_id").agg(
        F.sum("units").alias("units"), F.sum("n").alias("car_count")
    )
    mean = mean_speed(F.col("units"), F.col("car_count"))
    return sums.withColumn("avg_speed", mean).select(*AVG_SPEED_COLUMNS)
