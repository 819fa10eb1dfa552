"""Ordered operators on streams with very unequal keys.

The state machines of `machines` see all rows of one car in one task. Here a micro-batch goes
through the table operators instead, which split hot cars, and the few rows a later one may
still need are carried over in a folder all executors share: rows the watermark has not passed,
and rows the operator holds open. Of a micro-batch that runs again after a failure, all that it
had written is overwritten.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from roadstream.functions.scalar import floor_div
from roadstream.operators.area import RUNNING_MS, first_passes, running_since
from roadstream.operators.clones import GAP_SEC, clone_alarms, clone_columns, paired_passes
from roadstream.operators.danger import TIMES, WITHIN_MS, matches_of
from roadstream.operators.ordered import following
from roadstream.operators.police import BOUND_MS, SLOT_FIELDS, slot_outcomes, slot_rows
from roadstream.operators.speeding import SPEEDING_TOLERANCE
from roadstream.operators.tracks import BATCH_ROWS, numbered_tracks
from roadstream.operators.versions import open_versions, over_valid_limit
from roadstream.sinks.writers import Writer, write

Hold = Callable[[DataFrame], DataFrame]

# step(due, old, now, hold) -> (results, kept): `due` are the rows up to the watermark `now`
# together with those kept before at the watermark `old`; `kept` are rows of `due`. `hold(df)`
# caches what both results and kept rows are made of, until the micro-batch is done.
Step = Callable[[DataFrame, int, int, Hold], tuple[DataFrame, DataFrame]]

#: The watermark before the first row: below all times, so that no row is late.
NO_WATERMARK = -(1 << 63)


def run_carried(
    rows: DataFrame,
    time_col: str,
    delay_ms: int,
    step: Step,
    writer: Writer,
    folder: str,
    sides: str | None = None,
    clock: Column | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    trigger: dict | None = None,
) -> StreamingQuery | None:
    """Run `step` over a stream. `folder` takes the carried rows and Spark's checkpoint.

    `prepare` makes the rows of the step from those of a micro-batch, which may be fewer: the
    watermark goes by all of them. It is `delay_ms` behind the newest row; with a column `sides`
    of two values (0, 1), behind the newest of the side that is further back. Rows for which
    `clock` does not hold neither move it nor are they ever late.
    """

    moves = F.lit(True) if clock is None else clock

    def each(batch: DataFrame, batch_id: int) -> None:
        spark, held = batch.sparkSession, []

        def hold(df: DataFrame) -> DataFrame:
            held.append(df.persist())
            return df

        old, newest = read_progress(spark, folder, batch_id - 1)
        late = F.lit(False) if old == NO_WATERMARK else moves & (F.col(time_col) <= old)
        fresh = hold(batch.where(~late))
        side = F.col(sides) if sides else F.lit(0)
        for r in fresh.where(moves).groupBy(side.alias("s")).agg(F.max(time_col).alias("t")).collect():
            newest[r["s"]] = max(r["t"], newest.get(r["s"], r["t"]))
        complete = len(newest) == (2 if sides else 1)
        now = max(old, min(newest.values()) - delay_ms, NO_WATERMARK) if complete else old

        known = prepare(fresh)
        if batch_id > 0:
            known = known.unionByName(_read_kept(spark, folder, batch_id - 1))
        results, still_open = step(known.where(F.col(time_col) <= now), old, now, hold)
        writer(results, batch_id)
        waiting = known.where(F.col(time_col) > now).unionByName(still_open)
        waiting.write.mode("overwrite").parquet(_path(folder, "kept", batch_id))
        write_progress(spark, folder, batch_id, now, newest)
        for df in held:
            df.unpersist()

    return write(rows, each, f"{folder}/checkpoint", trigger=trigger)


def _path(folder: str, kind: str, batch_id: int) -> str:
    return f"{folder}/{kind}/{batch_id}"


def _read_kept(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(_path(folder, "kept", batch_id))


def read_progress(spark: SparkSession, folder: str, batch_id: int) -> tuple[int, dict[int, int]]:
    """The watermark, and the newest time per side: two rows at most."""
    if batch_id < 0:
        return NO_WATERMARK, {}
    rows = spark.read.parquet(_path(folder, "progress", batch_id)).collect()
    return rows[0]["watermark"], {r["side"]: r["newest"] for r in rows if r["side"] is not None}


def write_progress(spark: SparkSession, folder: str, batch_id: int, now: int, newest: dict[int, int]) -> None:
    rows = [(now, s, t) for s, t in newest.items()] or [(now, None, None)]
    spark.createDataFrame(rows, "watermark bigint, side int, newest bigint").coalesce(
        1
    ).write.mode("overwrite").parquet(_path(folder, "progress", batch_id))


def before(now: int, ms: int) -> int:
    return max(now - ms, NO_WATERMARK)


def clone_rows(traffic: DataFrame) -> DataFrame:
    return traffic.select(*clone_columns(traffic))


def clone_step(gap_sec: int = GAP_SEC, **split) -> Step:
    """Keeps the last pass of a car while it waits for a partner."""

    def step(due: DataFrame, old: int, now: int, hold: Hold) -> tuple[DataFrame, DataFrame]:
        paired = hold(paired_passes(due, gap_sec, split, _next=following(F.lit(True))))
        waits = ~F.col("_second") & F.col("_next").isNull()
        near = F.col("action_time") > before(now, (gap_sec + 1) * 1000)
        return clone_alarms(paired), paired.where(waits & near).select(*due.columns)

    return step


def danger_step(
    mode: str = "all", times: int = TIMES, within_ms: int = WITHIN_MS, **split
) -> Step:
    """Keeps the gross passes of the last `within_ms`. A match is new if it ends after the old
    watermark; a longest match is known when its time is over. Takes rows of `gross_passes`."""

    def step(due: DataFrame, old: int, now: int, hold: Hold) -> tuple[DataFrame, DataFrame]:
        due = hold(due)
        found = matches_of(due, times, within_ms, mode, split).drop("start_no")
        if mode == "all":
            new = F.col("end_time") > old
        else:
            over = F.col("start_time") + within_ms
            new = (over > old) & (over <= now)
        return found.where(new), due.where(F.col("action_time") > before(now, within_ms))

    return step


def slot_step(wait_ms: int = BOUND_MS, **split) -> Step:
    """Keeps the last row of a car while its slot is still open. Takes rows of `slot_rows`."""

    def step(due: DataFrame, old: int, now: int, hold: Hold) -> tuple[DataFrame, DataFrame]:
        pairs, alone = slot_outcomes(due, wait_ms, split, hold)
        waits = F.col("_is_last") & (F.col("at") > before(now, wait_ms))
        done = alone.where(~waits).select("outcome", "car", *SLOT_FIELDS)
        return pairs.unionByName(done), alone.where(waits).select(*due.columns)

    return step


def slot_sides(violations: DataFrame, police: DataFrame) -> DataFrame:
    return slot_rows(violations, police).select("car", "at", "side", *SLOT_FIELDS)


def speeding_step(tolerance: float = SPEEDING_TOLERANCE, **split) -> Step:
    """Keeps the open version of each checkpoint. Takes rows of `versions.merged`; versions should not move the watermark
    (`clock`), as limits change seldom: one that comes late counts for the passes not judged yet."""

    def step(due: DataFrame, old: int, now: int, hold: Hold) -> tuple[DataFrame, DataFrame]:
        due = hold(due)
        return over_valid_limit(due, tolerance, **split), open_versions(due)

    return step


def running_rows(traffic: DataFrame) -> DataFrame:
    """Passes for `running_step`; `seen` marks carried rows."""
    return traffic.drop("event_ts").withColumn("seen", F.lit(False))


def running_step(window_ms: int = RUNNING_MS, **split) -> Step:
    """Keeps the first pass of each car per area and window that is still open: a pass adds to the count of its window what
    was carried for it, and the passes of the micro-batch before it."""

    def step(due: DataFrame, old: int, now: int, hold: Hold) -> tuple[DataFrame, DataFrame]:
        due = hold(due)
        firsts = hold(first_passes(due, window_ms))
        results = running_since(due, firsts, window_ms, split)
        kept = firsts.where(F.col("window_start") + window_ms > now)
        return results, kept.select(*[F.lit(True).alias("seen") if c == "seen" else c for c in due.columns])

    return step


def track_rows(tracks: DataFrame) -> DataFrame:
    """Tracks for `track_step`. `no` is the place of a row in the order of all, once it is known,
    `done` says that it is written."""
    return tracks.drop("event_ts").withColumns(
        {"no": F.lit(None).cast("bigint"), "done": F.lit(False)})


def track_step(size: int = BATCH_ROWS, wait_ms: int | None = None, **cells) -> Step:
    """Batches of `size` rows over the order of all rows. Keeps the rows of the open last batch,
    and the last row of all, from which the numbering goes on. With `wait_ms`, an open batch whose
    last row is that far behind the watermark is written as it is; what follows in it later comes
    under the same number. The number is `track_batch`: `batch_id` is that of a micro-batch."""

    def step(due: DataFrame, old: int, now: int, hold: Hold) -> tuple[DataFrame, DataFrame]:
        known = due.where(F.col("no").isNotNull())
        last = known.agg(F.max("no")).first()[0]
        fresh = numbered_tracks(due.where(F.col("no").isNull()).drop("no"), "no", **cells)
        start = 0 if last is None else last + 1
        rows = known.unionByName(fresh.withColumn("no", F.col("no") + start))
        rows = hold(rows.withColumn("track_batch", floor_div(F.col("no"), size)))
        end = rows.agg(F.max("no").alias("no"), F.max("action_time").alias("at")).first()
        full = 0 if end["no"] is None else (end["no"] + 1) // size  # batches below this are full
        flush = wait_ms is not None and end["no"] is not None and end["at"] <= before(now, wait_ms)
        ready = F.lit(flush) | (F.col("track_batch") < full)
        results = rows.where(ready & ~F.col("done")).drop("no", "done")
        still = rows.where((~ready & ~F.col("done")) | (F.col("no") == F.lit(end["no"])))
        return results, still.withColumn("done", F.col("done") | ready).select(*due.columns)

    return step
