"""The streaming jobs, from lines to results, and a way to drain one over a finished input.

A job takes the lines of its inputs as DataFrames with a `value` column, from a topic or a
folder, and gives the result stream for a writer of `roadstream.sinks`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from roadstream.functions.scalar import with_warning_time
from roadstream.operators import area, clones, danger, flow, police, speeding, tracks, versions
from roadstream.plans import fixtures as fx
from roadstream.schemas import AREA_COUNT, LIMIT_VERSION, POLICE_ACTION, TRAFFIC, VIOLATION
from roadstream.session import shared_dir
from roadstream.sinks.by_day import DayStore, to_days
from roadstream.sinks.keyed import KeyedStore
from roadstream.sinks.writers import Writer, latest_counts, to_folder, to_keyed_store, write, write_speeding
from roadstream.sources.lines import MAX_TIME, parse_limit_version, parse_police, parse_traffic, parse_violation, read_lines_stream
from roadstream.streaming import carried, late
from roadstream.streaming.area_counts import area_running_stream
from roadstream.streaming.machines import (
    cloned_plates_stream, dangerous_drivers_stream, reconcile_slots_stream,
)
from roadstream.streaming.watermark import FLOW_DELAY, IN_ORDER, POLICE_DELAY, with_watermark


def _traffic(lines: DataFrame, delay: str, mode: str = "event") -> DataFrame:
    return with_watermark(parse_traffic(lines), delay, mode=mode)


def _police_sides(violation_lines: DataFrame, police_lines: DataFrame):
    return (
        with_watermark(parse_violation(violation_lines), POLICE_DELAY, "create_time"),
        with_watermark(parse_police(police_lines), POLICE_DELAY),
    )


def speeding_job(lines: DataFrame, limits: DataFrame) -> DataFrame:
    return speeding.speeding(parse_traffic(lines), limits)


def run_speeding(
    lines: DataFrame,
    read_limits: Callable[[], DataFrame],
    writer: Writer,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery | None:
    """`speeding_job` with limits that change: they are read again for every micro-batch, which
    follows new, changed and removed limits, and their size is checked anew each time."""

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = speeding.speeding(batch, read_limits())
        write_speeding(rows, lambda df, _: writer(df, batch_id))

    return write(parse_traffic(lines), each, checkpoint, trigger=trigger)


def avg_speed_job(lines: DataFrame) -> DataFrame:
    return flow.avg_speed(_traffic(lines, FLOW_DELAY))


def congestion_job(lines: DataFrame, n: int = 3) -> DataFrame:
    return flow.congestion_topn(_traffic(lines, FLOW_DELAY), n)


def area_job(lines: DataFrame, mode: str = "event") -> DataFrame:
    """mode="processing" counts by arrival instead of by the time in the rows."""
    return area.area_distinct(_traffic(lines, IN_ORDER, mode))


def area_running_job(lines: DataFrame, mode: str = "event") -> DataFrame:
    return area_running_stream(_traffic(lines, IN_ORDER, mode))


def area_approx_job(lines: DataFrame, mode: str = "event") -> DataFrame:
    return area.area_approx_distinct(_traffic(lines, IN_ORDER, mode))


def clones_job(lines: DataFrame, warned: bool = False) -> DataFrame:
    """With `warned`, each alarm also says when it was raised."""
    traffic = _traffic(lines, IN_ORDER)
    alarms = (cloned_plates_stream if lines.isStreaming else clones.cloned_plates)(traffic)
    return with_warning_time(alarms) if warned else alarms


def clone_violations_job(lines: DataFrame) -> DataFrame:
    """Alarms as violations, for `write_violation_once_per_day`."""
    return clones.as_violations(clones_job(lines))


def danger_job(
    lines: DataFrame, limits: DataFrame, mode: str = "all", warned: bool = False
) -> DataFrame:
    """With `warned`, each match also says when it was reported."""
    traffic = _traffic(lines, FLOW_DELAY)
    if lines.isStreaming:
        found = dangerous_drivers_stream(traffic, limits, mode=mode)
    else:
        found = danger.dangerous_drivers(traffic, limits, mode=mode).drop("start_no")
    return with_warning_time(found) if warned else found


def police_match_job(violation_lines: DataFrame, police_lines: DataFrame) -> DataFrame:
    return police.interval_join(*_police_sides(violation_lines, police_lines))


def reconcile_job(violation_lines: DataFrame, police_lines: DataFrame) -> DataFrame:
    return police.reconcile(*_police_sides(violation_lines, police_lines))


def slots_job(violation_lines: DataFrame, police_lines: DataFrame) -> DataFrame:
    sides = _police_sides(violation_lines, police_lines)
    if violation_lines.isStreaming:
        return reconcile_slots_stream(*sides)
    return police.reconcile_slots(*sides)


def tracks_job(lines: DataFrame, violations: DataFrame) -> DataFrame:
    return tracks.car_tracks(parse_traffic(lines), violations)


def corrected_averages(
    folder: str, lines: DataFrame, report: Writer | None = None, **kw
) -> StreamingQuery:
    """Average speeds in a store by key, late passes counted."""
    store = late.average_store(lines.sparkSession, f"{folder}/store")
    return late.run_corrected(
        parse_traffic(lines), to_keyed_store(store), f"{folder}/carried", report,
        **{"trigger": ONCE, **kw},
    )


def clones_by_day(folder: str, lines: DataFrame, gap_sec: int = clones.GAP_SEC) -> StreamingQuery:
    """Alarms as violations, the first per car and day, in a store by day."""
    put = to_days(DayStore(lines.sparkSession, f"{folder}/store"), merge_every=2)
    return carried.run_carried(
        carried.clone_rows(parse_traffic(lines)), "action_time", 0, carried.clone_step(gap_sec),
        lambda alarms, batch_id: put(clones.as_violations(alarms), batch_id),
        f"{folder}/carried", trigger=ONCE,
    )


def track_batches_carried(
    folder: str, lines: DataFrame, violations: DataFrame, wait_ms: int | None = None
) -> StreamingQuery:
    """Tracks of listed cars in batches of ten, numbered on over the micro-batches."""
    return carried.run_carried(
        parse_traffic(lines), "action_time", 0, carried.track_step(wait_ms=wait_ms),
        to_folder(f"{folder}/out"), f"{folder}/carried",
        prepare=lambda batch: carried.track_rows(tracks.car_tracks(batch, violations)), trigger=ONCE,
    )


# Draining: the inputs arrive as lines in the shared folder, slice by slice in time.

FAR_FUTURE = 4102444800000  # 2100-01-01: the closing row is not before that
DAY_MS = 24 * 60 * 60 * 1000
SLICES = 2  # at least, so that state is carried over
BYTES_PER_SLICE = 256 << 30
# Where the rows of one car go through one task, a slice must fit it whole.
BYTES_PER_STATE_SLICE = 64 << 20
BYTES_PER_PARTITION = 32 << 20
BYTES_PER_STATE_PARTITION = 2 << 20  # these rows go through Python: a slice must keep all cores busy
ONCE = {"availableNow": True}

# start(folder, **streams) starts a query that writes to <folder>/out.
Start = Callable[..., StreamingQuery]


def to_results(job: Callable[..., DataFrame], output_mode: str = "append") -> Start:
    """Write what `job` makes of the streams."""

    def start(folder: str, **inputs: DataFrame) -> StreamingQuery:
        out, checkpoint = to_folder(f"{folder}/out"), f"{folder}/checkpoint"
        return write(job(**inputs), out, checkpoint, output_mode, ONCE)

    return start


def clones_carried(folder: str, lines: DataFrame) -> StreamingQuery:
    rows = carried.clone_rows(parse_traffic(lines))
    return carried.run_carried(
        rows, "action_time", 0, carried.clone_step(), to_folder(f"{folder}/out"),
        f"{folder}/carried", trigger=ONCE,
    )


def danger_carried(folder: str, lines: DataFrame, limits: DataFrame, mode: str = "all"):
    return carried.run_carried(
        parse_traffic(lines), "action_time", 5_000, carried.danger_step(mode),
        to_folder(f"{folder}/out"), f"{folder}/carried",
        prepare=lambda batch: danger.gross_passes(batch, limits), trigger=ONCE,
    )


def slots_carried(folder: str, violation_lines: DataFrame, police_lines: DataFrame):
    rows = carried.slot_sides(parse_violation(violation_lines), parse_police(police_lines))
    return carried.run_carried(
        rows, "at", 2_000, carried.slot_step(), to_folder(f"{folder}/out"),
        f"{folder}/carried", sides="side", trigger=ONCE,
    )


def versions_carried(folder: str, lines: DataFrame, limit_lines: DataFrame) -> StreamingQuery:
    """Speeding with limits that arrive as versions; the watermark goes by the passes."""
    rows = versions.merged(parse_traffic(lines), parse_limit_version(limit_lines))
    return carried.run_carried(
        rows, "at", 5_000, carried.speeding_step(), to_folder(f"{folder}/out"),
        f"{folder}/carried", clock=F.col("side") == versions.PASS_SIDE, trigger=ONCE,
    )


def running_carried(folder: str, lines: DataFrame, writer: Writer | None = None) -> StreamingQuery:
    """The number of distinct cars after each pass, by area and window."""
    return carried.run_carried(
        carried.running_rows(parse_traffic(lines)), "action_time", 0, carried.running_step(),
        writer or to_folder(f"{folder}/out"), f"{folder}/carried", trigger=ONCE,
    )


def area_store(spark: SparkSession, folder: str) -> KeyedStore:
    return KeyedStore(spark, f"{folder}/store", ["window_end", "area_id"], AREA_COUNT)


def counts_to_store(folder: str, lines: DataFrame) -> StreamingQuery:
    """The latest count per window and area, kept in a store by key."""
    store = area_store(lines.sparkSession, folder)
    return running_carried(folder, lines, latest_counts(to_keyed_store(store, compact_every=2)))


def drain(
    spark: SparkSession,
    inputs: dict[str, DataFrame],
    start: Start,
    bytes_per_slice: int = BYTES_PER_SLICE,
    read: Callable[[SparkSession, str], DataFrame] | None = None,
    slices: int = SLICES,
    bytes_per_partition: int = BYTES_PER_PARTITION,
) -> DataFrame:
    """Results over all of `inputs` (name -> rows of `at`, `value`), taken in as streams. What
    waits in the state is never more than a slice and the rows in the delay. `read` gives the
    results from the folder, if they are not in <folder>/out."""
    base = f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"
    bounds, slice_bytes = _slices(inputs, bytes_per_slice, slices)
    array = F.array(*map(F.lit, bounds)).cast("array<bigint>")
    number = F.size(F.filter(array, lambda b: b <= F.col("at"))).alias("slice")  # 0 where a time is null
    staged = {}
    for name, rows in inputs.items():  # one pass; each slice is then read alone
        rows.select("value", number).write.partitionBy("slice").parquet(f"{base}/staged/{name}")
        staged[name] = spark.read.schema("value string, slice int").parquet(f"{base}/staged/{name}")
    with _state_partitions(spark, slice_bytes // bytes_per_partition):
        for i in range(len(bounds) + 1):
            for name, rows in staged.items():
                part = rows.where(F.col("slice") == i).select("value")
                part.write.mode("append").text(f"{base}/in/{name}")
            streams = {name: read_lines_stream(spark, f"{base}/in/{name}") for name in inputs}
            start(base, **streams).awaitTermination()
    for done in ("staged", "in", "checkpoint", "carried"):
        _remove(spark, f"{base}/{done}")
    return read(spark, base) if read else spark.read.parquet(f"{base}/out").drop("batch_id")


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _slices(inputs: dict[str, DataFrame], bytes_per_slice: int, at_least: int) -> tuple[list[int], int]:
    """Times that divide the rows into slices of about equally many, and the bytes of one slice.
    All inputs share them, so that neither runs ahead. The first and the last slice are open."""
    both = [df.select("at", F.octet_length("value").alias("b")) for df in inputs.values()]
    rows = reduce(DataFrame.unionByName, both)
    size = rows.agg(F.sum("b")).first()[0] or 0
    n = max(at_least, -(-size // bytes_per_slice))
    inner = rows.approxQuantile("at", [i / n for i in range(1, n)], 0.1 / n)
    return sorted({int(b) for b in inner}), size // n


@contextmanager
def _state_partitions(spark: SparkSession, n: int):
    """As many partitions of state as a slice asks for: unlike the shuffles of a table job,
    those of a stream are not fitted to the data by Spark."""
    name = "spark.sql.shuffle.partitions"
    given = spark.conf.get(name)
    spark.conf.set(name, str(max(4, n)))
    try:
        yield
    finally:
        spark.conf.set(name, given)


def traffic_lines(spark: SparkSession, sf_dir: str, raw_time: bool = False) -> DataFrame:
    rows = fx.traffic(spark, sf_dir, raw_time)
    return _as_lines(rows, TRAFFIC, "action_time", closing_time(rows.select("action_time")))


def delayed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic where the passes of some cameras arrive a quarter of an hour after their time."""
    delay = F.when(F.col("camera_id") < "20000", 900_000).otherwise(0)
    rows = fx.traffic(spark, sf_dir)
    at = closing_time(rows.select("action_time"))
    return _as_lines(rows, TRAFFIC, "action_time", at, F.col("action_time") + delay)


def violation_police_lines(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Both sides, closed at one time."""
    v, p = fx.violations(spark, sf_dir), fx.police_actions(spark, sf_dir)
    at = closing_time(v.select("create_time").union(p.select("action_time")))
    return {
        "violation_lines": _as_lines(v, VIOLATION, "create_time", at),
        "police_lines": _as_lines(p, POLICE_ACTION, "action_time", at),
    }


def limit_lines(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Passes and versions of limits, closed at one time."""
    rows, limits = fx.traffic(spark, sf_dir), fx.limit_versions(spark, sf_dir)
    at = closing_time(rows.select("action_time").union(limits.select("valid_from")))
    return {
        "lines": _as_lines(rows, TRAFFIC, "action_time", at),
        "limit_lines": _as_lines(limits, LIMIT_VERSION, "valid_from", at),
    }


def closing_time(times: DataFrame) -> int:
    """A day after the last time that a line can have, and not before `FAR_FUTURE`."""
    at = F.col(times.columns[0])
    last = times.agg(F.max(F.when(at <= MAX_TIME, at))).first()[0]
    return FAR_FUTURE if last is None else min(max(FAR_FUTURE, last + DAY_MS), MAX_TIME)


def _as_lines(df: DataFrame, schema: T.StructType, time_col: str, closing_at: int, arrival: Column | None = None) -> DataFrame:
    """Wire lines of a table with the time they arrive (their own if not given), and a closing row that lets the watermark pass all
    others. Its keys say `closing` and the name of the time column."""
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in schema.fieldNames()]
    line = F.concat_ws(",", *fields)  # which would leave out nulls, and so shift fields
    at = F.col(time_col) if arrival is None else arrival
    rows = df.select(at.alias("at"), line.alias("value"))
    closing = ",".join(
        str(closing_at) if f.name == time_col
        else "0" if isinstance(f.dataType, T.DoubleType) else f"closing {time_col}"
        for f in schema
    )
    last = df.sparkSession.range(1).select(
        F.lit(closing_at).alias("at"), F.lit(closing).alias("value")
    )
    return rows.unionByName(last)
