"""Registered queries: name -> (spark, sf_dir) -> DataFrame."""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from roadstream.functions import messages
from roadstream.functions.scalar import window_area_key
from roadstream.operators import area, clones, danger, flow, police, speeding, tracks, versions
from roadstream.plans import fixtures as fx, streams
from roadstream.schemas import POLICE_ACTION, TRACK, TRAFFIC, VIOLATION
from roadstream.session import shared_dir, snapshot
from roadstream.sinks.by_day import DayStore
from roadstream.sinks.keyed import KeyedStore
from roadstream.sources import lines
from roadstream.streaming import late

Query = Callable[[SparkSession, str], DataFrame]

# Small enough that the test tables have keys above it: those queries take the path of hot keys.
SPLIT = {"hot_rows": 40, "cell_rows": 2000}
SIX_HOURS = 6 * 3600


def limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speeding.monitor_limits(fx.monitor_info(spark, sf_dir))


def speeding_passes(spark, sf_dir):
    return speeding.speeding(fx.traffic(spark, sf_dir), limits(spark, sf_dir))


def speeding_large_lookup(spark, sf_dir):
    """As `speeding`, with the lookup treated as too large to broadcast."""
    return speeding.speeding(
        fx.traffic(spark, sf_dir), limits(spark, sf_dir), broadcast_rows=0, hot_rows=50, salts=8
    )


def with_default_limit(spark, sf_dir):
    return speeding.with_limit(fx.traffic(spark, sf_dir), limits(spark, sf_dir))


def speeding_versions(spark, sf_dir, **split):
    """Each pass against the limit that was valid at its time; limits change and are taken away."""
    return versions.speeding_at(fx.traffic(spark, sf_dir), fx.limit_versions(spark, sf_dir), **split)


def speeding_versions_split(spark, sf_dir):
    return speeding_versions(spark, sf_dir, **SPLIT)


def avg_speed_sliding(spark, sf_dir):
    return flow.avg_speed(fx.traffic(spark, sf_dir))


def congestion_top3(spark, sf_dir):
    return flow.congestion_topn(fx.traffic(spark, sf_dir))


def congestion_messages(spark, sf_dir):
    return messages.congestion_messages(congestion_top3(spark, sf_dir))


def area_distinct_10s(spark, sf_dir):
    return area.area_distinct(fx.traffic(spark, sf_dir)).withColumn(
        "message", messages.area_message()
    )


def area_running_distinct(spark, sf_dir, **split):
    return area.area_running_distinct(fx.traffic(spark, sf_dir), **split).withColumn(
        "window_key", window_area_key(F.col("window_end"), F.col("area_id"))
    )


def area_running_distinct_split(spark, sf_dir):
    return area_running_distinct(spark, sf_dir, **SPLIT)


def area_bloom_distinct(spark, sf_dir):
    return area.area_bloom_distinct(fx.traffic(spark, sf_dir))


def area_approx_distinct(spark, sf_dir):
    return area.area_approx_distinct(fx.traffic(spark, sf_dir))


def area_approx_within(spark, sf_dir):
    """Exact counts, and whether those of `area_approx_distinct` are within a tenth of them."""
    t = fx.traffic(spark, sf_dir)
    exact = area.area_distinct(t, area.RUNNING_MS)
    return area.within_bound(area.area_approx_distinct(t), exact, 0.1)


def area_sketch_windows(spark, sf_dir):
    """Sketches per minute are stored; windows of five minutes are merged from them every minute.
    Exact counts, and whether the merged ones are within the bound of the sketch."""
    t = fx.traffic(spark, sf_dir)
    path = f"{shared_dir(spark)}/sketches/{uuid.uuid4().hex}"
    area.area_sketches(t).write.parquet(path)
    five = area.merged_sketches(spark.read.parquet(path), 5 * area.PANE_MS, area.PANE_MS)
    starts = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k")
    slid = t.select("*", starts).withColumn(
        "window_start", F.col("action_time") - F.pmod("action_time", F.lit(area.PANE_MS)) - F.col("k") * area.PANE_MS)
    exact = slid.groupBy("area_id", "window_start").agg(F.countDistinct("car").alias("car_count")).withColumn(
        "window_end", F.col("window_start") + 5 * area.PANE_MS)
    return area.within_bound(five, exact)


def cloned_plates(spark, sf_dir, **split):
    return clones.cloned_plates(fx.traffic(spark, sf_dir), **split)


def cloned_plates_split(spark, sf_dir):
    return cloned_plates(spark, sf_dir, **SPLIT)


def clone_once_per_day(spark, sf_dir):
    """Alarms over thirty real days, at a gap of six hours; cars with an error that day are
    on the list already."""
    alarms = clones.cloned_plates(fx.traffic(spark, sf_dir, raw_time=True), SIX_HOURS)
    return clones.once_per_day(
        clones.as_violations(alarms), fx.violations(spark, sf_dir, raw_time=True)
    )


def dangerous_drivers_all(spark, sf_dir):
    return danger.dangerous_drivers(
        fx.traffic(spark, sf_dir), limits(spark, sf_dir), mode="all"
    )


def dangerous_drivers_longest(spark, sf_dir, **split):
    return danger.dangerous_drivers(
        fx.traffic(spark, sf_dir), limits(spark, sf_dir), mode="longest", **split
    )


def dangerous_drivers_longest_split(spark, sf_dir):
    return dangerous_drivers_longest(spark, sf_dir, hot_rows=15, cell_rows=600)


def dangerous_driver_messages(spark, sf_dir):
    passes = danger.numbered_passes(fx.traffic(spark, sf_dir), limits(spark, sf_dir))
    return danger.danger_messages(dangerous_drivers_longest(spark, sf_dir), passes)


def violation_police_interval(spark, sf_dir):
    return police.interval_join(
        fx.violations(spark, sf_dir), fx.police_actions(spark, sf_dir)
    ).withColumn("message", messages.police_pair_message())


def violation_police_reconcile(spark, sf_dir):
    rows = police.reconcile(fx.violations(spark, sf_dir), fx.police_actions(spark, sf_dir))
    return rows.withColumn(
        "message", F.when(F.col("outcome") == police.MATCHED, messages.police_match_message())
    )


def violation_police_slots(spark, sf_dir, **split):
    return police.reconcile_slots(
        fx.violations(spark, sf_dir), fx.police_actions(spark, sf_dir), **split
    )


def violation_police_slots_split(spark, sf_dir):
    return violation_police_slots(spark, sf_dir, hot_rows=20, cell_rows=1000)


def car_tracks(spark, sf_dir):
    return tracks.car_tracks(fx.traffic(spark, sf_dir), fx.violations(spark, sf_dir))


def car_tracks_latest(spark, sf_dir):
    return tracks.latest_per_key(car_tracks(spark, sf_dir))


def car_tracks_few(spark, sf_dir):
    """Tracks where most cars are not on the list."""
    return tracks.car_tracks(fx.traffic(spark, sf_dir), fx.serious_violations(spark, sf_dir))


def car_tracks_large_list(spark, sf_dir):
    """As `car_tracks_few`, with the list treated as too large to broadcast: a Bloom filter of it
    goes before the shuffle."""
    return tracks.car_tracks(
        fx.traffic(spark, sf_dir), fx.serious_violations(spark, sf_dir),
        broadcast_rows=0, hot_rows=50,
    )


def track_store(spark, sf_dir):
    """Tracks whose row keys repeat, put into a keyed store by three micro-batches, of which the
    second comes twice, with a compaction between."""
    rows = tracks.car_tracks(fx.minute_traffic(spark, sf_dir), fx.serious_violations(spark, sf_dir))
    rows = snapshot(rows.withColumn("third", F.ntile(3).over(Window.partitionBy("row_key").orderBy("event_id")) - 1))
    path = f"{shared_dir(spark)}/tracks/{uuid.uuid4().hex}"
    store = KeyedStore(spark, path, ["row_key"], TRACK)
    for batch_id, third in ((0, 0), (1, 1), (1, 1), (2, 2)):
        part = rows.where(F.col("third") == third)
        store.put(tracks.latest_per_key(part), batch_id)
        if batch_id == 1:
            store.compact()
    return store.read()


def track_batches(spark, sf_dir):
    rows = tracks.track_batches(car_tracks(spark, sf_dir))
    return rows.select("event_id", "row_key", "batch_id")


def traffic_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic as wire lines. Purchases lack the last field, sign-ups have no number as speed,
    and clicks come with a field too many: bad, bad and good lines to the parser."""
    t = fx.passes(spark, sf_dir)
    speed = F.when(F.col("event_type") == "signup", "fast").otherwise(
        F.col("speed").cast("string")
    )
    tail = (
        F.when(F.col("event_type") == "purchase", "")
        .when(F.col("event_type") == "click", F.concat(F.lit(","), "area_id", F.lit(",x")))
        .otherwise(F.concat(F.lit(","), "area_id"))
    )
    head = [F.col(c).cast("string") for c in ("action_time", "monitor_id", "camera_id", "car")]
    return t.select(
        "event_id", F.concat(F.concat_ws(",", *head, speed, "road_id"), tail).alias("value")
    )


def parse_traffic_lines(spark, sf_dir):
    return lines.parse(traffic_lines(spark, sf_dir), TRAFFIC).select(
        "event_id", *[_if_good(c) for c in TRAFFIC.fieldNames()], "reject_reason"
    )


def parse_violation_police(spark, sf_dir):
    v = fx.violations(spark, sf_dir).select(
        F.concat_ws(",", *VIOLATION.fieldNames()).alias("value")
    )
    p = fx.police_actions(spark, sf_dir).select(
        F.concat_ws(",", *POLICE_ACTION.fieldNames()).alias("value")
    )
    parsed_v = lines.parse_violation(v).withColumn("kind", F.lit("violation"))
    parsed_p = lines.parse_police(p).withColumn("kind", F.lit("police"))
    return parsed_v.unionByName(parsed_p, allowMissingColumns=True)


def _if_good(name: str) -> Column:
    return F.when(F.col("reject_reason").isNull(), F.col(name)).alias(name)


QUERIES: dict[str, Query] = {
    "speeding": speeding_passes,
    "speeding_large_lookup": speeding_large_lookup,
    "speeding_versions": speeding_versions,
    "speeding_versions_split": speeding_versions_split,
    "with_default_limit": with_default_limit,
    "avg_speed_sliding": avg_speed_sliding,
    "congestion_top3": congestion_top3,
    "congestion_messages": congestion_messages,
    "area_distinct_10s": area_distinct_10s,
    "area_running_distinct": area_running_distinct,
    "area_running_distinct_split": area_running_distinct_split,
    "area_bloom_distinct": area_bloom_distinct,
    "area_approx_distinct": area_approx_distinct,
    "area_approx_within": area_approx_within,
    "area_sketch_windows": area_sketch_windows,
    "cloned_plates": cloned_plates,
    "cloned_plates_split": cloned_plates_split,
    "clone_once_per_day": clone_once_per_day,
    "dangerous_drivers_all": dangerous_drivers_all,
    "dangerous_drivers_longest": dangerous_drivers_longest,
    "dangerous_drivers_longest_split": dangerous_drivers_longest_split,
    "dangerous_driver_messages": dangerous_driver_messages,
    "violation_police_interval": violation_police_interval,
    "violation_police_reconcile": violation_police_reconcile,
    "violation_police_slots": violation_police_slots,
    "violation_police_slots_split": violation_police_slots_split,
    "car_tracks": car_tracks,
    "car_tracks_few": car_tracks_few,
    "car_tracks_large_list": car_tracks_large_list,
    "car_tracks_latest": car_tracks_latest,
    "track_store": track_store,
    "track_batches": track_batches,
    "parse_traffic_lines": parse_traffic_lines,
    "parse_violation_police": parse_violation_police,
}


# The streaming jobs, drained over the whole input. Their lines have no event id, so equal times
# of a car are ordered by the other fields; the SQL for them orders likewise.


def _traffic_stream(job, output_mode: str = "append", **kw) -> Query:
    """`job(spark, sf_dir, lines)` gives the result stream."""

    def start(spark, sf_dir):
        return streams.to_results(lambda lines: job(spark, sf_dir, lines), output_mode)

    return _traffic_run(start, **kw)


def _traffic_run(start, **kw) -> Query:
    """`start(spark, sf_dir)` gives what starts the query."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        inputs = {"lines": streams.traffic_lines(spark, sf_dir)}
        return streams.drain(spark, inputs, start(spark, sf_dir), **kw)

    return query


def _police_run(start: streams.Start, **kw) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return streams.drain(spark, streams.violation_police_lines(spark, sf_dir), start, **kw)

    return query


def _danger_carried(mode: str) -> Query:
    return _traffic_run(
        lambda s, d: lambda folder, lines: streams.danger_carried(folder, lines, limits(s, d), mode)
    )


def area_running_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count after each pass, and its message."""
    counts = _traffic_run(lambda s, d: streams.running_carried)(spark, sf_dir)
    # The area of the closing row is not part of the input.
    return counts.where(F.col("area_id") != "closing action_time").withColumn("message", messages.area_message())


def area_counts_store_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store's one value per window end and area after the stream, by key."""
    counts = _traffic_run(
        lambda s, d: streams.counts_to_store, read=lambda s, folder: streams.area_store(s, folder).read()
    )(spark, sf_dir)
    return counts.where(F.col("area_id") != "closing action_time").withColumn(
        "window_key", window_area_key(F.col("window_end"), F.col("area_id")))


def speeding_versions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.drain(spark, streams.limit_lines(spark, sf_dir), streams.versions_carried)


def avg_speed_late_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some cameras are late by more than a window: what they missed is corrected."""
    return streams.drain(
        spark, {"lines": streams.delayed_lines(spark, sf_dir)}, streams.corrected_averages,
        read=lambda s, folder: late.average_store(s, f"{folder}/store").read(), slices=4)


def clone_once_per_day_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first alarm per car and day over thirty real days, at a gap of six hours."""
    return streams.drain(
        spark, {"lines": streams.traffic_lines(spark, sf_dir, raw_time=True)},
        lambda folder, lines: streams.clones_by_day(folder, lines, SIX_HOURS),
        read=lambda s, folder: DayStore(s, f"{folder}/store").read(), slices=4)


def track_batches_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = fx.violations(spark, sf_dir)
    start = lambda s, d: lambda folder, lines: streams.track_batches_carried(
        folder, lines, listed, streams.DAY_MS)
    return _traffic_run(start, slices=3)(spark, sf_dir).withColumnRenamed("track_batch", "batch_id")


_IN_STATE = {
    "bytes_per_slice": streams.BYTES_PER_STATE_SLICE,
    "bytes_per_partition": streams.BYTES_PER_STATE_PARTITION,
}

QUERIES |= {
    "speeding_stream": _traffic_stream(lambda s, d, x: streams.speeding_job(x, limits(s, d))),
    "avg_speed_stream": _traffic_stream(lambda s, d, x: streams.avg_speed_job(x)),
    "congestion_top3_stream": _traffic_stream(lambda s, d, x: streams.congestion_job(x)),
    "area_distinct_stream": _traffic_stream(lambda s, d, x: streams.area_job(x)),
    "area_running_stream": area_running_stream,
    "area_counts_store_stream": area_counts_store_stream,
    "speeding_versions_stream": speeding_versions_stream,
    "avg_speed_late_stream": avg_speed_late_stream,
    "clone_once_per_day_stream": clone_once_per_day_stream,
    "track_batches_stream": track_batches_stream,
    "car_tracks_stream": _traffic_stream(
        lambda s, d, x: streams.tracks_job(x, fx.violations(s, d))
    ),
    "violation_police_interval_stream": _police_run(streams.to_results(streams.police_match_job)),
    "violation_police_reconcile_stream": _police_run(streams.to_results(streams.reconcile_job)),
    # Ordered operators: through the table operators with carried rows (`_stream`), which holds
    # for cars with very many rows, and by a state machine per car (`_state`).
    "cloned_plates_stream": _traffic_run(lambda s, d: streams.clones_carried),
    "cloned_plates_state": _traffic_stream(
        lambda s, d, x: streams.clones_job(x), **_IN_STATE
    ),
    "dangerous_drivers_all_stream": _danger_carried("all"),
    "dangerous_drivers_all_state": _traffic_stream(
        lambda s, d, x: streams.danger_job(x, limits(s, d)), **_IN_STATE
    ),
    "dangerous_drivers_longest_stream": _danger_carried("longest"),
    "dangerous_drivers_longest_state": _traffic_stream(
        lambda s, d, x: streams.danger_job(x, limits(s, d), "longest"), **_IN_STATE
    ),
    "violation_police_slots_stream": _police_run(streams.slots_carried),
    "violation_police_slots_state": _police_run(
        streams.to_results(streams.slots_job), **_IN_STATE
    ),
}
