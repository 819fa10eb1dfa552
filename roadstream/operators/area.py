"""Distinct cars per area: exact, running, by bit vector, and by sketch."""

from pyspark.sql import Column, DataFrame, functions as F

from roadstream.functions.scalar import bit_offsets, floor_div
from roadstream.operators.ordered import ordered, total
from roadstream.schemas import pass_order

TUMBLING_MS = 10_000
RUNNING_MS = 600_000
BLOOM_BITS = 1 << 22


def _start(window_ms: int) -> Column:
    return (floor_div(F.col("action_time"), window_ms) * window_ms).alias("window_start")


def _end(window_ms: int) -> Column:
    return (F.col("window_start") + window_ms).alias("window_end")


def area_distinct(traffic: DataFrame, window_ms: int = TUMBLING_MS) -> DataFrame:
    """Exact number of distinct cars per area and tumbling window.

    Spark first combines to distinct (area, window, car), spread by car, and counts after, so
    neither a hot area nor a hot car gathers in one task.
    """
    if traffic.isStreaming:
        firsts = traffic.select("area_id", "car", _window(window_ms)).dropDuplicates()
        return _per_window(firsts, F.count("*"))
    return (
        traffic.groupBy("area_id", _start(window_ms))
        .agg(F.countDistinct("car").alias("car_count"))
        .select("area_id", "window_start", _end(window_ms), "car_count")
    )


def _window(window_ms: int) -> Column:
    return F.window("event_ts", f"{window_ms} milliseconds")


def _per_window(rows: DataFrame, cars: Column) -> DataFrame:
    """Aggregate a stream with a `window` column per area and window."""
    return rows.groupBy("window", "area_id").agg(cars.alias("car_count")).select(
        "area_id",
        F.unix_millis("window.start").alias("window_start"),
        F.unix_millis("window.end").alias("window_end"),
        "car_count",
    )


def area_running_distinct(
    traffic: DataFrame, window_ms: int = RUNNING_MS, **split
) -> DataFrame:
    """One row per pass: the number of distinct cars seen so far in its area and window."""
    rows, order = _running_input(traffic, window_ms)
    firsts = rows.groupBy("area_id", "window_start", "car").agg(
        F.min(F.struct(*order)).alias("at")
    )
    return _running_count(rows, firsts, order, window_ms, split)


def area_bloom_distinct(
    traffic: DataFrame, window_ms: int = RUNNING_MS, bits: int = BLOOM_BITS, **split
) -> DataFrame:
    """As `area_running_distinct`, counting a car only if a two-hash bit vector of `bits` bits
    per area and window did not yet hold it. The count can only fall short, never exceed.

    A bit is set by the first pass that has it, so a pass is counted exactly if it is the first
    for one of its bits. That needs no vector: a minimum per bit gives the same counts.
    """
    rows, order = _running_input(traffic, window_ms)
    setters = (
        rows.withColumn("bit", F.explode(bit_offsets(F.col("car"), bits)))
        .groupBy("area_id", "window_start", "bit")
        .agg(F.min(F.struct(*order)).alias("at"))
        .select("area_id", "window_start", "at")
        .distinct()
    )
    return _running_count(rows, setters, order, window_ms, split)


def first_passes(rows: DataFrame, window_ms: int = RUNNING_MS) -> DataFrame:
    """The first pass of each car per area and window, and whether it is one that was `seen` before."""
    keys = ["area_id", "window_start", "car"]
    order = _order(rows.columns)
    rest = [c for c in rows.columns if c not in (*keys, "seen")]
    first = F.min(F.struct((~F.col("seen")).alias("fresh"), *order, *[c for c in rest if c not in order])).alias("at")
    found = rows.select(*rows.columns, _start(window_ms)).groupBy(*keys).agg(first)
    return found.select(*keys, *[f"at.{c}" for c in rest], (~F.col("at.fresh")).alias("seen"))


def running_since(
    rows: DataFrame, firsts: DataFrame, window_ms: int = RUNNING_MS, split: dict | None = None
) -> DataFrame:
    """As `area_running_distinct` for the rows that are not `seen`, going on from those that are.

    `firsts` are the `first_passes` of the rows.
    """
    fresh, order = _running_input(rows.where(~F.col("seen")), window_ms)
    new = firsts.where(~F.col("seen")).select("area_id", "window_start", F.struct(*order).alias("at"))
    counted = _running_count(fresh, new, order, window_ms, split or {})
    before = firsts.where("seen").groupBy(F.col("area_id").alias("_area"), F.col("window_start").alias("_start")).agg(
        F.count("*").alias("_before"))
    same = F.col("area_id").eqNullSafe(F.col("_area")) & (F.col("window_start") == F.col("_start"))
    count = (F.col("car_count") + F.coalesce("_before", F.lit(0))).alias("car_count")
    return counted.join(before, same, "left").select(*[count if c == "car_count" else c for c in counted.columns])


def _order(columns: list[str]) -> list[str]:
    order = [c for c in pass_order(columns) if c != "area_id"]
    return order if "event_id" in order else [*order, "car"]


def _running_input(traffic: DataFrame, window_ms: int) -> tuple[DataFrame, list[str]]:
    order = _order(traffic.columns)
    extra = [c for c in order if c not in ("action_time", "car")]
    return traffic.select("area_id", _start(window_ms), "action_time", "car", *extra), order


def _running_count(rows, counted, order, window_ms, split) -> DataFrame:
    """Running number of `counted` marks. Marks join the rows by order, not by a join: each
    sorts right before the pass it stands for, and only the passes are kept."""
    marks = counted.select(
        "area_id", "window_start", *[F.col(f"at.{c}").alias(c) for c in order],
        F.lit(0).alias("is_pass"),
    )
    passes = rows.withColumn("is_pass", F.lit(1))
    both = passes.unionByName(marks, allowMissingColumns=True)
    scan = ordered(both, ["area_id", "window_start"], [*order, "is_pass"], sizes=rows, **split)
    scan = scan.scan(car_count=total((1 - F.col("is_pass")).cast("bigint")))
    return (
        scan.result()
        .where(F.col("is_pass") == 1)
        .select("area_id", "window_start", _end(window_ms),
                *dict.fromkeys([*order, "car"]), "car_count")
    )


PANE_MS = 60_000
SKETCH_BITS = 12
# A sketch of 2^12 cells is off by about 1.6 % (one standard deviation); five of them and one car.
SKETCH_ERROR = 0.08


def area_sketches(traffic: DataFrame, pane_ms: int = PANE_MS, bits: int = SKETCH_BITS) -> DataFrame:
    """A sketch of the cars per area and pane, to be stored and merged for any window of whole panes.

    Sketches are combined before they are shuffled; each is of a few kilobytes at most.
    """
    return traffic.groupBy("area_id", _start(pane_ms).alias("pane_start")).agg(
        F.hll_sketch_agg("car", F.lit(bits)).alias("cars"))


def merged_sketches(sketches: DataFrame, window_ms: int, slide_ms: int | None = None, pane_ms: int = PANE_MS) -> DataFrame:
    """Approximate distinct cars per area and window, from the `area_sketches` of its panes alone."""
    slide_ms = slide_ms or window_ms
    if window_ms % pane_ms or slide_ms % pane_ms:
        raise ValueError("windows must begin and end with a pane")
    last = floor_div(F.col("pane_start"), slide_ms) * slide_ms
    first = (floor_div(F.col("pane_start") - window_ms, slide_ms) + 1) * slide_ms
    starts = F.explode(F.sequence(first, last, F.lit(slide_ms).cast("bigint"))).alias("window_start")
    return (
        sketches.select("area_id", starts, "cars").groupBy("area_id", "window_start")
        .agg(F.hll_sketch_estimate(F.hll_union_agg("cars")).alias("car_count"))
        .select("area_id", "window_start", _end(window_ms), "car_count")
    )


def within_bound(estimated: DataFrame, exact: DataFrame, error: float = SKETCH_ERROR) -> DataFrame:
    """The exact counts, and whether each estimate is off by no more than a car and `error` of the count."""
    keys = ["area_id", "window_start", "window_end"]
    both = exact.join(estimated.select(*keys, F.col("car_count").alias("_estimate")), keys, "full")
    off = F.abs(F.col("_estimate") - F.col("car_count"))
    return both.select(*keys, "car_count", F.coalesce(off <= 1 + error * F.col("car_count"), F.lit(False)).alias("within"))


def area_approx_distinct(
    traffic: DataFrame, window_ms: int = RUNNING_MS, rsd: float = 0.02
) -> DataFrame:
    """Approximate distinct cars per area and window from a mergeable sketch of fixed size.

    On a stream in update mode this gives running counts, combined before they are shuffled.
    """
    cars = F.approx_count_distinct("car", rsd)
    if traffic.isStreaming:
        return _per_window(traffic.select("area_id", "car", _window(window_ms)), cars)
    return (
        traffic.groupBy("area_id", _start(window_ms))
        .agg(cars.alias("car_count"))
        .select("area_id", "window_start", _end(window_ms), "car_count")
    )
