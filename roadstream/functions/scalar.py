"""Time, rounding, key and hash expressions. All stay in the JVM."""

from pyspark.sql import Column, DataFrame, functions as F

# Speeds are summed as whole ten-thousandths, so that a mean does not depend on the order of
# summation. A bigint then holds about 10^12 passes at 100 km/h in one group with room left.
SPEED_UNITS = 10_000

LONG_MAX = 9223372036854775807


def floor_div(value: Column, step: int) -> Column:
    """Exact floor of value / step in bigint (plain `/` would go through double)."""
    return F.call_function("div", value - F.pmod(value, F.lit(step)), F.lit(step))


def with_event_time(df: DataFrame, ms_col: str = "action_time", mode: str = "event") -> DataFrame:
    """Add `event_ts` from epoch ms, or the processing time with mode="processing"."""
    if mode == "processing":
        return df.withColumn("event_ts", F.current_timestamp())
    if mode != "event":
        raise ValueError(f"unknown time mode {mode!r}")
    return df.withColumn("event_ts", F.timestamp_millis(ms_col))


def abs_gap_sec(a: Column, b: Column) -> Column:
    """Whole seconds between two epoch-ms values, the rest cut off."""
    return F.call_function("div", F.abs(a - b), F.lit(1000))


def day_start(ms: Column) -> Column:
    """Epoch ms of the midnight before `ms`, in the session time zone."""
    return F.unix_millis(F.date_trunc("day", F.timestamp_millis(ms)))


def speed_units(speed: Column) -> Column:
    return F.round(speed * F.lit(float(SPEED_UNITS))).cast("bigint")


def mean_speed(sum_units: Column, n: Column) -> Column:
    """Mean of `n` speeds with two decimals, half up, from a sum in speed units."""
    per_cent = F.lit(SPEED_UNITS // 100) * n
    cents = F.call_function("div", F.abs(sum_units) * 2 + per_cent, per_cent * 2)
    return F.signum(sum_units) * cents / F.lit(100.0)


def track_row_key(car: Column, ms: Column) -> Column:
    """Key that sorts the passes of one car newest first."""
    return F.concat_ws("_", car, (F.lit(LONG_MAX) - ms).cast("string"))


def window_area_key(end_ms: Column, area: Column) -> Column:
    return F.concat_ws("_", end_ms.cast("string"), area)


def bit_offsets(plate: Column, bits: int) -> Column:
    """Two positions of a plate in a bit vector of length `bits`, from two unlike hashes."""
    return F.array(
        F.pmod(F.xxhash64(plate), F.lit(bits)),
        F.pmod(F.hash(plate).cast("bigint"), F.lit(bits)),
    )


def with_warning_time(df: DataFrame, name: str = "warned_at") -> DataFrame:
    """Add the processing time as epoch ms: when a warning was raised, not when it happened."""
    return df.withColumn(name, F.unix_millis(F.current_timestamp()))
