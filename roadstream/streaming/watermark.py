"""How late rows may be. Rows further behind are dropped by Spark's stateful operators."""

from pyspark.sql import DataFrame

from roadstream.functions.scalar import with_event_time

FLOW_DELAY = "5 seconds"  # averages, congestion, dangerous drivers
POLICE_DELAY = "2 seconds"  # both sides of the police match
IN_ORDER = "0 seconds"  # cloned plates: input in order


def with_watermark(
    df: DataFrame, delay: str, ms_col: str = "action_time", mode: str = "event"
) -> DataFrame:
    """Add `event_ts` from `ms_col` (or processing time) with a watermark `delay` behind it."""
    return with_event_time(df, ms_col, mode).withWatermark("event_ts", delay)
