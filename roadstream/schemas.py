"""Record types. Field order is the order on the wire and in the tables."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


TRAFFIC = _struct(
    ("action_time", T.LongType()),  # epoch milliseconds
    ("monitor_id", T.StringType()),
    ("camera_id", T.StringType()),
    ("car", T.StringType()),
    ("speed", T.DoubleType()),
    ("road_id", T.StringType()),
    ("area_id", T.StringType()),
)

VIOLATION = _struct(
    ("car", T.StringType()),
    ("violation", T.StringType()),
    ("create_time", T.LongType()),
)

POLICE_ACTION = _struct(
    ("police_id", T.StringType()),
    ("car", T.StringType()),
    ("action_status", T.StringType()),
    ("action_time", T.LongType()),
)

MONITOR_INFO = _struct(
    ("monitor_id", T.StringType()),
    ("road_id", T.StringType()),
    ("speed_limit", T.IntegerType()),
    ("area_id", T.StringType()),
)

# A limit that counts from `valid_from` on; 0 takes the posted limit away.
LIMIT_VERSION = _struct(
    ("monitor_id", T.StringType()),
    ("speed_limit", T.IntegerType()),
    ("valid_from", T.LongType()),
)

TRACK = _struct(
    ("row_key", T.StringType()),
    ("car", T.StringType()),
    ("action_time", T.LongType()),
    ("monitor_id", T.StringType()),
    ("road_id", T.StringType()),
    ("area_id", T.StringType()),
    ("speed", T.DoubleType()),
)

AREA_COUNT = _struct(
    ("window_end", T.LongType()),
    ("area_id", T.StringType()),
    ("car_count", T.LongType()),
)

AVG_SPEED = _struct(
    ("start_time", T.LongType()),
    ("end_time", T.LongType()),
    ("monitor_id", T.StringType()),
    ("avg_speed", T.DoubleType()),
    ("car_count", T.LongType()),
)

# Column lists of the result tables.
SPEEDING_COLUMNS = ["car", "monitor_id", "road_id", "real_speed", "limit_speed", "action_time"]
AVG_SPEED_COLUMNS = AVG_SPEED.fieldNames()
VIOLATION_COLUMNS = VIOLATION.fieldNames()
TRACK_COLUMNS = ["row_key", "car", "action_time", "monitor_id", "road_id", "area_id", "speed"]


def pass_order(columns: list[str], time_col: str = "action_time") -> list[str]:
    """A total order of passes: event time, then arrival (`event_id`) where the rows have
    it, else every other traffic field, so that equal times always sort alike."""
    if "event_id" in columns:
        return [time_col, "event_id"]
    return [time_col] + [
        c for c in TRAFFIC.fieldNames() if c in columns and c not in (time_col, "car")
    ]
