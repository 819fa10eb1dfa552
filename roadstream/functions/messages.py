"""Message texts of the reports. The structured columns are the results; these only show them."""

from pyspark.sql import Column, DataFrame, functions as F

# The wording must equal that of the reports users read today.
CLONED = "涉嫌套牌车"
AREA_COUNT = "区域%s,在窗口其实时间%d,到窗口结束时间%d ,一共有%d 辆车"
TOP_WINDOW = "在窗口%d ----%d 时间范围内:"
TOP_HEAD = "整个城市最拥堵的前%d个卡口是:"
TOP_ENTRY = "卡口:%s,经过的车辆数量为:%d,平均车速为:%s"
DANGER_HEAD = "该车辆涉嫌危险驾驶,"
DANGER_ENTRY = "第%d个经过卡口是:%s -->"
POLICE_PAIR = "车辆%s,已经有交警出警了，警号为:%s,出警的状态是：%s,出警的时间:%d"
POLICE_MATCH = "该违法车辆%s，违法时间%d,已经有交警出警了，警号为:%s,出警的状态是：%s,出警的时间:%d"


def area_message() -> Column:
    return F.format_string(AREA_COUNT, "area_id", "window_start", "window_end", "car_count")


def congestion_messages(top: DataFrame, n: int = 3) -> DataFrame:
    """One line per window from the rows of `congestion_topn`, best rank first.

    A window has at most `n` rows.
    """
    entry = F.format_string(
        TOP_ENTRY, "monitor_id", "car_count", F.col("avg_speed").cast("string")
    )
    lines = top.groupBy("start_time", "end_time").agg(
        F.sort_array(F.collect_list(F.struct("rank", entry.alias("text")))).alias("top")
    )
    text = F.concat(
        F.format_string(TOP_WINDOW, "start_time", "end_time"),
        F.format_string(TOP_HEAD, F.lit(n)),
        F.array_join(F.col("top.text"), ""),
    )
    return lines.select("start_time", "end_time", text.alias("message"))


def danger_message(monitors: Column) -> Column:
    """Text for the checkpoints of one match, in order."""
    entries = F.transform(
        monitors, lambda m, i: F.format_string(DANGER_ENTRY, (i + 1).cast("int"), m)
    )
    return F.concat(F.lit(DANGER_HEAD), F.array_join(entries, ""))


def police_pair_message() -> Column:
    return F.format_string(POLICE_PAIR, "car", "police_id", "action_status", "action_time")


def police_match_message() -> Column:
    return F.format_string(
        POLICE_MATCH, "car", "create_time", "police_id", "action_status", "action_time"
    )
