"""The state machines: cloned plates, dangerous drivers, one-slot reconciliation."""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from roadstream.functions.messages import CLONED
from roadstream.functions.scalar import SPEED_UNITS
from roadstream.operators.clones import GAP_SEC
from roadstream.operators.danger import TIMES, WITHIN_MS, gross_passes
from roadstream.operators.police import (
    BOUND_MS, MATCHED, NO_POLICE, NO_VIOLATION, REPLACED, SLOT_FIELDS, slot_rows,
)
from roadstream.schemas import pass_order
from roadstream.streaming.replay import replay


@dataclass(frozen=True)
class ClonePairs:
    """Remembers one pass; a next pass near enough raises an alarm and empties the memory."""

    gap_sec: int = GAP_SEC

    def step(self, memory, row):
        if memory is None:
            return row, []
        first_time, now = memory["action_time"], row["action_time"]
        if abs(now - first_time) // 1000 > self.gap_sec:
            return row, []
        first = row["monitor_id"] if now == first_time else memory["monitor_id"]
        return None, [(first, row["monitor_id"], CLONED, first_time, now)]

    def expire(self, memory, watermark):
        return (None, []) if watermark >= self.deadline(memory) else (memory, [])

    def deadline(self, memory):
        return memory["action_time"] + (self.gap_sec + 1) * 1000


@dataclass(frozen=True)
class GrossRuns:
    """Remembers the gross passes of the last `within_ms`, oldest first."""

    times: int = TIMES
    within_ms: int = WITHIN_MS
    longest: bool = False

    def step(self, memory, row):
        at = row["action_time"]
        memory, out = self._drop(memory or [], at - self.within_ms)
        memory.append([at, row["monitor_id"], row["units"]])
        if not self.longest:
            out.extend(self._matches(memory, range(len(memory) - self.times + 1)))
        return memory, out

    def expire(self, memory, watermark):
        memory, out = self._drop(memory, watermark - self.within_ms)
        return memory or None, out

    def deadline(self, memory):
        return memory[0][0] + self.within_ms

    def _drop(self, memory, until):
        """Forget starts at or before `until`. A start that leaves has seen its longest match,
        which ends with the last pass remembered."""
        kept = 0
        while kept < len(memory) and memory[kept][0] <= until:
            kept += 1
        if not kept:
            return memory, []
        out = []
        if self.longest:
            out = self._matches(memory, range(min(kept, len(memory) - self.times + 1)))
        return memory[kept:], out

    @staticmethod
    def _matches(memory, starts):
        """Matches from each of `starts` to the last pass, with their mean speed."""
        out = []
        total = sum(units for _, _, units in memory)
        for i in starts:
            start, end, n = memory[i], memory[-1], len(memory) - i
            cents = (2 * total + n * (SPEED_UNITS // 100)) // (2 * n * (SPEED_UNITS // 100))
            out.append((start[0], end[0], start[1], end[1], n, cents / 100.0))
            total -= start[2]
        return out


@dataclass(frozen=True)
class Slots:
    """One slot per car: a violation or a police action that waits for the other kind."""

    wait_ms: int = BOUND_MS

    def step(self, memory, row):
        out = []
        if memory is not None and row["at"] - memory["at"] > self.wait_ms:
            memory, out = None, [self._alone(memory)]
        if memory is None:
            return row, out
        if memory["side"] == row["side"]:
            return row, [(REPLACED, *self._fields(memory))]
        v, p = (memory, row) if memory["side"] == 0 else (row, memory)
        pair = [p[c] if v[c] is None else v[c] for c in SLOT_FIELDS]
        return None, [(MATCHED, *pair)]

    def expire(self, memory, watermark):
        if watermark >= self.deadline(memory):
            return None, [self._alone(memory)]
        return memory, []

    def deadline(self, memory):
        return memory["at"] + self.wait_ms

    def _alone(self, row):
        return (NO_POLICE if row["side"] == 0 else NO_VIOLATION, *self._fields(row))

    @staticmethod
    def _fields(row):
        return [row[c] for c in SLOT_FIELDS]


def cloned_plates_stream(traffic: DataFrame, gap_sec: int = GAP_SEC) -> DataFrame:
    """`cloned_plates` on a stream with a watermark."""
    order = pass_order(traffic.columns)
    return replay(
        traffic, "car", "action_time", order, list(dict.fromkeys([*order, "monitor_id"])),
        ClonePairs(gap_sec),
        "car string, first_monitor string, second_monitor string, msg string, "
        "first_time bigint, second_time bigint",
    )


def dangerous_drivers_stream(
    traffic: DataFrame,
    limits: DataFrame,
    times: int = TIMES,
    within_ms: int = WITHIN_MS,
    mode: str = "all",
) -> DataFrame:
    """`dangerous_drivers` on a stream with a watermark. Mode "all" reports a match as soon as
    the watermark passes its end, "longest" once no later pass can prolong it."""
    gross = gross_passes(traffic, limits)
    fields = [c for c in gross.columns if c not in ("car", "event_ts")]
    order = pass_order(gross.columns)
    if "event_id" not in order:
        order = ["action_time", "monitor_id", "road_id", "units"]
    return replay(
        gross, "car", "action_time", order, fields,
        GrossRuns(times, within_ms, mode == "longest"),
        "car string, start_time bigint, end_time bigint, start_monitor string, "
        "end_monitor string, pass_count bigint, avg_speed double",
    )


def reconcile_slots_stream(
    violations: DataFrame, police: DataFrame, wait_ms: int = BOUND_MS
) -> DataFrame:
    """`reconcile_slots` on two streams with watermarks; the slower one sets the pace."""
    fields = ["at", "side", *SLOT_FIELDS]
    out = replay(
        slot_rows(violations, police), "car", "at", fields, fields, Slots(wait_ms),
        "car string, outcome string, violation string, create_time bigint, police_id string, "
        "action_status string, action_time bigint",
    )
    return out.select("outcome", "car", *SLOT_FIELDS)
