"""Event-time replay of a keyed stream through a small state machine.

Spark gives the rows of a key unordered within a micro-batch. Rows wait in the state until the
watermark has passed them, are then sorted, and go through the machine one by one: the same
result as over a sorted table, for any split of the stream into micro-batches. A key with
nothing waiting and nothing to remember leaves no state behind.

A call from Spark costs milliseconds however few rows it brings, and with a call per key and
micro-batch that cost comes to exceed all other work. So keys are dealt by hash to `SHARDS`
shards, and a call takes a shard: the number of calls does not grow with that of the keys. The
machine still sees each key alone.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Also the most state rows there can be. A checkpoint can only be read with the number it was written with.
SHARDS = 1024
ROWS_IN_LIST = 1000


class Machine(Protocol):
    """`memory` is any JSON value; None means nothing to remember."""

    def step(self, memory: Any, row: dict) -> tuple[Any, list[tuple]]:
        """Take the next row in order; give the new memory and the rows to emit."""

    def expire(self, memory: Any, watermark: int) -> tuple[Any, list[tuple]]:
        """Drop what no row later than `watermark` can use any more."""

    def deadline(self, memory: Any) -> int | None:
        """The watermark at which `expire` is next needed."""


def replay(
    df: DataFrame,
    key: str,
    time_col: str,
    order: list[str],
    fields: list[str],
    machine: Machine,
    output_schema: str,
    shards: int = SHARDS,
) -> DataFrame:
    """Run `machine` over the rows of each `key` in `order`. `df` has a watermark on `event_ts`.

    `output_schema` starts with the key column, which is put before what the machine emits.
    """
    shard = F.pmod(F.xxhash64(key), F.lit(shards)).cast("int").alias("_shard")
    rows = df.select(key, "event_ts", *fields, shard)
    whole = [f.name for f in rows.schema if isinstance(f.dataType, T.IntegralType)]
    columns = [part.split() for part in output_schema.split(",")]
    names = [name for name, _ in columns]
    run = _runner(key, time_col, order, fields, whole, machine, names)
    listed = ", ".join(f"{name} array<{dtype}>" for name, dtype in columns)
    out = rows.groupBy("_shard").applyInPandasWithState(
        run, listed, "state STRING", "append", GroupStateTimeout.EventTimeTimeout
    )
    return out.select(F.inline(F.arrays_zip(*names)))


def _runner(key, time_col, order, fields, whole, machine, names):
    columns = [key, *fields]  # of a row; the key is its first value
    at, places = columns.index(time_col), [columns.index(c) for c in order]

    def in_order(row: tuple) -> list:
        return [(row[i] is not None, row[i]) for i in places]

    def run(
        shard: tuple, frames: Iterable[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        kept, remembered = json.loads(state.get[0]) if state.exists else ([], [])
        memories = dict(map(tuple, remembered))
        due, waiting = defaultdict(list), []
        for rows in (kept, *(_plain_rows(f, columns, whole) for f in frames)):
            for r in rows:
                (due[r[0]] if r[at] <= watermark else waiting).append(r)

        out: list[tuple] = []
        for k, rows in due.items():
            rows.sort(key=in_order)
            memory = memories.get(k)
            for row in rows:
                memory, emitted = machine.step(memory, dict(zip(fields, row[1:])))
                out.extend((k, *r) for r in emitted)
            memories[k] = memory
        still = []
        for k, memory in memories.items():
            if memory is not None:
                memory, emitted = machine.expire(memory, watermark)
                out.extend((k, *r) for r in emitted)
            if memory is not None:
                still.append((k, memory))

        if waiting or still:
            times = [r[at] for r in waiting]
            times.extend(machine.deadline(memory) for _, memory in still)
            state.update((json.dumps([waiting, still]),))
            state.setTimeoutTimestamp(max(min(times), watermark + 1))
        elif state.exists:
            state.remove()
        if out:
            yield _listed(out, names)

    return run


def _listed(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    """Rows by the thousand, as lists of a column's values: PySpark fills up the state's columns
    for every row of a frame and looks at each of these cells, which takes longer than the machine."""
    parts = (zip(*rows[i:i + ROWS_IN_LIST]) for i in range(0, len(rows), ROWS_IN_LIST))
    return pd.DataFrame([[list(values) for values in part] for part in parts], columns=names)


def _plain_rows(frame: pd.DataFrame, fields: list[str], whole: list[str]) -> list[tuple]:
    """Rows fit for JSON: missing values as None, and whole numbers whole, also where pandas
    had made a column with missing values a float one."""
    columns = []
    for c in fields:
        values = frame[c].tolist()
        missing = frame[c].isna().tolist()
        make = int if c in whole else lambda v: v
        columns.append([None if m else make(v) for v, m in zip(values, missing)])
    return list(zip(*columns))
