"""A store of violations by day, in a folder all executors share.

Reading takes the days that are asked for, so that checking a micro-batch costs what its days
hold and not what the store holds. A repeated micro-batch overwrites its own rows. Small files
of a day are merged into a new folder, which counts once its mark is written: a merge that fails
at any point leaves the store as it was.

    rows/day=2024-01-01/batch_id=7/...   rows put by micro-batch 7
    merged/day=2024-01-01/upto=6/...     those of the day up to micro-batch 6
    marks/day=2024-01-01/upto=6/...      says that they are complete
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from roadstream.operators.clones import once_per_day
from roadstream.schemas import VIOLATION_COLUMNS
from roadstream.sinks.writers import write

_FIELDS = "car string, violation string, create_time bigint, day date, "


class DayStore:
    """Rows with the columns of a violation. Days are those of the session time zone, which must
    stay as it was; a null time has the null day."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def put(self, batch: DataFrame, batch_id: int) -> None:
        """A writer. Days are spread over tasks by size, a busy one over several."""
        rows = batch.select(*VIOLATION_COLUMNS, _day().alias("day"), F.lit(batch_id).alias("batch_id"))
        _overwrite(rows.hint("rebalance", "day"), f"{self.path}/rows", "batch_id")

    def read(self, days: list[date | None] | None = None, before: int | None = None) -> DataFrame:
        """The rows of `days` (all of them if not given), put before a micro-batch if given."""
        wanted = F.lit(True) if days is None else _among(days)
        rows = self._read("rows", "batch_id").where(wanted)
        if before is not None:
            rows = rows.where(F.col("batch_id") < before)
        merged, parts = self._read("merged", "upto").where(wanted), F.lit(False)
        for upto, same in self._merged_days(wanted).items():  # all of it goes by folders
            rows = rows.where(~(_among(same) & (F.col("batch_id") <= upto)))
            parts = parts | (_among(same) & (F.col("upto") == upto))
        merged = merged.where(parts)
        return rows.select(*VIOLATION_COLUMNS).unionByName(merged.select(*VIOLATION_COLUMNS))

    def merge(self, days: list[date | None], upto: int) -> None:
        """Merges what micro-batches up to `upto` put for `days` into few files."""
        done = [d for n, same in self._merged_days(_among(days)).items() if n >= upto for d in same]
        days = [d for d in days if d not in done]
        if not days:
            return
        rows = self.read(days, before=upto + 1).select(
            "*", _day().alias("day"), F.lit(upto).alias("upto"))
        _overwrite(rows.hint("rebalance", "day"), f"{self.path}/merged", "upto")
        written = self._read("merged", "upto").where(_among(days) & (F.col("upto") == upto))
        _overwrite(written.select("day", "upto", F.lit(True).alias("complete")).distinct().coalesce(1),
                   f"{self.path}/marks", "upto")

    def days_of(self, batch: DataFrame) -> list[date | None]:
        return [r[0] for r in batch.select(_day()).distinct().collect()]

    def _merged_days(self, wanted: Column) -> dict[int, list[date | None]]:
        """The days by the micro-batch up to which they were merged: a row per day."""
        marks = self._read("marks", "upto", "complete boolean, day date, ").where(wanted)
        found: dict[int, list[date | None]] = {}
        for day, upto in marks.groupBy("day").agg(F.max("upto")).collect():
            found.setdefault(upto, []).append(day)
        return found

    def _read(self, kind: str, number: str, fields: str = _FIELDS) -> DataFrame:
        schema = f"{fields}{number} bigint"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)


def write_violations_by_day(
    df: DataFrame,
    store: DayStore,
    checkpoint: str | None = None,
    merge_every: int = 100,
    **kw,
) -> StreamingQuery | None:
    """Puts a violation if its car has none that day, in the batch or in the store. Every
    `merge_every` micro-batches the files of the days of that batch are merged."""
    return write(df.select(*VIOLATION_COLUMNS), to_days(store, merge_every), checkpoint, **kw)


def to_days(store: DayStore, merge_every: int = 100):
    """The writer of `write_violations_by_day`."""

    def once(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select(*VIOLATION_COLUMNS).persist()
        days = store.days_of(batch)
        if days:
            store.put(once_per_day(batch, store.read(days, before=batch_id)), batch_id)
            if batch_id % merge_every == merge_every - 1:
                store.merge(days, batch_id)
        batch.unpersist()

    return once


def _day() -> Column:
    return F.to_date(F.timestamp_millis("create_time"))


def _among(days: list[date | None]) -> Column:
    found = F.coalesce(F.col("day").isin([d for d in days if d is not None]), F.lit(False))
    return found | F.col("day").isNull() if None in days else found


def _overwrite(rows: DataFrame, path: str, number: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day", number).parquet(path)
