"""Running values over rows in order, when one key may hold a large share of all rows.

`Window.partitionBy(key)` puts all rows of a key into one task. That is right and cheap for
ordinary keys. Rows of a hot key are instead range-partitioned on the full order into cells of
about equal size; each cell is scanned by itself, and what a cell needs from the other cells
(a sum, the last row before it) comes from one summary row per cell. The summary has at most
one row per cell and hot key, so it is small whatever the data size, and is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from roadstream.operators.skew import HOT_ROWS, hot_frame, hot_keys
from roadstream.session import ensure_checkpoint_dir

CELL = "_cell"
CELL_ROWS = 1_000_000
MAX_CELLS = 20_000

_FIRST, _LAST = Window.unboundedPreceding, Window.unboundedFollowing


@dataclass(frozen=True)
class Running:
    """A value to carry along a scan; make one with `total`, `latest`, `previous` or
    `following`."""

    value: Column
    kind: str


def total(value: Column) -> Running:
    """Sum up to and with the current row."""
    return Running(value, "total")


def latest(value: Column) -> Running:
    """Latest non-null value up to and with the current row."""
    return Running(value, "latest")


def previous(value: Column) -> Running:
    """Value, never null, of the row before the current one."""
    return Running(value, "previous")


def following(value: Column) -> Running:
    """Value, never null, of the row after the current one."""
    return Running(value, "following")


@dataclass(frozen=True)
class Ordered:
    """Rows in a total `order` per `keys`: those of ordinary keys in `whole`, those of hot keys,
    if there are any, in `cells`, with their cell number."""

    whole: DataFrame
    cells: DataFrame | None
    keys: tuple[str, ...]
    order: tuple[str, ...]

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Ordered:
        """Apply a change that keeps `keys`, the cell number and the order of the rows."""
        return replace(
            self,
            whole=change(self.whole),
            cells=None if self.cells is None else change(self.cells),
        )

    def with_column(self, name: str, value: Column) -> Ordered:
        return self.map(lambda df: df.withColumn(name, value))

    def scan(self, **values: Running) -> Ordered:
        """Add the running values as columns, all in one pass."""
        out = replace(self, whole=_local(self.whole, list(self.keys), self.order, values))
        if self.cells is not None:
            parts = [*self.keys, CELL]
            local = _local(self.cells, parts, self.order, values)
            joined = local.join(F.broadcast(self._seam(values)), parts, "left")
            filled = {
                name: F.col(name) + F.coalesce(F.col(f"_seam_{name}"), F.lit(0))
                if v.kind == "total"
                else F.coalesce(F.col(name), F.col(f"_seam_{name}"))
                for name, v in values.items()
            }
            joined = joined.withColumns(filled).drop(*[f"_seam_{n}" for n in values])
            out = replace(out, cells=joined)
        return out

    def _seam(self, values: dict[str, Running]) -> DataFrame:
        """What each cell takes over from the other cells of its key."""
        parts = [*self.keys, CELL]
        summary = self.cells.groupBy(*parts).agg(
            *[_summary(v, self.order).alias(f"_cell_{n}") for n, v in values.items()]
        )
        by_cell = Window.partitionBy(*self.keys).orderBy(CELL)
        earlier, later = by_cell.rowsBetween(_FIRST, -1), by_cell.rowsBetween(1, _LAST)

        def taken(name: str, kind: str) -> Column:
            if kind == "total":
                return F.sum(f"_cell_{name}").over(earlier)
            if kind == "following":
                return F.first(f"_cell_{name}._value", ignorenulls=True).over(later)
            return F.last(f"_cell_{name}._value", ignorenulls=True).over(earlier)

        return summary.select(
            *parts, *[taken(n, v.kind).alias(f"_seam_{n}") for n, v in values.items()]
        )

    def result(self) -> DataFrame:
        if self.cells is None:
            return self.whole
        return self.whole.unionByName(self.cells.drop(CELL))


def _local(df, parts, order, values: dict[str, Running]) -> DataFrame:
    by_order = Window.partitionBy(*parts).orderBy(*order)

    def over(v: Running) -> Column:
        if v.kind == "total":
            return F.sum(v.value).over(by_order.rowsBetween(_FIRST, Window.currentRow))
        if v.kind == "previous":
            return F.lag(v.value).over(by_order)
        if v.kind == "following":
            return F.lead(v.value).over(by_order)
        so_far = by_order.rowsBetween(_FIRST, Window.currentRow)
        return F.last(v.value, ignorenulls=True).over(so_far)

    return df.select("*", *[over(v).alias(name) for name, v in values.items()])


def _summary(v: Running, order) -> Column:
    if v.kind == "total":
        return F.sum(v.value)
    edge = F.when(v.value.isNotNull(), F.struct(*order, v.value.alias("_value")))
    return F.min(edge) if v.kind == "following" else F.max(edge)


def ordered(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    hot_rows: int = HOT_ROWS,
    cell_rows: int = CELL_ROWS,
    sizes: DataFrame | None = None,
) -> Ordered:
    """Prepare `df` for running values per `keys` in `order`, which must be total.

    Without hot keys this adds nothing but a pre-combined count per key. `sizes` may name a frame
    with the same keys and about as many rows per key that is cheaper to count.
    """
    hot = hot_keys(df if sizes is None else sizes, keys, hot_rows)
    if not hot:
        return Ordered(df, None, tuple(keys), tuple(order))
    marks = F.broadcast(hot_frame(df, keys, hot))
    cells = _in_cells(
        df.join(marks, keys, "left_semi"), keys, order, sum(r["n"] for r in hot), cell_rows
    )
    return Ordered(df.join(marks, keys, "left_anti"), cells, tuple(keys), tuple(order))


def numbered(
    df: DataFrame, order: list[str], name: str, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Number all rows from 0 in one total `order`.

    Rows are counted within range partitions, and each partition is offset by those before it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    n = min(max(2, -(-df.count() // cell_rows)), MAX_CELLS)
    # The id Spark gives holds the partition in its upper bits and the place in the lower 33.
    placed = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .select(
            "*",
            F.shiftright("_id", 33).alias(CELL),
            F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
        )
        .drop("_id")
        .checkpoint()
    )
    earlier = Window.orderBy(CELL).rowsBetween(_FIRST, -1)
    offsets = placed.groupBy(CELL).agg(F.count("*").alias("_n")).select(
        CELL, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        placed.join(F.broadcast(offsets), CELL)
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop(CELL, "_place", "_offset")
    )


def _in_cells(df, keys, order, n_rows: int, cell_rows: int) -> DataFrame:
    """Rows with their cell, checkpointed so that a lost executor cannot change the cells.

    They are stored grouped by cell and sorted. Spark keeps note of that, but only for a plan
    it will not adapt, and then the scans over them need no further shuffle or sort.
    """
    n = min(max(2, -(-n_rows // cell_rows)), MAX_CELLS)
    ensure_checkpoint_dir(df.sparkSession)
    in_cells = df.repartitionByRange(n, *keys, *order).withColumn(CELL, F.spark_partition_id())
    with _fixed_plan(df.sparkSession):
        return (
            in_cells.repartition(n, *keys, CELL)
            .sortWithinPartitions(*keys, CELL, *order)
            .checkpoint()
        )


@contextmanager
def _fixed_plan(spark: SparkSession):
    name = "spark.sql.adaptive.enabled"
    adaptive = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, adaptive)
