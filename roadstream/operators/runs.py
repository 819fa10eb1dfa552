"""Pairing of neighbours: the closed form of a one-slot state machine.

A machine that stores a row, and on a fitting next row emits the pair and empties its slot, is
the same as: cut each key's ordered rows into runs of fitting neighbours and pair them off from
the start of each run. Plain `lag` would pair the second row of a pair again.
"""

from pyspark.sql import Column, functions as F

from roadstream.operators.ordered import Ordered, Running, latest, previous, total

PREV = "_prev"


def pair_off(
    rows: Ordered, fields: list[str], fits: Column, **values: Running
) -> Ordered:
    """Add `_prev` (the row before, as a struct of `fields`) and `_second` (true if this row
    completes a pair with it). `fits` may use `_prev` and the row's own columns; further running
    `values` may use `_fits`, true if the row fits the one before."""
    rows = rows.scan(**{PREV: previous(F.struct(*fields)), "_n": total(F.lit(1).cast("bigint"))})
    rows = rows.with_column("_fits", F.col(PREV).isNotNull() & fits)
    rows = rows.scan(_run=latest(F.when(~F.col("_fits"), F.col("_n"))), **values)
    return rows.with_column("_second", (F.col("_n") - F.col("_run")) % 2 == 1)
