"""Mixing sources to target weights by entropy balancing.

Each source has a number of words (tokens) to reach. Among all document rates that do, the ones that differ least from one
copy each, in entropy, are rate = exp(l * size) with one multiplier l per source; no rate goes beyond `MOST`. The
multipliers solve the convex dual: Newton steps, kept inside a bracket, whose sums run as Spark aggregations over the counts
by (source, size). Rates are then rounded to whole copies such that the words taken of a source miss its target by no more
than about its longest document.

Rounding: by source, sizes in order, the running sum of expected copies is rounded, so that errors cancel. Within one size
of one source all documents get the whole part, and as many as are left over one more: the first by a hash of doc_id. Groups
of one size are cut into about sqrt(n) cells for that, so that no task ranks a large group.

Defined results: a null text has size 0; a document of size 0 takes no words and is kept once; the null source is a source
and comes last; equal doc_ids are ranked in any order; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.common import WORD, fresh, numbered, stored, whole_text

#: Copies of a document at most; a source can reach that many times its words.
MOST = 3
#: Sources weigh 1, 2, 3, 1, ... by code point, unless weights are given.
WEIGHTS = (1, 2, 3)
STEPS, EXACT = 100, 1e-9


def same(a, b, *names: str):
    """Equality of the columns `names`, nulls being equal."""
    out = F.lit(True)
    for n in names:
        out = out & a[n].eqNullSafe(b[n])
    return out


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, source_size, target from (source, size, n).

    Weights share all words; a target stops at `most` times its source's words and the rest is shared again by weight. That
    is the level t with sum(min(most * words, t * weight)) = all words: sources fill up in the order of most * words / weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    filling = Window.orderBy(F.col("fills_at"), F.col("source").asc_nulls_last())
    before, rest = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(rest)
    out = (
        sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
        .withColumn("weight", weight).withColumn("fills_at", most * F.col("source_size") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("fills_at"), F.col("level"))).over(everything))
    )
    full = F.col("level").isNull() | (F.col("fills_at") <= F.col("level"))
    return out.select(
        "source", "source_size",
        F.when(full, most * F.col("source_size").cast("double")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def multipliers(sizes: DataFrame, goals: DataFrame, most: float = MOST) -> DataFrame:
    """source, scale, l: the dual solution. Sizes count in units of `scale`. A source that must give all it can has l = null."""
    scale = sizes.groupBy("source").agg(F.try_divide(F.sum(F.col("size") * F.col("size") * F.col("n")), F.sum(F.col("size") * F.col("n"))).alias("scale"))
    state = stored(
        goals.join(scale.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
            "source", "scale", "target",
            (F.col("target") >= most * F.col("source_size") * (1 - 1e-12)).alias("full"),
            F.lit(0.0).alias("l"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
            F.lit(False).alias("done")),
        "multipliers")
    for _ in range(STEPS):
        x, l = F.col("size") / F.col("scale"), F.col("l")  # noqa: E741
        open_ = state.where(~F.col("full") & ~F.col("done") & (F.col("target") > 0)).withColumnRenamed("source", "s")
        free = l * x < F.log(F.lit(float(most)))
        rate = F.when(free, F.exp(l * x)).otherwise(float(most))
        words = F.col("n") * F.col("size")
        sums = (
            sizes.where("size > 0").join(open_, F.col("source").eqNullSafe(F.col("s")))
            .groupBy("source").agg(
                F.sum(words * rate).alias("now"), F.sum(F.when(free, words * x * rate).otherwise(0.0)).alias("slope"))
            .withColumnRenamed("source", "s")
        )
        miss = F.col("now") - F.col("target")
        low = F.when(miss < 0, l).otherwise(F.col("low"))
        high = F.when(miss > 0, l).otherwise(F.col("high"))
        newton = l - F.try_divide(miss, F.col("slope"))
        inside = F.coalesce(newton > low, newton > l - 8, F.lit(False)) & F.coalesce(newton < high, newton < l + 8, F.lit(False))
        other = F.when(low.isNull(), high - 2 * F.greatest(F.abs(high), F.lit(1.0))).when(
            high.isNull(), low + 2 * F.greatest(F.abs(low), F.lit(1.0))).otherwise((low + high) / 2)
        done = F.col("now").isNull() | (F.abs(miss) <= EXACT * F.col("target"))
        state = stored(
            state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left").select(
                "source", "scale", "target", "full",
                F.when(done, l).when(inside, newton).otherwise(other).alias("l"),
                low.alias("low"), high.alias("high"), done.alias("done")),
            "multipliers")
        if state.where("not done").isEmpty():
            break
    rounded = F.round("l", 9)  # sums of doubles come in any order; their last digits must not decide
    return state.select("source", "scale", F.when(~F.col("full"), rounded).alias("l"))


def mix(docs: DataFrame, rid: str | None = None, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, rate, copies, taken for each document, and its row number if `rid` names one."""
    number = F.col(rid) if rid else F.monotonically_increasing_id()
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size"), number.alias("rid")),
        "sizes")
    sizes = stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "size_counts")
    goals = stored(targets(sizes, weights, most), "targets")
    duals = multipliers(sizes, goals, most)

    by_size = Window.partitionBy("source").orderBy("size")
    tilt = F.when(F.col("size") == 0, 1.0).when(F.col("l").isNull(), float(most)).otherwise(
        F.least(F.exp(F.least(F.col("l") * F.col("size") / F.col("scale"), F.lit(10.0))), F.lit(float(most))))
    planned = (
        sizes.join(duals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        .join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        .withColumn("rate", tilt)
        .withColumn("upto", F.sum(F.col("n") * F.col("rate")).over(by_size))
        .withColumn("planned", F.least(
            F.floor(F.col("upto") + 0.5) - F.floor(F.coalesce(F.lag("upto").over(by_size), F.lit(0.0)) + 0.5), most * F.col("n")))
        .select(
            F.col("source").alias("s"), F.col("size").alias("z"), "source_size", "target", "rate",
            F.floor(F.col("planned") / F.col("n")).alias("each"), (F.col("planned") % F.col("n")).alias("extra"),
            F.ceil(F.sqrt(F.col("n")) / 4).alias("cells"))
    )
    salt = F.xxhash64(F.coalesce(F.col("doc_id"), F.col("rid")))
    placed = (
        rows.join(planned, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
        .withColumn("salt", salt).withColumn("cell", F.pmod(F.col("salt"), F.col("cells"))).drop("s", "z")
    )
    counts = placed.groupBy("source", "size", "cell").agg(F.count("*").alias("rows"))
    upto = Window.partitionBy("source", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("source").alias("s"), F.col("size").alias("z"), F.col("cell").alias("c"),
        F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "cell").orderBy("salt", "doc_id"))
    copies = F.col("each") + (F.col("rank") + F.col("offset") <= F.col("extra")).cast("long")
    return (
        placed.withColumn("rank", rank)
        .join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("cell") == F.col("c")))
        .select(
            "doc_id", "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken"),
            *([F.col("rid").alias(rid)] if rid else []))
    )


def repeat_rows(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it was given copies, with all its columns."""
    rows, rid = numbered(docs)
    copies, each = fresh(rows, "__copies"), fresh(rows, "__each")
    times = mix(rows, rid).where("copies > 0").select(rid, F.col("copies").alias(copies))
    return rows.join(times, rid).select(*docs.columns, F.explode(F.array_repeat(F.lit(True), F.col(copies).cast("int"))).alias(each)).drop(each)
