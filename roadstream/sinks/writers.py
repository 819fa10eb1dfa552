"""Where results go: folders, databases, keyed stores, topics, the console.

A writer is a function (batch, batch_id). `write` calls it once for a table and per micro-batch
for a stream. After a failure Spark runs a micro-batch again under its old id; the folder
writers then overwrite what that id had written, so nothing is doubled.
"""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from roadstream.operators.clones import once_per_day
from roadstream.operators.tracks import latest_per_key
from roadstream.sinks.keyed import KeyedStore
from roadstream.schemas import (
    AVG_SPEED_COLUMNS, SPEEDING_COLUMNS, TRACK_COLUMNS, VIOLATION, VIOLATION_COLUMNS,
)
from roadstream.sources.jdbc import table_options
from roadstream.sources.kafka import TRAFFIC_TOPIC

Writer = Callable[[DataFrame, int], None]

SPEEDING_TABLE = "t_speeding_info"
AVG_SPEED_TABLE = "t_average_speed"
DAY_MS = 24 * 3600 * 1000


def write(
    df: DataFrame,
    writer: Writer,
    checkpoint: str | None = None,
    output_mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery | None:
    if not df.isStreaming:
        writer(df, 0)
        return None
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder that all executors share")
    stream = df.writeStream.outputMode(output_mode).foreachBatch(writer)
    stream = stream.option("checkpointLocation", checkpoint)
    return stream.trigger(**(trigger or {"processingTime": "1 second"})).start()


def to_folder(path: str) -> Writer:
    """Parquet, one sub-folder per micro-batch."""

    def writer(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return writer


def read_folder(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a `to_folder` store with their `batch_id`; none if nothing was written."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def to_table(connection: dict[str, str], table: str) -> Writer:
    """Append to a database table, in parallel and in batches of rows."""
    options = table_options(connection, table)

    def writer(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("jdbc").options(**options).mode("append").save()

    return writer


def to_store(source: str, options: dict[str, str]) -> Writer:
    """Put to a keyed store through its Spark connector; a put replaces its key."""

    def writer(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(source).options(**options).mode("append").save()

    return writer


def write_speeding(df: DataFrame, writer: Writer, checkpoint: str | None = None, **kw):
    return write(df.select(*SPEEDING_COLUMNS), writer, checkpoint, **kw)


def write_avg_speed(df: DataFrame, writer: Writer, checkpoint: str | None = None, **kw):
    return write(df.select(*AVG_SPEED_COLUMNS), writer, checkpoint, **kw)


def write_violation_once_per_day(
    df: DataFrame,
    existing: Callable[[int], DataFrame],
    writer: Writer,
    checkpoint: str | None = None,
    **kw,
):
    """Write a violation only if its car has none that day, in the batch or in `existing`.

    `existing(batch_id)` gives the rows stored before that batch. Only the days of the batch
    are read from it, and the bound on the time reaches the store.
    """

    def once(batch: DataFrame, batch_id: int) -> None:
        span = batch.agg(F.min("create_time").alias("lo"), F.max("create_time").alias("hi")).first()
        if span["lo"] is None:
            return
        stored = existing(batch_id).where(
            F.col("create_time").between(span["lo"] - DAY_MS, span["hi"] + DAY_MS)
        )
        writer(once_per_day(batch, stored), batch_id)

    return write(df.select(*VIOLATION_COLUMNS), once, checkpoint, **kw)


def stored_violations(spark: SparkSession, path: str) -> Callable[[int], DataFrame]:
    """The rows of a folder store from before a batch, for `write_violation_once_per_day`."""

    def before(batch_id: int) -> DataFrame:
        rows = read_folder(spark, path, VIOLATION)
        return rows.where(F.col("batch_id") < batch_id).select(*VIOLATION_COLUMNS)

    return before


def write_tracks(df: DataFrame, writer: Writer, checkpoint: str | None = None, **kw):
    """Keyed puts of tracks; of equal keys in a micro-batch only the last is sent."""

    def put(batch: DataFrame, batch_id: int) -> None:
        writer(latest_per_key(batch).select(*TRACK_COLUMNS), batch_id)

    return write(df, put, checkpoint, **kw)


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType, key: list[str]
) -> DataFrame:
    """What a folder store holds per key: the row of the latest micro-batch."""
    rows = read_folder(spark, path, schema)
    rest = [c for c in schema.fieldNames() if c not in key]
    newest = F.max_by(F.struct(*rest), "batch_id").alias("r")
    return rows.groupBy(*key).agg(newest).select(*key, "r.*")


def to_keyed_store(store: KeyedStore, compact_every: int = 100) -> Writer:
    """Put to a folder that holds one row per key, and merge its change sets now and then."""

    def writer(batch: DataFrame, batch_id: int) -> None:
        store.put(batch, batch_id)
        if batch_id % compact_every == compact_every - 1:
            store.compact()

    return writer


def latest_counts(writer: Writer) -> Writer:
    """Hands on one row per (window_end, area_id): running counts only grow, so the largest is the latest."""

    def latest(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("window_end", "area_id").agg(F.max("car_count").alias("car_count"))
        writer(counts, batch_id)

    return latest


def write_area_counts(df: DataFrame, writer: Writer, checkpoint: str | None = None, **kw):
    """Latest counts per (window end, area, shard), new with every micro-batch."""
    return write(df, writer, checkpoint, output_mode="update", **kw)


def to_console(
    df: DataFrame, checkpoint: str | None = None, rows: int = 20, output_mode: str = "append", **kw
):
    """Show the first results; for a stream, those of every micro-batch."""

    def show(batch: DataFrame, _: int) -> None:
        batch.show(rows, truncate=False)

    return write(df, show, checkpoint, output_mode, **kw)


def publish_options(servers: str, topic: str = TRAFFIC_TOPIC) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def publish_rows(lines: DataFrame) -> DataFrame:
    """Lines as messages without a key."""
    return lines.select(F.lit(None).cast("string").alias("key"), "value")


def publish_lines(lines: DataFrame, servers: str, topic: str = TRAFFIC_TOPIC) -> None:
    publish_rows(lines).write.format("kafka").options(**publish_options(servers, topic)).save()
