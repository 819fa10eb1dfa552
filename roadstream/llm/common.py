"""What the operators of this package share: input columns, stored tables, held-out rows."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.session import shared_dir

#: One word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that are sent to a Python worker at once; the operators take no more at a time.
BATCH, ROWS_SENT = "spark.sql.execution.arrow.maxRecordsPerBatch", 512
#: Row numbers that are broadcast at most, after they were counted: 16 MB of longs.
BROADCAST_IDS = 2_000_000
#: Files of a table whose names are sent to every executor at most.
FILES = 50_000

_made: ContextVar[tuple[list[str], ...]] = ContextVar("made", default=())


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application: they may not have it installed.

    Also bounds the rows that are sent to a worker at once, unless the session has a number of its own: texts can be long.
    """
    sc = spark.sparkContext
    if spark.conf.get(BATCH) == "10000":  # as Spark has it
        spark.conf.set(BATCH, ROWS_SENT)
    if not getattr(sc, "_roadstream_shipped", False):
        package = Path(__file__).resolve().parents[1]
        made = shutil.make_archive(f"{tempfile.mkdtemp(prefix='roadstream-')}/package", "zip", package.parent, package.name)
        sc.addPyFile(made)  # the driver serves it; executors need not see the folder
        sc._roadstream_shipped = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that all executors share."""
    path = f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    for made in _made.get():
        made.append(path)
    return path


@contextmanager
def noting(made: list[str]) -> Iterator[None]:
    """Adds to `made` the folders that are made within."""
    token = _made.set((*_made.get(), made))
    try:
        yield
    finally:
        _made.reset(token)


def remove(spark: SparkSession, made: list[str], docs: DataFrame) -> list[str]:
    """Removes the folders that `docs` does not read; the others are returned."""
    read = docs.inputFiles()
    needed = [p for p in made if any(Path(p).name in f for f in read)]
    for p in set(made).difference(needed):
        where = spark._jvm.org.apache.hadoop.fs.Path(p)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return needed


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: computed once, and no lost executor changes it."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_remainder(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo `n`; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def bounded(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """At most about `rows` rows, chosen by a hash of `key`; all of them if there are no more than that.

    For fitting models only. Rows of equal key go together.
    """
    total = df.count()
    if total <= rows:
        return df
    slots = 1_000_000
    return df.where(F.pmod(F.xxhash64(*key, F.lit("bounded")), F.lit(slots)) < int(slots * rows / total))


def fresh(docs: DataFrame, name: str) -> str:
    """`name`, or a longer one that `docs` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a row number that stays the same, and that column's name, which `docs` does not have.

    Rows of stored files are numbered by file and place in it; other rows are stored first.
    """
    ship(docs.sparkSession)
    name = fresh(docs, "__rid")
    path, place = fresh(docs, "__file"), fresh(docs, "__place")
    files = None
    # Joins and the like would show places, too, but of several rows the same.
    if docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation" and fresh(docs, "_metadata") == "_metadata":
        try:
            placed = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place))
            files = [r[0] for r in placed.select(path).distinct().limit(FILES + 1).collect()]
        except AnalysisException:  # not Parquet
            pass
    if not files or len(files) > FILES:
        return stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name
    order = docs.sparkSession.createDataFrame(list(enumerate(sorted(files))), f"{name} bigint, {path} string")
    number = F.shiftleft(name, 40).bitwiseOR(F.col(place))
    return placed.join(F.broadcast(order), path).withColumn(name, number).drop(path, place), name


def without(rows: DataFrame, rid: str, dropped: DataFrame) -> DataFrame:
    """The rows whose number is not in `dropped`, which has that one column. Whole rows are moved only if there are too many."""
    dropped = stored(dropped, "dropped")
    few = dropped.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(dropped) if few else dropped, rid, "left_anti").select(*(c for c in rows.columns if c != rid))
