"""A store of one row per key in a folder all executors share.

Every micro-batch leaves a change set, divided by key bucket; a repeated one overwrites its own. Reading merges the base with
the change sets after it, so that of each key the row of the latest micro-batch counts. Compaction writes a new base beside
the old one and names it as the base last of all: a compaction that fails at any point leaves the store as it was.

    changes/batch_id=7/bucket=3/...     rows put by micro-batch 7
    base/upto=6/bucket=3/...            everything up to micro-batch 6, merged
    committed/upto=6/...                says that this base is complete
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

BUCKETS = 32


class KeyedStore:
    """Rows of `schema`, one for each value of the columns `key`. `buckets` is fixed when the store is made."""

    def __init__(
        self, spark: SparkSession, path: str, key: list[str], schema: T.StructType, buckets: int = BUCKETS
    ):
        self.spark, self.path, self.key, self.schema = spark, path.rstrip("/"), key, schema
        made = self._read("layout", "buckets int")
        self.buckets = made.first()["buckets"] if made is not None else buckets
        if made is None:
            spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{self.path}/layout")

    def put(self, batch: DataFrame, batch_id: int) -> None:
        """A writer. `batch` has one row per key."""
        rows = batch.select(*self.schema.fieldNames()).withColumn("bucket", self._bucket())
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.path}/changes/batch_id={batch_id}")

    def read(self) -> DataFrame:
        """All keys with their rows."""
        return self._merged(F.lit(True))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of `keys`. Only the files of their buckets are read."""
        keys = keys.select(*self.key).distinct()
        wanted = [r[0] for r in keys.select(self._bucket().alias("b")).distinct().collect()]  # `buckets` at most
        rows = self._merged(F.col("bucket").isin(wanted))
        return rows.join(keys.select(*[F.col(k).alias(f"_{k}") for k in self.key]), self._same(), "left_semi")

    def compact(self) -> None:
        """Merges all change sets into a new base."""
        newest = self._newest()
        if newest is None or newest == self._upto():
            return
        rows = self.read().withColumn("bucket", self._bucket())
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base/upto={newest}")
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.path}/committed/upto={newest}")

    def vacuum(self) -> None:
        """Removes what the base has made useless. Not while another reader is at it."""
        upto = self._upto()
        if upto is None:
            return
        for kind, name in (("changes", "batch_id"), ("base", "upto"), ("committed", "upto")):
            for number in self._numbers(kind, name):
                if number < upto or (number == upto and kind == "changes"):
                    where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/{name}={number}")
                    where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def _merged(self, buckets: Column) -> DataFrame:
        names, upto = self.schema.fieldNames(), self._upto()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema) + ", bucket int"
        changes, base = self._read("changes", columns + ", batch_id bigint"), None
        if upto is not None:
            base = self._read(f"base/upto={upto}", columns)
            base = None if base is None else base.where(buckets).select(*names)
        if changes is None:
            return base if base is not None else self.spark.createDataFrame([], self.schema)
        rest = [c for c in names if c not in self.key]
        after = F.lit(True) if upto is None else F.col("batch_id") > upto
        newest = changes.where(after & buckets).groupBy(*self.key).agg(F.max_by(F.struct(*rest), "batch_id").alias("r"))
        newest = newest.select(*self.key, "r.*").select(*names)
        if base is None:
            return newest
        changed = newest.select(*[F.col(k).alias(f"_{k}") for k in self.key])
        return base.join(changed, self._same(), "left_anti").unionByName(newest)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _same(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.key])

    def _read(self, folder: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _numbers(self, kind: str, name: str) -> list[int]:
        """The numbers of the sub-folders, which the driver lists for every read anyway."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{name}="))

    def _newest(self) -> int | None:
        found = self._numbers("changes", "batch_id")
        return max(found) if found else None

    def _upto(self) -> int | None:
        """The newest base that is complete: its mark holds a row."""
        for number in reversed(self._numbers("committed", "upto")):
            mark = self._read(f"committed/upto={number}", "id bigint")
            if mark is not None and not mark.isEmpty():
                return number
        return None
