"""Exact dedup against a persistent index of digests, bucketed and sorted by digest.

`DigestIndex` keeps one row per distinct text: its SHA-256, the document that stays, the copies seen. A batch is first
shrunk to one row per digest (combined before the shuffle), anti-joined with the index by sort-merge, and what is new is
appended. The index is bucketed, so only the batch is shuffled for that; a group of copies, however large, is one row by then.

Defined results: a null text counts as empty; of equal texts the largest doc_id stays, a null doc_id only among nulls;
repeated rows (one doc_id, one text) are one document and all say the same; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.llm.common import folder, numbered, stored, whole_text, without

BUCKETS = 64
SCHEMA = "digest binary, keep_id bigint, group_size bigint"


class DigestIndex:
    """The index at `path` (a new one if none is there).

    Its number of buckets is written beside it: an index that is opened keeps it, and asking for another one is an error.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark, self.path = spark, path or folder(spark, "digests")
        try:
            made = spark.read.schema("buckets int").parquet(f"{self.path}/_buckets").first()
        except AnalysisException:  # a new index
            made = None
        if made and buckets not in (None, made["buckets"]):
            raise ValueError(f"the index has {made['buckets']} buckets, not {buckets}")
        self.new, self.buckets = not made, made["buckets"] if made else buckets or BUCKETS
        if self.new:
            spark.range(1).select(F.lit(self.buckets).alias("buckets")).write.parquet(f"{self.path}/_buckets")
        self.table = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, group_size BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def close(self) -> None:
        """Takes the table out of the catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def rows(self) -> DataFrame:
        """The index as a bucketed table."""
        return self.spark.table(self.table)

    def groups(self) -> DataFrame:
        """digest, keep_id, group_size over all batches. Read as plain files: a join with them is shuffled on both sides, so that
        Spark can split a hot digest."""
        rows = self.spark.read.schema(SCHEMA).parquet(self.path)
        if self.new:
            return rows
        more = self._again()
        if more is None:
            return rows
        return rows.join(more, "digest", "left").select(
            "digest", "keep_id", (F.col("group_size") + F.coalesce("more", F.lit(0))).alias("group_size"))

    def _again(self) -> DataFrame | None:
        """digest, more: copies of texts that the index held already when they came."""
        try:
            again = self.spark.read.schema("digest binary, more bigint").parquet(f"{self.path}/_again")
        except AnalysisException:  # no text has come again
            return None
        return again.groupBy("digest").agg(F.sum("more").alias("more"))

    def append(self, docs: DataFrame) -> None:
        """Adds the texts of `docs` that the index does not hold. A text it holds keeps the document that stays, and its copies
        are counted."""
        batch = digests(docs).groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        if not self.new:
            batch = stored(batch, "batch")
            again = batch.hint("merge").join(self.rows(), "digest", "left_semi")
            again.select("digest", F.col("group_size").alias("more")).write.mode("append").parquet(f"{self.path}/_again")
        new = batch.hint("merge").join(self.rows(), "digest", "left_anti")
        (new.write.mode("append").format("parquet").option("path", self.path)
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))

    def compact(self) -> DigestIndex:
        """An equal index of one sorted file per bucket, after many appends."""
        new = DigestIndex(self.spark, buckets=self.buckets)
        (self.rows().repartition(self.buckets, "digest").write.mode("append").format("parquet").option("path", new.path)
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(new.table))
        if not self.new and (more := self._again()) is not None:
            more.write.parquet(f"{new.path}/_again")
        new.new = False
        return new


def digests(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, the SHA-256 of the text, and `more` columns."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(whole_text(), 256)).alias("digest"), *more)


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Which documents of `docs` stay: doc_id, keep_id, group_size, kept, text_sha256.

    With an index that has seen earlier data, a text known from there keeps the earlier document.
    """
    groups = _seen(docs, index)
    joined = digests(docs).hint("merge").join(groups.hint("merge"), "digest")
    return joined.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first_of_copies(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The documents that stay, with all their columns; repeated rows of one doc_id and text go to one.

    Rows are matched by digest and doc_id together, so that no group of copies meets in one task.
    """
    rows, rid = numbered(docs)
    own = digests(rows, rid)
    groups = _seen(rows, index).select("keep_id", F.col("digest").alias("group"))
    staying = own.join(groups, own["doc_id"].eqNullSafe(groups["keep_id"]) & (own["digest"] == groups["group"]))
    first = staying.groupBy("digest").agg(F.min(rid).alias(rid)).select(rid)
    return without(rows, rid, own.select(rid).join(first, rid, "left_anti"))


def _seen(docs: DataFrame, index: DigestIndex | None) -> DataFrame:
    """The groups of the index, to which `docs` are added; of an index for this batch alone if none is given."""
    if index:
        index.append(docs)
        index.new = False
        return index.groups()
    index = DigestIndex(docs.sparkSession)
    index.append(docs)
    index.close()
    return index.groups()
