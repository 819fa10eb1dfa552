"""A corpus pipeline: quality filter, exact dedup, near-duplicate dedup, mixing of sources, encoding to tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to the shared folder and read
again as the next stage's docs. All but the last return the columns of documents, so STAGES[k:] can go on from any stage's
output. What a stage kept for its result is removed when the next stage begins. One run at a time for each process.

Defined results: a stage treats null and empty texts, ties and repeated rows as its operator says; an empty table goes
through all stages; further columns of documents are carried along, up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadstream.llm import byte_bpe, common, exact_dedup, mixing, ngram_join, quality

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, common.labels(spark, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.keep_first_of_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the smallest doc_id stays."""
    return ngram_join.keep_one_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out until the sources have their target weights."""
    return mixing.repeat_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the token ids of every document of the mix."""
    common.ship(spark)
    return byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)


def tidy(stage: Stage, made: list[str]) -> Stage:
    """The stage, which first removes the folders that the stage before it made for its result: that is written by now. Folders
    that `docs` is still read from stay. `made` is shared by all stages."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        made[:] = common.remove(spark, made, docs)
        with common.noting(made):
            return stage(spark, docs, sf_dir)

    return run_stage


_made: list[str] = []
STAGES = [(name, tidy(stage, _made)) for name, stage in (
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
)]

#: The classifier is trained and the mix is rounded from a Newton solution, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.documents(spark, sf_dir), []
    for i, (_, stage) in enumerate(STAGES):
        written: list[str] = []
        with common.noting(written):
            docs = common.stored(stage(spark, docs, sf_dir), f"stage{i}")
        common.remove(spark, before, docs)
        before = written
    _made[:] = common.remove(spark, _made, docs)
    return docs
