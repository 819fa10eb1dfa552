"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadstream.llm import (
    burst_trie, byte_bpe, common, exact_dedup, fingerprints, language, lexical_search, mixing, ngram_join, packing, pii, quality, secrets,
    toxicity,
)

#: The files of the queries. Executors read them where they are installed.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": lambda spark, sf_dir: exact_dedup.exact_dedup(common.documents(spark, sf_dir)),
    "op2_secrets": lambda spark, sf_dir: secrets.scan(common.documents(spark, sf_dir)),
    "op3_ngram_join": lambda spark, sf_dir: ngram_join.join(common.documents(spark, sf_dir)),
    "op4_mixing": lambda spark, sf_dir: mixing.mix(common.documents(spark, sf_dir)),
    "op5_pii": lambda spark, sf_dir: pii.scan(common.documents(spark, sf_dir)),
    "op6_quality": lambda spark, sf_dir: quality.classify(common.documents(spark, sf_dir), common.labels(spark, sf_dir)),
    "op7_language": lambda spark, sf_dir: language.classify(common.documents(spark, sf_dir)),
    "op8_byte_bpe": lambda spark, sf_dir: byte_bpe.round_trip(
        common.documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN).drop("ids"),
    "op9_toxicity": lambda spark, sf_dir: toxicity.classify(common.documents(spark, sf_dir), common.labels(spark, sf_dir)),
    "op10_fingerprints": lambda spark, sf_dir: fingerprints.neighbours(common.documents(spark, sf_dir)),
    "op11_prefix_trie": lambda spark, sf_dir: burst_trie.prefix_trie(common.conversations(spark, sf_dir)),
    "op12_packing": lambda spark, sf_dir: packing.digests(packing.pack(common.documents(spark, sf_dir), WORDS)),
    "op13_lexical_search": lambda spark, sf_dir: lexical_search.search(
        common.documents(spark, sf_dir), common.benchmark(spark, sf_dir)),
}

ORACLE: dict[str, str] = {
    "op2_secrets": secrets.SQL,
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
        FROM d JOIN g USING (text_sha256)""",
    "op11_prefix_trie": burst_trie.SQL,
    "op13_lexical_search": lexical_search.SQL,
}
