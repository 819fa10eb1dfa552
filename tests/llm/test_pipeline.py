from collections import Counter
from hashlib import sha256
from pathlib import Path

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from compare import TESTDATA
from roadstream.llm import byte_bpe, common, mixing, quality
from test_ngram_join import brute

SF = str(TESTDATA / "sf0.01")


def test_against_brute_force(spark):
    """Each stage's decisions, taken again in plain Python on what the stage before kept."""
    docs = common.documents(spark, SF)
    rows = [(r["doc_id"], r["text"], r["source"], r["lang"], r["n_chars"]) for r in docs.collect()]
    scores = {r["doc_id"]: r["predicted"] for r in quality.classify(docs, common.labels(spark, SF)).collect()}
    rows = [r for r in rows if scores[r[0]]]
    last = {r[1]: max(x[0] for x in rows if x[1] == r[1]) for r in rows}
    rows = [r for r in rows if last[r[1]] == r[0]]
    classes = {i: c for i, _, c in brute(rows)}
    rows = [r for r in rows if classes[r[0]] == r[0]]
    kept = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(kept).collect()}
    vocabulary = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.vocabulary(corpus_pipeline.RANKS).rank, special_tokens={})
    want = Counter()
    for i, text, *_ in rows:
        ids = vocabulary.encode_ordinary(text or "")
        want[i, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256((text or "").encode()).hexdigest()] += copies[i]
    got = corpus_pipeline.run(spark, SF)
    assert Counter(tuple(r)[:4] for r in got.collect()) == +want
    assert 0 < len(rows) < len(scores) and max(want.values()) > 1


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None, 1, 2), (None, "", "a", None, 0, 1, 2), (2, "a b c d e f", "b", "en", 1, 0, 3), (2, "a b c d e f", "b", "en", 1, 0, 3)]])
def test_stages_keep_the_columns(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint, __RID int, __ridcopies int")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = common.stored(stage(spark, docs, SF), "test")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.schema.names == docs.schema.names
            assert out.count() <= 3 * docs.count()
            docs = out
    assert out.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == docs.count()


def test_folders_of_finished_stages_are_removed(spark):
    made = []
    with common.noting(made):
        docs = corpus_pipeline.run(spark, SF)
        assert docs.count() > 0
    left = [p for p in made if Path(p).exists()]
    assert left == [made[-1]] and any(made[-1] in f for f in docs.inputFiles())
    assert not corpus_pipeline._made


def test_a_stage_leaves_what_its_input_is_read_from(spark):
    (_, first), (_, second) = corpus_pipeline.STAGES[1:3]
    docs = common.documents(spark, SF)
    lazy = first(spark, docs, SF)  # not written in between
    assert second(spark, lazy, SF).count() == second(spark, common.stored(first(spark, docs, SF), "test"), SF).count()


def test_rows_are_numbered_by_their_place(spark):
    docs = common.stored(spark.range(1000).selectExpr("id AS doc_id", "'x' AS text").repartition(7), "test")
    rows, rid = common.numbered(docs)
    assert rows.select(rid).distinct().count() == 1000
    assert rows.select(rid, "doc_id").exceptAll(common.numbered(docs)[0].select(rid, "doc_id")).isEmpty()
    twice, rid = common.numbered(docs.union(docs))
    assert twice.select(rid).distinct().count() == 2000
    joined, rid = common.numbered(docs.crossJoin(spark.range(2).withColumnRenamed("id", "n")))
    assert joined.select(rid).distinct().count() == 2000
