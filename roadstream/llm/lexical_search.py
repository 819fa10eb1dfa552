"""Ranked lexical search by pipelined term partitioning.

Every term of the items has one owner; an owner holds a band of weights, the first one the rarest terms. Items travel in
bundles: for each block of documents a bundle is one row with its items' terms and a sparse accumulator of (item, document,
score). It passes the owners one after another. At each, cogroup brings it together with the owner's postings of that block,
and the contributions, whole numbers, are added. The last owner does not hand the accumulators on: each block names its best
documents by item, and the best of all blocks are ranked.

A block holds about `BLOCK` documents and a bundle at most `BUNDLE` items, so a task's memory does not grow with either
table. Documents are read once; a row per document keeps the terms that some item may hold, by a bit vector of fixed size,
and an exact join decides. A frequent term's postings are spread over all blocks.

Score: a term of weight w = floor(1000 ln((2 N + 2) / (2 df + 1))) that stands tf times in a document gives
w * (10^9 tf div (1000 tf + 8 m)), m = 25 + 75 n N div L, once for each time that it stands in the item. N documents hold a
term, L is the number of all terms, n of the document's.

Defined results: null and empty texts hold no term and are never found, and as items find nothing; a text of any length is
read whole; documents of equal score go by doc_id, null last; rows of equal doc_id are documents of their own, and rows of
equal item_id items of their own; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.common import ship, stored, whole_text

BEST = 10
#: The least weight of each owner's terms.
OWNERS = (5000, 3500, 2000, 0)
BLOCK, BUNDLE = 4096, 256
#: Bits that tell which terms items may hold.
BITS = 1 << 22
#: Fixed values of the score.
SCALE, SHARE, TOP, ONE, FACTOR = 1000, 75, 1_000_000_000, 1000, 8

#: A term, on UTF-8 bytes with A-Z lower-cased.
find_terms = re.compile(rb"[0-9a-z\x80-\xff]+").findall
#: An accumulator: its documents, and the scores above 0 by places in the list of items and in that of documents.
CARRIED = {"rids": "array<bigint>", "doc_ids": "array<bigint>", "at_item": "array<int>", "at_doc": "array<int>", "score": "array<bigint>"}
BUNDLES = "bundle bigint, block bigint, " + ", ".join(f"{c} {kind}" for c, kind in CARRIED.items())
FOUND = "item bigint, rid bigint, doc_id bigint, score bigint"
NO_ID = (1 << 63) - 1  # what a null doc_id counts as in the order


def terms_of(rows: DataFrame, *keys: str, vocabulary: DataFrame | None = None) -> DataFrame:
    """keys, n (terms with repeats) and the distinct terms with their numbers; only those that `vocabulary` may hold, if given."""
    held = None
    if vocabulary is not None:
        bits = vocabulary.select((F.crc32(F.col("term").cast("binary")) % BITS).cast("int").alias("bit")).distinct()
        held = np.zeros(BITS, bool)
        held[np.array([r[0] for r in bits.toLocalIterator()], np.int64)] = True
        held = np.packbits(held).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if held is None else np.unpackbits(np.frombuffer(held, np.uint8)).tobytes()
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                numbers, words, counts = [], [], []
                for raw in part.column(part.num_columns - 1).to_pylist():
                    found = Counter(find_terms(raw.lower()))
                    numbers.append(found.total())
                    kept = [t for t in found if bits is None or bits[crc32(t) % BITS]]
                    words.append(kept)
                    counts.append([found[t] for t in kept])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(numbers, pa.int64()),
                     pa.array(words, pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64()))],
                    [*part.schema.names[:-1], "n", "terms", "counts"])

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys)
    return rows.select(*keys, whole_text().cast("binary").alias("text")).mapInArrow(
        run, f"{schema}, n bigint, terms array<string>, counts array<bigint>")


def _by_term(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.select(*keys, F.explode(F.arrays_zip("terms", "counts")).alias("t")).select(*keys, F.col("t.terms").alias("term"), F.col("t.counts").alias("times"))


def search(docs: DataFrame, items: DataFrame, best: int = BEST, block_docs: int = BLOCK, bundle_items: int = BUNDLE) -> DataFrame:
    """item_id, rank, doc_id, score of the best documents for each item."""
    ship(docs.sparkSession)
    number = F.monotonically_increasing_id()
    asked = stored(items.select(number.alias("item"), F.col("item_id").cast("long").alias("item_id"), "text"), "items")
    asked_terms = stored(_by_term(terms_of(asked, "item"), "item"), "item_terms")
    read = stored(
        terms_of(docs.select(number.alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text"), "rid", "doc_id",
                 vocabulary=asked_terms.select("term")).where("n > 0"),
        "read")
    n_docs, n_terms = read.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    blocks, bundles = max(1, -(-n_docs // block_docs)), max(1, -(-asked.count() // bundle_items))

    length = F.lit(100 - SHARE) + F.expr(f"({SHARE} * n * {n_docs}L) div {max(1, n_terms)}L")
    postings = _by_term(read.withColumn("m", length), "rid", "doc_id", "m").select(
        "rid", "doc_id", "term", F.pmod(F.xxhash64("rid"), F.lit(blocks)).alias("block"),
        F.expr(f"({TOP}L * times) div ({ONE}L * times + {FACTOR}L * m)").alias("impact"))
    frequent = postings.groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(SCALE * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    owner = F.size(F.filter(F.array(*map(F.lit, OWNERS)), lambda least: least > F.col("weight")))
    bundle = F.pmod(F.xxhash64("item"), F.lit(bundles)).alias("bundle")
    known = asked_terms.select("term").distinct().join(frequent, "term").select(
        "term", F.monotonically_increasing_id().alias("term_id"), weight.cast("long").alias("weight")).withColumn("owner", owner)
    known = stored(known, "vocabulary")
    wanted = asked_terms.join(known, "term").select(
        bundle, "item", "term", "term_id", "owner", (F.col("times") * F.col("weight")).alias("times"))
    wanted = stored(wanted, "wanted")

    state = None
    for stage in range(len(OWNERS)):
        here = wanted.where(F.col("owner") == stage)
        held = here.select("bundle", "term", "term_id").distinct()
        owned = postings.join(held, "term").select(
            F.col("bundle").alias("to"), F.col("block").alias("place"), "term_id", "rid", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "impact")
        arriving = _arrive(wanted, here, state, blocks)
        last = stage == len(OWNERS) - 1
        both = arriving.groupBy("bundle", "block").cogroup(owned.groupBy("to", "place"))
        state = stored(both.applyInArrow(_final(best) if last else _pass_on, FOUND if last else BUNDLES), "found" if last else "bundles")

    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id", "rid")
    ranked = state.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return (
        ranked.drop("doc_id").join(read.select("rid", "doc_id"), "rid").join(asked.select("item", "item_id"), "item")
        .select("item_id", "rank", "doc_id", "score"))


def _arrive(wanted: DataFrame, here: DataFrame, state: DataFrame | None, blocks: int) -> DataFrame:
    """The bundles, one row for each block, with the weights of this owner's terms by item and what they carry."""
    items = wanted.groupBy("bundle").agg(F.array_sort(F.collect_set("item")).alias("items"))
    pairs = here.groupBy("bundle").agg(F.collect_list(F.struct("term_id", "item", "times")).alias("pairs"))
    terms = items.join(pairs, "bundle", "left").select(
        "bundle", "items", *(F.coalesce(F.col(f"pairs.{c}"), F.array().cast("array<bigint>")).alias(name)
                             for c, name in (("term_id", "term_of"), ("item", "item_of"), ("times", "times"))))
    if state is None:
        spread = terms.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        return spread.select("*", *(F.array().cast(kind).alias(c) for c, kind in CARRIED.items()))
    return state.join(terms, "bundle")


def _list(table: pa.Table, column: str) -> np.ndarray:
    """The list in the only row of the table."""
    return table.column(column).chunk(0).flatten().to_numpy(zero_copy_only=False)


def _added(bundle: pa.Table, postings: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bundle's items, the documents of the block that it knows of with their doc_ids, and the scores by (item, document)."""
    items, known = _list(bundle, "items"), _list(bundle, "rids")
    rids, terms, impacts = (postings.column(c).to_numpy() for c in ("rid", "term_id", "impact"))
    docs, first = np.unique(np.concatenate([known, rids]), return_index=True)
    doc_ids = np.concatenate([_list(bundle, "doc_ids"), postings.column("doc_id").to_numpy()])[first]
    scores = np.zeros((len(items), len(docs)), np.int64)
    scores[_list(bundle, "at_item"), np.searchsorted(docs, known)[_list(bundle, "at_doc")]] = _list(bundle, "score")
    if len(rids):
        by_term = np.argsort(terms, kind="stable")
        terms, impacts, places = terms[by_term], impacts[by_term], np.searchsorted(docs, rids[by_term])
        asked = _list(bundle, "term_of")
        by_asked = np.argsort(asked, kind="stable")
        asked, rows = asked[by_asked], np.searchsorted(items, _list(bundle, "item_of")[by_asked])
        times = _list(bundle, "times")[by_asked]
        starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
        for lo, hi in zip(starts, [*starts[1:], len(terms)]):
            a, b = np.searchsorted(asked, terms[lo]), np.searchsorted(asked, terms[lo], "right")
            scores[rows[a:b, None], places[None, lo:hi]] += times[a:b, None] * impacts[None, lo:hi]
    return items, docs, doc_ids, scores


def _pass_on(bundle: pa.Table, postings: pa.Table) -> pa.Table:
    _, docs, doc_ids, scores = _added(bundle, postings)
    item, doc = np.nonzero(scores)
    values = docs, doc_ids, item.astype(np.int32), doc.astype(np.int32), scores[item, doc]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in values]
    return pa.table([bundle.column("bundle"), bundle.column("block"), *lists], names=["bundle", "block", *CARRIED])


def _final(best: int):
    def run(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        items, docs, doc_ids, scores = _added(bundle, postings)
        found = []
        for item, row in zip(items, scores):
            at = np.flatnonzero(row)
            if len(at) > best:
                at = at[row[at] >= np.partition(row[at], -best)[-best]]
            at = at[np.lexsort((docs[at], doc_ids[at], -row[at]))][:best]
            found.append((np.full(len(at), item), docs[at], doc_ids[at], row[at]))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*found)], names=["item", "rid", "doc_id", "score"])

    return run


SQL = f"""
    WITH t AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
    p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
    d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
    s AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
    w AS (
        SELECT term, floor({SCALE} * ln((2.0::DOUBLE * max(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM p, s GROUP BY term),
    i AS (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY item_id, term),
    r AS (
        SELECT item_id, doc_id, sum(times * weight * (({TOP}::BIGINT * tf) // ({ONE} * tf + {FACTOR} * ({100 - SHARE} + ({SHARE} * n * n_docs) // n_terms))))::BIGINT AS score
        FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (doc_id), s GROUP BY item_id, doc_id),
    k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM r WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM k WHERE rank <= {BEST}"""
