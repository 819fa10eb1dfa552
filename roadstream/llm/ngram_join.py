"""Jaccard join on word n-grams, as a blocked sparse product of the document by n-gram incidence with itself.

1. Every text becomes a set of hashed n-grams. Texts of equal sets are one class from here on.
2. Classes that agree in a band of n-gram minima are compared with one class of their band, in numbers linear in the
   classes, and then classes that share frequent n-grams with a few of these. That ties groups of near copies together at
   little cost; it is no candidate search to be relied on.
3. The product proper runs over the blocks of the incidence that can decide: of n n-grams in one order for all, two sets
   with 100 * overlap >= 80 * union share at least one of their first n - ceil(0.8 n) + 1. Rare n-grams come first in that
   order. A pair is only counted if step 2 has not connected it, and if sizes and sketches (n-grams counted by bit, odd or
   even, which bounds how far two sets differ) allow a link at all; overlaps are accumulated by pair, and a pair goes if what
   it shares in these blocks is less than the sizes of the rest require. The whole overlap is then taken exactly.
4. Links make components.

`join` and `grouped` need components only, so pairs that are connected already are not compared. `links` gives every link between
classes, and `link_counts` how many each row has: for these step 2 is left out, and step 3 covers all pairs. That is quadratic in the
different texts of a group of near copies, as its links are.

No link between components is lost: each pair of classes that are not connected already is found in step 3, whatever step 2 found. n-grams are
64-bit hashes; nothing else is approximate. How rare an n-gram is comes from `BUCKETS` counters for all of them, which is
a bounded table however large the corpus, and decides the order only.

Defined results: a null text is empty; without words a set is empty and linked with nothing, its component is the doc_id;
with fewer than n words, the whole sequence is the one n-gram; a component is called by its smallest doc_id, null if it has
only nulls; repeated rows are of one class; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import numbered, stored, whole_text, without
from roadstream.llm.components import components
from roadstream.llm.hashing import KEPT as SLICE
from roadstream.llm.hashing import mixed, powers

#: Words of an n-gram; overlap in hundredths of the union from which two documents are linked.
WORDS, LINK = 5, 80
#: Counters of n-grams (a power of two), and how many make one row of a stored table.
BUCKETS, BLOCK = 1 << 22, 1 << 14
#: Bands of two minima each, and 64-bit numbers of a sketch (a power of two).
BANDS, SKETCH = 6, 8
#: Before the product is taken, classes that share an n-gram with `BUSY` classes at least are compared with `HEADS` of them (the
#: one of the most frequent n-grams, others by hash), in up to `TURNS` turns, to tie what are near copies of one document.
BUSY, HEADS, TURNS = 16, 4, 2
#: n-grams shared across groups that are broadcast; more of them are joined by shuffling.
BROADCAST_ROWS = 1_000_000

_rng = np.random.default_rng(20)
_value = _rng.integers(1 << 62, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_value[65:91] = _value[97:123]  # A-Z as a-z
_space = np.zeros(256, bool)
_space[[32, *range(9, 14)]] = True
_weight = _rng.integers(1 << 62, 1 << 63, WORDS + 1, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    texts = texts.cast(pa.large_string())
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + SLICE, "right")) - 1)
        yield from _sets(raw[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
        i = j


def _sets(raw: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    word = ~_space[raw]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cut = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(raw))]  # texts end words
    first[cut] = word[cut]
    last[cut - 1] = word[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    base, back = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_value[raw] * base[:len(raw)], out=sums[1:])
    words = mixed((sums[ends] - sums[starts]) * back[starts])
    grams = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        grams += words[k:k + len(grams)] * _weight[k]
    grams = mixed(grams)
    at = np.searchsorted(starts, bounds)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= WORDS:
            yield np.unique(grams[a:b - WORDS + 1])
        elif b > a:
            few = (words[a:b] * _weight[:b - a]).sum(dtype=np.uint64, keepdims=True)
            yield mixed(few + _weight[WORDS:] * np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def _marks(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, whatever their order."""
    one = mixed(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(grams.sum(dtype=np.uint64).view(np.int64)), int(one.view(np.int64))


_edges = (np.arange(2 * BANDS, dtype=np.uint64) * np.uint64((1 << 64) // (2 * BANDS)))


def _bands(grams: np.ndarray) -> list[int]:
    """By band, one number for the smallest n-grams of its two ranges. A range without n-grams takes the next one."""
    at = np.searchsorted(grams, _edges) % len(grams)
    least = grams[at]
    return mixed(least[0::2] * _weight[0] + least[1::2]).view(np.int64).tolist()


def _sketch(grams: np.ndarray) -> list[int]:
    """By bit, whether an odd number of n-grams falls on it: two sets differ in as many n-grams at least as in bits."""
    odd = np.bincount((grams >> np.uint64(58 - (SKETCH.bit_length() - 1))).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _longs(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each (rid, doc_id, text) with its set's size, marks and bands, and at the end rows of n-gram counters."""
    counters, waiting, held = np.zeros(BUCKETS, np.uint8), [], 0
    names = ["rid", "doc_id", "n", "m1", "m2", "bands", "sketch", "block", "counts"]

    def count():
        more = np.bincount(np.concatenate(waiting) & np.uint64(BUCKETS - 1), minlength=BUCKETS)
        counters[:] = np.minimum(counters + more, 255)  # a task counts to 255; what reaches that is frequent anyway
        waiting.clear()

    for part in _parts(batches):
        sets = list(shingle_sets(part.column(2)))
        marks = [_marks(s) for s in sets]
        waiting += sets
        held += sum(map(len, sets))
        if held > BUCKETS:
            count()
            held = 0
        yield pa.RecordBatch.from_arrays([
            part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
            pa.array([m for m, _ in marks], pa.int64()), pa.array([m for _, m in marks], pa.int64()),
            pa.array([_bands(s) if len(s) else [] for s in sets], pa.list_(pa.int64())),
            pa.array([_sketch(s) for s in sets], pa.list_(pa.int64())),
            pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names)
    if waiting:
        count()
    for block in range(0, BUCKETS, BLOCK * 64):
        blocks = [b for b in range(block // BLOCK, block // BLOCK + 64) if counters[b * BLOCK:(b + 1) * BLOCK].any()]
        yield pa.RecordBatch.from_arrays([
            *(pa.nulls(len(blocks), pa.int64()) for _ in range(5)), *(pa.nulls(len(blocks), pa.list_(pa.int64())) for _ in range(2)),
            pa.array(blocks, pa.int32()), pa.array([counters[b * BLOCK:(b + 1) * BLOCK].tobytes() for b in blocks], pa.binary())], names)


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for part in _parts(batches):
        for block, counts in zip(part.column(0).to_pylist(), part.column(1)):
            row = np.frombuffer(counts.as_buffer(), np.uint8).astype(np.uint64)
            sums[block] = sums[block] + row if block in sums else row
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["block", "counts"])


def frequent(described: DataFrame) -> np.ndarray:
    """By bucket, 0 if its n-grams are as rare as most, else the count: `BUCKETS` numbers."""
    rows = described.where("block IS NOT NULL").select("block", "counts")
    total = np.zeros(BUCKETS, np.uint64)
    for r in rows.repartition(BUCKETS // BLOCK // 8, "block").mapInArrow(_add_blocks, "block int, counts binary").collect():
        total[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] += np.frombuffer(r["counts"], np.uint64)
    usual = np.median(total)
    return np.where(total > usual + 4 * np.sqrt(usual) + 2, total, 0).astype(np.float32)


def prefixes(docs: DataFrame, classes: DataFrame, counters: np.ndarray) -> DataFrame:
    """cid, label, the first n-grams of each class, rare ones first, and how frequent all of its n-grams are.

    Of near copies of one text, the one that was changed least has the most frequent n-grams.
    """
    order = docs.sparkSession.sparkContext.broadcast(counters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seldom, seen = order.value, set()
        for part in _parts(batches):
            firsts, marks, new, usual = [], [], [], []
            for doc_id, s in zip(part.column(0).to_pylist(), shingle_sets(part.column(1))):
                marks.append(_marks(s))
                new.append((doc_id, marks[-1]) not in seen)  # repeated rows
                seen.add((doc_id, marks[-1]))
                often = seldom[s & np.uint64(BUCKETS - 1)]
                usual.append(int(1e6 * np.log1p(often).mean()) if len(s) else 0)
                if often.any():
                    s = s[np.argsort(often, kind="stable")]
                firsts.append(s[:len(s) - -(-LINK * len(s) // 100) + 1] if len(s) else s)
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array([m for m, _ in marks], pa.int64()), pa.array([m for _, m in marks], pa.int64()),
                _longs(firsts), pa.array(usual, pa.int64())], ["doc_id", "m1", "m2", "grams", "usual"]).filter(pa.array(new, pa.bool_()))

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        run, "doc_id bigint, m1 bigint, m2 bigint, grams array<bigint>, usual bigint")
    own = classes.select("cid", "label", F.col("rep"), F.col("m1").alias("k1"), F.col("m2").alias("k2"))
    return found.join(own, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("m1") == F.col("k1")) & (F.col("m2") == F.col("k2"))).select(
        "cid", "label", "usual", "grams")


def whole_sets(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """cid and all n-grams of the `needed` classes, a row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            sets = list(shingle_sets(part.column(1)))
            marks = [_marks(s) for s in sets]
            own = pa.array([(a, b) == m for a, b, m in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), marks)])
            yield pa.RecordBatch.from_arrays([part.column(0), _longs(sets)], ["cid", "grams"]).filter(own)

    few = needed.count() <= BROADCAST_ROWS
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    texts = named.join(F.broadcast(needed) if few else needed, F.col("doc_id").eqNullSafe(F.col("rep")))
    return texts.select("cid", "text", "m1", "m2").mapInArrow(run, "cid bigint, grams array<bigint>").groupBy("cid").agg(
        F.first("grams").alias("grams"))


def linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of `pairs` (a, b) whose whole sets overlap enough."""
    ids = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    needed = stored(classes.join(ids, "cid").select("cid", "rep", "m1", "m2"), "needed")
    sets = stored(whole_sets(docs, needed), "sets")
    one = sets.select(F.col("cid").alias("a"), F.col("grams").alias("x"))
    other = sets.select(F.col("cid").alias("b"), F.col("grams").alias("y"))
    overlap = F.size(F.array_intersect("x", "y"))
    enough = (100 + LINK) * overlap >= LINK * (F.size("x") + F.size("y"))
    return pairs.join(other, "b").join(one, "a").where(enough).select("a", "b")


def _may_link(n: str, m: str, x: str, y: str) -> Column:
    """What two sets of sizes n and m with sketches x and y must meet to be linked at all."""
    differ = sum((F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(SKETCH)), F.lit(0))
    overlap = F.ceil(LINK * (F.col(n) + F.col(m)) / (100 + LINK))
    return (100 * F.least(n, m) >= LINK * F.greatest(n, m)) & (differ <= F.col(n) + F.col(m) - 2 * overlap)


def first_links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links of classes to one class of each band they are in, a different one by band as far as chance has it."""
    rows = classes.select("cid", "n", "sketch", F.posexplode("bands").alias("band", "least"))
    order = F.struct(F.xxhash64("band", "cid"), "cid", "n", "sketch")
    heads = rows.groupBy("band", "least").agg(F.min(order).alias("head"), F.count("*").alias("size")).where("size > 1")
    heads = stored(heads.select("band", "least", F.col("head.cid").alias("a"), F.col("head.n").alias("m"), F.col("head.sketch").alias("y")), "heads")
    pairs = rows.join(heads, ["band", "least"]).where(F.col("a") != F.col("cid")).where(_may_link("n", "m", "sketch", "y"))
    pairs = pairs.select(F.least("a", "cid").alias("a"), F.greatest("a", "cid").alias("b")).distinct()
    return linked(docs, classes, stored(pairs, "pairs"))


def _least_shared() -> Column:
    """How many of their first n-grams sets of sizes n and m must share to be linked."""
    overlap = F.ceil(LINK * (F.col("n") + F.col("m")) / (100 + LINK))
    return overlap - (F.ceil(LINK * F.greatest("n", "m") / 100) - 1)  # less what is not among the first of the larger set


def _relabelled(classes: DataFrame, links: DataFrame) -> DataFrame:
    """cid and label after `links` have tied more labels together."""
    stars = classes.where("cid <> label").select(F.col("cid").alias("a"), F.col("label").alias("b"))
    now = components(stars.union(links)).withColumnRenamed("node", "cid")
    return classes.drop("label").join(now, "cid", "left").withColumn("label", F.coalesce("component", "cid")).drop("component")


def _head_links(docs: DataFrame, classes: DataFrame, entries: DataFrame, turn: int) -> DataFrame:
    """Links of the classes that share much-shared n-grams to a few of them, in numbers linear in the entries."""
    heads = [F.min(F.struct(F.xxhash64("cid", F.lit(turn), F.lit(k)).alias("by"), F.col("cid").alias("head"))) for k in range(1, HEADS)]
    heads.append(F.max(F.struct(F.col("usual").alias("by"), F.col("cid").alias("head"))))  # linked with most of its near copies
    busy = entries.groupBy("gram").agg(
        F.count("*").alias("df"), F.min("label").alias("low"), F.max("label").alias("high"), F.array(*heads).alias("heads"))
    busy = busy.where((F.col("low") < F.col("high")) & (F.col("df") >= BUSY))
    busy = stored(busy.select("gram", F.explode(F.array_distinct("heads.head")).alias("head")), "heads")
    met = entries.join(busy, "gram").where("cid <> head").groupBy(
        F.least("cid", "head").alias("a"), F.greatest("cid", "head").alias("b")).agg(F.count("*").alias("shared"))
    one = classes.select(F.col("cid").alias("a"), "n", F.col("label").alias("la"), F.col("sketch").alias("x"))
    other = classes.select(F.col("cid").alias("b"), F.col("n").alias("m"), F.col("label").alias("lb"), F.col("sketch").alias("y"))
    likely = (F.col("la") != F.col("lb")) & _may_link("n", "m", "x", "y") & (2 * F.col("shared") >= _least_shared())
    return linked(docs, classes, stored(met.join(one, "a").join(other, "b").where(likely).select("a", "b"), "pairs"))


def further_links(docs: DataFrame, classes: DataFrame, counters: np.ndarray, turns: int = TURNS) -> DataFrame:
    """All links between classes of different labels, but for those that others make needless; without `turns`, all of them."""
    firsts = stored(prefixes(docs, classes, counters), "prefixes")
    entries = firsts.select("cid", "label", "usual", F.explode("grams").alias("gram"))
    differ = lambda e: e.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("gram")
    shared = stored(differ(entries), "shared")
    few = shared.count() <= BROADCAST_ROWS
    entries = stored(entries.join(F.broadcast(shared) if few else shared, "gram"), "entries")
    found = None
    for turn in range(turns):
        links = stored(_head_links(docs, classes, entries, turn), "links")
        if links.isEmpty():
            break
        found = links if found is None else found.union(links)
        classes = stored(_relabelled(classes, links), "tied")
        entries = stored(entries.drop("label").join(classes.select("cid", "label"), "cid"), "entries")
    entries = entries.join(differ(entries), "gram", "left_semi").select("gram", "cid")
    side = stored(entries.join(classes.select("cid", "n", "label", "sketch"), "cid"), "entries")
    a = side.select("gram", F.col("cid").alias("a"), "n", F.col("label").alias("la"), F.col("sketch").alias("x"))
    b = side.select("gram", F.col("cid").alias("b"), F.col("n").alias("m"), F.col("label").alias("lb"), F.col("sketch").alias("y"))
    met = a.hint("merge").join(b.hint("merge"), "gram").where((F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")) & _may_link("n", "m", "x", "y"))
    counted = met.groupBy("a", "b", "n", "m").agg(F.count("*").alias("shared"))
    links = linked(docs, classes, stored(counted.where(F.col("shared") >= _least_shared()).select("a", "b"), "pairs"))
    return links if found is None else found.union(links)


def _described(docs: DataFrame, number: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What `_describe` gives, its rows for documents, and the classes of equal sets."""
    numbered_ = docs.select(number.alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    described = stored(
        numbered_.mapInArrow(_describe, "rid bigint, doc_id bigint, n bigint, m1 bigint, m2 bigint, bands array<bigint>, "
                                        "sketch array<bigint>, block int, counts binary"), "described")
    rows = described.where("block IS NULL").select("rid", "doc_id", "n", "m1", "m2", "bands", "sketch")
    classes = stored(
        rows.where("n > 0").groupBy("m1", "m2", "n", "bands", "sketch").agg(F.min("doc_id").alias("rep"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    return described, rows, classes


def grouped(docs: DataFrame, rid: str | None = None) -> DataFrame:
    """rid, doc_id, n_shingles, component (a number, null for empty sets) and component_id of every row of `docs`."""
    described, rows, classes = _described(docs, F.col(rid) if rid else F.monotonically_increasing_id())
    links = stored(first_links(docs, classes), "links")
    tied = components(links).withColumnRenamed("component", "label")
    tied = stored(
        classes.drop("bands").join(tied.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid")),
        "tied")
    links = links.union(stored(further_links(docs, tied, frequent(described)), "links"))
    found = classes.select("cid", "m1", "m2", "n", "rep").join(
        components(links).withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    names = found.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = stored(found.join(names, "component").select("m1", "m2", F.col("n").alias("size"), "component", "component_id"), "named")
    joined = rows.drop("bands", "sketch").join(
        named.withColumnsRenamed({"m1": "k1", "m2": "k2"}),
        (F.col("m1") == F.col("k1")) & (F.col("m2") == F.col("k2")) & (F.col("n") == F.col("size")), "left")
    return joined.select(
        "rid", "doc_id", F.col("n").alias("n_shingles"), "component",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id."""
    return grouped(docs).select("doc_id", "n_shingles", "component_id")


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every link (a, b) between classes of equal sets, a < b, and the class of each row: doc_id, n_shingles, cid (null if empty)."""
    described, rows, classes = _described(docs, F.monotonically_increasing_id())
    untied = classes.drop("bands").withColumn("label", F.col("cid"))
    found = stored(further_links(docs, untied, frequent(described), turns=0), "links")
    named = classes.select("cid", F.col("m1").alias("k1"), F.col("m2").alias("k2"), F.col("n").alias("size"))
    own = (F.col("m1") == F.col("k1")) & (F.col("m2") == F.col("k2")) & (F.col("n") == F.col("size"))
    return found, rows.join(named, own, "left").select("doc_id", F.col("n").alias("n_shingles"), "cid")


def link_counts(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and n_links, the number of other rows that each row is linked with, rows of equal sets among them."""
    found, members = links(docs)
    sizes = members.where("cid IS NOT NULL").groupBy("cid").agg(F.count("*").alias("own"))
    both = found.union(found.select("b", "a")).toDF("cid", "other")
    others = both.join(sizes.toDF("other", "rows"), "other").groupBy("cid").agg(F.sum("rows").alias("others"))
    counts = sizes.join(others, "cid", "left").select("cid", (F.col("own") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return members.join(counts, "cid", "left").select("doc_id", "n_shingles", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one_each(docs: DataFrame) -> DataFrame:
    """Of every component the document with the smallest doc_id, with all its columns; documents without words all stay."""
    rows, rid = numbered(docs)
    found = grouped(rows, rid)
    by_id = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid"))
    first = found.where("component IS NOT NULL").groupBy("component").agg(F.min(by_id).alias("first")).select("first.rid")
    others = found.where("component IS NOT NULL").join(first, "rid", "left_anti").select(F.col("rid").alias(rid))
    return without(rows, rid, others)
