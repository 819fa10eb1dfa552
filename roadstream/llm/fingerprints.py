"""Fingerprints by order MinHash: sketches that follow edit distance rather than the set of k-mers.

A text's k-mers of code points are numbered by their occurrence, so that the second `abab` differs from the first. For each
of `HASHES` hash functions the `LENGTH` smallest ones are selected and listed in the order in which they stand in the text;
the hash of that tuple is one number of the fingerprint. The likeness of two fingerprints is the share of equal numbers.

`neighbours` compares each document with its edited text and with the next document, by descending doc_id. For that the rows
are cut into cells by quantiles of doc_id, and the first document of each cell is copied to the end of the cell before; a
task then goes through its cells in order and keeps one document in memory.

Defined results: a null text is empty; a text shorter than a k-mer is one k-mer; the fingerprint of an empty text is like that
of empty texts only; equal doc_ids go by a hash of their text, null doc_ids come last in that order; a single document is
its own next; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.common import whole_text
from roadstream.llm.hashing import mixed, powers

#: Code points of a k-mer, hash functions, k-mers of a tuple.
K, HASHES, LENGTH = 10, 64, 2
#: Ranks that are held at once, as long as they are of one hash function.
RANKS = 1 << 16
#: Documents of a cell, as long as there are no more than `CELLS` cells.
ROWS, CELLS = 500, 40_000

_rng = np.random.default_rng(10)
_flips = _rng.integers(0, 1 << 63, HASHES, np.uint64)
_odd = _rng.integers(1 << 62, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_place = _rng.integers(1 << 62, 1 << 63, LENGTH, np.uint64) * np.uint64(2) + np.uint64(1)
_occurrence = np.uint64(0xD6E8FEB86659FD93)
_most = np.uint64((1 << 64) - 1)


def kmers(text: str) -> np.ndarray:
    """Hashes of the occurrence-numbered k-mers, in the order of the text; all differ."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    n = len(points)
    if not n:
        return points
    width = min(K, n)
    base, back = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(points) * base[:n], out=sums[1:])
    found = mixed((sums[width:] - sums[:-width]) * back[:n - width + 1])
    ordered = np.sort(found)
    if (ordered[1:] == ordered[:-1]).any():
        order = np.argsort(found, kind="stable")
        ordered = found[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        number = np.empty(len(order), np.uint64)
        number[order] = (np.arange(len(order)) - first).astype(np.uint64)
        found = mixed(found + number * _occurrence)
    return found


def signature(text: str) -> np.ndarray:
    """The fingerprint as `HASHES` numbers of 32 bits."""
    found = kmers(text)
    if not len(found):
        return np.zeros(HASHES, np.uint32)
    width, step = min(LENGTH, len(found)), max(1, RANKS // len(found))
    picked = np.empty((HASHES, width), np.int64)
    for lo in range(0, HASHES, step):
        ranked = found ^ _flips[lo:lo + step, None]
        ranked *= _odd[lo:lo + step, None]
        for k in range(width):
            least = ranked.argmin(axis=1)
            picked[lo:lo + step, k] = least
            ranked[np.arange(len(ranked)), least] = _most
    picked.sort(axis=1)
    tuples = np.zeros((HASHES, LENGTH), np.uint64)
    tuples[:, :width] = found[picked]
    return ((mixed((tuples * _place).sum(axis=1, dtype=np.uint64)) >> np.uint64(33)) + np.uint64(1)).astype(np.uint32)


def written(numbers: np.ndarray) -> str:
    return numbers.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The text with its last half, rounded down, replaced by as much of the beginning of `following`, or all of it."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(len, texts), pa.int64()), pa.array([written(signature(t)) for t in texts], pa.string())],
                    ["doc_id", "n_chars", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        run, "doc_id bigint, n_chars bigint, fingerprint string")


def _above(bounds: list[int]) -> Column:
    """How many of `bounds`, which descend, are at least doc_id: looked up in two steps of about sqrt(n)."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    at_least = lambda xs: F.size(F.filter(xs, lambda b: b >= F.col("doc_id")))
    full = at_least(F.array(*(F.lit(b[-1]) for b in blocks)))
    rest = F.get(F.array(*(F.array(*map(F.lit, b)) for b in [*blocks, [-(1 << 63)]])), full)
    return F.when(full == len(blocks), F.lit(len(bounds))).otherwise(full * step + at_least(rest))


def _in_cells(docs: DataFrame) -> DataFrame:
    """The rows by (cell, copied, null, down, mark): in this order each row is followed by the next document.

    `copied` rows are there only to follow the last row of a cell.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    total, nulls = ids.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    n = max(1, min(CELLS, (total - nulls) // ROWS))
    shares = [i / n for i in range(1, n)]
    found = ids.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 20 * n)).first()[0] if shares and total > nulls else []
    bounds = sorted(set(found or []), reverse=True)
    bits = min(16, max(0, int(nulls // ROWS).bit_length()))
    mark = F.xxhash64("text")
    null_cell = F.shiftrightunsigned(mark.bitwiseXOR(F.lit(-(1 << 63))), 64 - bits).cast("int") if bits else F.lit(0)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).select(
        "doc_id", "text",
        F.when(F.col("doc_id").isNull(), len(bounds) + 1 + null_cell).otherwise(_above(bounds)).alias("cell"),
        F.col("doc_id").isNull().alias("null"), F.bitwise_not("doc_id").alias("down"), mark.alias("mark"))
    heads = rows.groupBy("cell").agg(F.min(F.struct("null", "down", "mark")).alias("head"))
    before, last = F.lag("cell").over(Window.orderBy("cell")), F.max("cell").over(Window.partitionBy())
    heads = heads.select("head", F.coalesce(before, last).alias("to"), F.col("cell").alias("of"))  # a row for each cell
    own = F.col("head").eqNullSafe(F.struct("null", "down", "mark"))
    placed = rows.join(F.broadcast(heads), F.col("cell") == F.col("of"))
    places = F.when(own, F.array(F.struct(F.col("cell"), F.lit(False).alias("copied")), F.struct(F.col("to").alias("cell"), F.lit(True).alias("copied")))).otherwise(
        F.array(F.struct(F.col("cell"), F.lit(False).alias("copied"))))
    return placed.select("doc_id", "text", "null", "down", "mark", F.explode(places).alias("place")).select("doc_id", "text", "null", "down", "mark", "place.*")


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
    held, out = None, []

    def table():
        batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(len(names))], names)
        out.clear()
        return batch

    for batch in batches:
        for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
            for doc_id, text, cell, copied in zip(*(c.to_pylist() for c in part.columns)):
                own = signature(text)
                if held and held[2] == cell:
                    other = edited(held[1], text)
                    changed = signature(other)
                    out.append((held[0], len(held[1]), sha256(other.encode()).hexdigest(), written(held[3]), written(changed),
                                likeness(held[3], changed), likeness(held[3], own)))
                held = None if copied else (doc_id, text, cell, own)
            yield table()


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    placed = _in_cells(docs).repartition("cell").sortWithinPartitions("cell", "copied", "null", "down", "mark")
    return placed.select("doc_id", "text", "cell", "copied").mapInArrow(
        _follow, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double")
