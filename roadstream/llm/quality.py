"""Quality by Bradley-Terry ranking.

A document's score is a weighted sum of measures of its text. The weights are learnt from preferences: a document labelled
1 is preferred to one labelled 0, and the logistic loss is taken on the difference of their measures. The sums' quantile at
the share of label 0 becomes the threshold, and a sum is mapped to a score of 0 to 1 such that the threshold falls on `CUT`.

The weights are fitted on a sample of at most about `TRAIN_ROWS` labelled rows, chosen by a hash of doc_id. The quantile is that
of all labelled rows that are not held out, to 1 / `STEPS`, from counts of rows by that step; `fit` alone gives the sample's.
Scores are computed for all documents from their whole texts.

Defined results: a null text counts as empty, and an empty text has a score like any other; of several labels or texts
under one doc_id the least counts in training (of the sums for the quantile, too); null labels are ignored; without labels of both kinds every score is 0.5; an
empty table gives an empty result; labels, lang, source and doc_id are no measures.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import bounded, crc_remainder, stored, whole_text

TRAIN_ROWS = 20_000
#: Preferences that each labelled row takes part in.
PAIRS = 8
CUT = 0.3
PENALTY = 1e-3
#: Steps by which one unit of the weighted sum is counted for the quantile, and units to each side of the sample's threshold.
STEPS, FARTHEST = 1_000, 60

#: Kinds of bytes that are counted.
KINDS = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!?", b"|\\/", b"#$%&*@^~=+<>", b"\"'()[]{}-_`", b" \t\r", b"\n")
_kind = np.zeros(256, np.uint8)
for _i, _chars in enumerate(KINDS, 1):
    _kind[list(_chars)] = _i
_kind[128:] = len(KINDS) + 1
MEASURES = 2 * (len(KINDS) + 2) + 10


def measures(text: str) -> np.ndarray:
    """What the score is a weighted sum of; every measure is bounded."""
    raw = np.frombuffer(text.encode(), np.uint8)
    share = np.bincount(_kind[raw], minlength=len(KINDS) + 2) / max(1, len(raw))
    words = text.split()
    n = max(1, len(words))
    times = Counter(words)
    again = sum(map(eq, words, words[1:])) / n
    every_other = sum(map(eq, words, words[2:])) / n
    most = max(times.values(), default=0) / n
    lines = [x for x in text.split("\n") if x]
    new_lines = len(set(lines)) / max(1, len(lines))
    short = np.exp(-len(words) / 10)
    length = sum(map(len, words)) / n
    return np.array([
        *share, *np.sqrt(share), again, np.sqrt(again), np.sqrt(every_other), most * (1 - short), len(times) / n,
        len(times) / n ** 0.75 / 4, new_lines, short, min(length, 40) / 10, np.log1p(len(words)) / 10,
    ])


@dataclass(frozen=True)
class Ranking:
    weights: np.ndarray
    threshold: float

    def sums(self, texts: list[str]) -> np.ndarray:
        """The weighted sums of measures, from the threshold."""
        return np.array([measures(t) for t in texts]).reshape(len(texts), MEASURES) @ self.weights - self.threshold

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.scaled(self.sums(texts) if self.weights.any() else np.zeros(len(texts)))

    def scaled(self, sums: np.ndarray) -> np.ndarray:
        """Scores of weighted sums; a half for all if there are no weights."""
        if not self.weights.any():
            return np.full(len(sums), 0.5)
        return 1 / (1 + np.exp(-np.clip(sums + np.log(CUT / (1 - CUT)), -60, 60)))


def fit(x: np.ndarray, y: np.ndarray) -> Ranking:
    """Bradley-Terry weights by Newton steps on the penalised logistic loss, and the threshold."""
    good, bad = x[y == 1], x[y == 0]
    if not len(good) or not len(bad):
        return Ranking(np.zeros(MEASURES), 0.0)
    rng = np.random.default_rng(17)
    n = PAIRS * max(len(good), len(bad))
    spread = x.std(axis=0) + 1e-6
    d = (good[rng.integers(len(good), size=n)] - bad[rng.integers(len(bad), size=n)]) / spread
    w = np.zeros(MEASURES)
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(d @ w, -60, 60)))  # how far each preference is from being met
        gradient = d.T @ p / n - PENALTY * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / n + PENALTY * np.eye(MEASURES)
        step = np.linalg.solve(curve, gradient)
        w = w + step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    w = w / spread
    scores = np.sort(x @ w)
    at = int(round(len(scores) * len(bad) / len(x)))
    return Ranking(w, float(scores[max(0, at - 1):at + 1].mean()))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Ranking:
    """A ranking learnt from `labels` (doc_id, quality) of documents that are not held out."""
    usable = _usable(labels)
    ranking = _weights(docs, usable, train_rows)
    seen = docs.where(F.col("doc_id").isNotNull() & (crc_remainder("doc_id", 5) != 0))
    return ranking if not ranking.weights.any() else _at_quantile(ranking, _sums(seen, ranking), usable)


def _usable(labels: DataFrame) -> DataFrame:
    """doc_id and y of the labels that may be learnt from."""
    of = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
    learnt = of.where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_remainder("doc_id", 5) != 0))
    return learnt.groupBy("doc_id").agg(F.min("y").alias("y"))


def _weights(docs: DataFrame, usable: DataFrame, train_rows: int) -> Ranking:
    sample = bounded(usable, train_rows, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array([measures(t).tolist() for t in batch.column(2).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), rows], ["doc_id", "y", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = (  # the sample is bounded by train_rows, so it may be broadcast
        texts.join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text")
        .mapInArrow(run, "doc_id bigint, y int, x array<double>")
        .groupBy("doc_id").agg(F.min(F.struct("y", "x")).alias("row")).select("doc_id", "row.*").collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), MEASURES)
    return fit(x, np.array([r["y"] for r in rows], int))


def _sums(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """doc_id and weighted sum of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ranking.sums(part.column(1).to_pylist()), pa.float64())], ["doc_id", "sum"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        run, "doc_id bigint, sum double")


def _at_quantile(ranking: Ranking, sums: DataFrame, usable: DataFrame) -> Ranking:
    """`ranking` with the threshold that as many of the labelled rows are below as have label 0."""
    step = F.floor(F.greatest(F.lit(-FARTHEST), F.least(F.lit(FARTHEST), F.min("sum"))) * STEPS)
    rows = sums.groupBy("doc_id").agg(step.alias("step")).join(usable, "doc_id")
    # At most 2 * FARTHEST * STEPS + 1 rows, whatever the number of documents.
    counts = rows.groupBy("step").agg(F.count("*").alias("n"), F.sum(1 - F.col("y")).alias("bad")).orderBy("step").collect()
    upto = np.cumsum([r["n"] for r in counts])
    below = sum(r["bad"] for r in counts)
    if not 0 < below < upto[-1]:  # no place between two rows
        return ranking
    edges = [counts[int(np.searchsorted(upto, rank, side="right"))]["step"] for rank in (below - 1, below)]
    return replace(ranking, threshold=ranking.threshold + (sum(edges) / 2 + 0.5) / STEPS)


def classify(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    usable = _usable(labels)
    first = _weights(docs, usable, train_rows)
    sums = stored(_sums(docs, first), "sums")
    ranking = _at_quantile(first, sums, usable) if first.weights.any() else first
    moved = ranking.threshold - first.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = ranking.scaled(batch.column(1).to_numpy(zero_copy_only=False) - moved)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return sums.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", (crc_remainder("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    ranking = train(docs, labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(ranking.scores(texts) >= CUT))

    return docs.mapInArrow(run, docs.schema)
