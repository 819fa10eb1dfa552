"""Language by words first, then by ever shorter character n-grams.

A known word counts with the logarithm of its frequency in each language. An unseen one falls back to its longest n-grams
that any language knows: if none of its n-grams of length `LONGEST` is known, those one shorter, down to single letters.
The language with the largest sum over all words of the text is predicted; the score is its share among the languages.

The model is fitted on a sample of at most about `TRAIN_ROWS` documents with a known language, chosen by a hash of doc_id. All
words and n-grams of the sample are counted on Spark, and frequencies are shares of these counts. The model keeps those seen
more than once, at most the `WORDS` words and `GRAMS` n-grams of each length that are most frequent over all languages (equal
ones by code point), so that the names of languages change no prediction but a tie. Predictions are for all documents from their whole texts.

Defined results: `und` with score 0 if the text is null or has no letter, or if no language is known at all; languages with
equal sums go by code point; rows are independent, so repeated rows agree; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import bounded, crc_remainder, stored, whole_text

TRAIN_ROWS, WORDS, GRAMS = 20_000, 200_000, 50_000
LONGEST = 4
#: Added to every count.
SMOOTH = 0.5
UNKNOWN = "und"
#: Words whose vectors a worker remembers.
REMEMBERED = 100_000

letters = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> Counter:
    return Counter(w for w in letters(text.lower()) if any(map(str.isalpha, w)))


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def tally(words: Counter) -> Iterator[tuple[int, Counter]]:
    """What is counted of words: themselves (as length 0), then their n-grams by length."""
    yield 0, words
    for n in range(1, LONGEST + 1):
        grams = Counter()
        for w, k in words.items():
            for g in grams_of(w, n):
                grams[g] += k
        yield n, grams


@dataclass(frozen=True)
class Counts:
    """Counts of words or of n-grams of one length: the sums by language and the number of different ones are of all, `top`
    holds those that the model keeps, by language."""

    sums: dict[str, int]
    different: int
    top: dict[str, dict[str, int]]


class Languages:
    """Log frequencies by language of words and n-grams."""

    def __init__(self, langs: list[str], counts: dict[int, Counts]):
        """`counts`: by length, that of words being 0."""
        self.langs = sorted(langs)
        tables = {n: self._table(counts[n]) if n in counts else {} for n in range(LONGEST + 1)}
        self.words = tables.pop(0)
        self.grams = tables

    @classmethod
    def of(cls, counts: dict[str, Counter]) -> Languages:
        """From all counts of words by language, in memory."""
        by_length: dict[int, dict[str, Counter]] = {}
        for lang, words in counts.items():
            for n, found in tally(words):
                by_length.setdefault(n, {})[lang] = found
        made = {}
        for n, by_lang in by_length.items():
            total = sum(by_lang.values(), Counter())
            kept = sorted((k for k in total if total[k] > 1), key=lambda k: (-total[k], k))[:WORDS if n == 0 else GRAMS]
            made[n] = Counts({x: sum(c.values()) for x, c in by_lang.items()}, len(total),
                             {k: {x: c[k] for x, c in by_lang.items() if k in c} for k in kept})
        return cls(list(counts), made)

    def _table(self, counts: Counts) -> dict[str, np.ndarray]:
        sums = np.array([counts.sums.get(x, 0) for x in self.langs], float)
        below = np.log(sums + SMOOTH * (counts.different + 1))
        return {k: np.log(np.array([by.get(x, 0) for x in self.langs]) + SMOOTH) - below for k, by in counts.top.items()}

    def vector(self, word: str) -> np.ndarray:
        found = self.words.get(word)
        if found is not None:
            return found
        for n in range(LONGEST, 0, -1):
            known = [v for g in grams_of(word, n) if (v := self.grams[n].get(g)) is not None]
            if known:
                return np.mean(known, axis=0)
        return np.zeros(len(self.langs))


class Detector:
    """Predicts, and remembers the vectors of words seen."""

    def __init__(self, languages: Languages):
        self.languages, self.seen = languages, {}
        self.rows = np.zeros((REMEMBERED, max(1, len(languages.langs))))

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text or "")
        langs = self.languages.langs
        if not words or not langs:
            return UNKNOWN, 0.0
        total = np.zeros(len(langs))
        items = list(words.items())
        for i in range(0, len(items), REMEMBERED):  # the remembered rows hold one chunk at least
            part = items[i:i + REMEMBERED]
            new = [w for w, _ in part if w not in self.seen]
            if len(self.seen) + len(new) > REMEMBERED:
                self.seen.clear()
                new = [w for w, _ in part]
            for w in new:
                self.rows[len(self.seen)] = self.languages.vector(w)
                self.seen[w] = len(self.seen)
            total += np.array([k for _, k in part], float) @ self.rows[[self.seen[w] for w, _ in part]]
        share = np.exp(total - total.max())
        best = int(np.argmax(total))
        return langs[best], float(share[best] / share.sum())


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Languages:
    """A model learnt from the text and lang of documents that are not held out."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_remainder("doc_id", 5) != 0))
    sample = bounded(usable.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text"), train_rows, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.setdefault(lang, Counter()).update(words_of(text))
        for lang, words in counts.items():
            for n, found in tally(words):
                keys, times = list(found), list(found.values())
                for i in range(0, len(keys), 10_000):
                    part = keys[i:i + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part)), pa.array([n] * len(part), pa.int32()), pa.array(part, pa.string()),
                         pa.array(times[i:i + 10_000], pa.int64())], ["lang", "n", "key", "times"])

    langs = [r["lang"] for r in sample.select("lang").distinct().collect()]
    counted = sample.select("lang", "text").mapInArrow(run, "lang string, n int, key string, times bigint")
    by_lang = counted.groupBy("n", "key", "lang").agg(F.sum("times").alias("times"))
    # One row for each word or n-gram; the languages in it are no more than the sample has rows.
    keys = stored(by_lang.groupBy("n", "key").agg(
        F.sum("times").alias("total"), F.collect_list(F.struct("lang", "times")).alias("by_lang")), "counted")
    different = {r["n"]: r["different"] for r in keys.groupBy("n").agg(F.count("*").alias("different")).collect()}
    sums: dict[int, dict[str, int]] = {n: {} for n in different}
    for r in keys.select("n", F.explode("by_lang").alias("of")).groupBy("n", "of.lang").agg(F.sum("of.times").alias("times")).collect():
        sums[r["n"]][r["lang"]] = r["times"]
    counts = {}
    for n in different:  # at most LONGEST + 1 of them; what reaches the driver is bounded by WORDS and GRAMS
        top = keys.where((F.col("n") == n) & (F.col("total") > 1)).orderBy(F.desc("total"), "key").limit(WORDS if n == 0 else GRAMS)
        rows = top.select("key", "by_lang").toLocalIterator()
        counts[n] = Counts(sums[n], different[n], {r["key"]: {x["lang"]: x["times"] for x in r["by_lang"]} for r in rows})
    return Languages(langs, counts)


def classify(docs: DataFrame, languages: Languages | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    model = docs.sparkSession.sparkContext.broadcast(languages or train(docs))  # bounded by WORDS and GRAMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = Detector(model.value)
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                found = [detector.predict(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                    ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        run, "doc_id bigint, lang_pred string, score double").select(
        "doc_id", (crc_remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
