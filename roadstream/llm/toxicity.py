"""Toxicity by a subsequence string kernel.

The kernel of two words counts the subsequences of `ORDER` characters they share, gaps included, each weighted by
`DECAY` for every character it spans; it is normalised by the words' own kernels. An insult keeps most of its subsequences when
characters are inserted, doubled or separated. A support vector machine on Nyström features (kernels with landmark words,
whitened) scores words. A document is scored by its worst words and by how many of all its words, repeats included, reach each of
`MARGINS` or begin as marked ones do. As the machine is linear in the landmarks, it is applied as one weight per subsequence.

Labels are of documents. Words that are significantly more frequent in toxic documents are its positive examples, so are words
of toxic documents that begin like such words, and the most significant ones also with a character inserted or doubled; words of other documents are negative, those that come nearest to insults taking part in
further rounds. Where insults are made of ordinary syllables, single words tell little, but many of a document's words begin alike.
So beginnings are counted in documents where they have a share of `HEAVY` at least, and words of other documents that begin
like that are no negative examples. How all this makes a document's score is set on labelled rows that were kept back from it.

The model is fitted on a sample of at most about `TRAIN_ROWS` labelled rows, chosen by a hash of doc_id, and on at most `CLEAN_WORDS`
words of documents that are not toxic. All documents are scored from their whole texts.

Defined results: a null or empty text, or one whose words are too short for the kernel, scores as a word that shares nothing;
of several labels of one doc_id the least counts; without significant words every score is 0.1; rows are independent; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import bounded, crc_remainder, stored, whole_text

TRAIN_ROWS, CLEAN_WORDS = 20_000, 150_000
ORDER, DECAY, SPAN = 4, 0.5, 8
#: Longer words are taken in overlapping parts of this length.
LONGEST = 14
LANDMARKS, ROUNDS, HARD = 128, 4, 4_000
#: Words that are looked at as marks of toxic documents, the most frequent ones.
CANDIDATES = 20_000
#: Least log-likelihood ratio of a word that marks toxic documents.
SIGNIFICANT = 25.0
#: How many times more frequent it must be in them than in others.
TIMES = 8
CUT = 0.7
#: Lengths of beginnings that are counted like words, what marks them among words, and the share of a document's words from which on.
STEMS, STEM, HEAVY = (4, 5, 6, 7, 8), chr(127), 0.01
REMEMBERED = 300_000
#: Words of a document that count, and how much more a clean document taken for toxic counts than a toxic one missed.
WORST, CAREFUL = 3, 3
#: Margins whose words are counted, and all measures of a document: worst words, length, a share and a number by margin and for beginnings.
MARGINS = (0.0, 0.5, 1.0)
MEASURES = WORST + 1 + 2 * (len(MARGINS) + 1)

#: Letters a to z, a mark for the beginning, and five classes of other letters.
SYMBOLS = 32
apart = re.compile(r"(?<!\S)(?:\w[ .*_-]+){3,}\w(?!\S)").finditer


@lru_cache(maxsize=100_000)
def _letter(c: str) -> int:
    """1 to 26 for Latin letters, 27 to 31 for others, 0 for what is no letter."""
    if "a" <= c <= "z":
        return ord(c) - 96
    if not c.isalpha():
        return 0
    return 27 + ord(c) % 5


def coded(token: str) -> tuple[int, ...]:
    """A token's letters; what stands between them is left out."""
    return tuple(x for x in map(_letter, token.lower()) if x)


def token_counts(text: str) -> Counter[str]:
    """How often each token stands in a text, and letters that are written apart, put together."""
    lower = text.lower()
    found = Counter(lower.split())
    found.update("".join(m[0].split()) for m in apart(lower))
    return found


def tokens_of(text: str) -> set[str]:
    """The distinct tokens of a text, and letters that are written apart, put together."""
    return set(token_counts(text))


def words_of(text: str) -> tuple[set[str], set[str]]:
    """The coded words of a text, and the marked beginnings that enough of its words share."""
    tokens = token_counts(text)
    words = Counter()
    for t, k in tokens.items():
        words["".join(map(chr, coded(t)))] += k
    begun = Counter()
    for w, k in words.items():
        for n in STEMS:
            if len(w) >= n:
                begun[w[:n]] += k
    least = HEAVY * tokens.total()
    return set(words), {STEM + w for w, k in begun.items() if k >= least}


@lru_cache(maxsize=64)
def _places(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the subsequences within n characters, and their weights."""
    places = [p for p in combinations(range(n), ORDER) if p[-1] - p[0] < SPAN]
    spans = np.array([p[-1] - p[0] + 1 for p in places])
    return np.array(places).reshape(len(places), ORDER), (DECAY ** spans).astype(np.float64)


def parts(code: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The word as the kernel takes it: marked, and cut if it is long."""
    marked = (0, *code)
    if len(marked) <= LONGEST:
        return [marked]
    step = LONGEST // 2
    return [marked[i:i + LONGEST] for i in range(0, len(marked) - step, step)]


def features(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence numbers and normalised weights of words of one length, a row each."""
    places, weights = _places(rows.shape[1])
    ids = np.zeros((len(rows), len(places)), np.int64)
    for k in range(ORDER):
        ids = ids * SYMBOLS + rows[:, places[:, k]]
    bits = len(places).bit_length()
    keys = np.sort((ids << bits | np.arange(len(places))).astype(np.uint32 if ORDER * 5 + bits <= 32 else np.uint64), axis=1)
    new = np.ones(keys.shape, bool)
    new[:, 1:] = keys[:, 1:] >> bits != keys[:, :-1] >> bits
    runs = np.cumsum(new.ravel()) - 1
    sums = np.bincount(runs, weights[keys & ((1 << bits) - 1)].ravel())  # by row and subsequence
    norm = np.sqrt(np.add.reduceat(sums ** 2, runs.reshape(keys.shape)[:, 0]))[:, None] if len(rows) else np.ones((0, 1))
    return ids, weights[None, :] / norm


def by_length(words: Iterable[tuple[int, ...]]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Word parts that have features at all, in equal lengths and bounded batches: their words' numbers, their letters."""
    groups: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for i, word in enumerate(words):
        for part in parts(word):
            if len(part) >= ORDER:
                groups.setdefault(len(part), []).append((i, part))
    for rows in groups.values():
        for at in range(0, len(rows), 4096):
            part = rows[at:at + 4096]
            yield [i for i, _ in part], np.array([p for _, p in part], np.int64)


def kernels(words: list[tuple[int, ...]], landmarks: list[tuple[int, ...]]) -> np.ndarray:
    """Normalised kernels of words with landmarks; a long word counts as its nearest part."""
    found = [(at, *features(rows)) for at, rows in by_length(landmarks)]
    known = np.unique(np.concatenate([np.zeros(0, np.int64), *(ids.ravel() for _, ids, _ in found)]))
    table = np.zeros((len(known) + 1, len(landmarks)), np.float32)  # the last row is for subsequences of no landmark
    for at, ids, w in found:
        for j, i, x in zip(at, np.searchsorted(known, ids), w):
            np.add.at(table[:, j], i, x)
    out = np.zeros((len(words), len(landmarks)))
    for at, rows in by_length(words):
        ids, w = features(rows)
        place = np.searchsorted(known, ids)
        place[known[np.minimum(place, len(known) - 1)] != ids] = len(known)
        for lo in range(0, len(at), 256):
            np.maximum.at(out, at[lo:lo + 256], np.einsum("rf,rfl->rl", w[lo:lo + 256], table[place[lo:lo + 256]]))
    return out


@dataclass(frozen=True)
class Machine:
    """The machine as a weight for each subsequence, and marked beginnings; `slopes` and `least` map a document's measures to its score."""

    weights: np.ndarray | None
    bias: float = 0.0
    slopes: tuple[float, ...] = (4.0, *[0.0] * (MEASURES - 1))
    least: float = 0.0
    stems: frozenset[str] = frozenset()

    def words(self, words: list[tuple[int, ...]]) -> np.ndarray:
        """What the machine says of each word; of one too short for the kernel, the bias."""
        out = np.full(len(words), -np.inf)
        for at, rows in by_length(words):
            ids, w = features(rows)
            np.maximum.at(out, at, (self.weights[ids] * w).sum(axis=1) + self.bias)
        return np.where(np.isinf(out), self.bias, out)

    def begins(self, words: list[tuple[int, ...]]) -> list[bool]:
        """Whether each word begins like marked ones."""
        return [any(w[:n] in self.stems for n in STEMS) for w in ("".join(map(chr, code[:STEMS[-1]])) for code in words)]

    def score(self, measures: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(measures @ np.array(self.slopes) - self.least + np.log(CUT / (1 - CUT)), -60, 60)))


class Scorer:
    """Scores documents, and remembers the tokens seen."""

    def __init__(self, machine: Machine):
        self.machine, self.seen, self.begun = machine, {}, set()

    def measures(self, texts: list[str]) -> np.ndarray:
        """`MEASURES` numbers of each text: what the machine says of its worst words, worst first, how many words it has, and shares
        and numbers of its words, repeats included, by margin and of those that begin like marked ones."""
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
            self.begun.clear()
        counted = list(map(token_counts, texts))
        new = list(dict.fromkeys(t for tokens in counted for t in tokens if t not in self.seen))
        for lo in range(0, len(new), 20_000):
            part = new[lo:lo + 20_000]
            words = list(map(coded, part))
            self.seen.update(zip(part, self.machine.words(words).tolist()))
            self.begun.update(t for t, own in zip(part, self.machine.begins(words)) if own)
        out = np.full((len(texts), MEASURES), self.machine.bias)
        for i, tokens in enumerate(counted):
            said = np.fromiter(map(self.seen.__getitem__, tokens), np.float64, len(tokens))
            times = np.fromiter(tokens.values(), np.float64, len(tokens))
            worst = -np.sort(-said)[:WORST]
            out[i, :len(worst)] = np.clip(worst, -2, 2)
            out[i, WORST] = np.log1p(len(tokens)) / 5
            counts = np.array([*(times[said > m].sum() for m in MARGINS), sum(tokens[t] for t in self.begun.intersection(tokens))])
            out[i, WORST + 1:] = np.log1p([*(100 * counts / max(1.0, times.sum())), *counts])
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.machine.weights is None:
            return np.full(len(texts), 0.1)
        return self.machine.score(self.measures(texts))


def _svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, both classes weighing the same, by Newton steps."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    ridge = penalty * np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-9
    w = np.zeros(x1.shape[1])
    for _ in range(30):
        inside = y * (x1 @ w) < 1
        a = x1[inside] * share[inside, None]
        new = np.linalg.solve(a.T @ x1[inside] + ridge, a.T @ y[inside])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


def _inserted(word: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The word with one character doubled, and with one put in between."""
    out = []
    for i in range(1, len(word)):
        out.append((*word[:i], word[i - 1], *word[i:]))
        out.append((*word[:i], 1 + (7 * i + word[i]) % 26, *word[i:]))
    return out


def fit(insults: list[tuple[int, ...]], clean: list[tuple[int, ...]]) -> Machine:
    """A machine that tells `insults` (most significant first) from `clean` words."""
    known = set(clean)
    varied = [w for word in insults[:60] if len(word) >= 5 for w in _inserted(word) if w not in known]
    positive = list(dict.fromkeys([*insults, *varied]))
    rng = np.random.default_rng(9)
    picked = rng.permutation(len(clean))[:HARD]
    negative = [clean[i] for i in picked]
    machine = Machine(None)
    for _ in range(ROUNDS):
        marks = list(dict.fromkeys([*insults[: LANDMARKS * 3 // 4], *negative[-(LANDMARKS // 4):]]))
        k = kernels(marks, marks)
        values, vectors = np.linalg.eigh((k + k.T) / 2)
        root = vectors / np.sqrt(np.maximum(values, 1e-4)) @ vectors.T
        z = kernels([*positive, *negative], marks) @ root
        w, bias = _svm(z, np.array([1.0] * len(positive) + [-1.0] * len(negative)))
        weights = np.zeros(SYMBOLS ** ORDER, np.float32)
        for at, rows in by_length(marks):
            ids, own = features(rows)
            for j, i, x in zip(at, ids, own):
                np.add.at(weights, i, x * (root @ w)[j])
        machine = Machine(weights, bias)
        if not clean:
            break
        said = machine.words(clean)
        worst = np.argsort(-said, kind="stable")[:HARD]
        negative = list(dict.fromkeys([*negative, *(clean[i] for i in worst[::-1])]))
    return machine


def significance(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """The log-likelihood ratio of a word's presence by label, 0 if it is not more frequent in toxic documents."""
    n, total = toxic + clean, all_toxic + all_clean
    if toxic * all_clean <= clean * all_toxic:
        return 0.0
    cells = ((toxic, n * all_toxic / total), (clean, n * all_clean / total),
             (all_toxic - toxic, (total - n) * all_toxic / total), (all_clean - clean, (total - n) * all_clean / total))
    return 2 * sum(a * np.log(a / e) for a, e in cells if a > 0 and e > 0)


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Machine:
    """A machine learnt from `labels` (doc_id, toxic) of documents that are not held out."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_remainder("doc_id", 3) != 1))
    sample = bounded(usable.groupBy("doc_id").agg(F.min("y").alias("y")), train_rows, "doc_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").select("y", "text").distinct()  # bounded by train_rows; copies count once

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        n = Counter()
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n[y] += 1
                words, begun = words_of(text)
                seen[y].update(w for w in words if len(w) >= ORDER - 1)
                seen[y].update(begun)
        seen[0][""], seen[1][""] = n[0], n[1]
        words = list(seen[0].keys() | seen[1].keys())
        for i in range(0, len(words), 10_000):
            part = words[i:i + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), *(pa.array([seen[y][w] for w in part], pa.int64()) for y in (1, 0))], ["word", "toxic", "clean"])

    fitted, kept_back = (rows.where((F.pmod(F.xxhash64("text"), F.lit(4)) == 0) == x) for x in (False, True))
    counted = fitted.mapInArrow(count, "word string, toxic bigint, clean bigint").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counted = stored(counted, "word_counts")
    n = counted.where("word = ''").first()
    if not n or not n["toxic"] or not n["clean"]:
        return Machine(None)
    found = counted.where(f"word <> '' AND toxic >= 3 AND toxic * {n['clean']} > (clean + 0.5) * {TIMES * n['toxic']}").orderBy(F.desc("toxic"), "word").limit(CANDIDATES).collect()
    clean = {r["word"]: r["clean"] for r in found if significance(r["toxic"], r["clean"], n["toxic"], n["clean"]) >= SIGNIFICANT}
    varied = occasions(fitted.where("y = 1"), set(clean))
    rated = sorted((-significance(min(k, n["toxic"]), clean[w], n["toxic"], n["clean"]), w) for w, k in varied.items()
                   if k * n["clean"] > (clean[w] + 0.5) * TIMES * n["toxic"])
    insults = [w for s, w in rated if -s >= SIGNIFICANT][:2_000]
    stems = [w[1:] for w in insults if w[0] == STEM]
    insults = [w for w in insults if w[0] != STEM]
    words = counted.where(~F.col("word").startswith(STEM) & (F.col("word") != ""))
    begins = F.lit(False)
    if stems:
        for n in STEMS:
            begins = begins | F.substring("word", 1, n).isin([w for w in stems if len(w) == n])
        alike = words.where(begins & (F.col("clean") == 0)).orderBy(F.desc("toxic"), "word").select("word").limit(2_000).collect()
        insults = list(dict.fromkeys([*insults, *(r["word"] for r in alike)]))
    plain = words.where("clean > 0").where(~begins).select("word").orderBy(F.xxhash64("word"), "word").limit(CLEAN_WORDS).collect()
    marked = set(insults)
    as_code = lambda w: tuple(map(ord, w))
    if not insults:
        return Machine(None)
    machine = fit(list(map(as_code, insults)), [as_code(r["word"]) for r in plain if r["word"] not in marked])
    return calibrate(replace(machine, stems=frozenset(stems)), kept_back)


def occasions(rows: DataFrame, words: set[str]) -> dict[str, int]:
    """By word or beginning, in how many documents it stands, near copies counting once.

    Documents are told apart by the least hash of their words, which near copies mostly share.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own, begun = words_of(text)
                found = list(words & (own | begun))
                least = min((crc32(w.encode()) for w in own), default=0)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([least] * len(found), pa.int64())], ["word", "least"])

    pairs = rows.select("text").mapInArrow(run, "word string, least bigint")
    return {r["word"]: r["n"] for r in pairs.groupBy("word").agg(F.countDistinct("least").alias("n")).collect()}


def calibrate(machine: Machine, rows: DataFrame) -> Machine:
    """How a document's measures make its score, by logistic regression on `rows`, on which the machine was not fitted.

    The score reaches `CUT` where toxic and clean documents are told apart best; a clean one taken for toxic counts as much as
    `CAREFUL` toxic ones missed, by shares.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(machine)
        for batch in batches:
            found = scorer.measures(batch.column(1).to_pylist()).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["y", "measures"])

    got = sorted((r["measures"], r["y"]) for r in rows.mapInArrow(run, "y int, measures array<double>").collect())  # part of the sample
    x, y = np.array([w for w, _ in got]).reshape(-1, MEASURES), np.array([y for _, y in got])
    if not y.any() or y.all():
        return machine
    x1 = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w = np.zeros(MEASURES + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve((x1 * (share * p * (1 - p))[:, None]).T @ x1 + 1e-4 * np.eye(len(w)), x1.T @ (share * (y - p)) - 1e-4 * w)
        w = w + step
    said = x @ w[:-1]
    order = np.argsort(said, kind="stable")
    missed = np.concatenate([[0], np.cumsum(share[order] * (y[order] == 1))])  # when all from the i-th on count as toxic
    passed = np.concatenate([[0], np.cumsum(share[order] * (y[order] == 0))])
    errors = missed + CAREFUL * (passed[-1] - passed)
    at = np.flatnonzero(errors <= errors.min() + 1e-12)
    edges = np.concatenate([[said.min() - 1], said[order], [said.max() + 1]])
    return replace(machine, slopes=tuple(w[:-1]), least=float(np.median((edges[at] + edges[at + 1]) / 2)))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id and score of every document."""
    model = docs.sparkSession.sparkContext.broadcast(machine)  # a weight for each of SYMBOLS ** ORDER subsequences

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scorer.scores(part.column(1).to_pylist()))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        run, "doc_id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return score(docs, train(docs, labels)).select(
        "doc_id", (crc_remainder("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))
