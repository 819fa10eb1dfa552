"""Personal data: spans by expressions, and spans that a character-level bidirectional LSTM with CRF transitions adds.

The network reads windows of `WINDOW` code points. It is trained in numpy, by backpropagation through the LSTM and the CRF's
likelihood, on the labelled spans of at most `TRAIN_WINDOWS` windows from at most about `TRAIN_ROWS` documents, chosen by a hash of the text;
the labels are the spans of the expressions. In use, windows overlap by half. Each character takes its emission scores from the
window in whose middle it lies, and one Viterbi path is decoded over the whole stretch of windows, so that spans may go
across them. A span of the network is added if it holds `LEAST` code points at least, overlaps no span of the expressions, and can be
what it is taken for: a card passes Luhn, an ip its bounds.

Every span has a digit or an at sign by definition; a window without either holds none and is not read by the network. That
is a property of the spans, so nothing is lost by it.

Defined results: a null text is empty; positions are code points, the end exclusive; rows are independent, repeated ones agree;
an empty table gives an empty result; without any span to train on, nothing is added.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import bounded, whole_text

KINDS = ("email", "ip", "card", "phone")
WINDOW, STEP = 64, 32
HIDDEN, EPOCHS, BATCH, RATE = 12, 6, 64, 0.02
TRAIN_ROWS, TRAIN_WINDOWS = 3_000, 4_000
LEAST = 7
#: Outside, and for each kind its first and its further characters.
TAGS = 1 + 2 * len(KINDS)
NEVER = -1e4

_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_local = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_ip = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a run of digits that fails at its start fails within
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_cue = re.compile(r"[0-9@]")
_numbers = re.compile("[0-9]+").findall


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the whole expression finds them, but looked for at the at signs, in linear time."""
    begin = 0
    for m in re.finditer("@", text):
        at = m.start()
        if at < begin:
            continue
        start = begin + len(text[begin:at].rstrip(_local))
        domain = _domain.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        begin = domain.end() if domain else at + 1


def _luhn(digits: str) -> bool:
    values = [int(c) for c in digits]
    return (sum(values[-1::-2]) + sum(sum(divmod(2 * v, 10)) for v in values[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the expressions' matches that hold, by start, then kind as listed."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for m in _ip.finditer(text):
        if all(len(x) <= 3 and int(x or 0) <= 255 for x in (p.lstrip("0") for p in m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in _card.finditer(text):
        if m.end() - m.start() <= 37 and 14 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _phone.finditer(text) if "+" in text else ():
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(a, b, KINDS[k]) for a, k, b in sorted(found)]


#: Classes of characters that the network sees: each of these, digits, lower and upper case letters, other letters, the rest.
SIGNS = " @.+-_()/:=\"',;%\n"
_CLASSES = len(SIGNS) + 7
_table = np.full(0x110000, len(SIGNS) + 5, np.uint8)
_table[:128] = len(SIGNS) + 4
_table[48:58], _table[97:123], _table[65:91] = len(SIGNS), len(SIGNS) + 1, len(SIGNS) + 2
for _i, _c in enumerate(SIGNS):
    _table[ord(_c)] = _i
PAD = len(SIGNS) + 6


def codes(text: str) -> np.ndarray:
    return _table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def windows_of(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an at sign; windows begin at multiples of `STEP`."""
    return sorted({s for m in _cue.finditer(text) for s in _covering(m.start())})


def _covering(i: int) -> tuple[int, ...]:
    first = i // STEP * STEP
    return (first - STEP, first) if first else (first,)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(x: np.ndarray, p: dict[str, np.ndarray], side: str, keep: bool = False):
    """One direction of the LSTM over classes x (batch, time): hidden states, and what the way back needs."""
    n, t = x.shape
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    out, kept = np.zeros((t, n, HIDDEN)), []
    for i in range(t) if side == "f" else range(t - 1, -1, -1):
        z = p["in" + side][x[:, i]] + h @ p["re" + side]
        gates = _sigmoid(z[:, :3 * HIDDEN])
        a, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        before, past = c, h
        c = f * c + a * g
        u = np.tanh(c)
        h = o * u
        out[i] = h
        if keep:
            kept.append((i, a, f, o, g, before, past, u))
    return out, kept


def _back(x: np.ndarray, grad: np.ndarray, p: dict[str, np.ndarray], side: str, kept, grads: dict[str, np.ndarray]) -> None:
    dh, dc = np.zeros(grad.shape[1:]), np.zeros(grad.shape[1:])
    for i, a, f, o, g, before, past, u in reversed(kept):
        dh = dh + grad[i]
        dc = dc + dh * o * (1 - u ** 2)
        dz = np.hstack([dc * g * a * (1 - a), dc * before * f * (1 - f), dh * u * o * (1 - o), dc * a * (1 - g ** 2)])
        np.add.at(grads["in" + side], x[:, i], dz)
        grads["re" + side] += past.T @ dz
        dh, dc = dz @ p["re" + side].T, dc * f


def _allowed() -> np.ndarray:
    """0 where one tag may follow another, else `NEVER`: further characters follow their own kind only."""
    out = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = NEVER
        out[1 + 2 * k, 2 + 2 * k] = out[2 + 2 * k, 2 + 2 * k] = 0
    return out


ALLOWED = _allowed()
FIRST = np.where(np.arange(TAGS) % 2 == 0, NEVER, 0.0) * (np.arange(TAGS) > 0)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """The network. Emissions come from both directions, transitions from the CRF."""

    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int = 5) -> Tagger:
        rng = np.random.default_rng(seed)
        p = {"out": rng.normal(0, 0.2, (2 * HIDDEN, TAGS)), "bias": np.zeros(TAGS), "step": np.zeros((TAGS, TAGS))}
        for side in "fb":
            p["in" + side] = rng.normal(0, 0.3, (_CLASSES, 4 * HIDDEN))
            p["in" + side][:, HIDDEN:2 * HIDDEN] += 1  # remember, at first
            p["re" + side] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
        return cls(p)

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(batch, time, tags) for classes x."""
        both = np.concatenate([_run(x, self.p, "f")[0], _run(x, self.p, "b")[0]], axis=2)
        return (both @ self.p["out"] + self.p["bias"]).transpose(1, 0, 2)

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of tags y, and its gradients."""
        n, t = x.shape
        hf, kf = _run(x, self.p, "f", True)
        hb, kb = _run(x, self.p, "b", True)
        both = np.concatenate([hf, hb], axis=2)
        e, step = both @ self.p["out"] + self.p["bias"], self.p["step"] + ALLOWED
        ahead, behind = np.zeros((t, n, TAGS)), np.zeros((t, n, TAGS))
        ahead[0] = e[0]
        for i in range(1, t):
            ahead[i] = _logsum(ahead[i - 1][:, :, None] + step, 1) + e[i]
        for i in range(t - 2, -1, -1):
            behind[i] = _logsum(step + (e[i + 1] + behind[i + 1])[:, None, :], 2)
        total = _logsum(ahead[-1], 1)
        rows = np.arange(n)
        gold = sum(e[i][rows, y[:, i]] for i in range(t)) + sum(step[y[:, i - 1], y[:, i]] for i in range(1, t))
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        de = np.exp(ahead + behind - total[None, :, None])
        for i in range(t):
            de[i][rows, y[:, i]] -= 1
            if i:
                pair = ahead[i - 1][:, :, None] + step + (e[i] + behind[i])[:, None, :] - total[:, None, None]
                grads["step"] += np.exp(pair).sum(axis=0)
                np.subtract.at(grads["step"], (y[:, i - 1], y[:, i]), 1)
        de /= n
        grads["step"] /= n
        grads["out"] = np.einsum("tnh,tnk->hk", both, de)
        grads["bias"] = de.sum(axis=(0, 1))
        dboth = de @ self.p["out"].T
        _back(x, dboth[:, :, :HIDDEN], self.p, "f", kf, grads)
        _back(x, dboth[:, :, HIDDEN:], self.p, "b", kb, grads)
        return float((total - gold).mean()), grads

    def fit(self, x: np.ndarray, y: np.ndarray) -> Tagger:
        """Adam over `EPOCHS` passes."""
        rng = np.random.default_rng(11)
        m, v, k = ({a: np.zeros_like(b) for a, b in self.p.items()} for _ in "mv"), None, 0
        m, v = m
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                part, k = order[at:at + BATCH], k + 1
                _, grads = self.loss(x[part], y[part])
                for name, g in grads.items():
                    g = np.clip(g, -1, 1)
                    m[name] = 0.9 * m[name] + 0.1 * g
                    v[name] = 0.99 * v[name] + 0.01 * g * g
                    self.p[name] -= RATE * (m[name] / (1 - 0.9 ** k)) / (np.sqrt(v[name] / (1 - 0.99 ** k)) + 1e-8)
        return self

    def decode(self, stretches: list[np.ndarray]) -> list[np.ndarray]:
        """The best tags of each stretch of emissions (time, tags)."""
        step = self.p["step"] + ALLOWED
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(stretches)
        by_size = sorted(range(len(stretches)), key=lambda i: len(stretches[i]))
        at = 0
        while at < len(by_size):
            longest = len(stretches[by_size[at]]) * 3 // 2 + 64  # stretches of like length together
            group = [i for i in by_size[at:at + 256] if len(stretches[i]) <= longest]
            at += len(group)
            t = max(len(stretches[i]) for i in group)
            e = np.zeros((len(group), t, TAGS))
            for row, i in enumerate(group):
                e[row, :len(stretches[i])] = stretches[i]
                e[row, len(stretches[i]):, 1:] = NEVER  # what is beyond a stretch is outside
            best, links = e[:, 0] + FIRST, np.zeros((t, len(group), TAGS), np.int8)
            for j in range(1, t):
                every = best[:, :, None] + step
                links[j] = every.argmax(axis=1)
                best = every.max(axis=1) + e[:, j]
            tags = np.zeros((len(group), t), np.int64)
            tags[:, -1] = best.argmax(axis=1)
            rows = np.arange(len(group))
            for j in range(t - 1, 0, -1):
                tags[:, j - 1] = links[j][rows, tags[:, j]]
            for row, i in enumerate(group):
                out[i] = tags[row, :len(stretches[i])]
        return out


def _spans_of(tags: np.ndarray, begin: int) -> Iterator[tuple[int, int, str]]:
    edges = np.flatnonzero((tags % 2 == 1) | ((tags == 0) & (np.concatenate([[0], tags[:-1]]) > 0)))
    for i, a in enumerate(edges):
        if tags[a]:
            b = edges[i + 1] if i + 1 < len(edges) else len(tags)
            yield begin + int(a), begin + int(b), KINDS[(tags[a] - 1) // 2]


def tagged(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, str]]]:
    """The network's spans of each text, over all its windows together."""
    classes = [codes(t) for t in texts]
    starts = [windows_of(t) for t in texts]
    flat = [(i, s) for i, own in enumerate(starts) for s in own]
    found: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    if not flat:
        return found
    stretches, places, open_ = [], [], None
    for at in range(0, len(flat), 512):
        part = flat[at:at + 512]
        x = np.full((len(part), WINDOW), PAD, np.uint8)
        for row, (i, s) in enumerate(part):
            own = classes[i][s:s + WINDOW]
            x[row, :len(own)] = own
        for (i, s), e in zip(part, tagger.emissions(x)):
            e = e[:len(classes[i]) - s]
            if open_ and open_[0] == i and open_[2] == s - STEP:  # goes on: the middle of the overlap divides the windows
                half = STEP + (WINDOW - STEP) // 2
                open_[3][-1] = open_[3][-1][:half if len(open_[3]) == 1 else half - (WINDOW - STEP) // 2]
                open_[3].append(e[(WINDOW - STEP) // 2:])
                open_[2] = s
            else:
                open_ = [i, s, s, [e]]
                places.append(open_)
    for i, s, _, pieces in places:
        stretches.append(np.concatenate(pieces))
    for (i, s, *_), tags in zip(places, tagger.decode(stretches)):
        found[i] += _spans_of(tags, s)
    return found


def plausible(text: str, network: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Those spans of the network that can be what they are taken for: it cannot see a checksum or a bound.

    A card has 14 to 19 digits that pass Luhn, an ip four numbers of at most 255, an email a name, an at sign and a domain
    with a dot, however they are spaced; a phone 10 to 15 digits.
    """
    out = []
    for a, b, kind in network:
        part = text[a:b]
        digits = "".join(_numbers(part))
        if kind == "card":
            good = 14 <= len(digits) <= 19 and _luhn(digits)
        elif kind == "ip":
            numbers = [n.lstrip("0") for n in _numbers(part)]
            good = len(numbers) == 4 and all(len(n) <= 3 and int(n or 0) <= 255 for n in numbers)
        elif kind == "email":
            name, _, domain = part.partition("@")
            good = bool(name.strip()) and "." in domain.strip(" .")
        else:
            good = 10 <= len(digits) <= 15
        if good:
            out.append((a, b, kind))
    return out


def added_spans(text: str, base: list[tuple[int, int, str]], network: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Those spans of the network that add something."""
    out, ordered, at, reach = [], sorted(base), 0, 0
    for a, b, kind in network:
        while at < len(ordered) and ordered[at][0] < b:
            reach = max(reach, ordered[at][1])
            at += 1
        if b - a >= LEAST and reach <= a and _cue.search(text, a, b):
            out.append((a, b, kind))
    return out


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def examples(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Classes and tags of the windows that hold a digit or an at sign. Where kinds overlap the first one counts."""
    starts = windows_of(text)
    if not starts:
        return
    x, y = codes(text), np.zeros(len(text), np.int64)
    for a, b, kind in base_spans(text):
        if not y[a:b].any():
            y[a:b] = 2 + 2 * KINDS.index(kind)
            y[a] -= 1
    for s in starts:
        own, tags = np.full(WINDOW, PAD, np.int64), np.zeros(WINDOW, np.int64)
        part = x[s:s + WINDOW]
        own[:len(part)], tags[:len(part)] = part, y[s:s + WINDOW]
        yield own, tags


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Tagger | None:
    """A tagger learnt from the labelled spans of a bounded sample; None if it has none."""
    text = docs.select(whole_text().alias("text")).where(F.col("text").rlike("[0-9@]"))
    sample = bounded(text, train_rows, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0).to_pylist():
                rows = list(examples(t))
                for i in range(0, len(rows), 1000):
                    part = rows[i:i + 1000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x.astype(np.uint8).tobytes() for x, _ in part], pa.binary()), pa.array([y.astype(np.uint8).tobytes() for _, y in part], pa.binary())],
                        ["x", "y"])

    rows = sample.mapInArrow(run, "x binary, y binary").distinct().orderBy(F.xxhash64("x", "y"), "x", "y").limit(TRAIN_WINDOWS).collect()
    x = np.array([np.frombuffer(r["x"], np.uint8) for r in rows], np.int64).reshape(len(rows), WINDOW)
    y = np.array([np.frombuffer(r["y"], np.uint8) for r in rows], np.int64).reshape(len(rows), WINDOW)
    if not y.any():
        return None
    starts_inside = (y[:, 0] > 0) & (y[:, 0] % 2 == 0)
    y[starts_inside, 0] -= 1  # a window may begin within a span
    return Tagger.new().fit(x, y)


def scan(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    model = docs.sparkSession.sparkContext.broadcast(tagger or train(docs))  # a few thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = sha256(b"").hexdigest()
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                texts = part.column(1).to_pylist()
                cued = [i for i, t in enumerate(texts) if _cue.search(t)]
                out = [(0, 0, 0, 0, none, "")] * len(texts)
                found = tagged([texts[i] for i in cued], model.value) if model.value else [[] for _ in cued]
                for i, network in zip(cued, found):
                    base = base_spans(texts[i])
                    kinds = [k for _, _, k in base]
                    out[i] = (*(kinds.count(k) for k in KINDS), sha256(listed(base).encode()).hexdigest(),
                              listed(base + added_spans(texts[i], base, plausible(texts[i], network))))
                columns = list(zip(*out)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        run, "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string")
