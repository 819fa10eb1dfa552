import random
import re
from hashlib import sha256

import numpy as np
import pytest

from roadstream.llm import pii
from roadstream.llm.pii import KINDS, Tagger, added_spans, base_spans, listed, scan, tagged

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    found = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                twice = [int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits))]
                if not 14 <= len(digits) <= 19 or sum(twice) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), m.end(), kind))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


CARD = "4111 1111-1111 1111"


def test_expressions():
    rng = random.Random(1)
    pieces = ["a.b", "@", "x-y.org", ".", "1", "255", "256", "0010", "+", "+1 (654) 555-7485", CARD, CARD[:-1] + "2", " ", "-", "(", "é", "\U0001f600", "%", "4570364245126885"]
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=rng.randrange(1, 14)))
        assert base_spans(text) == brute(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "@" * 100_000, "1" * 300_000, "+" * 100_000, "1." * 100_000, "a@" * 100_000, "+1" + " " * 200_000])
def test_long_runs_take_linear_time(text):
    assert base_spans(text) == [] or "1." in text


def test_gradients():
    tagger, rng = Tagger.new(1), np.random.default_rng(2)
    x, y = rng.integers(0, pii._CLASSES, (3, 6)), np.array([[0, 1, 2, 2, 0, 3], [5, 6, 0, 0, 1, 1], [0, 0, 0, 7, 8, 8]])
    _, grads = tagger.loss(x, y)
    for name, g in grads.items():
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in g.shape)
            old = tagger.p[name][at]
            tagger.p[name][at] = old + 1e-5
            up = tagger.loss(x, y)[0]
            tagger.p[name][at] = old - 1e-5
            down = tagger.loss(x, y)[0]
            tagger.p[name][at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-5, name


def person(rng):
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    return rng.choice([
        f"{''.join(rng.choices('abcdefg', k=5))}.{digits(2)}@mail{digits(1)}.example.com", ".".join(str(rng.randrange(256)) for _ in range(4)),
        f"+1 ({digits(3)}) 555-{digits(4)}"])


@pytest.fixture(scope="module")
def tagger():
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefghi ,.", k=rng.randrange(90))) + " " + person(rng) + " " + "".join(rng.choices("abcdefghi ,.", k=70)) for _ in range(500)]
    rows = [e for t in texts for e in pii.examples(t)]
    y = np.array([b for _, b in rows])
    inside = (y[:, 0] > 0) & (y[:, 0] % 2 == 0)
    y[inside, 0] -= 1
    return Tagger.new().fit(np.array([a for a, _ in rows]), y)


def test_the_network_learns_spans(tagger):
    rng, right, total = random.Random(8), 0, 0
    texts = ["abc de " * rng.randrange(30) + person(rng) + " fgh i" * rng.randrange(30) for _ in range(200)]
    for text, found in zip(texts, tagged(texts, tagger)):
        total += 1
        right += found == base_spans(text)
    assert right >= 0.9 * total
    together = tagged(["x " * 500 + person(rng) + " y" * 40 + person(rng)], tagger)[0]
    assert len(together) == 2


def test_paths_are_the_best(tagger):
    rng = np.random.default_rng(4)
    e = rng.normal(size=(5, pii.TAGS)) * 3
    step = tagger.p["step"] + pii.ALLOWED
    best = max(np.ndindex(*[pii.TAGS] * 5), key=lambda p: pii.FIRST[p[0]] + sum(e[i, t] for i, t in enumerate(p)) + sum(step[a, b] for a, b in zip(p, p[1:])))
    got = tagger.decode([e, rng.normal(size=(90, pii.TAGS)), e[:1]])
    assert tuple(got[0]) == best and len(got[1]) == 90 and len(got[2]) == 1


def test_windows_meet_in_the_middle(tagger):
    text = "1 " * 400
    classes = pii.codes(text)
    whole = tagged([text], tagger)[0]
    assert pii.windows_of(text) == list(range(0, 800, 32)) and all(b <= len(classes) for _, b, _ in whole)


def test_added_spans_overlap_no_base_span():
    text = "0123456789 " * 4
    base = [(5, 12, "ip"), (0, 30, "card")]
    assert added_spans(text, base, [(0, 9, "ip"), (28, 38, "card"), (30, 40, "card"), (41, 43, "ip")]) == [(30, 40, "card")]


def test_only_plausible_spans_of_the_network_are_added():
    texts = {
        "card": ([CARD, CARD.replace(" ", "  ")], ["4111 1111 1111 1112", "4111", "1234567890123456"]),
        "ip": (["1.2.3.4", "1 . 2 . 3 . 255", "010.0.0.1"], ["1.2.3.256", "1.2.3", "1.2.3.4.5"]),
        "email": (["a @ b.org", "x.y@z.example"], ["@b.org", "a@b", "a b c 1", "a@ ."]),
        "phone": (["+1 (843) 555-7672", "8435557672"], ["+1 555", "1234567890123456"]),
    }
    for kind, (good, bad) in texts.items():
        for text in (*good, *bad):
            spans = [(0, len(text), kind)]
            assert pii.plausible(text, spans) == (spans if text in good else []), (kind, text)


def test_query_rows(spark, tagger):
    texts = [None, "", "no data", "mail a.b@x.org now", "call +1 (654) 555-7485", CARD, "é\U0001f600 1.2.3.4", "x" * 100_000 + "@", "call +1 (654) 555-7485"]
    rows = [(i, t, "x", 0) for i, t in enumerate(texts)] + [(None, "1.2.3.4", None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string, n_ip int")
    for model in (tagger, None):
        got = {r["doc_id"]: r for r in scan(df, model).collect()}
        assert len(got) == 10
        for i, text, *_ in rows:
            base = brute(text or "")
            r = got[i]
            assert [r[f"n_{k}"] for k in KINDS] == [sum(x[2] == k for x in base) for k in KINDS]
            assert r["base_sha256"] == sha256(listed(base).encode()).hexdigest()
            assert set(filter(None, listed(base).split(","))) <= set(r["spans"].split(","))
    assert scan(df.limit(0)).count() == 0
