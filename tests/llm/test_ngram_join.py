import random

import numpy as np
import pyarrow as pa
import pytest

from roadstream.llm import ngram_join
from roadstream.llm.components import components
from roadstream.llm.ngram_join import join, keep_one_each

SCHEMA = "doc_id bigint, text string, n int, cid string"
SPACES = "\x20\t\n\x0b\x0c\r"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACES[1:]:
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w]


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            groups.setdefault(find(i), []).append(r[0])
    return sorted(((r[0], len(s), min(groups.get(find(i), [None])) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, n):
    """Near copies around the limit, common passages, short texts, copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=30))
    texts = []
    while len(texts) < n:
        kind = rng.random()
        if kind < 0.25 or not texts:
            texts.append(" ".join(rng.choices(vocabulary, k=rng.randrange(1, 120))))
        elif kind < 0.75:
            w = rng.choice(texts[-40:]).split()
            for _ in range(rng.randrange(0, 1 + len(w) // 25)):
                i = rng.randrange(len(w))
                w[i:i + rng.randrange(2)] = [rng.choice(vocabulary)]
            if rng.random() < 0.3:
                w = w[: max(1, int(len(w) * rng.uniform(0.7, 1)))]
            texts.append(" ".join(w))
        elif kind < 0.9:
            texts.append(" ".join(rng.choices(vocabulary, k=rng.randrange(5, 40))) + " " + passage)
        else:
            texts.append(rng.choice(texts).upper().replace(" ", rng.choice(SPACES) * 2))
    return [(i * 3 + 1, t, 0, "") for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed, 500)
    got = join(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_the_product_finds_all_links_by_itself(spark, monkeypatch):
    """Without the bands, and with joins in place of broadcasts."""
    monkeypatch.setattr(ngram_join, "first_links", lambda docs, classes: classes.selectExpr("cid a", "cid b").limit(0))
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    rows = corpus(3, 400)
    assert sorted(map(tuple, join(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == brute(rows)


def test_every_link_is_counted(spark):
    rows = [*corpus(4, 300), (None, None, 0, ""), (5000, "", 0, ""), (5001, "only here", 0, ""), (5002, "Only  here", 0, "")]
    words_ = [f"g{i}" for i in range(60)]
    rows += [(6000 + i, " ".join([*words_[:55], *(f"{w}{i}" for w in words_[55:57])]), 0, "") for i in range(20)]  # a group of near copies
    sets = [shingles(t) for _, t, *_ in rows]
    alike = lambda x, y: bool(x & y) and 100 * len(x & y) >= 80 * len(x | y)
    want = [(r[0], len(x), sum(alike(x, y) for j, y in enumerate(sets) if j != i)) for i, (r, x) in enumerate(zip(rows, sets))]
    got = ngram_join.link_counts(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "n_shingles", "n_links"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(n for i, _, n in want if (i or 0) >= 6000) == 20 * 19


def test_exactly_at_the_limit(spark):
    """8 of 10 n-grams link, 7 of 9 do not."""
    base = [f"a{i}" for i in range(13)]
    rows = [(1, " ".join(base[:13]), 0, ""), (2, " ".join(base[:12] + ["x"]), 0, ""),
            (3, " ".join([*(f"b{i}" for i in range(12))]), 0, ""), (4, " ".join([*(f"b{i}" for i in range(11)), "y"]), 0, "")]
    got = sorted(map(tuple, join(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == brute(rows) == [(1, 9, 1), (2, 9, 1), (3, 8, 3), (4, 8, 4)]


def test_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(40_000))
    rows = [(1, None, 0, ""), (2, "", 0, ""), (3, " \t\n", 0, ""), (4, "One two", 0, ""), (5, "one  TWO", 0, ""), (6, "two one", 0, ""),
            (None, "one two", 0, ""), (None, "alone here", 0, ""), (None, None, 0, ""), (9, long, 0, ""), (8, long + " end", 0, ""),
            (7, "É a b c d e", 0, ""), (10, "é a b c d e", 0, ""), (11, "same same", 0, ""), (11, "same same", 0, ""),
            (12, "one", 0, ""), (12, "other", 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, join(df).collect()), key=str) == brute(rows)
    assert join(df.limit(0)).count() == 0
    kept = keep_one_each(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], (r["text"] or "")[:5]) for r in kept.collect()), key=str) == sorted(
        [(1, ""), (2, ""), (3, " \t\n"), (4, "One t"), (6, "two o"), (None, "alone"), (None, ""), (8, "v0 v1"),
         (7, "É a b"), (10, "é a b"), (11, "same "), (12, "one"), (12, "other")], key=str)


def test_hashes_do_not_depend_on_neighbours():
    texts = ["a b c d e f", "", "Z y", " lead and trail \n", "é" * 300_000, "a b c d e f"]
    together = list(ngram_join.shingle_sets(pa.array(texts)))
    assert all(np.array_equal(s, next(ngram_join.shingle_sets(pa.array([t])))) for s, t in zip(together, texts))
    assert all(np.array_equal(s, t) for s, t in zip(together[2:], ngram_join.shingle_sets(pa.array(texts).slice(2))))
    assert [len(s) for s in together] == [2, 0, 1, 1, 1, 2]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 400)] + [(500, 501), (501, 502), (502, 500), (7, 7)]
    edges = [e if rng.random() < 0.5 else e[::-1] for e in edges]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 400), 100), **dict.fromkeys((500, 501, 502), 500)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
