import math
import random
import re
from collections import Counter, defaultdict

import pytest

from roadstream.llm.mixing import mix, multipliers, repeat_rows, targets

SCHEMA = "doc_id bigint, text string, source string, s int, size string"


def corpus(n, sources, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        source = sources[0] if rng.random() < 0.4 else rng.choice(sources)
        words = 40 if rng.random() < 0.3 else int(rng.lognormvariate(3.5, 1)) + 1
        out.append((i, " ".join(["w"] * words), source, 0, "x"))
    return out


def fill(sizes, weights=(1, 2, 3), most=3):
    """Targets as the rule says them: share, stop the ones above, share what is over again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while left > 1e-9 and open_:
        unit = left / sum(weight[s] for s in open_)
        for s in open_:
            target[s] += unit * weight[s]
        left = 0.0
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, got, most=3):
    sizes = defaultdict(int)
    longest = Counter()
    for _, text, source, *_ in rows:
        sizes[source] += count(text)
        longest[source] = max(longest[source], count(text))
    want, taken = fill(sizes), defaultdict(int)
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    for i, text, source, *_ in rows:
        r = by_id[i]
        assert (r["size"], r["source_size"]) == (count(text), sizes[source])
        assert math.isclose(r["target"], want[source], rel_tol=1e-9, abs_tol=1e-6)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= most
        taken[source] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * longest[s] + 1, (s, taken[s], want[s])


def test_targets_are_met(spark):
    rows = corpus(1500, ["b", "a", "Z", "é", "c", None, "tiny"]) + [(9000, "one two", "tiniest", 0, "")]
    got = mix(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, got)
    again = mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_rates_solve_the_dual(spark):
    """Rates are exp(l * size) up to the bound, and meet the target before they are rounded."""
    rows = corpus(800, ["a", "b", "c"], seed=4)
    sizes = spark.createDataFrame([(s, count(t), 1) for _, t, s, *_ in rows], "source string, size bigint, n bigint")
    goals = targets(sizes)
    found = {r["source"]: r for r in multipliers(sizes, goals).collect()}
    for g in goals.collect():
        own, m = [count(t) for _, t, s, *_ in rows if s == g["source"]], found[g["source"]]
        rates = [3.0 if m["l"] is None else min(3.0, math.exp(min(5, m["l"] * x / m["scale"]))) for x in own]
        assert math.isclose(sum(r * x for r, x in zip(rates, own)), g["target"], rel_tol=1e-6)


@pytest.mark.parametrize("rows", [
    [(1, "a b", "x", 0, "")],
    [(1, None, None, None, None), (2, "", "x", 0, ""), (3, " \t", "y", 0, "")],
    [(1, "w " * 100_000, "a", 0, ""), (2, "w", "b", 0, ""), (3, "w w", "c", 0, "")],
])
def test_odd_tables(spark, rows):
    check(rows, mix(spark.createDataFrame(rows, SCHEMA)).collect())


def test_repeated_and_null_ids(spark):
    rows = [(None, "a b c", "x", 0, "")] * 20 + [(5, "a b c", "x", 0, "")] * 20 + [(6, "a b c", "y", 0, "")] * 20
    got = mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 60
    assert sum(r["taken"] for r in got) == 180
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_mix_repeats_whole_rows(spark):
    rows = corpus(300, ["a", "b"])
    df = spark.createDataFrame(rows, SCHEMA)
    got, want = repeat_rows(df), {r["doc_id"]: r["copies"] for r in mix(df).collect()}
    assert got.columns == df.columns
    times = Counter(map(tuple, got.collect()))
    assert all(times[r] == want[r[0]] for r in rows) and sum(times.values()) == sum(want.values())
