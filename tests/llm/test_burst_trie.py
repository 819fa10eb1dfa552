import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from compare import TESTDATA, duck, spark_rows, sql_rows
from roadstream.llm import burst_trie, common
from roadstream.llm.burst_trie import SQL, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    paths = {}
    for turns in by_conv.values():
        turns.sort(key=lambda t: (*t[:2], sha256(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).digest()))
    for c, turns in by_conv.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = [t[2:] for t in by_conv.get(c - c % 5, [])[:h] + turns[h:]]
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)

    def below(node):
        out, todo = [], [node]
        while todo:
            out.append(todo.pop())
            todo += kids[out[-1]]
        return out

    found = []
    for node, convs in members.items():
        under = below(node)
        ends = sorted(c for c in convs if len(paths[c]) == len(node))
        found.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids[node]),
            sum(not kids[x] for x in under), sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in under if x),
            sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(found)


def nodes(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def conversations(seed, n=60):
    rng = random.Random(seed)
    return [(c, t if rng.random() < 0.95 else None, rng.choice(["user", "tool", None]), rng.choice(["a", "é", "", None]))
            for c in rng.sample(range(n * 2), n) for t in range(rng.choice([1, 2, 3, 12]))]


@pytest.mark.parametrize("limit", [8192, 20, 1])
def test_against_brute_force(spark, limit):
    rows = conversations(limit)
    rows += rows[:7]  # repeated turns, and ties
    rows += [(None, 0, "user", "lost"), (1001, 0, "user", "z" * 200_000)]
    assert nodes(prefix_trie(spark.createDataFrame(rows, SCHEMA), limit)) == brute(rows)


def test_one_long_path_shared_by_many_and_a_longer_one(spark, monkeypatch):
    """Bursts go down a common beginning at once; ends of one node are digested run by run."""
    monkeypatch.setattr(burst_trie, "RUN", 3)
    path = [(t, "user", f"turn {t}") for t in range(40)]
    rows = [(5 * c, *t) for c in range(20) for t in path] + [(500, *t) for t in path + [(99, "user", "more")]]
    got = nodes(prefix_trie(spark.createDataFrame(rows, SCHEMA), 10))
    assert got == brute(rows)
    assert len(got) == 42


def test_split_numbering_of_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(burst_trie, "ordered", lambda df, keys, order: real(df, keys, order, hot_rows=50, cell_rows=20))
    rows = [(c, t, "user", f"{c} {t}") for c, n in ((3, 400), (10, 4), (11, 2)) for t in range(n)]
    assert nodes(prefix_trie(spark.createDataFrame(rows, SCHEMA), 5)) == brute(rows)


real = burst_trie.ordered


def test_empty_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert nodes(prefix_trie(empty)) == []
    assert nodes(prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA))) == []
    rows = [(1, 1, "user", "x"), (2, 1, "user", "x")]
    odd = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", head int, pos int, n int")
    assert nodes(prefix_trie(odd)) == brute(rows)


def test_against_sql_with_bursts(spark):
    sf = str(TESTDATA / "sf0.001")
    got = spark_rows(prefix_trie(common.conversations(spark, sf), 10))
    assert got == sql_rows(duck(sf), SQL)
