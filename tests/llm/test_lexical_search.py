import math
import random
import re
from collections import Counter

import pytest

from compare import TESTDATA, duck, spark_rows, sql_rows
from roadstream.llm import common
from roadstream.llm.lexical_search import SQL, search

find = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+").findall
DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def terms(text):
    return Counter(find(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))


def brute(docs, items, best=10):
    own = [(i, terms(t)) for i, t in docs]
    own = [(i, t) for i, t in own if t]
    total = sum(t.total() for _, t in own)
    df = Counter(x for _, t in own for x in t)
    found = []
    for item, text in items:
        scored = []
        for i, t in own:
            m = 25 + 75 * t.total() * len(own) // total
            score = sum(k * math.floor(1000 * math.log((2 * len(own) + 2) / (2 * df[x] + 1))) * (10**9 * t[x] // (1000 * t[x] + 8 * m))
                        for x, k in terms(text).items() if t[x])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        found += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scored)[:best], 1)]
    return sorted(found, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("sizes", [{}, {"block_docs": 20, "bundle_items": 2}])
def test_against_brute_force(spark, sizes):
    rng = random.Random(13)
    words = ["the", "The", "of", "Ärger", "ärger", "x1", "42", "rare", "日本", "naïve"] + [f"w{i}" for i in range(60)]
    weights = [200, 50, 100] + [3] * (len(words) - 3)
    text = lambda n: rng.choice([" ", "-", "_", "\u007f"]).join(rng.choices(words, weights, k=n))
    docs = [(i, text(rng.choice([1, 5, 30, 200]))) for i in range(150)]
    docs += [(None, "rare words"), (None, "rare words"), (7, "rare words"), (7, "rare words"), (900, None), (901, ""), (902, "..."), (903, "the " * 50_000)]
    items = [(i, text(rng.choice([1, 3, 20]))) for i in range(15)] + [(None, "rare of"), (3, "rare rare the"), (98, None), (99, "--"), (97, "unheardof")]
    got = search(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS), **sizes)
    assert found(got) == brute(docs, items)


def test_many_equal_documents(spark):
    docs = [(i, "copy of one text") for i in range(3000, 0, -1)] + [(i, f"other text {i}") for i in range(4000, 4050)]
    items = [(1, "one copy"), (2, "text")]
    got = search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block_docs=100)
    assert found(got) == brute(docs, items)


def test_empty_tables_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 1, "z"), (2, "b", 2, "z")], DOCS + ", rid int, term string")
    items = spark.createDataFrame([(5, "b a", 3, 4)], ITEMS + ", bundle int, item int")
    assert found(search(docs, items)) == brute([(1, "a b"), (2, "b")], [(5, "b a")])
    assert found(search(docs.limit(0), items)) == found(search(docs, items.limit(0))) == []


def test_against_sql(spark):
    sf = str(TESTDATA / "sf0.01")
    got = search(common.documents(spark, sf), common.benchmark(spark, sf), block_docs=64, bundle_items=9)
    assert spark_rows(got) == sql_rows(duck(sf), SQL)
