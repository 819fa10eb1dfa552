import random
from hashlib import sha256

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from roadstream.llm.byte_bpe import Encoder, PrefixTable, Vocabulary, encoder, round_trip
from roadstream.llm.byte_bpe import vocabulary as load

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def want():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load(PATH).rank, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text("ab cd' \n\t\x1c\x85\xa0　é1２١.", max_size=60))
def test_as_the_library(text):
    want = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load(PATH).rank, special_tokens={})
    assert encoder(PATH, P.PATTERN).encode(text) == want.encode_ordinary(text)


def test_every_code_point(want):
    for i in [*range(0x3100), *range(0xFE00, 0x10000), *range(0x1F600, 0x1F620)]:
        text = f"a{chr(i)} {chr(i)}{chr(i)}\n {chr(i)}1"
        assert encoder(PATH, P.PATTERN).encode(text) == want.encode_ordinary(text), hex(i)


def test_any_merges():
    """Random vocabularies of two letters, where merges of equal rank overlap."""
    rng = random.Random(3)
    for _ in range(60):
        ranks = {bytes([i]): i for i in (97, 98, 99)}
        for r in range(200, 230):
            ranks.setdefault(rng.choice(list(ranks)) + rng.choice(list(ranks)), r)
        ranks = {t: r for t, r in ranks.items() if len(t) <= 12}
        vocabulary = Vocabulary(ranks)
        reachable = {t: r for t, r in ranks.items() if len(t) == 1 or vocabulary.halves[r]}
        vocabulary = Vocabulary(reachable)

        def merged(s):
            parts = [s[i:i + 1] for i in range(len(s))]
            while found := [(reachable[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in reachable]:
                i = min(found)[1]
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            return [reachable[p] for p in parts]

        for _ in range(30):
            s = bytes(rng.choice(b"abc") for _ in range(rng.randrange(40)))
            assert PrefixTable(vocabulary, s).tokens() == merged(s)


def test_appends_and_edits():
    vocabulary, rng = load(PATH), random.Random(5)
    text = "".join(rng.choice("theanreingostr é") for _ in range(3000)).encode()
    table = PrefixTable(vocabulary)
    for i in range(0, 3000, 7):
        table.append(text[i:i + 7])
    assert table.tokens() == PrefixTable(vocabulary, table.piece).tokens()
    for _ in range(60):
        a = rng.randrange(len(table.piece))
        b = min(len(table.piece), a + rng.randrange(6))
        again = table.edit(a, b, bytes(rng.choice(b"thean ") for _ in range(rng.randrange(6))))
        assert again < 600
        assert table.last == PrefixTable(vocabulary, table.piece).last


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr("roadstream.llm.byte_bpe.REMEMBERED", 50)
    own = Encoder(load(PATH), P.PATTERN)
    text = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x{i}" for i in range(2000))
    assert own.encode(text) == encoder(PATH, P.PATTERN).encode(text)
    assert len(own) <= 50 and len(own.older) <= 50


def test_query_on_odd_rows(spark, want):
    rows = [(1, None, 3), (2, "", 3), (None, "née £5\n\n x", None), (4, "lo" * 60_000, 0), (4, "lo" * 60_000, 0), (5, "a b" * 20_000, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    got = round_trip(df, PATH, P.PATTERN).collect()
    expected = []
    for i, t, _ in rows:
        ids = want.encode_ordinary(t or "")
        expected.append((i, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256((t or "").encode()).hexdigest()))
    assert sorted((tuple(r)[:4] for r in got), key=str) == sorted(expected, key=str)
    assert round_trip(df.limit(0), PATH, P.PATTERN).count() == 0
