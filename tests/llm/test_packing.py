import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from compare import TESTDATA
from roadstream.llm import common, packing
from roadstream.llm.packing import best_fit, digests, pack, sequences, words

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]


def check(tokenizer, docs, rows, window=packing.WINDOW):
    """The pieces of each document are its ids, each once; sequences have no gaps. Returns the padding and all tokens."""
    pieces, filled = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] > 0
        pieces[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"]))
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    texts = defaultdict(list)
    for doc_id, text in docs:
        texts[doc_id].append(text)
    assert set(pieces) == set(texts)
    for doc_id, own in texts.items():
        want = sorted(ids_of(tokenizer, t) for t in own)
        if len(want) == 1:
            assert [i for _, ids, _ in sorted(pieces[doc_id]) for i in ids] == want[0]
            assert {n for *_, n in pieces[doc_id]} == {len(want[0])}
        else:  # rows of equal doc_id
            assert sorted(i for _, ids, _ in pieces[doc_id] for i in ids) == sorted(i for ids in want for i in ids)
    padding = 0
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        total = sum(n for _, n in parts)
        assert total <= window
        padding += window - total if total & (total - 1) else 0
    return padding, sum(n for parts in filled.values() for _, n in parts)


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(12)
    for _ in range(300):
        window = rng.choice([1, 7, 20, 64])
        sizes = [rng.randint(1, window) for _ in range(rng.randint(0, 50))]
        free = []
        for size in sorted(sizes, reverse=True):
            fits = [f for f in free if f >= size]
            if fits:
                free.remove(min(fits))
            free.append((min(fits) if fits else window) - size)
        got = best_fit(sizes, window)
        assert sorted(i for own in got for i in own) == list(range(len(sizes)))
        assert sorted(window - sum(sizes[i] for i in own) for own in got) == sorted(free)


def test_words_are_encoded_as_by_the_tokenizer(tokenizer):
    rng = random.Random(5)
    near = [chr(i) for i in range(0x180)] + [chr(i) for i in range(0x2010, 0x2028)]
    texts = ["".join(rng.choice(near) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += [x for c in map(chr, range(0x250)) for x in (c, f"a{c}B", f"{c}1{c}")]
    texts += ["Don't I'LL we'Re <|endoftext|> x", "", " \t\n", "Σίγμας ς Σ", "日本語 text", "é ẛ̣", "x y　z", "\U0001f600 a"]
    for text, ids in zip(texts, words(PATH).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_memory_of_words_is_emptied(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    own = packing.Words(PATH)
    for text in ("a b c d e", "a f g", "a b z"):
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(own.known) <= 8


def test_whole_table(spark, tokenizer):
    docs = common.documents(spark, str(TESTDATA / "sf0.01")).select("doc_id", "text")
    padding, total = check(tokenizer, docs.collect(), pack(docs, PATH).collect())
    assert padding < 0.005 * total


@pytest.mark.parametrize("pool", [2, 4, 50])
def test_small_windows_and_pools(spark, tokenizer, pool):
    rng = random.Random(pool)
    docs = [(i, " ".join(rng.choice(["cat", "extraordinarily", "x1", "ß"]) for _ in range(rng.randint(0, 70)))) for i in range(300)]
    rows = pack(spark.createDataFrame(docs, SCHEMA).repartition(3), PATH, window=32, pool=pool, slack=2).collect()
    padding, total = check(tokenizer, docs, rows, 32)
    assert padding <= 2 * total / 30


def test_defined_results(spark, tokenizer):
    long = "word " * 100_000
    docs = [(1, None), (2, ""), (3, long), (4, "same"), (4, "same"), (None, "none"), (5, " \n ")]
    odd = spark.createDataFrame([(*d, 7, "x", b"y") for d in docs], SCHEMA + ", length int, sequence_id string, ids binary")
    rows = pack(odd, PATH).collect()
    check(tokenizer, docs, rows)
    assert [(r["length"], r["doc_tokens"]) for r in rows if r["doc_id"] in (1, 2, 5)] == [(1, 1)] * 3
    assert pack(odd.limit(0), PATH).count() == 0


def test_digests_and_sequences(spark):
    docs = common.documents(spark, str(TESTDATA / "sf0.001"))
    pieces = pack(docs, PATH)
    own = {(r["doc_id"], r["start"]): r for r in pieces.collect()}
    for r in digests(pieces).collect():
        assert r["ids_crc32"] == zlib.crc32(own[r["doc_id"], r["start"]]["ids"])
    whole = {r["sequence_id"]: r for r in sequences(pieces).collect()}
    assert sum(len(r["ids"]) for r in whole.values()) == sum(len(r["ids"]) for r in own.values())
    assert all(whole[r["sequence_id"]]["ids"][4 * r["offset"]:][:len(r["ids"])] == r["ids"] for r in own.values())
