import random
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest

from roadstream.llm import fingerprints
from roadstream.llm.fingerprints import HASHES, K, LENGTH, edited, likeness, neighbours, signature, written


def brute_signature(text):
    """The rule step by step, on the same hashes of single k-mers."""
    found = fingerprints.kmers(text).tolist()
    if not text:
        return [0] * HASHES
    seen, numbered = defaultdict(int), []
    width = min(K, len(text))
    for i in range(len(text) - width + 1):
        numbered.append((text[i:i + width], seen[text[i:i + width]]))
        seen[text[i:i + width]] += 1
    assert len(set(numbered)) == len(set(found)) == len(found)
    out = []
    for flip, odd in zip(fingerprints._flips.tolist(), fingerprints._odd.tolist()):
        least = sorted(range(len(found)), key=lambda i: (found[i] ^ flip) * odd % 2**64)[:LENGTH]
        row = np.zeros(LENGTH, np.uint64)
        for at, i in enumerate(sorted(least)):
            row[at] = found[i]
        out.append(int((fingerprints.mixed((row * fingerprints._place).sum(dtype=np.uint64, keepdims=True)) >> np.uint64(33))[0]) + 1)
    return out


@pytest.mark.parametrize("text", ["", "a", "ab" * 40, "é\U0001f600xyz" * 9, "The quick brown fox jumps over it. " * 3])
def test_signature(text):
    assert signature(text).tolist() == brute_signature(text)


def test_order_counts_and_edits_show():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    near = text[:1000] + "X" + text[1000:2500] + text[2510:]
    assert likeness(signature(text), signature(near)) > 0.8
    assert likeness(signature(text), signature("".join(rng.choice("abcdefgh ") for _ in range(4000)))) == 0
    blocks = [text[i:i + 100] for i in range(0, 4000, 100)]
    rng.shuffle(blocks)
    assert likeness(signature(text), signature("".join(blocks))) < 0.75  # the k-mers are nearly the same


def brute(rows):
    key = lambda r: (r[0] is None, -(r[0] or 0))
    ordered = sorted(rows, key=key)
    out = []
    for (i, text, *_), (_, following, *_) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        other = edited(text, following)
        a, b, c = signature(text), signature(other), signature(following)
        out.append((i, len(text), sha256(other.encode()).hexdigest(), written(a), written(b), likeness(a, b), likeness(a, c)))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, cell int, mark string")


@pytest.mark.parametrize("size", [500, 7, 1])
def test_neighbours(spark, monkeypatch, size):
    monkeypatch.setattr(fingerprints, "ROWS", size)
    rng = random.Random(size)
    ids = rng.sample(range(-5000, 5000), 300)
    rows = [(i, "".join(rng.choice("abc é\U0001f600") for _ in range(rng.randrange(80))), 0, "x") for i in ids] + [
        (2**63 - 1, None, 0, ""), (-2**63, "", 1, ""), (None, "last", 0, "")]
    got = neighbours(table(spark, rows))
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_a_replaced_half_shows(spark):
    """A document is always nearer to its edited text than to the next one."""
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(300, 1500))), 0, "") for i in range(150)]
    got = neighbours(table(spark, rows)).collect()
    assert len(got) == 150 and all(r["near_edited"] > r["near_next"] for r in got)


def test_odd_tables(spark, monkeypatch):
    assert neighbours(table(spark, [])).count() == 0
    for rows in ([(5, "only one", 0, "")], [(1, None, 0, ""), (2, None, 0, "")], [(1, "x" * 300_000, 0, ""), (2, "y", 0, "")]):
        assert sorted(map(tuple, neighbours(table(spark, rows)).collect()), key=str) == brute(rows)
    monkeypatch.setattr(fingerprints, "ROWS", 3)
    rows = [(4, "same", 0, "")] * 9 + [(None, f"n{i}", 0, "") for i in range(20)] + [(7, "z", 0, "")]
    got = neighbours(table(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    assert [r["doc_id"] for r in fingerprints.fingerprints(table(spark, rows)).collect()].count(4) == 9
