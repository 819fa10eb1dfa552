"""Packing of documents into windows of tokens, by best-fit decreasing.

A document longer than a window is first cut into full windows; each of these is a sequence. What remains of it, like any
shorter document, goes into a pool. The pool is packed longest piece first, each into the open window that it fills most
tightly: a segment tree over the remaining capacities finds that window. Windows that are full, or nearly, are written; the
pieces of the others go back to the pool, where the next documents can fill them up. Windows still open at the end of a
partition, or as the pool is full, are cut at powers of two, which need no padding.

Every task packs the rows it reads: nothing is shuffled, and a pool holds `POOL` pieces at most, however many rows there
are. A sequence lies in one partition, so that a task that runs again writes whole sequences again.

Defined results: a null text is empty and yields the end token alone; a text of any length is cut, no id is lost; rows are
independent, so equal doc_ids, null doc_ids and repeated rows are documents of their own; an empty table gives an empty
result; only doc_id and text are read.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import whole_text

WINDOW = 2048
#: The id after each document.
END = 1
#: Free places a written window may have.
SLACK = 32
#: Pieces that a task holds back to fill windows with.
POOL = 16_384
#: Documents that are encoded before their pieces are handed on.
ROWS = 512
#: Pieces of text whose ids a worker remembers.
REMEMBERED = 600_000
#: Texts without characters from here on, but for dashes and quotes, are lower-cased and split here; others by the tokenizer.
FAR, MARKS = "\u0180", "\u2010-\u2027"
SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


class OpenWindows:
    """Open windows by remaining capacity: a segment tree whose leaves are capacities and whose nodes count windows."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, window: int, capacity: int) -> None:
        self.at[capacity].append(window)
        node = self.leaves + capacity
        while node:
            self.count[node] += 1
            node >>= 1

    def tightest(self, size: int) -> int | None:
        """The least capacity that holds `size`, or None."""
        count, node = self.count, self.leaves + size
        if count[node]:
            return size
        while node > 1 and (node & 1 or not count[node + 1]):  # up, until windows lie to the right
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node *= 2
            if not count[node]:
                node += 1
        return node - self.leaves

    def take(self, capacity: int) -> int:
        node = self.leaves + capacity
        while node:
            self.count[node] -= 1
            node >>= 1
        return self.at[capacity].pop()


def best_fit(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Windows as lists of indexes into `sizes`, none of which is above `window`. Equal sizes go in their order."""
    out: list[list[int]] = []
    tree = OpenWindows(window)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        capacity = tree.tightest(size)
        if capacity is None:
            out.append([i])
            own, capacity = len(out) - 1, window
        else:
            own = tree.take(capacity)
            out[own].append(i)
        if capacity > size:
            tree.put(own, capacity - size)
    return out


class Words:
    """Ids of texts. A text is split as the tokenizer splits it; the ids of a piece do not depend on its neighbours, so they
    are remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a piece
        self.last[[i for token, i in vocabulary.items() if token.endswith(self.tokenizer.model.end_of_word_suffix)]] = True
        self.known: dict[str, bytes] = {}
        near = [chr(i) for i in range(ord(FAR))]
        letters, numbers = ("".join(re.escape(c) for c in near if unicodedata.category(c)[0] == kind) for kind in "LN")
        #: Fixed value: the pattern of the tokenizer, with its classes spelled for the characters that `far` does not find.
        self.split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\t-\r \x85\xa0{letters}{numbers}]+").findall
        self.far = re.compile(f"[^\0-{chr(ord(FAR) - 1)}{MARKS}]").search

    def _learn(self, pieces: list[str]) -> None:
        encode = self.tokenizer.encode_batch_fast
        for i in range(0, len(pieces), 1000):  # many in one text: the last token of each is known by its form
            some = pieces[i:i + 1000]
            ids = np.array(encode([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(self.last[ids]) + 1) * 4
            if len(ends) != len(some):
                raise ValueError("the tokenizer splits texts in another way than expected")
            raw = ids.tobytes()
            self.known.update(zip(some, map(raw.__getitem__, map(slice, [0, *ends[:-1].tolist()], ends.tolist()))))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, 32 bits each, the lowest byte first."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        rows = [None if self.far(t) else self.split(t.lower()) for t in texts]
        self._learn(list(set().union(*filter(None, rows)).difference(self.known)))
        known = self.known.__getitem__
        return [b"".join(map(known, row)) if row is not None else self._whole(t) for t, row in zip(texts, rows)]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


class Packer:
    """Takes documents as ids and gives pieces (doc_id, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, window: int = WINDOW, pool: int = POOL, slack: int = SLACK):
        self.window, self.most, self.slack = window, pool, slack
        self.pool: list[tuple] = []
        self.sequences = 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        n, w = len(ids) // 4, self.window
        for start in range(0, n - n % w, w):
            yield doc_id, start, ids[4 * start:4 * (start + w)], n, self.sequences, 0
            self.sequences += 1
        if n % w:
            self.pool.append((doc_id, n - n % w, ids[4 * (n - n % w):], n))
            if len(self.pool) >= self.most:
                yield from self.flush(self.most // 2)

    def flush(self, keep: int = 0) -> Iterator[tuple]:
        """Packs the pool. The pieces of windows that are not full stay in it, the smallest windows first, up to `keep` pieces."""
        pieces, self.pool = self.pool, []
        sizes = [len(p[2]) // 4 for p in pieces]
        windows = sorted(((sum(map(sizes.__getitem__, own)), own) for own in best_fit(sizes, self.window)), key=lambda x: x[0])
        for filled, own in windows:
            if filled < self.window - self.slack:
                if len(self.pool) + len(own) <= keep:
                    self.pool += [pieces[i] for i in own]
                    continue
                parts = [1 << b for b in range(filled.bit_length() - 1, -1, -1) if filled >> b & 1]
            else:
                parts = [filled]
            yield from self._sequences([pieces[i] for i in own], parts)

    def _sequences(self, pieces: list[tuple], parts: list[int]) -> Iterator[tuple]:
        """The pieces one after another, cut into sequences of these lengths."""
        room, at, parts = parts[0], 0, parts[1:]
        for doc_id, start, ids, n in pieces:
            done, size = 0, len(ids) // 4
            while done < size:
                if at == room:
                    room, at, parts = parts[0], 0, parts[1:]
                    self.sequences += 1
                part = min(size - done, room - at)
                yield doc_id, start + done, ids[4 * done:4 * (done + part)], n, self.sequences, at
                done, at = done + part, at + part
        self.sequences += 1


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END, pool: int = POOL, slack: int = SLACK) -> DataFrame:
    """The pieces: doc_id, start, length, doc_tokens, sequence_id, offset, ids (32 bits each, the lowest byte first).

    `path`: the tokenizer's file, which every executor has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer, last = words(path), Packer(window, pool, slack), np.uint32(end).tobytes()
        first = TaskContext.get().partitionId() << 33

        def table(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            for part in (rows[i:i + 4096] for i in range(0, len(rows), 4096)):
                ids, starts, pieces, totals, numbers, offsets = zip(*part)
                columns = [ids, starts, [len(p) // 4 for p in pieces], totals, [first + s for s in numbers], offsets]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns), pa.array(pieces, pa.binary())],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for batch in batches:
            for part in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                coded = own.encode(part.column(1).to_pylist())
                yield from table([p for i, ids in zip(part.column(0).to_pylist(), coded) for p in packer.add(i, ids + last)])
        yield from table(list(packer.flush()))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(run, SCHEMA)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, n_pieces and the ids of each sequence, of no more than a window."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.col("parts"), F.lit(b""), lambda out, p: F.concat(out, p["ids"]))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.size("parts").alias("n_pieces"), joined.alias("ids"))


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
