"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that the BPE encoding of that prefix ends in. `PrefixTable`
stores it for each prefix, found among the vocabulary's tokens that end there: the one that stays apart from the last token
of what precedes it. The tokens are read off backwards. Bytes may be appended, and an edit recomputes only from its start to
where the table agrees with the old one again.

Defined results: a null text is empty and has no tokens; a text of any length is handled in time linear in its length; rows
are independent, so ties, repeated rows and empty tables need no rule; only doc_id and text are read.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import whole_text

#: Fixed value: the White_Space property, as the pattern's \s means it; `regex` also takes \x1c to \x1f for white space.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Texts without characters from here on are split by `re`, with the classes of letters, numbers and spaces written out.
FAR = "\u0250"
#: Documents that are encoded before their result is handed to Spark.
ROWS = 512
#: Pieces whose tokens a worker remembers in each of two generations.
REMEMBERED = 300_000
#: Pairs of tokens that a worker remembers to stay apart or not.
PAIRS = 300_000


class Vocabulary:
    """Tokens by rank, and what tells whether two of them stay apart when they meet."""

    def __init__(self, ranks: dict[bytes, int]):
        self.rank = ranks
        self.longest = max(map(len, ranks), default=0)
        self.bytes = {r: t for t, r in ranks.items()}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.known: dict[tuple[int, int], bool] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):  # parts have lower ranks than what they make
            self.halves[rank] = pair = self._last_merge(token)
            if pair:
                self.joined[pair] = rank
        self.ending = ahocorasick.Automaton()  # all tokens that end at a byte; bytes are written as the code points of equal number
        for token, rank in ranks.items():
            self.ending.add_word(token.decode("latin-1"), (rank, len(token)))
        self.ending.make_automaton()
        self.table = pa.array([self.bytes.get(r, b"") for r in range(max(self.bytes, default=0) + 1)], pa.binary())

    def _last_merge(self, token: bytes) -> tuple[int, int] | None:
        """The two tokens that merging makes `token` of last. Its bytes are merged without the token itself."""
        parts = [self.rank[token[i:i + 1]] for i in range(len(token))]
        while len(parts) > 2:
            found = [(r, i) for i, p in enumerate(zip(parts, parts[1:])) if (r := self.joined.get(p)) is not None]
            if not found:
                return None  # no merges lead to it; only a piece equal to it yields it
            rank, i = min(found)
            parts[i:i + 2] = [rank]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def apart(self, left: int, right: int) -> bool:
        """Whether `left` and `right` remain as they are when one follows the other.

        Goes back through the merges that made them, the latest first. At each step the two parts at the border must not
        have merged before the merge that was undone; of equal ranks the one further left comes first.
        """
        before = None
        while True:
            both = self.joined.get((left, right))
            if both is not None and (before is None or both < before):
                return False
            a, b = self.halves[left], self.halves[right]
            if a and (left > right or not b):
                before, left = left, a[1]
            elif b:
                before, right = right + 1, b[0]
            else:
                return True


class PrefixTable:
    """The last token of each prefix of one piece of bytes."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", []
        self.append(piece)

    def append(self, more: bytes) -> PrefixTable:
        self.piece += more
        self._fill(len(self.piece))
        return self

    def _fill(self, end: int) -> None:
        known, last, filled = self.vocabulary.known, self.last, len(self.last)
        begin = max(0, filled - self.vocabulary.longest)
        text = self.piece[begin:end].decode("latin-1")
        for at, (token, size) in self.vocabulary.ending.iter(text):
            at += begin
            if at != filled:
                continue
            if size <= at:
                pair = last[at - size], token
                apart = known.get(pair)
                if apart is None:
                    if len(known) >= PAIRS:
                        known.clear()
                    apart = known[pair] = self.vocabulary.apart(*pair)
                if not apart:
                    continue
            last.append(token)
            filled += 1
        if filled < end:
            raise ValueError(f"no token ends at byte {filled}: the vocabulary lacks a byte")

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Puts `new` for the bytes from `start` to `end`. Returns how many prefixes were computed again."""
        old, moved, longest = self.last, start + len(new) - end, self.vocabulary.longest
        self.piece = self.piece[:start] + new + self.piece[end:]
        self.last = old[:start]
        same, i = 0, start
        while i < len(self.piece) and same < longest:  # a prefix depends on no more than `longest` before it
            upto = min(len(self.piece), i + longest)
            self._fill(upto)
            while i < upto and same < longest:
                i += 1
                same = same + 1 if i - moved > end and self.last[i - 1] == old[i - moved - 1] else 0
        del self.last[i:]
        self.last += old[i - moved:]
        return i - start

    def tokens(self) -> list[int]:
        out, i, size = [], len(self.last), self.vocabulary.bytes
        while i:
            out.append(self.last[i - 1])
            i -= len(size[self.last[i - 1]])
        return out[::-1]


def _written_out(pattern: str, letters: str, numbers: str) -> str:
    """The pattern with its classes spelled; `letters` and `numbers` are what stands for them inside brackets."""
    named = {r"\s": SPACE, r"\p{L}": letters, r"\p{N}": numbers}

    def spelled(m: re.Match) -> str:
        if m[0] == r"\S":
            return f"[^{SPACE}]"
        inner = "".join(named[x] for x in re.findall(r"\\s|\\p\{[LN]\}", m[0]))
        return f"[^{inner}]" if m[0].startswith("[") else f"[{inner}]"

    return re.sub(r"\[\^(?:\\s|\\p\{[LN]\})+\]|\\s|\\S|\\p\{[LN]\}", spelled, pattern)


class Encoder(dict):
    """Tokens by piece. Remembers pieces in two generations, so its size is bounded however many there are."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        super().__init__()
        near = [chr(i) for i in range(ord(FAR))]
        kinds = ("".join(c for c in near if unicodedata.category(c)[0] == kind) for kind in "LN")
        self.vocabulary, self.older = vocabulary, {}
        self.near = re.compile(_written_out(pattern, *kinds)).findall
        self.all = regex.compile(_written_out(pattern, r"\p{L}", r"\p{N}")).findall
        self.has_far = re.compile(f"[^\0-{chr(ord(FAR) - 1)}]").search

    def split(self, text: str) -> list[str]:
        return (self.all if self.has_far(text) else self.near)(text)

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found = self.older.get(piece)
        if found is None:
            raw = piece.encode()
            whole = self.vocabulary.rank.get(raw)
            found = (whole,) if whole is not None else tuple(PrefixTable(self.vocabulary, raw).tokens())
        if len(piece) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found

    def forget(self) -> None:
        """Gives back the memory of what is remembered."""
        self.clear()
        self.older = {}
        self.vocabulary.known.clear()

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.split(text))))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(t): int(r) for t, r in map(bytes.split, f)})


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(vocabulary(path), pattern)


Batches = Iterator[pa.RecordBatch]


def _encoding(path: str, pattern: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        own = encoder(path, pattern)
        try:
            for batch in batches:
                for part in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                    rows = [own.encode(t) for t in part.column(1).to_pylist()]
                    flat = np.fromiter(chain.from_iterable(rows), np.int32, sum(map(len, rows)))
                    ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)))]).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                    yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])
        finally:
            own.forget()  # the worker may go on with other work
            pa.default_memory_pool().release_unused()

    return run


def _decoding(path: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        table = vocabulary(path).table
        for batch in batches:
            for part in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                ids = part.column(part.num_columns - 1)
                ends = pa.array(np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())]).astype(np.int32))
                decoded = pc.binary_join(pa.ListArray.from_arrays(ends, table.take(ids.flatten())), b"")
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], [*part.schema.names, "decoded"])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the token ids of the whole text. `path`: the rank file, which every executor has."""
    return _texts(docs).mapInArrow(_encoding(path, pattern), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str, kept: str = "doc_id bigint") -> DataFrame:
    """`encoded` with the bytes that its column `ids` stands for, as `decoded`. `kept`: its other columns' schema."""
    names = [x.split()[0] for x in kept.split(",")]
    return encoded.select(*names, "ids").mapInArrow(_decoding(path), f"{kept}, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids, n_tokens and digests of the ids and of what they decode to."""
    ids_text = F.concat_ws(",", F.col("ids").cast("array<string>"))
    encoding, decoding = _encoding(path, pattern), _decoding(path)
    coded = _texts(docs).mapInArrow(  # both in one worker
        lambda batches: decoding(encoding(batches)), "doc_id bigint, ids array<int>, decoded binary")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids_text, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "ids",
    )
