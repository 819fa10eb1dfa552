"""A Bloom filter as a small table, to thin out a large side before it is shuffled.

The filter has one 64-bit word per group of keys: a key's hash names its word and sets four bits in
it. Words are built by one aggregation (`bit_or`, combined before the shuffle) and broadcast; a row
passes if its word holds all of its bits. Rows whose key is listed always pass, few others do, so
an exact join has to follow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Listed keys per word, as long as there are words enough: about 1 in 150 unlisted keys passes.
KEYS_PER_WORD = 4
# The words are broadcast: a million rows of two bigints.
MAX_WORDS = 1 << 20
# With more keys per word than this a third of the unlisted keys pass, and the filter is not worth it.
MAX_KEYS_PER_WORD = 20
PROBES = 4

_WORD, _BITS = "_word", "_bits"


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words).cast("bigint"))


def _mask(key: Column) -> Column:
    """The bits of a key; a second hash, so that keys of one word differ in them."""
    second = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("bigint")
    places = [F.pmod(F.shiftright(second, 6 * i), F.lit(64)).cast("int") for i in range(PROBES)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", one, p) for p in places])


def words_for(n_keys: int, max_words: int = MAX_WORDS) -> int | None:
    """Number of words for that many keys; None if the filter would hold back too few rows."""
    if n_keys > max_words * MAX_KEYS_PER_WORD:
        return None
    return min(max(1, -(-n_keys // KEYS_PER_WORD)), max_words)


def filter_words(keys: DataFrame, key: str, words: int) -> DataFrame:
    """The filter of the non-null values of `key`: at most `words` rows (_word, _bits)."""
    listed = keys.where(F.col(key).isNotNull())
    return listed.groupBy(_word(F.col(key), words).alias(_WORD)).agg(
        F.bit_or(_mask(F.col(key))).alias(_BITS)
    )


def thinned(df: DataFrame, key: str, keys: DataFrame, words: int) -> DataFrame:
    """Rows of `df` whose key may be among `keys`, all that are among them included.

    `df` is not moved. Null keys are in no list and do not pass.
    """
    columns = [F.col(c) for c in df.columns]
    bits = F.broadcast(filter_words(keys, key, words))
    probed = df.where(F.col(key).isNotNull()).withColumn(_WORD, _word(F.col(key), words))
    mask = _mask(F.col(key))
    return probed.join(bits, _WORD).where(F.col(_BITS).bitwiseAND(mask) == mask).select(*columns)
