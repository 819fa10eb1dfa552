"""Joins and key statistics that hold when one key has a large share of all rows."""

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from roadstream.operators.bloom import thinned, words_for

# A key is hot if it has more rows than this (one task sorts so many narrow rows in seconds) and
# more than a fair share of all rows (many keys of like size balance by themselves). There are
# fewer than HOT_SHARE hot keys then, whatever the data, and any other key is handled whole.
HOT_ROWS = 1_000_000
HOT_SHARE = 10_000
# A side is broadcast only when it was counted and is within both limits.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
# Salts of every key of a stream, whose keys cannot be counted ahead.
SALTS = 32

_SALT = "_salt"


def hot_keys(
    df: DataFrame,
    keys: list[str],
    hot_rows: int = HOT_ROWS,
    share: int = HOT_SHARE,
    nulls: bool = False,
) -> list[Row]:
    """Keys with more than `hot_rows` rows and more than 1/`share` of all, as (keys..., n).

    The count is combined before the shuffle, so a hot key sends one row per input task. At
    most `share` rows can pass, and no more come to the driver. Null keys count if `nulls`.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > hot_rows)
    for key in [] if nulls else keys:
        counts = counts.where(F.col(key).isNotNull())
    large = counts.orderBy(F.desc("n"), *keys).limit(share).collect()
    if not large:
        return []
    fair = df.count() / share
    return [r for r in large if r["n"] > fair]


def hot_frame(df: DataFrame, keys: list[str], hot: list[Row]) -> DataFrame:
    schema = T.StructType([df.schema[k] for k in keys])
    return df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in hot], schema)


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Count rows and bytes of `df`, not an estimate of the optimizer."""
    n, size = counted(df)
    return n <= max_rows and size <= max_bytes


def counted(df: DataFrame) -> tuple[int, int]:
    """Rows of `df`, and their bytes about as Spark holds them."""
    width = F.lit(0)
    for f in df.schema:
        if isinstance(f.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 16
        else:
            width = width + 16
    row = df.agg(F.count("*").alias("n"), F.sum(width.cast("bigint")).alias("b")).first()
    return row["n"], row["b"] or 0


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join to a static lookup with one row per `key` (inner, left or left_semi).

    A lookup of proven small size is broadcast and the left side is not moved. A larger one is
    shuffled. Of a semi-join only the rows that pass a Bloom filter of the lookup are, unless it
    has too many keys for one. Hot left keys and the null key are spread over one group per
    `hot_rows` of their rows; only the lookup rows of these keys are copied, and null has none.
    A stream cannot be counted ahead, so there every key is spread over `salts` groups.
    """
    n, size = counted(right)
    if n <= max_rows and size <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), key, how)
    if how == "left_semi" and (words := words_for(n)):
        left = thinned(left, key, right, words)
    if left.isStreaming:
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
        spread = left.withColumn(_SALT, _salt_of(left, F.lit(salts)))
        return spread.join(right.withColumn(_SALT, every), [key, _SALT], how).drop(_SALT)
    hot = hot_keys(left, [key], hot_rows, nulls=how == "left")
    if not hot:
        return left.join(right, key, how)
    loads = salts_by_load(left, key, hot, hot_rows)
    copied = right.join(F.broadcast(loads), key, "left").withColumn(
        _SALT,
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)) - 1)),
    )
    spread = salted(left, key, loads)
    return spread.join(copied.drop("_salts"), [key, _SALT], how).drop(_SALT)


def salts_by_load(left: DataFrame, key: str, hot: list[Row], per_salt: int) -> DataFrame:
    """(key, _salts): one salt for each `per_salt` rows of a hot key."""
    schema = T.StructType([left.schema[key], T.StructField("_salts", T.LongType())])
    rows = [(r[key], -(-r["n"] // per_salt)) for r in hot]
    return left.sparkSession.createDataFrame(rows, schema)


def salted(left: DataFrame, key: str, loads: DataFrame) -> DataFrame:
    """`left` with a salt, from 0 up to the salts of the key; 0 for a key without any."""
    marked = left.alias("l").join(
        F.broadcast(loads.withColumnRenamed(key, "_hot")),
        F.col(f"l.{key}").eqNullSafe(F.col("_hot")),
        "left",
    )
    salt = _salt_of(left, F.coalesce("_salts", F.lit(1)))
    return marked.select("l.*", salt.alias(_SALT))


def _salt_of(left: DataFrame, salts: Column) -> Column:
    """From the whole row, so that a task run again gives the same salts."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), salts).cast("bigint")
