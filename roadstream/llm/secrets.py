"""Secrets in texts: certain ones by their form, parts of credentials where complementary parts meet.

Certain parts are assignments to secret names, access key ids and long hex strings. Weak candidates are user names and
client ids, opaque strings, and endpoints. Each part has a scope of `REACH` code points to both sides. A weak candidate is
reported only if a part of another role (identifier, secret, endpoint) lies in its scope; this is an interval join by row
and cell of `REACH` code points. A weak candidate that overlaps a certain part is not reported.

Everything is DataFrame functions. A match's position is summed from the lengths of what the matches leave and of the
matches themselves; only the parts found are shuffled, never texts, and a cell holds few parts however long its text is.

Defined results: a null text is empty; positions are code points, the end exclusive; rows are independent, repeated ones
agree; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.common import stored, whole_text

REACH = 200


def either(word: str) -> str:
    """The word with its letters in either case, in any regular expression dialect."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
_SECRET_NAMES = f"({'|'.join(map(either, ('password', 'passwd', 'secret', 'token')))}|{either('api')}_?{either('key')})"
_USER_NAMES = f"({either('user')}_?{either('name')}|{either('user')}|{either('login')}|{either('client')}_?{either('id')}|{either('account')}_?{either('id')})"
_SCHEMES = "(https?|s?ftp|ssh|s3|ldaps?|postgres|postgresql|mysql|mongodb|redis|amqps?)"

#: kind: (role, expression, group whose length counts, least length, what else the match must contain). The first three are
#: certain, in the order in which equal starts are listed.
KINDS: dict[str, tuple[str, str, int, int, tuple[str, ...]]] = {
    "assign": ("secret", _SECRET_NAMES + _GIVEN + r"([A-Za-z0-9+/_.=-]+)", 2, 8, ()),
    "access": ("identifier", r"AKIA[A-Z0-9]+", 0, 16, ()),
    "hex": ("secret", r"[0-9a-f]{32,}", 0, 32, ()),
    "user": ("identifier", _USER_NAMES + _GIVEN + r"([A-Za-z0-9@._+-]+)", 2, 3, ()),
    "opaque": ("secret", r"[A-Za-z0-9+/_=-]{20,}", 0, 20, ("[0-9]", "[a-z]", "[A-Z]")),
    "endpoint": ("endpoint", _SCHEMES + r"://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+", 0, 8, ()),
}
CERTAIN = ("assign", "access", "hex")


def _matches(kind: str) -> Column:
    """The matches of a kind as (gap, size, good): the code points before one since the last, its own, whether it counts."""
    _, expression, group, least, contains = KINDS[kind]
    text = F.col("text")
    found = F.regexp_extract_all(text, F.lit(expression), 0)
    counting = F.regexp_extract_all(text, F.lit(expression), group) if group else found
    gaps = F.transform(F.split(text, expression, -1), F.length)

    def one(pair):
        good = F.length(pair["counting"]) >= least
        for x in contains:
            good = good & pair["found"].rlike(x)
        return F.struct(pair["gap"].alias("gap"), F.length(pair["found"]).alias("size"), good.alias("good"))

    zipped = F.arrays_zip(found.alias("found"), counting.alias("counting"), F.slice(gaps, 1, F.size(found)).alias("gap"))
    none = F.array().cast("array<struct<gap:int,size:int,good:boolean>>")
    return F.when(text.rlike(expression), F.transform(zipped, one)).otherwise(none)


def parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents as (rid, doc_id), and all parts as (rid, kind, start, end)."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    scanned = stored(text.select(F.monotonically_increasing_id().alias("rid"), "doc_id", *(_matches(k).alias(k) for k in KINDS)), "scanned")
    by_kind = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("matches")) for k in KINDS))
    each = (
        scanned.select("rid", F.explode(by_kind).alias("of")).select("rid", "of.kind", F.posexplode("of.matches").alias("at", "match"))
        .select("rid", "kind", "at", "match.*")
    )
    upto = Window.partitionBy("rid", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.col("size")).over(upto)
    found = each.select("rid", "kind", (end - F.col("size")).alias("start"), end.alias("end"), "good").where("good").drop("good")
    return scanned.select("rid", "doc_id"), stored(found, "parts")


def _cells(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(F.floor(first / REACH), F.floor(last / REACH))).alias("cell")


def linked(found: DataFrame) -> DataFrame:
    """The weak candidates that overlap no certain part and have a part of another role in their scope."""
    role = F.create_map(*(F.lit(x) for k, v in KINDS.items() for x in (k, v[0])))[F.col("kind")]
    every = found.withColumn("role", role)
    placed = every.select(
        "rid", F.col("kind").alias("k"), F.col("role").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"),
        _cells(F.col("start"), F.col("end") - 1))
    weak = every.where(~F.col("kind").isin(*CERTAIN))
    free = weak.select("*", _cells(F.col("start"), F.col("end") - 1)).alias("w").join(
        placed.where(F.col("k").isin(*CERTAIN)), ["rid", "cell"]).where("s < end AND e > start")
    weak = weak.join(free.select("rid", "kind", "start").distinct(), ["rid", "kind", "start"], "left_anti")
    scope = weak.select("*", _cells(F.col("start") - REACH, F.col("end") - 1 + REACH))
    met = scope.join(
        placed, (scope["rid"] == placed["rid"]) & (scope["cell"] == placed["cell"]) & (F.col("r") != F.col("role"))
        & (F.col("s") < F.col("end") + REACH) & (F.col("e") > F.col("start") - REACH), "left_semi")
    return met.select("rid", "kind", "start", "end").distinct()


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    rows, found = parts(docs)
    order = F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)))
    spans = found.where(F.col("kind").isin(*CERTAIN)).union(linked(found)).groupBy("rid").agg(
        F.array_sort(F.collect_list(F.struct("start", order[F.col("kind")].alias("rank"), "end", "kind"))).alias("all"))
    certain = F.filter("all", lambda x: x["rank"] < len(CERTAIN))
    listed = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    number = lambda kind: F.coalesce(F.size(F.filter("all", lambda x: x["kind"] == kind)), F.lit(0)).cast("long")
    return rows.join(spans, "rid", "left").withColumn("all", F.coalesce("all", F.array().cast(spans.schema["all"].dataType))).select(
        "doc_id", *(number(k).alias(f"n_{k}") for k in CERTAIN),
        F.sha2(listed(certain), 256).alias("base_sha256"), listed(F.col("all")).alias("spans"))


def _sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    kinds = []
    for i, (kind, (role, expression, group, least, contains)) in enumerate(KINDS.items()):
        more = "".join(f" AND regexp_matches(m[i], {quote(x)})" for x in contains)
        kinds.append(f"""
            SELECT rid, {quote(kind)} AS kind, {i} AS rank, {quote(role)} AS role, {"true" if kind in CERTAIN else "false"} AS certain,
                coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s,
                length(m[i]) AS z
            FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
                SELECT rid, string_split_regex(t, {quote(expression)}) AS p, regexp_extract_all(t, {quote(expression)}, 0) AS m,
                    regexp_extract_all(t, {quote(expression)}, {group}) AS g FROM d))
            WHERE length(g[i]) >= {least}{more}""")
    return f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
        f AS (SELECT rid, kind, rank, role, certain, s, s + z AS e FROM ({" UNION ALL ".join(kinds)})),
        k AS (SELECT * FROM f WHERE certain OR (
            NOT EXISTS (SELECT 1 FROM f b WHERE b.rid = f.rid AND b.certain AND b.s < f.e AND b.e > f.s)
            AND EXISTS (SELECT 1 FROM f b WHERE b.rid = f.rid AND b.role <> f.role AND b.s < f.e + {REACH} AND b.e > f.s - {REACH}))),
        a AS (SELECT rid, {", ".join(f"count(*) FILTER (kind = {quote(x)}) AS n_{x}" for x in CERTAIN)},
            string_agg(concat(kind, ':', s::BIGINT, ':', e::BIGINT), ',' ORDER BY s, rank) FILTER (certain) AS base,
            string_agg(concat(kind, ':', s::BIGINT, ':', e::BIGINT), ',' ORDER BY s, rank) AS spans FROM k GROUP BY rid)
        SELECT doc_id, {", ".join(f"coalesce(n_{x}, 0) AS n_{x}" for x in CERTAIN)}, sha256(coalesce(base, '')) AS base_sha256,
            coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (rid)"""


SQL = _sql()
