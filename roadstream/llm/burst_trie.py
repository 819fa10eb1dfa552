"""Prefix trie of conversations, built by burst tries.

A conversation is a path of turn ids; a node is a distinct beginning of some. All conversations start in one container under
the root. A container of more than `LIMIT` turns is burst: the turns that all its members share become a chain of nodes, and
the members are dealt by their next turn id into new containers under the end of that chain. When no container is too large,
each is brought to one task, its members are sorted, and one sweep over them yields its nodes. Sums over subtrees are then
handed up from containers to the heads above them, level by level.

A turn is a row throughout: no conversation is gathered into one value, and a container of one member, however long, needs
neither a burst nor a task of its own. Bursts and sums are pre-combined aggregations and joins that Spark can split. The
conversations that end in one burst node are written as runs of decimal text, so that the task that takes their digest, which
can only be taken in order, reads few rows.

`rebuilt` gives conversations a shared beginning: c takes its first h turns from conversation c - c % 5, h = crc32(c) % 9.

Defined results: turns go by `turn`, null first, and equal ones by a digest of role and text; a null role or text is empty;
repeated rows are turns of their own; rows with a null conv_id belong to no conversation and are left out; texts are only
digested, so their length does not matter; an empty table gives an empty result, without a root; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.common import ship, stored
from roadstream.operators.ordered import ordered, total

#: Turns of a container that is not burst.
LIMIT = 8192
#: Conversation ids of one run of text.
RUN = 8192
#: How turns are shared: blocks of conversations, and turns taken at most, plus one.
BLOCK, SHARED = 5, 9

NODES = ("level int, up bigint, top boolean, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
         "n_leaves bigint, saved_tokens bigint, ends binary")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), size (UTF-8 bytes of the text) and the turn's id, 128 bits as two numbers."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = stored(
        conversations.where("conv_id IS NOT NULL").select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), digest.alias("digest"),
            F.octet_length(text).cast("long").alias("size")),
        "turns")
    return ordered(rows, ["conv_id"], ["turn", "digest"]).scan(pos=total(F.lit(1))).result().select(
        "conv_id", F.col("pos").cast("long").alias("pos"), "size",
        F.xxhash64("digest").alias("hi"), F.xxhash64(F.lit(1), "digest").alias("lo"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """The paths: conv_id, pos, size, hi, lo, len. Each conversation also has a row of position 0, for the root."""
    own = stored(turns(conversations), "places")
    lens = own.groupBy("conv_id").agg(F.max("pos").alias("len"))
    base = F.col("conv_id") - F.col("conv_id") % BLOCK
    bases = lens.select(F.col("conv_id").alias("base"), F.col("len").alias("base_len"))
    share = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).alias("h")
    plan = stored(
        lens.select("conv_id", "len", share, base.alias("base")).join(bases, "base", "left")
        .withColumn("taken", F.least(F.col("h"), F.coalesce("base_len", F.lit(0))))
        .select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("len") - F.col("h"), F.lit(0))).alias("len")),
        "plan")
    first = own.where((F.col("conv_id") % BLOCK == 0) & (F.col("pos") < SHARED)).withColumnRenamed("conv_id", "base")
    shared = plan.join(first, "base").where("pos <= taken").select("conv_id", "pos", "size", "hi", "lo", "len")
    rest = own.join(plan, "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "size", "hi", "lo", "len")
    zero = F.lit(0).cast("long")
    return plan.select("conv_id", zero.alias("pos"), zero.alias("size"), zero.alias("hi"), zero.alias("lo"), "len").unionByName(
        shared).unionByName(rest)


def trie(paths: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of the trie of `paths`: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    ship(paths.sparkSession)
    paths = stored(paths, "paths")
    whole = paths.where("pos = 0").agg(F.min("conv_id").alias("head"), F.count("*").alias("n"), F.sum(F.col("len") + 1).alias("rows")).first()
    root = paths.where("pos = 0").select(
        "conv_id", F.lit(0).alias("level"), F.lit(None).cast("long").alias("up"), F.lit(whole["head"]).cast("long").alias("head"),
        F.lit(0).cast("long").alias("depth"), F.lit(whole["n"]).alias("n"))
    bursts, finals = [], []
    if whole["n"] < 2 or whole["rows"] <= limit:
        finals.append(root)
    else:
        heads = stored(root.where("conv_id = head").drop("conv_id"), "heads")
        active = paths.withColumn("head", F.when(F.col("pos").isNotNull(), F.lit(whole["head"])))  # no literal, to stay an equi-join
        while True:
            level = len(bursts)
            bursts.append(_burst(active, heads, level))
            members = bursts[-1]["members"]
            large = (F.col("n") > 1) & (F.col("rows") > limit)
            finals.append(members.where(~large).drop("rows"))
            grown = members.where(large)
            heads = stored(grown.where("conv_id = head").drop("conv_id", "rows"), "heads")
            if heads.isEmpty():
                break
            active = stored(
                active.drop("head").join(grown.select("conv_id", "head", "depth"), "conv_id").where("pos >= depth").drop("depth"), "active")
    placed = stored(paths.join(reduce(DataFrame.unionByName, finals), "conv_id").where("pos >= depth"), "placed")
    swept = stored(_sweep(placed.where("n > 1")).unionByName(_single(placed.where("n = 1"))), "swept")
    nodes = swept.drop("level", "up", "top")
    if bursts:
        nodes = nodes.unionByName(_chains(bursts, swept))
    ends = F.coalesce(F.lower(F.hex("ends")), F.sha2(F.lit(b""), 256))
    return nodes.withColumn("ends", ends).withColumnRenamed("ends", "ends_sha256")


def _burst(active: DataFrame, heads: DataFrame, level: int) -> dict[str, DataFrame]:
    """One level: the chains of the burst containers, the members that end there, and the new containers of the others."""
    at = active.groupBy("head", "pos").agg(
        F.count("*").alias("here"), F.min("hi").alias("hi"), F.max("hi").alias("hi2"), F.min("lo").alias("lo"), F.max("lo").alias("lo2"),
        F.max("size").alias("size"))
    at = stored(at.join(heads, "head"), "positions")
    parts = (F.col("here") < F.col("n")) | (F.col("hi") != F.col("hi2")) | (F.col("lo") != F.col("lo2"))
    ends = stored(
        at.groupBy("head", "level", "up", "depth", "n").agg(
            F.coalesce(F.min(F.when(parts, F.col("pos"))) - 1, F.max("pos")).alias("upto")),
        "heads_upto")
    known = ends.select("head", "upto")
    here = active.join(known, "head")
    stepped = here.where(F.col("pos") == F.col("upto") + 1).select(
        F.col("head").alias("up"), "conv_id", "len", F.col("pos").alias("depth"), "hi", "lo")
    groups = stored(
        stepped.groupBy("up", "hi", "lo").agg(
            F.min("conv_id").alias("head"), F.count("*").alias("n"), F.sum(F.col("len") - F.col("depth") + 1).alias("rows")),
        "containers")
    return {
        "ends": ends,
        "chain": at.join(known, "head").where("pos <= upto").select(F.lit(level).alias("level"), "head", "pos", "size"),
        "ended": here.where((F.col("pos") == F.col("upto")) & (F.col("len") == F.col("upto"))).select(
            F.lit(level).alias("level"), "head", "conv_id"),
        "members": stored(
            stepped.join(groups, ["up", "hi", "lo"]).select(
                "conv_id", F.lit(level + 1).alias("level"), "up", "head", "depth", "n", "rows"),
            "members"),
    }


def _chains(bursts: list[dict[str, DataFrame]], swept: DataFrame) -> DataFrame:
    """The nodes of burst containers, with the sums of all that lies below them."""
    tops = swept.where("top AND up IS NOT NULL").groupBy("level", "up").agg(
        F.count("*").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("below"))
    tops = stored(tops, "tops")
    chain = stored(reduce(DataFrame.unionByName, [b["chain"] for b in bursts]), "chain")
    lengths = stored(chain.groupBy("level", "head").agg(F.sum("size").alias("sizes")), "chain_sums")
    totals, under = [], None
    for level in reversed(range(len(bursts))):
        kids = tops.where(F.col("level") == level + 1).drop("level")
        if under is not None:
            kids = kids.unionByName(under.groupBy("up").agg(
                F.count("*").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("below")))
        kids = kids.groupBy(F.col("up").alias("head")).agg(
            F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("below").alias("below"))
        own = bursts[level]["ends"].join(lengths.where(F.col("level") == level).drop("level"), "head").join(kids, "head", "left")
        below = F.coalesce("below", F.lit(0))
        under = stored(
            own.select(
                "level", "head", "up", "depth", "upto", "n", "sizes", F.coalesce("kids", F.lit(0)).alias("kids"),
                F.coalesce("leaves", F.lit(1)).alias("leaves"), below.alias("below"),
                (below + (F.col("n") - 1) * F.col("sizes")).alias("saved")),
            "head_totals")
        totals.append(under)
    heads = reduce(DataFrame.unionByName, totals)
    ended = _digests(reduce(DataFrame.unionByName, [b["ended"] for b in bursts]))
    summed = ordered(chain, ["level", "head"], ["pos"]).scan(upto_here=total(F.col("size"))).result()
    rest = F.col("sizes") - F.col("upto_here") + F.col("size")
    last = F.col("pos") == F.col("upto")
    return summed.join(heads, ["level", "head"]).join(ended, ["level", "head"], "left").select(
        F.col("head").alias("conv_id"), F.col("pos").alias("depth"),
        F.when(F.col("pos") == F.col("depth"), F.col("up")).otherwise(F.col("head")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("kids")).otherwise(F.lit(1)).alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("below") + (F.col("n") - 1) * rest).alias("saved_tokens"),
        F.when(last, F.col("digest")).alias("ends"))


def _digests(ended: DataFrame) -> DataFrame:
    """level, head, digest of the conv_ids joined by commas, ascending."""
    key = ["level", "head"]
    rows = stored(ended, "ended")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ids = None, []

        def run() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([own[0]], pa.int32()), pa.array([own[1]], pa.int64()), pa.array([ids[0]], pa.int64()),
                 pa.array([",".join(map(str, ids))], pa.string())], [*key, "first", "ids"])

        for batch in batches:
            for *now, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if now != own or len(ids) == RUN:
                    if ids:
                        yield run()
                    own, ids = now, []
                ids.append(conv)
        if ids:
            yield run()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, digest = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([own[0]], pa.int32()), pa.array([own[1]], pa.int64()), pa.array([digest.digest()], pa.binary())], [*key, "digest"])

        for batch in batches:
            for *now, ids in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3))):
                if now == own:
                    digest.update(b"," + ids.encode())
                    continue
                if own:
                    yield row()
                own, digest = now, sha256(ids.encode())
        if own:
            yield row()

    in_runs = rows.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(
        runs, "level int, head bigint, first bigint, ids string")
    return in_runs.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(joined, "level int, head bigint, digest binary")


def _single(placed: DataFrame) -> DataFrame:
    """The nodes of containers of one member: its turns."""
    top, last = F.col("pos") == F.col("depth"), F.col("pos") == F.col("len")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    return placed.select(
        "level", "up", top.alias("top"), "conv_id", F.col("pos").alias("depth"),
        F.when(top, F.col("up")).otherwise(F.col("conv_id")).alias("parent_conv_id"), one.alias("n_convs"),
        F.when(last, zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(last, F.unhex(F.sha2(F.col("conv_id").cast("string"), 256))).alias("ends"))


def _sweep(placed: DataFrame) -> DataFrame:
    """The nodes of the other containers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in NODES.split(", ")]
        kinds = [pa.int32(), pa.int64(), pa.bool_(), *[pa.int64()] * 7, pa.binary()]
        own, members, out = None, [], []

        def table() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("head", "level", "up", "depth", "conv_id", "size", "hi", "lo"))
            for head, level, up, depth, conv, size, hi, lo in zip(*columns):
                if own is None or head != own[0]:
                    if own:
                        out += swept(members, *own[1:])
                    own, members = (head, level, up, depth), []
                    if len(out) > 20_000:
                        yield table()
                if not members or members[-1][1] != conv:
                    members.append(([], conv, []))
                members[-1][0].append((hi, lo))
                members[-1][2].append(size)
        if own:
            out += swept(members, *own[1:])
        if out:
            yield table()

    columns = ["head", "level", "up", "depth", "conv_id", "size", "hi", "lo"]
    rows = placed.select(*columns, "pos").repartition("head").sortWithinPartitions("head", "conv_id", "pos")
    return rows.select(*columns).mapInArrow(run, NODES)


class Node:
    """A node while the sweep is below it."""

    __slots__ = ("above", "conv", "depth", "ends", "kids", "leaves", "n", "saved", "size")

    def __init__(self, above: Node | None, depth: int, size: int):
        self.above, self.depth, self.size = above, depth, size
        self.conv, self.n, self.kids, self.leaves, self.saved, self.ends = None, 0, 0, 0, 0, []

    def close(self) -> None:
        """All below is known: the sums are complete, and count above."""
        if self.ends:
            self.n += len(self.ends)
            self.conv = self.ends[0] if self.conv is None else min(self.conv, self.ends[0])
        self.leaves = self.leaves or 1
        self.saved += (self.n - 1) * self.size
        if above := self.above:
            above.n += self.n
            above.kids += 1
            above.leaves += self.leaves
            above.saved += self.saved
            above.conv = self.conv if above.conv is None else min(above.conv, self.conv)


def swept(members: list[tuple[list, int, list[int]]], level: int, up: int | None, depth: int) -> Iterator[tuple]:
    """Rows of the nodes of one container. Members (turn ids, conv_id, sizes) come by conv_id and share their first turn id."""
    nodes, open_, before = [], [], []
    for path, conv, sizes in sorted(members, key=lambda m: m[0]):
        same = 0
        for a, b in zip(before, path):
            if a != b:
                break
            same += 1
        while len(open_) > same:
            open_.pop().close()
        for i in range(same, len(path)):
            open_.append(Node(open_[-1] if open_ else None, depth + i, sizes[i]))
            nodes.append(open_[-1])
        open_[-1].ends.append(conv)
        before = path
    while open_:
        open_.pop().close()
    for x in nodes:
        ends = sha256(",".join(map(str, x.ends)).encode()).digest() if x.ends else None
        parent = x.above.conv if x.above else up
        yield level, up, x.above is None, x.conv, x.depth, parent, x.n, x.kids, x.leaves, x.saved, ends


def prefix_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The trie of the rebuilt conversations."""
    ship(conversations.sparkSession)
    return trie(rebuilt(conversations), limit)


#: CRC-32 of a text, bit by bit.
_CRC = """
    list_reduce([4294967295::BIGINT] || list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT),
        lambda a, b: list_reduce([xor(a, b)] || range(8), lambda x, i: xor(x // 2, (x % 2) * 3988292384)))"""
SQL = f"""
    WITH t AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(
                octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
        FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295, {_CRC.format('conv_id::VARCHAR')}) % 9 AS h FROM t),
    r AS (
        SELECT c.conv_id, 0 AS part, t.pos, t.id, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
        UNION ALL SELECT c.conv_id, 1, t.pos, t.id, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
    p AS (
        SELECT conv_id, octet_length(encode(text)) AS size,
            row_number() OVER w AS depth, sha256(string_agg(id, ',') OVER w) AS node FROM r
        WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
        UNION ALL SELECT conv_id, 0, 0, '' FROM c),
    n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size FROM p GROUP BY node, depth),
    l AS (SELECT conv_id, max(depth) AS len FROM p GROUP BY conv_id),
    e AS (SELECT p.node, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ends FROM p JOIN l ON l.conv_id = p.conv_id AND l.len = p.depth GROUP BY p.node),
    up AS (SELECT DISTINCT a.node, b.node AS above FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.depth = a.depth - 1),
    kids AS (SELECT above AS node, count(*) AS n_children FROM up GROUP BY above),
    under AS (SELECT DISTINCT a.node, b.node AS below FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
    sums AS (
        SELECT u.node, count(*) FILTER (k.node IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved_tokens
        FROM under u JOIN n ON n.node = u.below LEFT JOIN kids k ON k.node = u.below GROUP BY u.node)
    SELECT n.conv_id, n.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
        s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ends, '')) AS ends_sha256
    FROM n JOIN sums s ON s.node = n.node LEFT JOIN up ON up.node = n.node LEFT JOIN n a ON a.node = up.above
    LEFT JOIN kids k ON k.node = n.node LEFT JOIN e ON e.node = n.node"""
