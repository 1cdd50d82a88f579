"""Conversation prefix trie by prefix doubling: blocks of turns get dense names in logarithmically many rounds, and prefixes are lists of names."""

from __future__ import annotations

import hashlib
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rows import numbered
from .common import cut, written

#: Of a node's ids, as many bytes of text are put together before they're hashed.
PIECE_BYTES = 1 << 20


def named(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, name): the distinct keys of df, numbered from 0 without gaps.

    The distinct rows are written once; a row's number is its place in its partition plus what the partitions before hold, of which there is
    one figure each.
    """
    rows = cut(df.select(*keys).distinct()).select(*keys, F.spark_partition_id().alias("g_part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("g_place"))
    sizes = sorted((r["g_part"], r["count"]) for r in rows.groupBy("g_part").count().collect())  # a figure a partition
    before, starts = 0, []
    for part, n in sizes:
        starts.append((part, before))
        before += n
    starts = df.sparkSession.createDataFrame(starts, "g_part int, g_before long")
    return rows.join(F.broadcast(starts), "g_part").select(*keys, (F.col("g_before") + F.col("g_place")).alias(name))


def plain_turns(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, digest, bytes): each turn's place in its conversation, from 0, by turn with null first and then by digest; a SHA-256
    of role and text, which are empty where null; and the text's bytes. Rows without a conversation's id are left out."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = convs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    return numbered(rows, ["conv"], ["turn", "digest"], "pos").drop("turn")


def rebuilt(turns: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(conversations (conv, n), turns (conv, pos, digest, bytes)) rebuilt from plain_turns.

    Conversation c has the first h turns of c - c % group (all if it has fewer, none if it isn't there), then its own after the first h, with h =
    crc32(c in decimal) % most. So only the first few turns of a conversation are copied, to `group` others at most.
    """
    conv = F.col("conv")
    sizes = turns.groupBy("conv").agg(F.count("*").alias("own"))
    convs = sizes.select("conv", "own", (F.crc32(conv.cast("string").cast("binary")) % most).cast("long").alias("h"), (conv - conv % group).alias("base"))
    have = sizes.select(F.col("conv").alias("base"), F.col("own").alias("base_turns"))
    convs = convs.join(have, "base", "left").select("conv", "own", "h", F.least(F.col("h"), F.coalesce("base_turns", F.lit(0))).alias("head"))
    convs = written(convs)
    near = F.filter(F.sequence(conv - (group - 1), conv + (group - 1)), lambda c: c - c % group == conv)
    heads = turns.where((conv % group == 0) & (F.col("pos") < most - 1)).select(F.explode(near).alias("conv"), "pos", "digest", "bytes")
    heads = heads.join(convs, "conv").where("pos < h").select("conv", "pos", "digest", "bytes")
    tails = turns.join(convs, "conv").where("pos >= h").select("conv", (F.col("head") + F.col("pos") - F.col("h")).alias("pos"), "digest", "bytes")
    return convs.select("conv", (F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")), written(heads.unionByName(tails))


def named_blocks(turns: DataFrame) -> DataFrame:
    """(conv, level, block, name): of every conversation the blocks of 2 ** level turns that begin at a multiple of that.

    Blocks of a level have the same name if and only if they hold the same turns: a name stands for a pair of names of the
    level before. Each round joins names of half as many rows; a name that very many rows have is one row on one side.
    """
    names = named(turns, ["digest"], "name")
    level = written(turns.join(names, "digest").select("conv", F.col("pos").alias("block"), "name"))
    out = level.select("conv", F.lit(0).alias("level"), "block", "name")
    for k in count(1):
        even = F.col("block") % 2 == 0
        halves = level.groupBy("conv", F.floor(F.col("block") / 2).alias("block")).agg(F.max(F.when(even, F.col("name"))).alias("left"), F.max(F.when(~even, F.col("name"))).alias("right"))
        halves = written(halves.where("left is not null and right is not null"))
        if halves.isEmpty():
            return out
        level = written(halves.join(named(halves, ["left", "right"], "name"), ["left", "right"]).select("conv", "block", "name"))
        out = out.unionByName(level.select("conv", F.lit(k).alias("level"), "block", "name"))


def prefixes(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, key) for every depth from 0 to a conversation's length: key lists the names of the blocks, largest first, that the
    depth's binary digits stand for. Prefixes of a depth are equal if and only if their keys are.

    An even block of a level ends the part of a prefix that the digits from the level upward stand for, in 2 ** level depths.
    """
    step = F.expr("shiftleft(1L, level)")
    used = blocks.where("block % 2 = 0").select("conv", "level", "name", (step * (F.col("block") + 1)).alias("low"), (step * (F.col("block") + 2) - 1).alias("high"))
    used = used.join(convs, "conv").withColumn("high", F.least("high", "n"))
    spread = used.select("*", F.explode(F.expr("sequence(low, high, 4096L)")).alias("at"))  # in two turns: no row holds all depths of a large block
    spread = spread.select("conv", "level", "name", F.explode(F.sequence("at", F.least(F.col("at") + 4095, F.col("high")))).alias("depth"))
    keys = spread.groupBy("conv", "depth").agg(F.transform(F.sort_array(F.collect_list(F.struct("level", "name")), asc=False), lambda x: x["name"]).alias("key"))
    return keys.unionByName(convs.select("conv", F.lit(0).cast("long").alias("depth"), F.array().cast("array<long>").alias("key")))


def ends_digests(ends: DataFrame) -> DataFrame:
    """(node, digest) of (node, conv): the SHA-256 in hex of a node's conversations in decimal, ascending, with commas between.

    Rows are ranged by node and conversation, so a node with many of them is spread out; each task joins a node's ids to texts of about
    PIECE_BYTES, and only these texts come together, in a stream that a task hashes as it reads.
    """

    def pieces(batches):
        for b in batches:
            node, at = b.column(0).to_numpy(), 0
            convs = b.column(1).to_pylist()
            while at < len(node):
                end, size = at, 0
                while end < len(node) and node[end] == node[at] and size < PIECE_BYTES:
                    size += 20
                    end += 1
                yield pa.RecordBatch.from_arrays([pa.array([node[at]], pa.int64()), pa.array([convs[at]], pa.int64()), pa.array([",".join(map(str, convs[at:end]))])], ["node", "first", "ids"])
                at = end

    def hashes(batches):
        now, h = None, None
        done: list[tuple[int, str]] = []
        for b in batches:
            for node, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if node != now:
                    if h is not None:
                        done.append((now, h.hexdigest()))
                    now, h = node, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done])], ["node", "digest"])
                done = []
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([h.hexdigest()])], ["node", "digest"])

    dealt = ends.select("node", "conv").repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    texts = dealt.mapInArrow(pieces, "node long, first long, ids string")
    return texts.repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(hashes, "node long, digest string")


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """(node, leaves, saved) of (node, up, leaves, saved): each node's sums over its subtree, itself included.

    By pointer doubling: after k rounds a node has the sums of the 2 ** k levels that begin with it and knows its ancestor
    2 ** k levels up; a round adds the sums of those whose ancestor it is, and doubles the step. What is added to a node is summed
    up in every task first. It ends when nobody has an ancestor so far up, after as many rounds as the depth has digits.
    """
    now = written(nodes)
    while not now.where("up is not null").isEmpty():
        below = now.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        hops = now.where("up is not null").select(F.col("node").alias("up"), F.col("up").alias("next"))
        summed = now.join(below, "node", "left").select("node", "up", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))
        now = written(summed.join(hops, "up", "left").select("node", F.col("next").alias("up"), "leaves", "saved"))
    return now.select("node", "leaves", "saved")


def prefix_trie(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The trie of the rebuilt conversations, a row for each distinct sequence of first turns, the empty one included: conv_id (the
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A null role or text counts as empty; turns with the same number are taken by the digest of role and text; equal rows are a turn each. Rows
    without a conversation's id belong to none and are left out. A table without conversations gives no rows, not even a root. Columns
    but the four named take no part. Texts are read once, for their digests; what is shuffled after that is numbers.
    Below a node of one conversation lies a single path, so the sums go over the nodes of several conversations only.
    """
    members, turns = rebuilt(plain_turns(convs, id_col, turn_col, role_col, text_col))
    members = written(members)
    keys = written(prefixes(named_blocks(turns), members))
    groups = keys.groupBy("depth", "key").agg(F.min("conv").alias("first"), F.count("*").alias("n_convs"))
    nodes = written(groups.select("depth", "key", "first", "n_convs", F.monotonically_increasing_id().alias("node")))
    places = written(keys.join(nodes.select("depth", "key", "node"), ["depth", "key"]).select("conv", "depth", "node"))
    # a node's parent is where its smallest member is one turn earlier
    above = places.select(F.col("conv").alias("first"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("up"))
    last = turns.select(F.col("conv").alias("first"), (F.col("pos") + 1).alias("depth"), "bytes")
    tree = nodes.select("node", "depth", "first", "n_convs").join(above, ["first", "depth"], "left").join(last, ["first", "depth"], "left")
    tree = written(tree)
    one = (F.col("n_convs") == 1).cast("long")
    children = written(tree.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("n_children"), F.sum(one).alias("n_single")))
    tree = tree.join(children, "node", "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "n_single": F.coalesce("n_single", F.lit(0))})
    tree = written(tree)
    shared = tree.where("n_convs > 1").select("node", "up", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_single")).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.coalesce("bytes", F.lit(0))).alias("saved"))
    sums = subtree_sums(shared)
    ends = ends_digests(places.join(members.withColumnRenamed("n", "depth"), ["conv", "depth"]))
    parents = tree.select(F.col("node").alias("up"), F.col("first").alias("parent_conv_id"))
    out = tree.join(parents, "up", "left").join(sums, "node", "left").join(ends, "node", "left")
    return out.select(
        F.col("first").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"), F.coalesce("saved", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


#: The same rows in DuckDB, with whole prefixes as keys and sums over all descendants.
SQL = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c0 AS (SELECT conv_id, count(*) AS own, xor(4294967295, list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(conv_id::varchar, ''), lambda x: list_concat([ascii(x)::bigint], [-1::bigint, -1, -1, -1, -1, -1, -1, -1])))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 9 AS h, conv_id - conv_id % 5 AS base FROM t GROUP BY conv_id),
c AS (SELECT c0.conv_id, c0.own, c0.h, c0.base, least(c0.h, coalesce(b.own, 0)) AS head FROM c0 LEFT JOIN c0 b ON c0.base = b.conv_id),
r AS (SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL SELECT c.conv_id, c.head + t.pos - c.h, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h),
s AS (SELECT c.conv_id, coalesce(list(struct_pack(role := r.role, text := r.text) ORDER BY r.pos) FILTER (r.pos IS NOT NULL), []) AS turns FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
p AS (SELECT conv_id, len(turns) AS n, turns, unnest(range(0, len(turns) + 1)) AS depth FROM s),
k AS (SELECT conv_id, n, depth, list_slice(turns, 1, depth) AS key FROM p),
n AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (n = depth) AS ends,
  CASE WHEN depth > 0 THEN (count(*) - 1) * strlen(key[depth].text) ELSE 0 END AS own FROM k GROUP BY depth, key),
ch AS (SELECT depth - 1 AS depth, list_slice(key, 1, depth - 1) AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
x AS (SELECT n.*, coalesce(ch.n_children, 0) AS n_children, par.conv_id AS parent_conv_id FROM n LEFT JOIN ch ON n.depth = ch.depth AND n.key = ch.key
  LEFT JOIN n par ON par.depth = n.depth - 1 AND par.key = list_slice(n.key, 1, n.depth - 1)),
d AS (SELECT *, unnest(range(0, depth + 1)) AS top FROM x),
u AS (SELECT top AS depth, list_slice(key, 1, top) AS key, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved FROM d GROUP BY ALL)
SELECT x.conv_id, x.depth, x.parent_conv_id, x.n_convs, x.n_children, u.n_leaves, u.saved::bigint AS saved_tokens, sha256(coalesce(x.ends, '')) AS ends_sha256
FROM x JOIN u ON x.depth = u.depth AND x.key = u.key
"""
