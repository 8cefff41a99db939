"""Prefix trie of conversations, built and rolled up a level at a time.

Turns of a conversation stand in order of `turn` (null first), equal ones in order
of the SHA-256 of role and text; each row is a turn. Conversations are rebuilt
(their first turns are those of the conversation that opens their block), and each
depth is one level: the live conversations are grouped by (parent node, next turn),
and a group is a node, named by its least conv_id. Only conversations of nodes that
several share stay live; the nodes below a node of one conversation are its turns,
read off at once. Levels are then joined in reverse, each to its children's sums.

Turns are told apart by the SHA-256 of role and text, so that texts are read once and
never shuffled. Numbers of turns come from sorted ranges of all turns, so a
conversation of many turns is numbered in several tasks; no conversation and no node
is gathered in one task. Ids of conversations that end at a node are joined in
slices of 65,536 ids and hashed as they pass.

Null roles and texts are empty. Rows without conv_id are left out. Repeated rows are
turns as often as they stand. An empty table has no nodes, not even a root. Other
columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import WORDS, checkpointed, map_batches, read_table

#: Conversations of a block, of which the first opens the others; turns that it can open them with at most.
BLOCK, HEADS = 20, 4
SLICE = 1 << 16
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, d (from 1), digest of role and text, words of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.sha2(told.cast("binary"), 256)).alias("digest"),
        F.size(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))).cast("long").alias("words"),
    )
    order = ["conv_id", "turn", "digest"]
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = checkpointed(dealt.select("conv_id", "digest", "words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("i")))
    ranges = dealt.groupBy("conv_id", "part").agg(F.min("i").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(_running("conv_id", "part")) - F.col("n")  # a row for each range that holds the conversation
    ranges = ranges.select("conv_id", "part", (before - F.col("first") + 1).alias("shift"))
    return dealt.join(ranges, ["conv_id", "part"]).select("conv_id", (F.col("i") + F.col("shift")).alias("d"), "digest", "words")


def _running(key: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and a row for each: conv_id, size."""
    turns = checkpointed(turns)
    sizes = checkpointed(turns.groupBy("conv_id").agg(F.max("d").alias("size")))
    opener = F.col("conv_id") - F.col("conv_id") % BLOCK
    openers = sizes.select(F.col("conv_id").alias("opener"), F.col("size").alias("opener_size"))
    plans = sizes.withColumn("head", head_length(F.col("conv_id"))).withColumn("opener", opener).join(openers, "opener", "left")
    plans = plans.withColumn("taken", F.least("head", F.coalesce("opener_size", F.lit(0)))).withColumn("own", F.greatest(F.col("size") - F.col("head"), F.lit(0)))
    plans = checkpointed(plans.select("conv_id", "opener", "head", "taken", "own"))
    own = turns.join(plans, "conv_id").where("d > head").select("conv_id", (F.col("d") - F.col("head") + F.col("taken")).alias("d"), "digest", "words")
    heads = turns.where(F.col("d") < HEADS).withColumnRenamed("conv_id", "opener").join(plans, "opener").where("d <= taken").select("conv_id", "d", "digest", "words")
    return own.union(heads), plans.select("conv_id", (F.col("taken") + F.col("own")).alias("size"))


def ends_hashed(ends: DataFrame) -> DataFrame:
    """From rows of depth, node, conv_id: depth, node and the SHA-256 of the ids in order, comma-joined."""
    # distinct ids of a slice are bounded in number
    joined = ends.groupBy("depth", "node", F.floor(F.col("conv_id") / SLICE).alias("slice")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    order = ["depth", "node", "slice"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["depth", "node", "ends_sha256"]
        made = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], names=names)
        of, state = None, None
        for batch in batches:
            rows = []
            for depth, node, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "node", "ids")), strict=True):
                if (depth, node) != of:
                    if of:
                        rows.append((*of, state.hexdigest()))
                    of, state = (depth, node), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield made(rows)
        if of:
            yield made([(*of, state.hexdigest())])

    return joined.repartition("depth", "node").sortWithinPartitions(*order).transform(map_batches, run, "depth long, node long, ends_sha256 string")


def levels_of(turns: DataFrame, convs: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """A table of nodes for each depth from 1 (id, node of the parent, n, words, and of nodes of one conversation its size), and tables of the ends at shared nodes (depth, node, conv_id)."""
    root = convs.agg(F.min("conv_id")).first()[0]
    ends = [convs.where("size = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("node"), "conv_id")]
    live = convs.where("size > 0").select("conv_id", F.lit(root).cast("long").alias("node"), "size")
    levels: list[DataFrame] = []
    while not live.isEmpty():
        depth = len(levels) + 1
        at = turns.where(F.col("d") == depth).join(live, "conv_id")
        nodes = at.groupBy("node", "digest").agg(F.min("conv_id").alias("id"), F.count("*").alias("n"), F.min("words").alias("words"), F.max("size").alias("size"))
        nodes = checkpointed(nodes)
        levels.append(nodes)
        shared = nodes.where("n > 1").select("node", "digest", "id")
        members = checkpointed(at.select("conv_id", "node", "digest", "size").join(shared, ["node", "digest"]).select("conv_id", F.col("id").alias("node"), "size"))
        ends.append(members.where(F.col("size") == depth).select(F.lit(depth).cast("long").alias("depth"), "node", "conv_id"))
        live = members.where(F.col("size") > depth)
    return levels, ends


def rolled_up(levels: list[DataFrame], convs: DataFrame) -> DataFrame:
    """The root and the nodes of all levels, with what their subtrees hold; NODE without the hash."""
    sums = lambda of: of.groupBy(F.col("parent_conv_id").alias("parent")).agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))

    def with_children(nodes: DataFrame, below: DataFrame | None) -> DataFrame:
        """nodes: conv_id, depth, parent_conv_id, n_convs, own (saved by the node itself), lone (its children if it has one conversation)."""
        empty = nodes.sparkSession.createDataFrame([], "parent long, children long, leaves long, saved long")
        both = nodes.join(empty if below is None else sums(below), (F.col("conv_id") == F.col("parent")) & (F.col("n_convs") > 1), "left")
        return both.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("children", "lone").alias("n_children"), F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"), (F.col("own") + F.coalesce("saved", F.lit(0))).alias("saved_tokens"))

    out, below = [], None
    for depth in range(len(levels), 0, -1):
        nodes = levels[depth - 1].select(
            F.col("id").alias("conv_id"), F.lit(depth).cast("long").alias("depth"), F.col("node").alias("parent_conv_id"), F.col("n").alias("n_convs"), ((F.col("n") - 1) * F.col("words")).alias("own"),
            F.when((F.col("n") == 1) & (F.col("size") > depth), 1).otherwise(0).cast("long").alias("lone"),
        )
        below = checkpointed(with_children(nodes, below))
        out.append(below)
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    none = F.lit(None).cast("long")
    root = root.select("conv_id", F.lit(0).cast("long").alias("depth"), none.alias("parent_conv_id"), "n_convs", F.lit(0).cast("long").alias("own"), F.lit(0).cast("long").alias("lone"))
    if below is not None:
        under = below.agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")).first()
        root = root.select("conv_id", "depth", "parent_conv_id", "n_convs", *(F.lit(v).cast("long").alias(n) for n, v in zip(("n_children", "n_leaves", "saved_tokens"), under, strict=True)))
    else:
        root = with_children(root, None)
    return reduce(DataFrame.union, out, root)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node: NODE."""
    turns, convs = rebuilt(numbered_turns(conversations))
    turns, convs = checkpointed(turns), checkpointed(convs)
    levels, ends = levels_of(turns, convs)
    nodes = rolled_up(levels, convs)
    hashed = ends_hashed(reduce(DataFrame.union, ends)).withColumnRenamed("depth", "at")
    own_end = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    nodes = nodes.join(convs.withColumnRenamed("conv_id", "only"), (F.col("conv_id") == F.col("only")) & (F.col("n_convs") == 1), "left")
    nodes = nodes.join(hashed, (F.col("depth") == F.col("at")) & (F.col("conv_id") == F.col("node")), "left")
    ended = F.when(F.col("n_convs") == 1, F.when(F.col("size") == F.col("depth"), own_end)).otherwise(F.col("ends_sha256"))
    nodes = nodes.withColumn("ends_sha256", F.coalesce(ended, F.lit(NOTHING)))
    if not levels:
        return nodes.select(*NODE)
    # below the first node of one conversation, its turns are nodes of their own
    firsts = reduce(DataFrame.union, [level.where("n = 1").select("id", F.lit(k + 1).alias("from"), "size") for k, level in enumerate(levels)])
    tails = turns.join(firsts, (F.col("conv_id") == F.col("id")) & (F.col("d") > F.col("from")))
    number = lambda v: F.lit(v).cast("long")
    last = F.col("d") == F.col("size")
    tails = tails.select(
        "conv_id", F.col("d").alias("depth"), F.col("conv_id").alias("parent_conv_id"), number(1).alias("n_convs"), F.when(last, number(0)).otherwise(number(1)).alias("n_children"), number(1).alias("n_leaves"), number(0).alias("saved_tokens"),
        F.when(last, own_end).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )
    return nodes.select(*NODE).union(tails.select(*NODE))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


ORACLE_SQL = r"""WITH tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN (c & 1) = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
own AS (SELECT conv_id, list({'key': sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')), 'words': len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))}
  ORDER BY turn NULLS FIRST, sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS t FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, own.t, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, b: xor(tab.t[(xor(c, b) & 255) + 1], c >> 8))) % 4 AS h FROM own, tab),
r AS (SELECT h.conv_id, list_concat(coalesce(o.t, [])[1 : h.h], h.t[h.h + 1 :]) AS t FROM h LEFT JOIN own o ON o.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, d, len(t) AS size, list_transform(t[1 : d], lambda x: x.key) AS path, CASE WHEN d > 0 THEN t[d].words ELSE 0 END AS words FROM (SELECT conv_id, t, unnest(range(len(t) + 1)) AS d FROM r)),
m AS (SELECT conv_id AS member, d, size, words, min(conv_id) OVER (PARTITION BY d, path) AS node FROM p),
n AS (SELECT d, node, count(*) AS n_convs, any_value(words) AS words, coalesce(string_agg(CAST(member AS VARCHAR), ',' ORDER BY member) FILTER (size = d), '') AS ends FROM m GROUP BY d, node),
k AS (SELECT n.*, u.node AS parent FROM n LEFT JOIN m u ON u.member = n.node AND u.d = n.d - 1),
c AS (SELECT parent AS node, d - 1 AS d, count(*) AS n_children FROM k WHERE parent IS NOT NULL GROUP BY ALL),
a AS (SELECT u.d, u.node, sum((k.n_convs - 1) * k.words) AS saved, count(*) FILTER (c.n_children IS NULL) AS leaves FROM k JOIN m u ON u.member = k.node AND u.d <= k.d LEFT JOIN c ON c.node = k.node AND c.d = k.d GROUP BY ALL)
SELECT k.node AS conv_id, CAST(k.d AS BIGINT) AS depth, k.parent AS parent_conv_id, k.n_convs, coalesce(c.n_children, 0) AS n_children, a.leaves AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, sha256(k.ends) AS ends_sha256
FROM k LEFT JOIN c ON c.node = k.node AND c.d = k.d JOIN a ON a.node = k.node AND a.d = k.d"""
