"""Prefix trie of conversations by the Euler-tour technique.

Conversations are rebuilt (the first turns of a base conversation, then their
own), and every distinct sequence of first turns is a node. A prefix is told by
128 bits: the exclusive or, along the conversation, of two hashes of (depth, role,
text). As the parent's digest is the node's without its last turn, nodes and their
parents come from aggregations and one join. A node is named by its smallest member
and its depth.

Subtree figures come from the Euler tour: every node has an enter and an exit
arc; an enter leads to the first child's enter or to the own exit, an exit to the
next sibling's enter or the parent's exit. ``list_ranking`` finds each arc's position;
leaves and savings are running totals over the positions, and a subtree's figure is
the total at its exit less the total before its enter.

Scale. Turns of one conversation, children of one node and the tour are ordered by
``tally.operators.ordered`` in ranges, so no conversation and no node, the root
included, is one task. Members are counted before the shuffle. The ids that end at a
node are joined to blocks in parallel, in order; one task then hashes a node's
blocks as a stream (a SHA-256 has to run in order), never holding more than one.

Edge cases. A null conv_id takes no part. Null turn sorts first, null role or text
is empty; equal turns are ordered by role, then text; repeated rows are turns
each. Empty table: no node at all. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tally.llm import list_ranking
from tally.llm.stage import staged
from tally.operators.ordered import Prefix, prefix_aggregate, sequence_index

#: Fixed values of the contract: conversations share a base of five ids, and up to eight turns of it.
BASE_OF, MOST_SHARED = 5, 8
#: Ids in a block of the digest.
BLOCK_IDS = 1 << 16


def turns(conversations: DataFrame) -> DataFrame:
    """(c, seq, t1, t2, bytes): the turns of each conversation numbered from 1; texts only as hashes."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("c"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text")).filter("c is not null")
    ordered = sequence_index(rows, ["c"], ["turn", "role", "text"], idx="seq", idx_inverse=None, count=None,
                             cut_by=["turn", "role", F.substring("text", 1, 32)])
    return staged(ordered.select("c", "seq", F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(7), "text", "role").alias("t2"),
                                 F.octet_length("text").cast("long").alias("bytes")), "turns")


def rebuild(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations' turns (c, depth, t1, t2, bytes), and all ids (c, length)."""
    ids = own.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    ids = ids.select("c", "n", (F.crc32(F.col("c").cast("string").cast("binary")) % (MOST_SHARED + 1)).alias("h"), (F.col("c") - F.col("c") % BASE_OF).alias("b"))
    ids = staged(ids.join(ids.select(F.col("c").alias("b"), F.col("n").alias("n_b")), "b", "left")
                 .select("c", "b", "h", F.least("h", F.coalesce("n_b", F.lit(0))).alias("shared"), "n")
                 .select("*", (F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "conversations")
    first = own.filter(F.col("seq") <= MOST_SHARED).withColumnRenamed("c", "b")
    shared = ids.select("c", "b", "h").join(first, "b").filter("seq <= h").select("c", F.col("seq").alias("depth"), "t1", "t2", "bytes")
    rest = own.join(ids.select("c", "h", "shared"), "c").filter("seq > h").select("c", (F.col("seq") - F.col("h") + F.col("shared")).alias("depth"), "t1", "t2", "bytes")
    return shared.union(rest), ids.select("c", "length")


def _joined_ids(batches):
    """Sorted (conv_id, depth, c) to blocks (conv_id, depth, first, ids): comma-joined decimals."""
    for b in batches:
        node, depth, c = (b[x].to_numpy() for x in ("conv_id", "depth", "c"))
        new = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (depth[1:] != depth[:-1])]) if len(b) else []
        cuts = sorted({*new, *range(0, len(b), BLOCK_IDS), len(b)})
        yield pd.DataFrame([(node[lo], depth[lo], c[lo], ",".join(map(str, c[lo:hi].tolist()))) for lo, hi in zip(cuts, cuts[1:])],
                           columns=["conv_id", "depth", "first", "ids"])


def _digests(batches):
    """Blocks sorted by (conv_id, depth, first) to one SHA-256 a node, one block at a time."""
    now, state = None, None
    for b in batches:
        done = []
        for node, depth, ids in zip(b["conv_id"], b["depth"], b["ids"]):
            if (node, depth) != now:
                if now:
                    done.append((*now, state.hexdigest()))
                now, state = (node, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield pd.DataFrame(done, columns=["conv_id", "depth", "ends_sha256"])
    if now:
        yield pd.DataFrame([(*now, state.hexdigest())], columns=["conv_id", "depth", "ends_sha256"])


def _end_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes at which conversations end, from (conv_id, depth, c)."""
    key = ["conv_id", "depth"]
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = (staged(ends, "ends").repartitionByRange(parts, *key, "c").sortWithinPartitions(*key, "c")
              .mapInPandas(_joined_ids, "conv_id long, depth long, first long, ids string"))
    return blocks.repartition(parts, *key).sortWithinPartitions(*key, "first").mapInPandas(_digests, "conv_id long, depth long, ends_sha256 string")


def trie(conversations: DataFrame, parts: int | None = None, base: int = list_ranking.BASE) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``parts`` and ``base`` are the list ranking's.
    """
    key = ["conv_id", "depth"]
    rows, ids = rebuild(turns(conversations))
    rows = rows.select("c", "depth", F.xxhash64("depth", "t1").alias("e1"), F.xxhash64("t2", "depth").alias("e2"), "bytes")
    prefixes = staged(prefix_aggregate(rows, ["c"], ["depth"], [Prefix("p1", "xor", "e1"), Prefix("p2", "xor", "e2")], total="length"), "prefixes")

    zero = F.lit(0).cast("long")
    root = ids.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("conv_id is not null").select(
        zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv_id", "n_convs", zero.alias("bytes"), zero.alias("q1"), zero.alias("q2"))
    named = staged(root.unionByName(prefixes.groupBy("depth", "p1", "p2").agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"),
        F.max(F.col("p1").bitwiseXOR(F.col("e1"))).alias("q1"), F.max(F.col("p2").bitwiseXOR(F.col("e2"))).alias("q2"))), "named")
    up = named.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    nodes = staged(named.join(up, ["depth", "q1", "q2"], "left").select(*key, "parent_conv_id", "n_convs", "bytes"), "nodes")

    children = nodes.filter("depth > 0")
    kids = children.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"), F.min("conv_id").alias("first_child"))
    siblings = prefix_aggregate(children.select("parent_conv_id", *key), ["parent_conv_id", "depth"], ["conv_id"],
                                [Prefix("sibling", "lead", "conv_id")]).drop("parent_conv_id")
    linked = staged(nodes.join(kids, key, "left").join(siblings, key, "left").fillna(0, ["n_children"]), "linked")

    leaf, sibling, top = F.col("first_child").isNull(), F.col("sibling").isNotNull(), F.col("depth") == 0
    arc = lambda out, c, d, e: linked.select(*key, F.lit(out).alias("out"), c.alias("next_conv_id"), d.alias("next_depth"), e.alias("next_out"))
    enter = arc(0, F.coalesce("first_child", "conv_id"), F.col("depth") + F.when(leaf, 0).otherwise(1), F.when(leaf, 1).otherwise(0))
    leave = arc(1, F.coalesce("sibling", "parent_conv_id"), F.when(~top, F.col("depth") - F.when(sibling, 0).otherwise(1)), F.when(~top, F.when(sibling, 0).otherwise(1)))
    tour = list_ranking.rank(enter.union(leave), [*key, "out"], parts, base)

    weights = linked.select(*key, F.lit(0).alias("out"), leaf.cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    summed = prefix_aggregate(tour.join(weights, [*key, "out"], "left").fillna(0, ["leaf", "saved"]), [], ["position"],
                              [Prefix("leaves", "sum", "leaf"), Prefix("savings", "sum", "saved")])
    at = lambda out, c: F.max(F.when(F.col("out") == out, F.col(c)))
    subtree = summed.groupBy(*key).agg((at(1, "leaves") - at(0, "leaves") + at(0, "leaf")).alias("n_leaves"),
                                       (at(1, "savings") - at(0, "savings") + at(0, "saved")).alias("saved_tokens"))

    last = prefixes.filter("depth = length").select("c", "depth", "p1", "p2").union(
        ids.filter("length = 0").select("c", zero, zero, zero))
    ends = _end_digests(last.join(named.select("depth", "p1", "p2", "conv_id"), ["depth", "p1", "p2"]).select(*key, "c"))
    return linked.join(subtree, key).join(ends, key, "left").select(
        *key, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
