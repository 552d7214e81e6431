"""Prefix trie of conversations by whole-sequence collapse.

Equal rebuilt conversations become one weighted sequence. A sequence that is a proper prefix of
another one is no leaf (anti-join), and nodes are weighted sums over the prefixes of the distinct
sequences. Turns travel as digest and length, never as text.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import stage, unique_key_join

# Conversations that share their first turns, and the most turns they share plus one.
GROUP = 100
SHARED = 6
# Ends of one sequence that are written out as one piece of text.
PIECE = 4096
ROOT = b""
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_TURN = "conv_id long, own boolean, pos long, code binary, n long"
_PATH = "conv_id long, depth long, node binary, parent binary, n long, before long, last boolean"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), code, n of every turn that belongs to a conversation.

    Turns come by turn (null first), then role and text, null ones counting as empty. `code` is a
    digest of role and text, `n` the text's code points. Rows without a conv_id belong to no
    conversation and are left out.
    """
    said = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # The role's length keeps (ab, c) and (a, bc) apart.
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return said.select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("pos"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("code"),
        F.char_length("text").cast("long").alias("n"),
    )


def shared_turns(conv_id: Column, shared: int = SHARED) -> Column:
    """How many first turns a conversation takes from its group's."""
    return F.crc32(conv_id.cast("string").cast("binary")) % shared


def rebuilt(turns: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """conv_id, own, pos, code, n of the turns of every rebuilt conversation.

    Its first h turns are those of conversation `conv_id - conv_id % group`, the others its own
    after the h-th. Each conversation has a start besides, at position 0. A first turn is sent to
    fewer than 2 * group conversations.
    """
    own = turns.filter(F.col("pos") > shared_turns(F.col("conv_id"), shared))
    convs = turns.select("conv_id").distinct()
    of_group = F.col("conv_id") - F.col("conv_id") % group
    firsts = turns.filter((F.col("conv_id") % group == 0) & (F.col("pos") < shared))
    firsts = firsts.withColumnRenamed("conv_id", "of_group")
    taken = convs.withColumn("of_group", of_group).join(firsts, "of_group")
    taken = taken.filter(F.col("pos") <= shared_turns(F.col("conv_id"), shared))
    starts = convs.select(
        "conv_id", F.lit(False).alias("own"), F.lit(0).cast("long").alias("pos"),
        F.lit(ROOT).alias("code"), F.lit(0).cast("long").alias("n"),
    )
    columns = lambda df, own: df.select("conv_id", F.lit(own).alias("own"), "pos", "code", "n")
    return starts.unionByName(columns(taken, False)).unionByName(columns(own, True))


def _paths(batches):
    """The prefixes of each conversation: a prefix's name is the digest of its parent's and its turn."""
    names = [c.split()[0] for c in _PATH.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_())
    conv, depth, node, before, held = None, 0, ROOT, 0, None
    for batch in batches:
        rows = []
        for conv_id, code, n in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4))):
            if conv_id != conv:
                if held:
                    rows.append((*held, True))
                conv, depth, node, before = conv_id, 0, ROOT, 0
                held = (conv, 0, ROOT, None, 0, 0)
                continue
            rows.append((*held, False))
            parent, node = node, hashlib.blake2b(node + code, digest_size=16).digest()
            depth += 1
            held = (conv, depth, node, parent, n, before)
            before += n
        if rows:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    if held:
        yield pa.record_batch([pa.array([c], k) for c, k in zip((*held, True), kinds)], names=names)


def paths(turns: DataFrame) -> DataFrame:
    """Every prefix of every rebuilt conversation, from the root: a task holds one turn at a time.

    conv_id, depth, node (digest, the root's is empty), parent, n (of the last turn), before (code
    points ahead of it), last (the whole conversation).
    """
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "own", "pos")
    return ordered.mapInArrow(_paths, _PATH)


def _pieces(batches):
    """Runs of up to PIECE ends of one sequence, in order, as text."""
    for batch in batches:
        rows = []
        for node, ids in groupby(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), lambda r: r[0]):
            ids = [i for _, i in ids]
            for k in range(0, len(ids), PIECE):
                rows.append((node, ids[k], ",".join(map(str, ids[k : k + PIECE]))))
        kinds = (pa.binary(), pa.int64(), pa.string())
        if rows:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["node", "first", "ids"])


def _digests(batches):
    """SHA-256 of each sequence's pieces, comma-joined: a task holds one piece at a time."""
    done: list[tuple[bytes, str]] = []
    node, sha = None, None
    for batch in batches:
        for here, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if here != node:
                if sha is not None:
                    done.append((node, sha.hexdigest()))
                node, sha = here, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        yield pa.record_batch([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["node", "ends_sha256"])
        done = []
    if sha is not None:
        yield pa.record_batch([pa.array([node], pa.binary()), pa.array([sha.hexdigest()], pa.string())], names=["node", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """node, ends_sha256: digest of the ascending conv_ids of each sequence's conversations.

    Ids are ordered in ranges of (sequence, id), so those of one sequence spread over tasks; the
    digest itself reads its pieces of text, one row for PIECE ids, in order.
    """
    ranged = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = ranged.mapInArrow(_pieces, "node binary, first long, ids string")
    ordered = pieces.repartition("node").sortWithinPartitions("node", "first")
    return ordered.mapInArrow(_digests, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations; see `rebuilt` and `numbered_turns`.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. Prefixes are told apart by 128-bit digests. An empty table has no node.

    What a subtree saves is the sum over its nodes of n_convs times length, less that of their
    lengths. The first sum runs over sequences: weight times the code points from the node on. For
    the second each node belongs to the sequence of its smallest member, which owns the end of its
    path from some depth on, so it too is a sum over sequences and no pair of nodes is formed.
    """
    turns = stage(numbered_turns(conversations), "trie-turns")
    every = stage(paths(rebuilt(turns, group, shared)), "trie-paths")
    whole = every.filter("last")
    # Whole-sequence collapse: one row per distinct rebuilt conversation, with its weight.
    sequences = whole.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("weight"),
        F.max(F.col("before") + F.col("n")).alias("total"),
    )
    sequences = stage(sequences, "trie-sequences")
    weights = sequences.select("conv_id", "weight", "total")
    distinct = every.join(weights, "conv_id")
    # Code points ahead of the first node that a sequence owns; it may own none.
    smallest = distinct.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.max("before").alias("before"))
    owned = smallest.groupBy("conv_id").agg(F.min("before").alias("start"))
    inner = distinct.filter(~F.col("last")).select("node").distinct()
    leaves = sequences.join(inner, "node", "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    weights = weights.join(owned, "conv_id", "left").join(leaves, "conv_id", "left")

    here = F.col("total") - F.col("before")
    mine = F.col("total") - F.greatest("before", "start")
    nodes = every.join(weights, "conv_id").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("parent").alias("parent"),
        F.sum("weight").alias("n_convs"),
        F.count("leaf").alias("n_leaves"),
        F.sum(F.col("weight") * here - F.when(F.col("start").isNotNull(), mine).otherwise(0)).alias("saved_tokens"),
    )
    nodes = stage(nodes, "trie-nodes")
    children = nodes.filter("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    ends = end_digests(whole)
    counted = nodes.join(children.withColumnRenamed("parent", "node"), "node", "left").join(ends, "node", "left")
    counted = stage(
        counted.select(
            "*", F.coalesce("n_children", F.lit(0)).cast("long").alias("many"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("sha")
        ).drop("n_children", "ends_sha256"),
        "trie-counted",
    )
    total = counted.count()
    above = counted.filter("many > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("many").alias("times"))
    below = unique_key_join(counted.filter("parent is not null"), above, "parent", "times", total)
    top = counted.filter("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return below.drop("times").unionByName(top).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("many").alias("n_children"), "n_leaves", "saved_tokens",
        F.col("sha").alias("ends_sha256"),
    )
