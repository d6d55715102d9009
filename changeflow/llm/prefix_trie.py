"""Prefix trie of conversations by whole-sequence collapse.

Conversations are first folded whole: those with the same turns are one weighted sequence with the list of its ends (the
conversations that stop there). Sequences that are proper prefixes of others are found by an anti-join, the rest are the
leaves. Only one conversation of each sequence is then spread into its prefixes, and every figure of a node is a sum over
the weighted sequences that pass through it; no tree is walked.

A sequence of turns is named by its depth and two 64-bit exclusive-ors of hashes of (place, SHA-256 of the turn): the whole
sequence and all its prefixes follow from the turns without gathering them. Running values are taken inside blocks of 1,024
turns and carried from block to block, so a conversation that holds a large share of all turns is spread over many tasks.
Style: DataFrame; ids that end in one node are hashed as a stream of sorted blocks (Arrow), never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from changeflow.llm.common import stage
from changeflow.operators.ranges import row_number_in_group

FAMILY, HEADS = 5, 9
BLOCK_BITS = 10
KEY = ["depth", "k1", "k2"]


def numbered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, digest, bytes): the turns of each conversation from 1 on, ``digest`` of role and text, bytes of the text.

    Turns go by number, a missing number first; turns of one number by role and text (its first 200 characters, then its
    SHA-256), so repeated rows stay and are neighbours. A null role or text is empty. Rows without ``conv_id`` belong to no
    conversation and are left out. Other columns are not read.
    """
    who, what = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), who.alias("role"), F.substring(what, 1, 200).alias("start"),
        F.unhex(F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what), 256)).alias("digest"),
        F.octet_length(what).cast("long").alias("bytes")).filter("conv_id IS NOT NULL")
    return row_number_in_group(stage(rows, "turns"), ["conv_id"], ["turn", "role", "start", "digest"], "pos").select("conv_id", "pos", "digest", "bytes")


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """(conv_id, depth, digest, bytes): each conversation c with its first turns taken from conversation c - c % ``family``.

    The first crc32(c) % ``heads`` turns come from there, all if it has fewer and none if it is missing; c's own turns after
    as many follow. A conversation that is left without turns has one row with depth 0 and no digest.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    first = turns.filter(F.col("pos") < heads)
    sizes = first.groupBy(F.col("conv_id").alias("source")).agg(F.count("*").alias("have"))
    every = turns.groupBy("conv_id").agg(F.max("pos").alias("own")).withColumn("h", h).withColumn("source", F.col("conv_id") - F.col("conv_id") % family)
    every = stage(every.join(sizes, "source", "left").withColumn("have", F.least("h", F.coalesce("have", F.lit(0)))), "conversations")
    front = every.select("conv_id", "h", "source").join(first.withColumnRenamed("conv_id", "source"), "source").filter("pos <= h")
    front = front.select("conv_id", F.col("pos").alias("depth"), "digest", "bytes")
    rest = turns.join(every.select("conv_id", "h", "have"), "conv_id").filter("pos > h")
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("have")).alias("depth"), "digest", "bytes")
    none = every.filter("have = 0 AND own <= h").select("conv_id", F.lit(0).cast("long"), F.lit(None).cast("binary"), F.lit(0).cast("long"))
    return front.union(rest).union(none)


def _hash(k: int) -> Column:
    return F.when(F.col("depth") > 0, F.xxhash64(F.lit(k), "depth", "digest")).otherwise(F.lit(0).cast("long")).alias(f"h{k}")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's blocks of ids, which come one after the other."""
    last, digest = None, None
    done: list[tuple] = []
    for batch in batches:
        for *key, ids in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if key != last:
                if last is not None:
                    done.append((*last, digest.hexdigest()))
                last, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], [*KEY, "ends_sha256"])
            done = []
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*last, digest.hexdigest())], [*KEY, "ends_sha256"])


def ends(members: DataFrame) -> DataFrame:
    """``KEY`` and ends_sha256: the hash of the ascending ids of the conversations that end in a node, comma-joined.

    At most 2**BLOCK_BITS ids meet in a cell; the cells of a node are hashed one after the other in the order of their ids.
    """
    blocks = members.groupBy(*KEY, F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    ordered = blocks.repartition(*KEY).sortWithinPartitions(*KEY, "block").select(*KEY, "ids")
    return ordered.mapInArrow(_hashed, "depth long, k1 long, k2 long, ends_sha256 string")


def collapsed(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (conv_id and the key of its whole sequence) and weighted sequences (key, weight, its smallest conversation)."""
    members = stage(
        turns.select("conv_id", "depth", _hash(1), _hash(2), "bytes").groupBy("conv_id").agg(
            F.max("depth").alias("depth"), F.bit_xor("h1").alias("k1"), F.bit_xor("h2").alias("k2"), F.sum("bytes").alias("total")), "members")
    sequences = members.groupBy(*KEY).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"), F.first("total").alias("total"))
    return members, stage(sequences, "sequences")


def weighted_prefixes(turns: DataFrame, sequences: DataFrame) -> DataFrame:
    """Every prefix of every sequence: its key, its parent's (p1, p2), bytes of its last text and of those before, and what the
    sequence has: ``conv_id``, ``length``, ``weight``, ``total``."""
    own = sequences.select("conv_id", F.col("depth").alias("length"), "weight", "total")
    rows = turns.filter("depth > 0").select("conv_id", "depth", _hash(1), _hash(2), "bytes").join(own, "conv_id")
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "h1", "h2", "bytes")]
    rows = rows.unionByName(own.select("conv_id", *zero, "length", "weight", "total")).withColumn("block", F.shiftright("depth", BLOCK_BITS))
    rows = stage(rows, "spread")
    by = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    long_ones = rows.filter(F.col("length") >= 1 << BLOCK_BITS).groupBy("conv_id", "block").agg(
        F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"), F.sum("bytes").alias("bytes"))
    carried = long_ones.select("conv_id", "block", F.bit_xor("h1").over(by).alias("c1"), F.bit_xor("h2").over(by).alias("c2"),
                               F.sum("bytes").over(by).alias("carry")).filter("block > 0")
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)

    def so_far(h: str, c: str) -> Column:
        return F.bit_xor(h).over(inside).bitwiseXOR(F.coalesce(c, F.lit(0).cast("long")))

    found = rows.join(carried, ["conv_id", "block"], "left").select(
        "*", so_far("h1", "c1").alias("k1"), so_far("h2", "c2").alias("k2"), (F.sum("bytes").over(inside) + F.coalesce("carry", F.lit(0)) - F.col("bytes")).alias("before"))
    return found.select(*KEY, F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("h2")).alias("p2"), "bytes", "before",
                        "conv_id", "length", "weight", "total")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, depth from 1 without gaps, digest, bytes; depth 0: no turns).

    A node is a distinct sequence of first turns; conversations that begin with it are its members. Columns: ``conv_id`` (the
    smallest member; with ``depth`` it names the node), ``depth``, ``parent_conv_id``, ``n_convs`` (members), ``n_children``,
    ``n_leaves`` (nodes without children in its subtree, itself included), ``saved_tokens`` (over its subtree, members less one
    times bytes of the last text) and ``ends_sha256``. An empty table has no node, not even a root.
    """
    members, sequences = collapsed(turns)
    prefixes = stage(weighted_prefixes(turns, sequences), "prefixes")
    nodes = stage(prefixes.groupBy(*KEY).agg(
        F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("p1").alias("p1"), F.first("p2").alias("p2"),
        F.first("before").alias("before")), "nodes")

    # leaves: sequences that are no proper prefix of another
    proper = prefixes.filter("depth < length").select(*KEY).distinct()
    leaves = sequences.join(proper, KEY, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    # nodes are counted once: by their smallest conversation, which has them from one depth on
    owned = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "before")).alias("own")).select("conv_id", "own.depth", "own.before")
    has = stage(sequences.select("conv_id").join(leaves, "conv_id", "left").join(
        owned.withColumnsRenamed({"depth": "from_depth", "before": "from_before"}), "conv_id", "left"), "owners")
    after = F.col("total") - F.col("before")
    once = F.when(F.col("from_depth").isNull(), 0).when(F.col("depth") >= F.col("from_depth"), after).otherwise(F.col("total") - F.col("from_before"))
    sums = prefixes.join(has, "conv_id").groupBy(*KEY).agg(
        F.sum("leaf").alias("n_leaves"), F.sum(F.col("weight") * after - once).alias("saved_tokens"))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"))
    full = stage(nodes.join(sums, KEY).join(children, KEY, "left").join(ends(members), KEY, "left"), "figures")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return full.join(parents, ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.coalesce("n_leaves", F.lit(0)).cast("long").alias("n_leaves"), "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
