"""Prefix trie of conversations by whole-sequence collapse.

A conversation is a sequence of keys, the k-th a digest of its first k turns. Identical conversations collapse into one
weighted sequence with a list of ends; from there on only distinct sequences are looked at, each through one representative,
its smallest conversation. Sequences that are a proper prefix of another fall to an anti-join: what stays are the
leaves. Every node is then the sum of the weighted sequences through it.

Sums over a node's subtree need no pairs of nodes. A node belongs to the sequence of its smallest member, and what belongs
to a sequence is an end of its path; so the distinct words below a node are the sum, over the sequences through it, of the words of
their own ends, but for the node's owner, of whose path all from the node on counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herdcast.llm.common import columns_of, materialise, pick, words_of

ROOT = b"\0" * 16


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest, words of every turn with a conversation; null role and text are empty."""
    own = pick(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]).where("conv_id IS NOT NULL")
    # the length keeps a role from running over into the text
    said = own.select("conv_id", "turn", F.size(words_of(F.col("text"))).cast("long").alias("words"),
                      F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)).alias("digest"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return said.select("conv_id", F.row_number().over(order).alias("place"), "digest", "words")


def rebuilt(turns: DataFrame, block: int = 20, heads: int = 4) -> DataFrame:
    """conv_id, part, place, digest, words of every rebuilt conversation, and a row of part -1 that begins each.

    The first h turns (h: crc32 of the id, modulo ``heads``) of the conversation whose id is the next lower multiple of ``block``
    (towards 0) come first, then the own turns after the h-th. At most ``block`` conversations share a head.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    ids = turns.select("conv_id").distinct().withColumn("h", h)
    start = ids.select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("place"), F.lit(b"").alias("digest"), F.lit(0).cast("long").alias("words"))
    base = F.col("conv_id") - F.col("conv_id") % block
    first = (turns.where((F.col("place") < heads) & (F.col("conv_id") % block == 0))
             .withColumnRenamed("conv_id", "base"))
    head = (ids.withColumn("base", base).join(first, "base").where(F.col("place") <= F.col("h"))
            .select("conv_id", F.lit(0).alias("part"), "place", "digest", "words"))
    own = turns.where(F.col("place") > h).select("conv_id", F.lit(1).alias("part"), "place", "digest", "words")
    return start.union(head).union(own)


def steps(sequences: DataFrame) -> DataFrame:
    """conv_id, depth, key, parent, before (words of the turns above), words, last: a row for every prefix.

    A conversation is sorted by Spark and streamed, never held whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, key = None, ROOT                          # the last row waits to know whether it ends a conversation

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_())
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                              names=["conv_id", "depth", "key", "parent", "before", "words", "last"])

        for rows in columns_of(batches, ("conv_id", "part", "digest", "words")):
            out = []
            for conv, part, digest, words in zip(*rows, strict=True):
                if waiting is not None:
                    out.append((*waiting, part < 0))
                if part < 0:
                    key, waiting = ROOT, (conv, 0, ROOT, None, 0, 0)
                else:
                    parent, key = key, hashlib.blake2b(key + digest, digest_size=16).digest()
                    waiting = (conv, waiting[1] + 1, key, parent, waiting[4] + waiting[5], words)
            yield batch(out)
        if waiting is not None:
            yield batch([(*waiting, True)])

    ordered = sequences.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return ordered.select("conv_id", "part", "digest", "words").mapInArrow(
        run, "conv_id long, depth int, key binary, parent binary, before long, words long, last boolean")


def end_lists(ends: DataFrame) -> DataFrame:
    """key, ends_sha256: digest of the ascending, comma-joined conv_ids of each key, streamed in their order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
                                              names=["key", "ends_sha256"])

        for rows in columns_of(batches, ("key", "conv_id")):
            out = []
            for key, conv in zip(*rows, strict=True):
                if key == current:
                    digest.update(b",%d" % conv)
                    continue
                if current is not None:
                    out.append((current, digest.hexdigest()))
                current, digest = key, hashlib.sha256(b"%d" % conv)
            yield batch(out)
        if current is not None:
            yield batch([(current, digest.hexdigest())])

    ordered = ends.select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    return ordered.mapInArrow(run, "key binary, ends_sha256 string")


def collapse(prefixes: DataFrame) -> DataFrame:
    """key, rep, weight, total, leaf: one row per distinct whole sequence.

    ``rep`` is its smallest conversation, ``weight`` how many there are, ``total`` its words; sequences that
    another one goes on from are no leaves.
    """
    whole = prefixes.where("last").groupBy("key").agg(F.min("conv_id").alias("rep"), F.count("*").alias("weight"),
                                                      F.max(F.col("before") + F.col("words")).alias("total"))
    inner = prefixes.where("parent IS NOT NULL").select(F.col("parent").alias("key")).distinct()
    leaves = whole.join(inner, "key", "left_anti").select("key", F.lit(1).alias("leaf"))
    return whole.join(leaves, "key", "left").withColumn("leaf", F.coalesce("leaf", F.lit(0)))


def prefix_trie(conversations: DataFrame, block: int = 20, heads: int = 4) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    Turns are ordered by turn (null first); equal or repeated turns are turns each, in the order of a digest of role and
    text. Null roles and texts are empty. Rows without conv_id belong to no conversation. Rebuilt conversations may be without
    turns: they are members, and ends, of the root. An empty table gives an empty one: without a conversation
    there is no root. Other columns are ignored.
    """
    prefixes = materialise(steps(rebuilt(materialise(turn_rows(conversations), "turns"), block, heads)), "prefixes")
    sequences = materialise(collapse(prefixes), "sequences")
    paths = (prefixes.join(sequences.select(F.col("rep").alias("conv_id"), "weight", "total", "leaf"), "conv_id")
             .select("conv_id", "depth", "key", "parent", "before", "words", "weight", "total", "leaf"))
    paths = materialise(paths, "paths")                    # every prefix of every distinct sequence
    nodes = paths.groupBy("key").agg(
        F.min("conv_id").alias("owner"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("weight") * F.col("total")).alias("all_words"))
    owned = paths.join(nodes.select("key", "owner"), "key")
    mine = Window.partitionBy("conv_id")
    owned = materialise(owned.withColumn("tail", F.col("total") - F.min(F.when(F.col("owner") == F.col("conv_id"), F.col("before"))).over(mine))
                        .withColumn("parent_conv_id", F.lag("owner").over(mine.orderBy("depth"))), "owned")
    # a sequence owns its last node at least, so it has a tail
    below = owned.groupBy("key").agg(F.sum("tail").alias("tails"))
    children = (owned.where((F.col("owner") == F.col("conv_id")) & F.col("parent").isNotNull())
                .groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children")))
    top = owned.where(F.col("owner") == F.col("conv_id"))
    distinct = F.col("tails") - F.col("tail") + F.col("total") - F.col("before")

    def long(c: Column, name: str) -> Column:
        return F.coalesce(c, F.lit(0)).cast("long").alias(name)

    return (top.select("key", "conv_id", "depth", "parent_conv_id", "before", "tail", "total")
            .join(nodes.drop("owner"), "key").join(below, "key").join(children, "key", "left")
            .join(end_lists(prefixes.where("last")), "key", "left")
            .select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", long(F.col("n_convs"), "n_convs"),
                    long(F.col("n_children"), "n_children"), long(F.col("n_leaves"), "n_leaves"),
                    long(F.col("all_words") - F.col("n_convs") * F.col("before") - distinct, "saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))
