"""Shared beginnings of conversations, from whole sequences instead of a tree that is walked.

Conversations that are equal as wholes collapse into one sequence with a weight and the list of the
conversations that end there. Sequences that are the beginning of another one drop out by an
anti-join; the others are the leaves. Each distinct sequence then gives its beginnings, weighted, and
one aggregate over them makes the nodes.

A node's subtree is never walked either. The words below a node, counted once per conversation, are
what its sequences hold from there on, times their weights. Counted once per node, they are what
each sequence holds from the first node that no sequence with a smaller conversation shares: these
nodes are the end of its path.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import released, slices
from .store import land, small_batches

FAMILY, HEADS = 20, 4           # conversations that may share a beginning, and one more than the turns shared
SEGMENT = 4096                  # depths of one sequence that one join key holds
CHUNK_BITS = 12                 # ids that one partial end list holds, as a power of two
HOT_PARENTS = 100_000           # nodes that may be broadcast as parents
ROOT = b""
FLUSH = 20_000

_PREFIX = pa.schema([
    ("conv", pa.int64()), ("depth", pa.int64()), ("parent", pa.binary()), ("node", pa.binary()),
    ("words", pa.int64()), ("before", pa.int64()), ("ends", pa.bool_())])
_PREFIX_DDL = "conv bigint, depth bigint, parent binary, node binary, words bigint, before bigint, ends boolean"


def next_node(parent: bytes, role: str, text: str) -> bytes:
    """The name of the node that one more turn leads to: a digest of the whole sequence so far."""
    said = role.encode("utf-8", "surrogatepass")
    name = hashlib.blake2b(parent + len(said).to_bytes(8, "little") + said, digest_size=16)
    name.update(text.encode("utf-8", "surrogatepass"))
    return name.digest()


def shared_turns(conv: int, heads: int) -> int:
    """How many turns of its family's first conversation a conversation begins with."""
    return zlib.crc32(str(conv).encode()) % heads if heads else 0


def _prefixes(batches: Iterator[pa.RecordBatch], heads: int) -> Iterator[pa.RecordBatch]:
    """One row per rebuilt turn, and one for the start, of rows ordered by family, conversation and turn.

    The rows of a family's first conversation come first. Only its first turns are remembered, so a
    conversation of any length passes through.
    """
    out: list[tuple] = []
    family = conv = None
    head: list[tuple[str, str]] = []
    base_turns: list[tuple[str, str]] = []
    skip = depth = before = 0
    node = ROOT

    def add(role: str, text: str) -> None:
        nonlocal depth, before, node
        parent, node, depth = node, next_node(node, role, text), depth + 1
        words = len(text.encode("utf-8", "surrogatepass").split())
        out.append((conv, depth, parent, node, words, before, False))
        before += words

    def close() -> None:
        if conv is not None:
            out[-1] = (*out[-1][:-1], True)

    for batch in slices(batches):
        for base, own, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if base != family:
                family, base_turns = base, []
            if own != conv:
                close()
                if len(out) >= FLUSH:
                    yield _arrow(out)
                    out.clear()
                conv, depth, before, node, seen = own, 0, 0, ROOT, 0
                out.append((conv, 0, None, ROOT, 0, 0, False))
                skip = 0 if own == base else shared_turns(own, heads)
                head = base_turns[:skip]
                for turn in head:
                    add(*turn)
            if own == base and len(base_turns) < heads:
                base_turns.append((role, text))
            seen += 1
            if seen > skip:
                add(role, text)
            if len(out) >= 2 * FLUSH:       # a very long conversation; its last row may still become the end
                yield _arrow(out[:-1])
                del out[:-1]
    close()
    if out:
        yield _arrow(out)


def _arrow(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PREFIX.types)], names=_PREFIX.names)


def prefixes(conversations: DataFrame, family: int | None = None, heads: int = HEADS) -> DataFrame:
    """Beginnings of all conversations, landed: ``conv, depth, parent, node, words, before, ends``.

    ``conversations`` holds ``conv_id, turn, role, text``. A row stands for the first ``depth`` turns of
    ``conv``; ``node`` names this sequence of roles and texts, ``parent`` the one without its last turn.
    ``words`` are those of the last text, ``before`` those of the texts before it; ``ends`` marks whole
    conversations.

    With ``family`` = f, conversations are branches of others: conversation c begins with the first h
    turns of conversation ``c - c % f`` (fewer if it has fewer), instead of its own first h, where h is
    crc32(c) modulo ``heads``.

    Turns are ordered by ``turn``, null first; ties by role, then text. Null roles and texts are empty.
    Repeated rows are turns of their own. Rows without a ``conv_id`` belong to no conversation. A
    conversation is worked on by one task, turn by turn.
    """
    small_batches(conversations.sparkSession)
    conv = F.col("conv_id").cast("bigint")
    base = conv - conv % F.lit(family) if family else conv
    turns = conversations.filter("conv_id IS NOT NULL").select(
        base.alias("base"), conv.alias("conv"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), "turn")
    ordered = turns.repartition("base").sortWithinPartitions(
        "base", (F.col("conv") != F.col("base")), "conv", F.col("turn").asc_nulls_first(), "role", "text")
    shared = heads if family else 0
    return land(ordered.drop("turn").mapInArrow(lambda it: released(_prefixes(it, shared)), _PREFIX_DDL), "trie-prefixes")


def _by_segment(df: DataFrame, conv: str, depth: str) -> DataFrame:
    """One row per sequence and segment of its depths, so that no join key holds a whole long sequence."""
    segments = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"{depth} div {SEGMENT}")))
    return df.withColumn("segment", segments).withColumnRenamed(conv, "conv").drop(depth)


def sequences(rows: DataFrame) -> DataFrame:
    """Distinct whole sequences, landed: ``node, rep`` (smallest conversation), ``weight, depth, total, leaf``.

    ``leaf`` is 1 for those that are not the beginning of another one, found by an anti-join.
    """
    whole = land(rows.filter("ends").groupBy("node").agg(
        F.min("conv").alias("rep"), F.count("*").alias("weight"), F.first("depth").alias("depth"),
        F.first(F.col("before") + F.col("words")).alias("total")), "trie-sequences")
    begun = rows.filter("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct()
    leaves = whole.join(begun, "node", "left_anti").select("rep", F.lit(1).cast("bigint").alias("leaf"))
    return land(whole.join(leaves, "rep", "left").fillna(0, ["leaf"]), "trie-sequences")


def trie(rows: DataFrame) -> DataFrame:
    """Nodes of the tree that ``prefixes`` span, landed.

    ``node, parent, conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_words``: the words that need not be stored again if every node of the subtree is kept once.
    An empty table has no nodes, not even the root.
    """
    whole = sequences(rows)
    # Collapsed: the beginnings of one conversation of each distinct sequence stand for all its copies.
    place = F.expr(f"depth div {SEGMENT}").alias("segment")
    of_sequence = _by_segment(whole.select("rep", "weight", "depth", "total", "leaf"), "rep", "depth")
    weighted = land(rows.select("conv", "depth", "parent", "node", "words", "before", place).join(
        of_sequence, ["conv", "segment"]), "trie-weighted")
    nodes = land(weighted.groupBy("node").agg(
        F.min("conv").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
        F.first("before").alias("before"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("weight") * (F.col("total") - F.col("before"))).alias("said")), "trie-nodes")

    # From where on a sequence holds nodes that no sequence with a smaller conversation has.
    own = nodes.groupBy(F.col("conv_id").alias("rep")).agg(F.min("before").alias("own"))
    own = _by_segment(whole.select("rep", "depth").join(own, "rep"), "rep", "depth")
    once = weighted.join(own, ["conv", "segment"], "left").withColumn(
        "once", F.col("total") - F.greatest("before", F.coalesce("own", "total")))
    kept = once.groupBy("node").agg(F.sum("once").alias("kept"))
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    full = land(nodes.join(kept, "node").join(children, "node", "left").fillna(0, ["n_children"]), "trie-nodes")
    return _with_parents(full).select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("said") - F.col("kept")).alias("saved_words"))


def _with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with their parent's conversation.

    Parents of many children are broadcast: at most ``HOT_PARENTS``, as each has more children than
    the nodes per place. All others are joined by a shuffle, in which a key holds few rows.
    """
    above = max(1000, nodes.count() // HOT_PARENTS)
    parents = nodes.filter("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = F.broadcast(parents.filter(F.col("n_children") > above).drop("n_children").withColumn("hot", F.lit(True)))
    marked = land(nodes.join(hot, "parent", "left"), "trie-nodes")
    done = marked.filter("hot OR parent IS NULL").drop("hot")
    rest = marked.filter("hot IS NULL AND parent IS NOT NULL").drop("hot", "parent_conv_id")
    return done.unionByName(rest.join(parents.filter(F.col("n_children") <= above).drop("n_children"), "parent"))


def end_lists(rows: DataFrame) -> DataFrame:
    """Conversations that end at a node, in pieces: ``node, chunk, ids`` (ascending, as text, comma-joined).

    The pieces of a node follow one another by ``chunk``; each holds at most ``2 ** CHUNK_BITS`` ids.
    """
    ends = rows.filter("ends").select("node", F.shiftright("conv", CHUNK_BITS).alias("chunk"), "conv")
    lists = ends.groupBy("node", "chunk").agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    return lists.withColumn("ids", F.array_join(F.transform("ids", lambda i: i.cast("string")), ","))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node = digest = None
    out: list[tuple] = []
    for batch in slices(batches):
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name != node:
                if digest:
                    out.append((node, digest.hexdigest()))
                node, digest = name, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield _pairs(out)
        out = []
    if digest:
        yield _pairs([(node, digest.hexdigest())])


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["node", "ends_sha256"])


def end_digests(rows: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of the nodes at which conversations end; a task reads a list piece by piece."""
    lists = end_lists(rows).repartition("node").sortWithinPartitions("node", "chunk").select("node", "ids")
    return lists.mapInArrow(lambda it: released(_fold(it)), "node binary, ends_sha256 string")


def report(rows: DataFrame) -> DataFrame:
    """The tree with the digest of each node's end list; without ends that of the empty text."""
    nothing = hashlib.sha256().hexdigest()
    return trie(rows).join(end_digests(rows), "node", "left").fillna(nothing, ["ends_sha256"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved_words").alias("saved_tokens"), "ends_sha256")
