"""Operator 12: the prefix trie of conversations, by partition refinement.

All conversations start in one class, the root. Turn after turn, each class is split by what its members say next; a
class is named by a digest of its parent's name and that turn, so members go to their new class without meeting each
other. A class with one member is retired: the rest of that conversation is a chain of nodes of its own, written out at
once and never refined again. Rounds take several turns, `FIRST` at first and twice as many each time up to `MOST`, so
that a long shared conversation costs few rounds and no round holds more than `MOST` turns of one conversation at a time.

Then sums are folded back. What a class saves in its subtree is told by its members alone: a member adds the words of
its own later shared turns as long as it is not the smallest member of their class, and a leaf is counted for its
smallest member. Both are sums from a conversation's deepest turn back to its first, taken by block and added up by
class.

Defined results: turns follow each other by turn (null first), equal ones by the digest of role and text; repeated rows
are turns of their own. Null roles and texts are empty. Rows without conv_id take no part: they have no smallest member.
Conversations without turns end at the root. Without any conversation there is no node. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.chat import turn_digest
from aerolith.llm.common import WORD, running_sum, written

FIRST, MOST = 4, 1024
#: Bytes of joined ids that a task hands on at a time.
CHUNK = 1 << 16
ROOT = b""
NOTHING = hashlib.sha256(b"").hexdigest()
KINDS = "depth long, parent_conv_id {0}, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def blocks() -> list[tuple[int, int]]:
    """(first, last) turn of the blocks up to the first of MOST turns, after which all are as long."""
    out, first, size = [], 1, FIRST
    while size <= MOST:
        out.append((first, first + size - 1))
        first, size = first + size, 2 * size
    return out


def block_of(k: Column) -> Column:
    known = blocks()
    out = F.lit(0)
    for b, (first, _) in enumerate(known):
        out = F.when(k >= first, F.lit(b)).otherwise(out) if b else out
    last = known[-1][1]
    return F.when(k > last, len(known) + F.floor((k - last - 1) / MOST)).otherwise(out).cast("int")


def last_turn(block: int) -> int:
    known = blocks()
    return known[block][1] if block < len(known) else known[-1][1] + (block - len(known) + 1) * MOST


def numbered(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, k, said, n_words) for each turn: its number from 1, the digest of role and text, the words of its text."""
    words = F.regexp_count(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    rows = df.where(F.col(f"`{conv}`").isNotNull()).select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), turn_digest(role, text).alias("said"), words.alias("n_words"))
    placed = running_sum(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("said")], {"k": F.lit(1).cast("long")}, "trie-turns")
    return placed.select("conv_id", (F.col("k") + 1).alias("k"), "said", "n_words")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a conversation in order, the class that it has reached first: the classes of its turns."""
    conv, name = None, None
    for batch in batches:
        out: list[tuple] = []
        for c, k, said, words in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "k", "said", "n_words")), strict=True):
            if k == 0:
                conv, name = c, said
            elif c == conv:  # else it was retired before
                parent, name = name, hashlib.sha256(name + said).digest()
                out.append((c, k, name, parent, words))
        columns = list(zip(*out, strict=True)) or [()] * 5
        kinds = (batch.schema.field("conv_id").type, pa.int64(), pa.binary(), pa.binary(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["conv_id", "k", "name", "parent", "n_words"])


def joined_digests(ends: DataFrame, name: str = "name", member: str = "conv_id") -> DataFrame:
    """(name, ends_sha256): the digest of the members' decimal numbers in order, joined by commas. Members are dealt by
    ranges of name and number, so that a name of very many is written out in many tasks; one task then digests what these
    hand on, a few thousand numbers to a row."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, parts, size = None, None, [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([first], kind), pa.array([",".join(parts)], pa.string())], ["name", "first", "ids"])

        for batch in batches:
            kind = batch.schema.field("member").type
            for n, m in zip(batch.column("name").to_pylist(), batch.column("member").to_pylist(), strict=True):
                if n != at or size >= CHUNK:
                    if parts:
                        yield row()
                    at, first, parts, size = n, m, [], 0
                parts.append(str(m))
                size += len(parts[-1]) + 1
        if parts:
            yield row()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, done = None, None, []
        for batch in batches:
            for n, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if n != at:
                    if state is not None:
                        done.append((at, state.hexdigest()))
                    at, state = n, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.string())], ["name", "ends_sha256"])
            done.clear()
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["name", "ends_sha256"])

    kind = ends.schema[member].dataType.simpleString()
    rows = written(ends.select(F.col(name).alias("name"), F.col(member).alias("member")), "trie-ends")
    some = rows.repartitionByRange("name", "member").sortWithinPartitions("name", "member").mapInArrow(chunks, f"name binary, first {kind}, ids string")
    return some.repartition("name").sortWithinPartitions("name", "first").mapInArrow(summed, "name binary, ends_sha256 string")


def nodes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """A row for each node, from numbered turns (conv_id, k, said, n_words) and the conversations (conv_id, n_turns), each
    once, also those without turns: conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = turns.sparkSession
    kind = turns.schema["conv_id"].dataType.simpleString()
    convs = written(conversations.select("conv_id", "n_turns"), "trie-conversations")
    all_turns = written(turns.select("conv_id", "k", "said", "n_words", block_of(F.col("k")).alias("block")), "trie-blocks")
    total, lowest = convs.agg(F.count("*"), F.min("conv_id")).first()
    if not total:
        return spark.createDataFrame([], f"conv_id {kind}, {KINDS.format(kind)}")
    blocks_there = all_turns.agg(F.max("block")).first()[0]
    root = F.lit(ROOT)
    low = F.lit(lowest).cast(kind)
    shared = convs.select("conv_id", F.lit(0).cast("long").alias("k"), root.alias("name"), low.alias("low"), F.lit(0).cast("long").alias("n_words"), F.lit(0).alias("block"))
    classes = spark.range(1).select(root.alias("name"), F.lit(0).cast("long").alias("k"), F.lit(None).cast("binary").alias("parent"), F.lit(total).cast("long").alias("n_convs"), low.alias("low"))
    active = convs.select("conv_id", root.alias("name"))
    for block in range(-1 if blocks_there is None else blocks_there + 1):
        start = active.select("conv_id", F.lit(0).cast("long").alias("k"), F.col("name").alias("said"), F.lit(0).cast("long").alias("n_words"))
        rows = all_turns.where(F.col("block") == block).select("conv_id", "k", F.unhex("said").alias("said"), "n_words").union(start)
        ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "k")
        members = written(ordered.mapInArrow(_chained, f"conv_id {kind}, k long, name binary, parent binary, n_words long"), "trie-members")
        split = members.groupBy("name").agg(F.min("k").alias("k"), F.min("parent").alias("parent"), F.count("*").alias("n_convs"), F.min("conv_id").alias("low"))
        split = written(split, "trie-classes")
        # written on both sides, so that the join can be split where one class is very large
        stay = members.select("conv_id", "k", "name", "n_words").join(split.where("n_convs > 1").select("name", "low"), "name")
        stay = written(stay.select("conv_id", "k", "name", "low", "n_words", F.lit(block).alias("block")), "trie-shared")
        shared, classes = shared.union(stay), classes.union(split)
        active = stay.where(F.col("k") == last_turn(block)).select("conv_id", "name")
        if active.isEmpty():
            break
    shared_classes = classes.where((F.col("n_convs") > 1) | (F.col("k") == 0))
    children = classes.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children"))
    shared_classes = written(shared_classes.join(children.withColumnRenamed("parent", "of"), F.col("name") == F.col("of"), "left").select("name", "k", "parent", "n_convs", "low", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children")), "trie-shared-classes")

    # how far a conversation is shared, and whether it is the one that its leaf is counted for
    reach = shared.groupBy("conv_id").agg(F.max("k").alias("shared_depth"), F.max_by("low", "k").alias("top"), F.max_by("name", "k").alias("name"))
    leaves = shared_classes.where("n_children = 0").select(F.col("low").alias("leaf_of"))
    reach = reach.join(convs, "conv_id").join(leaves, F.col("conv_id") == F.col("leaf_of"), "left")
    alone = F.col("n_turns") > F.col("shared_depth")
    reach = written(reach.select("conv_id", "n_turns", "shared_depth", "top", "name", (alone | F.col("leaf_of").isNotNull()).cast("long").alias("leaf")), "trie-reach")

    # fold back: from a conversation's deepest shared turn to its first
    added = F.when(F.col("conv_id") != F.col("low"), F.col("n_words")).otherwise(0)
    later = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    by_block = shared.groupBy("conv_id", "block").agg(F.sum(added).alias("s")).select("conv_id", "block", F.coalesce(F.sum("s").over(later), F.lit(0)).alias("later"))
    within = Window.partitionBy("conv_id", "block").orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = shared.select("conv_id", "block", "name", F.sum(added).over(within).alias("s")).join(by_block, ["conv_id", "block"])
    folded = carried.join(reach.select("conv_id", "leaf"), "conv_id").groupBy("name").agg(F.sum(F.col("s") + F.col("later")).alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))

    ended = joined_digests(reach.where(~alone).select("name", "conv_id"))
    parents = shared_classes.select(F.col("name").alias("parent"), F.col("low").alias("parent_conv_id"))
    inner = shared_classes.join(parents, "parent", "left").join(folded, "name", "left").join(ended, "name", "left")
    inner = inner.select(F.col("low").alias("conv_id"), F.col("k").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))

    tails = all_turns.select("conv_id", "k").join(reach.where(alone).select("conv_id", "n_turns", "shared_depth", "top"), "conv_id").where("k > shared_depth")
    last = F.col("k") == F.col("n_turns")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    tails = tails.select(
        "conv_id", F.col("k").alias("depth"), F.when(F.col("k") == F.col("shared_depth") + 1, F.col("top")).otherwise(F.col("conv_id")).alias("parent_conv_id"), one.alias("n_convs"),
        F.when(last, none).otherwise(one).alias("n_children"), one.alias("n_leaves"), none.alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )
    return inner.union(tails)


def trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The nodes of the conversations in df, a row for each turn."""
    turns = written(numbered(df, conv, turn, role, text), "trie-numbered")
    return nodes(turns, turns.groupBy("conv_id").agg(F.count("*").alias("n_turns")))
