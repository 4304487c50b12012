"""Operator 3: mixing sources to target weights by a low-discrepancy schedule.

The documents of a source, shuffled by a digest of their ids and texts, make one stream of words that repeats as often
as the source's target asks. The mix has K slots of equal size (of T / K words, T being all words). Slot k is given the
base-2 van der Corput point of k; the points are mapped through the cumulative target weights, so each source gets its
share of every stretch of the schedule, to within a slot over the whole. The slots of a source are ranked, the words of
its target are cut into as many equal blocks (to within a word), and slot and block of equal rank are joined: that is
the mix. A source takes its target to within a word, since it is its own blocks that give way to the rounding of slots;
one that is too small for a point of its own has one slot, that of the point after its place.

Targets: sources in code point order, null last, are weighed by the given weights, repeating; they share all words, but
a target stops at `most_repeats` times its source's words and the excess is shared by weight among the others.

Scale: there are 2^20 slots, or as many more as keep a slot at `MOST_SLOT_WORDS`; they are made, ranked and joined in
many tasks. Offsets in a stream come from sums over (source, bucket of digests) and from sums within each bucket, so no
task gets a whole source; rows that are equal in id, text and source are one row with a number until they have their
places. The only rows that meet in one task are one for each source and one for each bucket or 1,024 slots of a source.

Defined results: a null text has no words; a document without words takes no part (taken 0). Rows that are equal have a
place each in the stream. An empty table gives an empty mix. Reruns agree: the order depends on the documents alone.
Columns of the input keep their names and values, whatever they are called.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import WORD, free_names, written

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SLOT_BITS = 20
#: Words of a slot, at most, as a power of two.
MOST_SLOT_WORDS = 16
CHUNK = 1024
#: Documents of a bucket of digests, about.
BUCKET_ROWS = 1500


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, weight, target) from one row (source, source_size) for each source.

    The water level: with sources in order of how soon they fill up (cap by weight), the level is what remains after
    the full ones, by the weight of the rest; a source is full if its cap by weight is not above the level."""
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights))) + 1)
    every = Window.partitionBy()
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    below = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rows = sizes.select("source", F.col("source_size"), w.cast("long").alias("weight")).withColumn("cap", F.col("source_size") * F.lit(most_repeats))
    rows = rows.select("*", F.sum("source_size").over(every).alias("total"), F.sum("weight").over(every).alias("all_weight"),
                       F.coalesce(F.sum("cap").over(below), F.lit(0)).alias("cap_below"), F.coalesce(F.sum("weight").over(below), F.lit(0)).alias("weight_below"))
    level = (F.col("total") - F.col("cap_below")).cast("double") / (F.col("all_weight") - F.col("weight_below"))
    rows = rows.withColumn("level", level).withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
    first = F.min(F.when(F.col("open"), F.struct((F.col("cap") / F.col("weight")).alias("fill"), "level"))).over(every)
    return rows.select("source", "source_size", "weight", F.when(F.col("open"), first["level"] * F.col("weight")).otherwise(F.col("cap").cast("double")).alias("target"))


def _edge(rank: str) -> Column:
    """Words of a source's first `rank` blocks: floor(rank * taken_words / blocks), without a product that overflows."""
    return F.expr(f"({rank}) * (taken_words div blocks) + (({rank}) * (taken_words % blocks)) div blocks")


def schedule(plan: DataFrame) -> DataFrame:
    """(source_no, slot, rank) for every slot: plan has source_no, first_point and blocks, the first of the source's
    points (whole numbers) and how many it has, and slot_bits. A slot's point is its number with the bits reversed."""
    last = F.col("first_point") + F.col("blocks") - 1
    chunks = plan.where("blocks > 0").select("source_no", "slot_bits", "first_point", last.alias("last"), F.explode(F.sequence(F.expr(f"first_point div {CHUNK}"), F.expr(f"(first_point + blocks - 1) div {CHUNK}"))).alias("c"))
    chunks = chunks.repartition("source_no", "c")
    points = chunks.select("source_no", "slot_bits", F.explode(F.sequence(F.greatest("first_point", F.col("c") * CHUNK), F.least("last", F.col("c") * CHUNK + CHUNK - 1))).alias("point"))
    slot = F.conv(F.reverse(F.lpad(F.bin("point"), F.greatest(F.col("slot_bits").cast("int"), F.lit(1)), "0")), 2, 10).cast("long")
    slots = points.select("source_no", slot.alias("slot")).withColumn("chunk", F.expr(f"slot div {CHUNK}"))
    counts = slots.groupBy("source_no", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source_no", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source_no", "chunk").orderBy("slot")
    ranked = slots.withColumn("inside", F.row_number().over(inside) - 1)
    return ranked.join(starts.hint("merge"), ["source_no", "chunk"]).select("source_no", "slot", (F.col("start") + F.col("inside")).alias("rank"))


def mix(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS,
        most_repeats: int = MOST_REPEATS, slot_bits: int = SLOT_BITS) -> tuple[DataFrame, DataFrame]:
    """(pieces, placed). placed has a row for each document: id, tie (a hash of its text), source, size, source_size,
    target, offset, row_key, where row_key is unique. pieces has a row for each document, repeat and block it meets:
    row_key, epoch, slot, taken."""
    words = F.col(f"`{text}`").cast("string")
    empty = F.lit("")
    key = F.md5(F.concat(F.coalesce(F.col(f"`{id_column}`").cast("string"), empty), F.md5(F.coalesce(words, empty))))
    slim = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{source}`").cast("string").alias("source"), n_words(words).alias("size"), key.alias("key"), F.xxhash64(words).alias("tie"))
    slim = written(slim.groupBy("source", "key", "id", "size", "tie").agg(F.count("*").alias("copies")), "mix-sizes")

    per_source = slim.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.sum("copies").alias("source_rows"))
    plan = targets(per_source.select("source", "source_size"), weights, most_repeats)
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    plan = plan.select("*", F.row_number().over(ordered).alias("source_no"), F.sum("target").over(upto).alias("through"), F.sum("source_size").over(Window.partitionBy()).alias("total"))
    # as many slots as words at most, and a power of two, so that the points are spread evenly
    whole = F.length(F.bin("total")) - 1
    bits = F.when(F.col("total") > 0, F.least(whole, F.greatest(F.lit(slot_bits), whole - MOST_SLOT_WORDS))).otherwise(0)
    plan = plan.withColumn("slot_bits", bits.cast("int")).withColumn("slots", F.expr("shiftleft(1L, slot_bits)"))
    last = F.col("source_no") == F.max("source_no").over(Window.partitionBy())
    point = F.when(F.col("total") == 0, 0).when(last, F.col("slots")).otherwise(F.least(F.col("slots"), F.ceil(F.round(F.col("through") * (F.col("slots") / F.col("total")), 6))))
    plan = plan.withColumn("next_point", point.cast("long"))
    plan = plan.withColumn("first_point", F.least(F.coalesce(F.lag("next_point").over(ordered), F.lit(0).cast("long")), F.col("slots") - 1))
    plan = plan.withColumn("taken_words", F.least(F.floor(F.col("target") + 0.5).cast("long"), F.col("source_size") * most_repeats))
    plan = plan.withColumn("blocks", F.when(F.col("taken_words") > 0, F.greatest(F.lit(1).cast("long"), F.col("next_point") - F.col("first_point"))).otherwise(F.lit(0).cast("long")))
    plan = written(plan, "mix-plan")

    # offsets in the streams: sums before a bucket, then sums in it
    rows = F.coalesce(F.sum("source_rows"), F.lit(0))
    buckets = per_source.agg(F.greatest(F.lit(1), F.ceil(rows / BUCKET_ROWS)).cast("long").alias("buckets"))
    bucket = F.pmod(F.conv(F.substring("key", 1, 15), 16, 10).cast("long"), F.col("buckets"))
    dealt = slim.crossJoin(F.broadcast(buckets)).withColumn("bucket", bucket).drop("buckets")  # one row
    all_words = F.col("size") * F.col("copies")
    sums = dealt.groupBy("source", "bucket").agg(F.sum(all_words).alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "id", "size", "tie")
    placed = dealt.withColumn("inside", F.sum(all_words).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - all_words).withColumn("nth", F.row_number().over(inside))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).select("id", "tie", "source", "size", "copies", "bucket", "nth", (F.col("start") + F.col("inside")).alias("offset"))
    known = plan.select(F.col("source").alias("s"), "source_no", "source_size", "target", "blocks", "taken_words")
    placed = placed.join(known, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).withColumn("offset", F.col("offset") + F.col("copy") * F.col("size"))
    row_key = F.concat_ws("-", "source_no", "bucket", "nth", "copy")
    placed = written(placed.withColumn("row_key", row_key).drop("copies", "copy", "bucket", "nth"), "mix-placed")

    # a document meets the blocks from that of its first word to that of its last, in every repeat of the stream
    turns = F.expr("sequence(0, int((taken_words - 1) div source_size))")
    met = placed.where("size > 0 AND taken_words > 0").withColumn("epoch", F.explode(turns))
    met = met.withColumn("lo", F.col("epoch") * F.col("source_size") + F.col("offset")).withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("taken_words"))).where("lo < hi")
    near = lambda x: F.floor(x * (F.col("blocks") / F.col("taken_words"))).cast("long")  # noqa: E731  to within one block
    met = met.withColumn("rank", F.explode(F.sequence(F.greatest(near(F.col("lo")) - 1, F.lit(0).cast("long")), F.least(near(F.col("hi") - 1) + 1, F.col("blocks") - 1))))
    begin, end = _edge("rank"), _edge("rank + 1")
    met = met.withColumn("taken", F.least("hi", end) - F.greatest("lo", begin)).where("taken > 0")
    pieces = met.select("row_key", "source_no", "epoch", "rank", "taken").join(schedule(plan).hint("merge"), ["source_no", "rank"])
    return pieces.select("row_key", "epoch", "slot", "taken"), placed


def first_words(text: Column, n: Column) -> Column:
    """The text up to the start of word n + 1; null stays null."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, counts: pa.Array) -> pa.Array:
        out = []
        for x, k in zip(texts.to_pylist(), counts.to_pylist(), strict=True):
            starts = None if x is None else [m.start() for m in islice(re.finditer(WORD, x), k, k + 1)]
            out.append(x[: starts[0]] if starts else x)
        return pa.array(out, pa.string())

    return cut(text, n)


def repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", column: str = "turn", **options) -> DataFrame:
    """The mixed corpus: the rows of docs, each once for every repeat of its source's stream that takes words of it,
    with a struct of epoch, taken (a repeat takes a document's first words) and size. Documents are joined with their
    places by id and text; equal rows are told apart by a number, and which of them gets which makes no difference."""
    pieces, placed = mix(docs, id_column, text, source, **options)
    i, t, n, tie, nth, all_turns = free_names(docs, "id", "t", "n", "tie", "nth", "turns")
    turns = pieces.groupBy("row_key", "epoch").agg(F.sum("taken").alias("taken")).join(placed.select("row_key", "id", "tie", "size"), "row_key")
    turns = turns.groupBy("id", "tie", "row_key").agg(F.sort_array(F.collect_list(F.struct("epoch", "taken", "size"))).alias(all_turns))
    turns = turns.select(F.col("id").alias(i), F.col("tie").alias(t), all_turns, F.row_number().over(Window.partitionBy("id", "tie").orderBy("row_key")).alias(n))
    keyed = docs.withColumn(tie, F.xxhash64(F.col(f"`{text}`").cast("string")))
    keyed = keyed.withColumn(nth, F.row_number().over(Window.partitionBy(F.col(f"`{id_column}`"), tie).orderBy(F.lit(1))))
    same = F.col(f"`{id_column}`").eqNullSafe(F.col(i)) & (F.col(tie) == F.col(t)) & (F.col(nth) == F.col(n))
    return keyed.join(turns, same).withColumn(column, F.explode(all_turns)).drop(tie, nth, i, t, n, all_turns)


def taken(docs: DataFrame, **options) -> DataFrame:
    """One row for each document: id, size, source, source_size, target, taken (words, repeats counted)."""
    pieces, placed = mix(docs, **options)
    sums = pieces.groupBy("row_key").agg(F.sum("taken").alias("taken"))
    return placed.join(sums, "row_key", "left").select("id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
