"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.operators.scratch import deleted, scratch_path, shared_dir, written

__all__ = ["deleted", "scratch_path", "shared_dir", "written"]

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that df has not, whatever the case of its letters."""
    taken = {x.lower() for x in df.columns}
    out = []
    for name in wanted:
        k = 0
        while (found := f"__{name}_{k}" if k else f"__{name}") in taken:
            k += 1
        out.append(found)
        taken.add(found)
    return out


_held: list = [None, None]


def take_over(operator: str, forget) -> None:
    """Called by a Python worker when it starts an operator's task: what another operator has remembered in this
    process, which Spark reuses, is forgotten, so that caches of several operators never add up."""
    if _held[0] != operator:
        if _held[1] is not None:
            _held[1]()
        _held[:] = operator, forget
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass


def values(column: pa.Array, most_bytes: int = 4 << 20) -> Iterator:
    """The Python values of an Arrow column, made a few megabytes at a time."""
    step = max(1, len(column) * most_bytes // max(column.nbytes, 1))
    for at in range(0, len(column), step):
        yield from column.slice(at, step).to_pylist()


def pieces(batch: pa.RecordBatch, most_bytes: int = 8 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in slices of about most_bytes of text, one row at least, so that a few long texts don't fill memory."""
    index = batch.schema.get_field_index(column)
    size = batch.column(index).nbytes
    step = max(1, batch.num_rows * most_bytes // max(size, 1))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def small_pieces(batches: Iterable[pa.RecordBatch], most_bytes: int = 8 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from pieces(batch, most_bytes, column)


def running_sum(df: DataFrame, key: str, order: list[Column], sums: dict[str, Column], label: str) -> DataFrame:
    """df with, for each name, the sum over the rows of the same key (null is a key) that come before a row in the order.

    Rows are dealt by ranges of key and order, rows that are equal in both by their place in the input, so that a key of
    any number of rows is spread over tasks; rows and their range are written, sums are taken within the ranges of a key,
    and the totals of its earlier ranges are added. Nothing but these totals, a row for each range, meets in one task.
    """
    p, of, tie, k, *totals = free_names(df, "range", "of", "tie", "key", *sums)
    ranged = written(df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(F.col(key), *order, F.col(tie)).withColumn(p, F.spark_partition_id()), label)
    inside = Window.partitionBy(p, key).orderBy(*order, tie).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(k).orderBy(of).rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(F.col(p).alias(of), F.col(key).alias(k)).agg(*[F.sum(x).alias(t) for x, t in zip(sums.values(), totals, strict=True)])
    starts = parts.select(of, k, *[F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(t) for t in totals])
    near = ranged.withColumns({name: F.coalesce(F.sum(x).over(inside), F.lit(0)) for name, x in sums.items()})
    joined = near.join(starts, (F.col(p) == F.col(of)) & F.col(key).eqNullSafe(F.col(k)))
    return joined.select(*df.columns, *[(F.col(name) + F.col(t)).alias(name) for name, t in zip(sums, totals, strict=True)])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node in edges; component is the smallest node that links reach.

    Alternating large-star and small-star rounds: every node of a neighbourhood is tied to the smallest one, so a
    group of any size takes as many rows as it has links, and the rounds grow with the logarithm of its width. Each
    round is written to the shared folder, as is the smallest neighbour of each node, so that the joins with a star's
    centre, whose arcs are as many as its group has members, can be split between tasks. Null ends and loops are ignored;
    an empty input gives an empty result.
    """
    both = [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]
    now = written(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(*both).distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        # large star: each node ties its larger neighbours to the smallest of its neighbourhood
        arcs = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = arcs.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = written(large, "large-star")
        # small star: each node ties its smaller neighbours and itself to the smallest of them
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").union(low.select("u", F.col("m").alias("v"))).distinct()
        before, now = now, written(small, "edges")
        for done in (before, least, large, low):
            deleted(done)
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(sign) == mark:
            break
        mark = tuple(sign)
    else:
        raise RuntimeError("connected_components: more rounds than expected")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
