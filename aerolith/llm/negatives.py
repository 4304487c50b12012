"""Operator 13: hard negatives of anchors by inner product, with a pivot table.

Vectors are augmented by one component, so that all have the length M of the longest one; an anchor gets a zero there.
Then |q - x|^2 = |q|^2 + M^2 - 2 <q, x>: the nearest rows are those with the highest inner product, and distances keep
the triangle inequality. The pivot table stores each row's distances to a few pivots far from each other and to the
centre of its cell. An anchor's own distances to these bracket its distance to a row, |d(q,p) - d(x,p)| <= d(q,x) <=
d(q,p) + d(x,p), and so their score, without a look at the row's vector; the extremes of a cell's distances bracket the
scores of all its rows. Cells and rows that cannot matter are passed over, the survivors' scores are worked out in whole
numbers.

Three passes, each a shuffle of cells with the anchors that visit them: the anchor's nearest cell gives a score that its
last positive has at least; with it the other cells give the positives; the positives' scores bound the cells of their
negatives. Cells are dealt in blocks of bounded size to different tasks, and what a block gives for an anchor is bounded
too. The driver holds pivots, centres and the cells' extremes, at most `MOST_CELLS` of them.

Defined results: rows with a null label or vector, or with null components take no part. Vectors have products with those
of equal length alone. Rows are told apart, not ids: of repeated rows each is an anchor, a positive, a negative by itself.
Rows without id are no anchors and come last among equal scores. Scores beyond 64 bits count as the nearest 64-bit number. Anchors without positives, and positives without negatives, have no rows. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import written

#: Pivots whose distances are stored; cells at most, and the rows that a cell is meant to have below that.
PIVOTS = 16
MOST_CELLS = 256
CELL_ROWS = 2000
#: Rows from which pivots and centres are chosen: so many, and so many bytes, at most.
SAMPLE, SAMPLE_BYTES = 2048, 16 << 20
#: A block of a cell: rows and bytes (as doubles) at most, but for one row.
BLOCK_ROWS, BLOCK_BYTES = 16_384, 32 << 20
LONG = 1 << 63


def packed(x: np.ndarray) -> bytes:
    """Whole numbers in the narrowest of 2, 4 and 8 bytes, which the last byte tells."""
    most = max(int(x.max()), -int(x.min())) if len(x) else 0
    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return x.astype(f"<i{width}").tobytes() + bytes([width])


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<i{raw[-1]}", count=(len(raw) - 1) // raw[-1])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers: doubles where these hold all sums and a hundred times
    as much exactly, else Python's numbers, held within 64 bits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)))
    most = max(abs(int(a.max())), abs(int(a.min()))) * max(abs(int(b.max())), abs(int(b.min()))) * a.shape[1]
    if most < 1 << 46:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return np.clip(a.astype(object) @ b.astype(object).T, -LONG, LONG - 1)


@dataclass
class Pivots:
    """Centres of cells; the first `PIVOTS` are those whose distances are stored."""

    centres: np.ndarray  # (cells, longest), doubles, shorter ones filled with zeros
    rest: np.ndarray  # their added component
    square: float  # M^2
    extremes: dict[int, tuple[np.ndarray, np.ndarray]] | None = None  # of a cell: least and greatest distances

    def slack(self, dim: int) -> float:
        """More than rounding can move a stored distance, a computed one and their sum."""
        return math.sqrt(self.square) * (8e-6 + 8 * math.sqrt(dim * 4e-16))

    def _with(self, x: np.ndarray) -> np.ndarray:
        n = min(x.shape[1], self.centres.shape[1])
        return x[:, :n] @ self.centres[:, :n].T

    def of_rows(self, x: np.ndarray) -> np.ndarray:
        """(rows, cells): distances of augmented rows to augmented centres."""
        rest = np.sqrt(np.maximum(self.square - (x * x).sum(axis=1), 0))
        return np.sqrt(np.maximum(2 * (self.square - self._with(x) - rest[:, None] * self.rest[None, :]), 0))

    def of_anchors(self, q: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((q * q).sum(axis=1)[:, None] + self.square - 2 * self._with(q), 0))

    def scores(self, square: np.ndarray, low: np.ndarray, high: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """Brackets of scores from those of distances."""
        slack = self.slack(dim)
        low, high = np.maximum(low - slack, 0), high + slack
        return (square + self.square - high * high) / 2, (square + self.square - low * low) / 2

    def of_cells(self, q: np.ndarray, cells: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchors, cells): brackets of the scores of all rows of cells; and the distances to all centres."""
        far = self.of_anchors(q)
        low, high = np.zeros((len(q), len(cells))), np.full((len(q), len(cells)), np.inf)
        least, most = (np.stack([self.extremes[c][k] for c in cells]) for k in (0, 1))
        n = least.shape[1] - 1
        for k in range(n + 1):
            d = far[:, cells] if k == n else far[:, [k]]
            low = np.maximum(low, np.maximum(d - most[:, k], least[:, k] - d))
            high = np.minimum(high, d + most[:, k])
        return *self.scores((q * q).sum(axis=1)[:, None], low, high, q.shape[1]), far


def choose(sample: list[np.ndarray], square: float, cells: int) -> Pivots:
    """Centres from a sample: first those that are farthest from all before, then the sample's next ones."""
    longest = max((len(x) for x in sample), default=0)
    x = np.zeros((max(1, len(sample)), longest))
    for k, row in enumerate(sample):
        x[k, : len(row)] = row
    rest = np.sqrt(np.maximum(square - (x * x).sum(axis=1), 0))
    every = Pivots(x, rest, square)
    chosen, near = [0], every.of_rows(x[:1])[0]
    while len(chosen) < min(PIVOTS, len(x)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, every.of_rows(x[chosen[-1:]])[0])
    taken = set(chosen)
    chosen += [k for k in range(len(x)) if k not in taken][: max(0, cells - len(chosen))]
    return Pivots(x[chosen], rest[chosen], square)


def _by_length(vectors: list[np.ndarray]) -> dict[int, np.ndarray]:
    """Length -> places of the vectors that have it."""
    lengths = np.array([len(x) for x in vectors], int)
    return {int(n): np.flatnonzero(lengths == n) for n in np.unique(lengths)}


@dataclass
class Block:
    """Members of a block: rows of a cell by vector length."""

    row: np.ndarray
    id: np.ndarray
    nameless: np.ndarray
    label: np.ndarray
    far: np.ndarray  # (members, PIVOTS + 1)
    x: list[np.ndarray]

    def __post_init__(self) -> None:
        self.parts = {n: (at, np.stack([self.x[k] for k in at])) for n, at in _by_length(self.x).items()}

    def best(self, pivots: Pivots, anchors: list[tuple], same: bool, count: int) -> Iterator[tuple]:
        """(anchor's row, bound, score, id, row) of each anchor's count best members of the same label, or of another one
        below each of its bounds. anchors: (row, label, vector, distances, least score, bounds), of one vector length."""
        at, x = self.parts.get(len(anchors[0][2]), (None, None))
        if at is None:
            return
        q = np.stack([a[2] for a in anchors])
        far = np.array([a[3] for a in anchors])
        low, high = np.zeros((len(q), len(at))), np.full((len(q), len(at)), np.inf)
        for k in range(far.shape[1]):
            d, e = far[:, [k]], self.far[at, k][None, :]
            low = np.maximum(low, np.abs(d - e))
            high = np.minimum(high, d + e)
        exact = q.astype(np.float64)
        worst, top = pivots.scores((exact * exact).sum(axis=1)[:, None], low, high, q.shape[1])
        labels = np.array([a[1] for a in anchors])[:, None]
        left = (top >= np.array([[float(a[4])] for a in anchors])) & ((labels == self.label[at]) == same)
        left &= np.array([a[0] for a in anchors])[:, None] != self.row[at]
        if not same:
            left &= worst <= np.array([[float(max(a[5]))] for a in anchors])
        every = products(q, x) if left.mean() > 0.1 else None
        for k, a in enumerate(anchors):
            some = np.flatnonzero(left[k])
            if not len(some):
                continue
            s = every[k, some] if every is not None else products(q[k : k + 1], x[some])[0]
            for bound in [None] if same else a[5]:
                fits = slice(None) if same else np.flatnonzero((100 * s >= 80 * bound) & (s <= bound)) if s.dtype != object else np.array([j for j, y in enumerate(s) if 80 * bound <= 100 * y and y <= bound], int)
                t, members = s[fits], at[some[fits]]
                if len(t) > count and t.dtype != object:
                    good = t >= np.partition(t, len(t) - count)[len(t) - count]
                    t, members = t[good], members[good]
                order = sorted(range(len(t)), key=lambda j: (-t[j], bool(self.nameless[members[j]]), self.id[members[j]], self.row[members[j]])) if t.dtype == object else np.lexsort((self.row[members], self.id[members], self.nameless[members], -t))
                for j in list(order)[:count]:
                    m = members[j]
                    yield a[0], bound, int(t[j]), None if self.nameless[m] else int(self.id[m]), int(self.row[m])


FOUND = "anchor long, bound long, score long, id long, row long"


def mine(df: DataFrame, anchor: Column, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = 5, negatives: int = 5) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for the rows where anchor holds and
    each of their best other rows of the same label, the best rows of other labels that score at least 80 and at most
    100 percent of the positive. vector: an array of whole numbers."""
    spark = df.sparkSession
    x = F.col(f"`{vector}`").cast("array<bigint>")
    there = F.col(f"`{label}`").isNotNull() & F.col(f"`{vector}`").isNotNull() & F.forall(x, lambda c: c.isNotNull())
    valid = df.where(there).select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), x.alias("x"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.asarray(v.values.to_numpy(zero_copy_only=False), np.int64) for v in batch.column("x")]
            squares = [float((v.astype(np.float64) ** 2).sum()) for v in vectors]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "label", "anchor")), pa.array(map(packed, vectors), pa.binary()), pa.array(map(len, vectors), pa.int64()), pa.array(squares, pa.float64())], ["id", "label", "anchor", "x", "dim", "square"])

    rows = valid.mapInArrow(pack, "id long, label long, anchor boolean, x binary, dim long, square double")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    n, square, longest = rows.agg(F.count("*"), F.max("square"), F.max("dim")).first()
    if not n:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * max(1, longest))))
    digest = F.xxhash64("x")
    share = min(1.0, 4 * most / n)
    sample = rows.where((F.pmod(digest, F.lit(1 << 30)) <= share * (1 << 30)) & (F.col("dim") <= SAMPLE_BYTES // 8)).select("x", digest.alias("h")).distinct().orderBy("h", "x").limit(most)
    chosen = choose([unpacked(r.x).astype(np.float64) for r in sample.toLocalIterator()], square, min(MOST_CELLS, max(1, round(n / CELL_ROWS))))
    stored = min(PIVOTS, len(chosen.centres))
    first = spark.sparkContext.broadcast(chosen)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [unpacked(v) for v in batch.column("x").to_pylist()]
            cells, far = np.zeros(len(vectors), np.int32), np.zeros((len(vectors), stored + 1), np.float32)
            for at in _by_length(vectors).values():
                for k in range(0, len(at), 1024):
                    some = at[k : k + 1024]
                    d = first.value.of_rows(np.stack([vectors[j] for j in some]).astype(np.float64))
                    cells[some] = d.argmin(axis=1)
                    far[some] = np.concatenate([d[:, :stored], d.min(axis=1, keepdims=True)], axis=1)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(far.ravel()), stored + 1).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "id", "label", "anchor", "x", "dim")), pa.array(cells), flat], ["row", "id", "label", "anchor", "x", "dim", "cell", "far"])

    table = written(rows.select("row", "id", "label", "anchor", "x", "dim").mapInArrow(place, "row long, id long, label long, anchor boolean, x binary, dim long, cell int, far array<float>"), "negatives-table")
    ends = [f(F.col("far")[k]).alias(f"{name}{k}") for name, f in (("a", F.min), ("b", F.max)) for k in range(stored + 1)]
    cells = table.groupBy("cell").agg(F.count("*").alias("n"), F.sum("dim").alias("d"), *ends).collect()  # MOST_CELLS or PIVOTS rows at most
    chosen.extremes = {r.cell: tuple(np.array([r[f"{name}{k}"] for k in range(stored + 1)], float) for name in "ab") for r in cells}
    count = {r.cell: max(-(-r.n // BLOCK_ROWS), -(-8 * r.d // BLOCK_BYTES), 1) for r in cells}
    pivots = spark.sparkContext.broadcast(chosen)
    parts = spark.createDataFrame(sorted(count.items()), "cell int, blocks long")
    members = table.join(F.broadcast(parts), "cell").select("cell", F.pmod(F.xxhash64("row"), F.col("blocks")).alias("block"), F.lit(False).alias("visit"), "row", "id", "label", "x", F.col("far").cast("array<double>").alias("far"), F.lit(None).cast("double").alias("least"), F.lit(None).cast("array<long>").alias("bounds"))

    columns_of, layout = members.columns, members.schema

    def visits(anchors: DataFrame, home: bool, same: bool) -> DataFrame:
        """Anchors (row, label, x, least, bounds) with the blocks they visit: of their nearest cell, or of all other
        ones (of all, for negatives) that can have scores from least to the greatest bound."""
        known = sorted(count)

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row, label, raw, least, bounds = (batch.column(c).to_pylist() for c in ("row", "label", "x", "least", "bounds"))
                vectors = [unpacked(v) for v in raw]
                out: list[tuple] = []
                for at in _by_length(vectors).values():
                    for k in range(0, len(at), 256):
                        some = at[k : k + 256]
                        low, top, far = pivots.value.of_cells(np.stack([vectors[j] for j in some]).astype(np.float64), known)
                        nearest = far[:, known].argmin(axis=1)
                        for i, j in enumerate(some.tolist()):
                            if home:
                                go = [int(nearest[i])]
                            else:
                                fits = top[i] >= least[j]
                                if same:
                                    fits[nearest[i]] = False
                                else:
                                    fits &= low[i] <= max(bounds[j])
                                go = np.flatnonzero(fits).tolist()
                            own = [float(d) for d in far[i, :stored]]
                            out += [(known[c], b, True, row[j], None, label[j], raw[j], [*own, float(far[i, known[c]])], least[j], bounds[j]) for c in go for b in range(count[known[c]])]
                            if len(out) > 4000:
                                yield as_batch(out)
                yield as_batch(out)

        kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.float64()), pa.float64(), pa.list_(pa.int64()))

        def as_batch(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], columns_of)

        return anchors.select("row", "label", "x", "least", "bounds").mapInArrow(route, layout)

    def found(visitors: DataFrame, same: bool, best: int, label: str) -> DataFrame:
        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cell, block, kept, waiting, out = None, None, [], [], []

            def compare() -> None:
                nonlocal block
                if kept and waiting:
                    if block is None:
                        row, ids, labels, raw, far = zip(*kept, strict=True)
                        block = Block(np.array(row), np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids]), np.array(labels), np.array(far), [unpacked(v) for v in raw])
                    vectors = [unpacked(w[2]) for w in waiting]
                    for at in _by_length(vectors).values():
                        out.extend(block.best(pivots.value, [(w[0], w[1], vectors[k], w[3], w[4], w[5]) for k in at for w in (waiting[k],)], same, best))
                waiting.clear()

            def as_batch() -> pa.RecordBatch:
                columns = list(zip(*out, strict=True)) or [()] * 5
                out.clear()
                return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "bound", "score", "id", "row"])

            for batch in batches:
                for r in zip(*(batch.column(c).to_pylist() for c in columns_of), strict=True):
                    if r[:2] != cell:
                        compare()
                        cell, block, kept = r[:2], None, []
                    if r[2]:
                        waiting.append((r[3], r[5], r[6], r[7], r[8], r[9]))
                        if len(waiting) >= 64:
                            compare()
                    else:
                        kept.append((r[3], r[4], r[5], r[6], r[7]))
                if len(out) > 4000:
                    yield as_batch()
            compare()
            yield as_batch()

        visitors = written(visitors, f"negatives-visits-{label}")
        there = members.join(visitors.select("cell", "block").distinct(), ["cell", "block"], "left_semi")
        dealt = there.union(visitors).repartition("cell", "block").sortWithinPartitions("cell", "block", "visit")
        return written(dealt.mapInArrow(meet, FOUND), f"negatives-{label}")

    def first_of(found: DataFrame, by: list[str], count: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)

    anchors = table.where("anchor").select("row", "id", "label", "x")
    none = F.lit(None).cast("array<long>").alias("bounds")
    near = found(visits(anchors.withColumns({"least": F.lit(-math.inf)}).withColumn("bounds", none), True, True), True, positives, "near")
    # the last of so many in the nearest cell: no positive scores less
    least = first_of(near, ["anchor"], positives).where(F.col("rank") == positives).select(F.col("anchor").alias("row"), F.col("score").cast("double").alias("least"))
    bounded = anchors.join(least, "row", "left").withColumn("least", F.coalesce("least", F.lit(-math.inf))).withColumn("bounds", none)
    far = found(visits(bounded, False, True), True, positives, "far")
    best = written(first_of(near.union(far), ["anchor"], positives).select("anchor", F.col("id").alias("positive_id"), F.col("row").alias("positive_row"), F.col("score").alias("positive_score")), "negatives-positives")
    bounds = best.where("positive_score >= 0").groupBy("anchor").agg(F.array_sort(F.collect_set("positive_score")).alias("bounds"))
    asking = anchors.join(bounds.withColumnRenamed("anchor", "row"), "row").withColumn("least", F.array_min("bounds") * F.lit(0.8))
    hard = first_of(found(visits(asking, False, False), False, negatives, "hard"), ["anchor", "bound"], negatives)
    hard = hard.select("anchor", F.col("bound").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return best.join(hard, ["anchor", "positive_score"]).join(named, "anchor").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
