"""Operator 2: near-duplicate vectors by product quantisation.

A coarse quantiser deals unit vectors to inverted lists; the residual to the list's centre is coded by one byte for each
subspace. A vector is compared with the lists of the centres nearest to it: per list, tables of its distances to all
code words give the asymmetric distance to each code by lookups, and those within reach of the threshold (widened by
the quantisation error seen in the sample) are reranked by the exact cosine in double precision.

Index: centres and code words are fitted on a sample of at most `SAMPLE` vectors (and 64 MB), chosen by a digest of their
values; all vectors are indexed and all are queries. The number of lists grows with the number of vectors, so lists stay
of a size: above `MOST_CENTRES` centres, second centres are fitted to what is left of vectors beside their first one, and
a list is a pair of both. A list longer than `BLOCK` is dealt in blocks to several tasks, each of which gets all its
visitors' part. How many lists a vector visits is measured: the links of up to `MEASURED` vectors of the sample are
counted by brute force, and a vector visits twice as many lists as find all of these (a link is found from either side).

Vectors that are equal in direction are one class, compared once. What leaves a task is a count of links for each class
and its components, not pairs: a pair found from both sides is counted once for each side.

Defined results: vectors that are null, zero, or hold null or non-finite components link with nothing. Vectors of
different lengths link with nothing: each length is a space of its own, with an index that the driver fits. Null and
repeated ids are allowed; equal rows are copies. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import connected_components, written
from aerolith.llm.jaccard import Union

THRESHOLD = 0.9
SAMPLE = 65_536
MOST_SAMPLE_BYTES = 64 << 20
LIST_SIZE = 200
MOST_CENTRES = 16_384
#: Lists that a vector visits at least, and without any link in the sample.
LEAST_PROBES, PROBES = 8, 32
MEASURED = 1024
SUBSPACES = 8
WORDS = 256
BLOCK = 1024
#: Of the quantisation errors in the sample, the share that the widened threshold covers.
COVERED = 0.9999


@dataclass
class Index:
    centres: np.ndarray  # (first centres, dim), float32
    second: np.ndarray  # (second centres, dim): of what is left beside the first; one of zeros if there is one level
    words: np.ndarray  # (subspaces, words, dim of a subspace)
    cuts: list[int]
    slack: float
    probes: int

    @property
    def lists(self) -> int:
        return len(self.centres) * len(self.second)

    def centre(self, number: int) -> np.ndarray:
        a, b = divmod(number, len(self.second))
        return self.centres[a] + self.second[b]

    def nearest(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n lists nearest to each row, in order: among the pairs of the nearest first centres (n, and 256 at least,
        so that the nearest list doesn't depend on n) and all second ones."""
        n = min(n, self.lists)
        some = min(n if len(self.second) == 1 else max(n, 256), len(self.centres))
        width = max(len(self.centres), some * len(self.second))
        step = max(1, (16 << 20) // (4 * width))
        if len(x) > step:
            return np.concatenate([self.nearest(x[a : a + step], n) for a in range(0, len(x), step)])
        first, far = _closest(x, self.centres, some)
        if len(self.second) > 1:
            # |x - a - b|^2 = |x - a|^2 + |b|^2 - 2 (x - a) b
            cross = 2 * (self.centres[first] @ self.second.T) - 2 * (x @ self.second.T)[:, None, :]
            far = (far[:, :, None] + (self.second**2).sum(axis=1) + cross).reshape(len(x), -1)
            first = (first[:, :, None] * len(self.second) + np.arange(len(self.second))).reshape(len(x), -1)
        order = np.argsort(far, axis=1, kind="stable")[:, :n]
        return np.take_along_axis(first, order, 1)

    def codes(self, residual: np.ndarray) -> np.ndarray:
        out = np.empty((len(residual), len(self.words)), np.uint8)
        for m, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            w = self.words[m][:, : b - a]
            out[:, m] = _own(residual[:, a:b], w)
        return out

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([self.words[m][codes[:, m]][:, : b - a] for m, (a, b) in enumerate(zip(self.cuts, self.cuts[1:]))], axis=1)

    def tables(self, residual: np.ndarray) -> np.ndarray:
        """(rows, subspaces, words): squared distances of each row's parts to all code words."""
        parts = []
        for m, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            r, w = residual[:, a:b], self.words[m][:, : b - a]
            parts.append((r**2).sum(axis=1)[:, None] + (w**2).sum(axis=1)[None, :] - 2 * (r @ w.T))
        return np.stack(parts, axis=1)


def _closest(x: np.ndarray, centres: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, squared distances) of the n nearest centres of each row."""
    far = (x**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :] - 2 * (x @ centres.T)
    some = np.argpartition(far, n - 1, axis=1)[:, :n]
    return some, np.take_along_axis(far, some, 1)


def _own(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row."""
    squares = (centres**2).sum(axis=1)[None, :]
    step = max(1, (16 << 20) // (4 * len(centres)))
    return np.concatenate([np.argmin(squares - 2 * (x[a : a + step] @ centres.T), axis=1) for a in range(0, len(x), step)])


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        own = _own(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=k)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres).astype(np.float32)
    return centres


def needed_probes(index: Index, sample: np.ndarray, threshold: float, measured: int = MEASURED, links: int = 64, most: int = 256) -> int | None:
    """How many lists the vectors of a sample must visit, so that up to `links` links of each of some of them are found
    from either side: 1 if no link leaves a list, null without any link. Where `most` lists are too few for a link, four
    times as many are looked at, up to all."""
    home = index.nearest(sample, 1)[:, 0]
    queries = np.arange(0, len(sample), -(-len(sample) // measured))
    pairs, linked = [np.zeros((0, 2), np.int64)], False
    for at in range(0, len(queries), 128):
        some = queries[at : at + 128]
        near = sample[some] @ sample.T >= threshold
        near[np.arange(len(some)), some] = False
        linked = linked or bool(near.any())
        for q, row in zip(some.tolist(), near, strict=True):
            found = np.flatnonzero(row)
            found = found[home[found] != home[q]]
            found = found[:: max(1, -(-len(found) // links))]
            pairs.append(np.stack([np.full(len(found), q), found], axis=1))
    pairs = np.concatenate(pairs)
    if not len(pairs):
        return 1 if linked else None
    needed = 1
    while len(pairs):
        most = min(most, index.lists)
        rows, number = np.unique(pairs, return_inverse=True)
        number = number.reshape(pairs.shape)
        place = np.full(len(pairs), most + 1)
        for side in (0, 1):
            # a stretch of rows at a time: their lists are many
            for at in range(0, len(rows), 1 << 14):
                near = index.nearest(sample[rows[at : at + (1 << 14)]], most).astype(np.int32)
                mine = np.flatnonzero((number[:, side] >= at) & (number[:, side] < at + (1 << 14)))
                for k in range(0, len(mine), 1 << 12):
                    some = mine[k : k + (1 << 12)]
                    hit = near[number[some, side] - at] == home[pairs[some, 1 - side]][:, None]
                    place[some] = np.minimum(place[some], np.where(hit.any(axis=1), hit.argmax(axis=1) + 1, most + 1))
        found = place <= most
        needed = max(needed, int(place[found].max(initial=1)))
        pairs = pairs[~found]
        if most == index.lists:
            break
        most *= 4
    return needed


def fit(sample: np.ndarray, n_vectors: int, threshold: float = THRESHOLD, probes: int | None = None, seed: int = 1) -> Index:
    """An index for n_vectors unit vectors, fitted on a sample of them."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    lists = max(1, round(n_vectors / LIST_SIZE))
    centres = _kmeans(sample, max(1, min(lists, MOST_CENTRES, len(sample))), rng)
    residual = sample - centres[_own(sample, centres)]
    more = max(1, min(len(sample), round(lists / len(centres))))
    second = _kmeans(residual, more, rng) if more > 1 else np.zeros((1, dim), np.float32)
    parts = min(SUBSPACES, dim)
    cuts = [round(k * dim / parts) for k in range(parts + 1)]
    width = max(b - a for a, b in zip(cuts, cuts[1:]))
    index = Index(centres, second, np.zeros((parts, WORDS, width), np.float32), cuts, 0.0, 1)
    home = index.nearest(sample, 1)[:, 0]
    residual = sample - np.stack([index.centre(int(h)) for h in home]) if more > 1 else residual
    for m, (a, b) in enumerate(zip(cuts, cuts[1:])):
        index.words[m, :, : b - a] = _kmeans(residual[:, a:b], WORDS, rng, 6)
    error = np.linalg.norm(residual - index.decoded(index.codes(residual)), axis=1)
    index.slack = float(np.quantile(error, COVERED)) if len(error) else 0.0
    found = needed_probes(index, sample, threshold) if probes is None and index.lists > 1 else None
    index.probes = min(index.lists, probes or (PROBES if found is None else max(LEAST_PROBES, 2 * found)))
    return index


def _unit(raw: bytes) -> np.ndarray:
    x = np.frombuffer(raw, "<f8")
    return x / np.sqrt(x @ x)


def near_pairs(index: Index, home: int, visitors: np.ndarray, members: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(visitor, member) of all pairs with cosine >= threshold that table lookups let through; rows of unit doubles."""
    centre = index.centre(home).astype(np.float64)
    codes = index.codes((members - centre).astype(np.float32))
    reach = (math.sqrt(max(0.0, 2 - 2 * threshold)) + index.slack) ** 2 + 1e-6
    left, right = [], []
    for at in range(0, len(visitors), 128):
        some = visitors[at : at + 128]
        tables = index.tables((some - centre).astype(np.float32))
        far = np.zeros((len(some), len(members)), np.float32)
        for m in range(codes.shape[1]):
            far += tables[:, m, :][:, codes[:, m]]
        a, b = np.nonzero(far <= reach)
        for k in range(0, len(a), 1 << 15):
            u, v = a[k : k + (1 << 15)], b[k : k + (1 << 15)]
            good = np.einsum("ij,ij->i", some[u], members[v]) >= threshold
            left.append(u[good] + at)
            right.append(v[good])
    if not left:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(left), np.concatenate(right)


def link(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, probes: int | None = None, sample: int = SAMPLE) -> DataFrame:
    """One row for each row of df: id, n_links (other vectors linked), component_id (smallest id that links reach) and
    class_id (smallest id with the same direction)."""
    spark = df.sparkSession
    rows = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    kind = rows.schema["id"].dataType.simpleString()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, units, dims = [], [], []
            for x in batch.column("x").to_pylist():
                v = np.array([math.nan if c is None else c for c in x or ()], np.float64)
                with np.errstate(over="ignore", invalid="ignore"):
                    v = v / np.abs(v).max() if len(v) and np.isfinite(v).all() and v.any() else v[:0]
                    v = v / np.sqrt(v @ v) if len(v) else v
                nodes.append(xxhash.xxh3_128_digest(v.tobytes()) if len(v) else None)
                units.append(v.astype("<f8").tobytes() if len(v) else None)
                dims.append(len(v))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(nodes, pa.binary()), pa.array(units, pa.binary()), pa.array(dims, pa.int32())], ["id", "node", "unit", "dim"])

    every = written(rows.mapInArrow(keyed, f"id {kind}, node binary, unit binary, dim int"), "vectors-units")
    classes = every.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"), F.min("id").alias("class_id"), F.min(F.struct("dim", "unit")).alias("u"))
    classes = written(classes.select("node", "copies", "class_id", "u.*"), "vectors-classes")
    sizes = {r.dim: r.n for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    indexes = {}
    for dim, n in sizes.items():
        most = max(1000, min(sample, MOST_SAMPLE_BYTES // (8 * dim)))
        share = min(1.0, most / n)
        some = classes.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < share * (1 << 30)))
        some = [r.unit for r in some.select("node", "unit").orderBy("node").limit(2 * most).select("unit").toLocalIterator()]
        if not some:
            some = [classes.where(F.col("dim") == dim).first().unit]
        indexes[dim] = fit(np.stack([np.frombuffer(x, "<f8") for x in some]).astype(np.float32), n, threshold, probes)
    shared = spark.sparkContext.broadcast(indexes)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array(batch.column("dim").to_pylist(), int)
            units = batch.column("unit").to_pylist()
            lists: list = [None] * len(units)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = np.stack([np.frombuffer(units[k], "<f8") for k in at]).astype(np.float32)
                for a in range(0, len(at), 1024):
                    near = shared.value[int(dim)].nearest(x[a : a + 1024], shared.value[int(dim)].probes)
                    for k, row in zip(at[a : a + 1024], near.tolist(), strict=True):
                        lists[k] = row
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "copies", "dim", "unit")), pa.array(lists, pa.list_(pa.int32()))], ["node", "copies", "dim", "unit", "lists"])

    placed = written(classes.select("node", "copies", "dim", "unit").mapInArrow(dealt, "node binary, copies long, dim int, unit binary, lists array<int>"), "vectors-placed")
    placed = placed.withColumn("home", F.col("lists")[0])
    lengths = written(placed.groupBy("dim", "home").agg(F.count("*").alias("n")).select("dim", "home", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "vectors-lists")
    # a list's members are dealt to its blocks; each of its visitors goes to every block
    base = placed.join(lengths, ["dim", "home"]).select("dim", F.col("home").alias("list"), F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), F.lit(True).alias("member"), "node", "copies", "unit", "lists")
    visits = placed.withColumn("list", F.explode("lists")).join(lengths.withColumnRenamed("home", "list"), ["dim", "list"])
    visits = visits.select("dim", "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("member"), "node", "copies", "unit", "lists")
    cells = base.union(visits).repartition("dim", "list", "block").sortWithinPartitions("dim", "list", "block", F.desc("member"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, members, visitors = None, [], []
        out: list[tuple] = []
        kinds = (pa.binary(), pa.int64(), pa.binary())

        def meet() -> None:
            index = shared.value[cell[0]]
            a, b = near_pairs(index, cell[1], np.stack([_unit(v[2]) for v in visitors]), np.stack([_unit(m[2]) for m in members]), threshold)
            counts: dict[bytes, int] = {}
            names = {r[0]: k for k, r in enumerate([*members, *visitors])}
            order = sorted(names)
            number = {name: k for k, name in enumerate(order)}
            sets = Union(len(order))
            probed = [set(m[3]) for m in members]
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                v, m = visitors[i], members[j]
                if v[0] == m[0]:
                    continue
                sets.join(number[v[0]], number[m[0]])
                counts[v[0]] = counts.get(v[0], 0) + m[1]
                if v[3][0] not in probed[j]:  # else the member finds the visitor in the visitor's list
                    counts[m[0]] = counts.get(m[0], 0) + v[1]
            out.extend((name, n, order[sets.root(number[name])]) for name, n in counts.items())
            out.extend((name, 0, order[sets.root(k)]) for name, k in number.items() if name not in counts and sets.root(k) != k)

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 3
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], ["node", "links", "root"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("dim", "list", "block", "member", "node", "copies", "unit", "lists")), strict=True):
                if row[:3] != cell:
                    if members and visitors:
                        meet()
                    cell, members, visitors = row[:3], [], []
                if row[3]:
                    members.append(row[4:])
                else:
                    visitors.append(row[4:])
                    if len(visitors) >= 4 * BLOCK:  # members come first, so visitors can pass by
                        meet()
                        visitors = []
            if len(out) > 20_000:
                yield batch_of()
        if members and visitors:
            meet()
        yield batch_of()

    links = written(cells.mapInArrow(compared, "node binary, links long, root binary"), "vectors-links")
    components = connected_components(links.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_class = classes.select("node", "copies", "class_id").join(links.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(components, "node", "left")
    per_class = per_class.withColumn("component", F.coalesce("component", "node"))
    # written, so that the join can be split where one component is very large
    heads = written(per_class.groupBy("component").agg(F.min("class_id").alias("component_id")), "vectors-heads")
    per_class = per_class.join(heads, "component").select(F.col("node").alias("n"), "class_id", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    found = every.select("id", "node").join(per_class, F.col("node") == F.col("n"), "left")
    alone = F.col("node").isNull()
    return found.select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"))
