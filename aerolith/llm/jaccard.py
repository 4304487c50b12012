"""Operator 9: n-gram Jaccard join by MinHash banding, verified on full n-gram sets.

A document is the set of its word n-grams (five words; fewer words make one n-gram of them all). Two documents link if
the Jaccard similarity of their sets is at least the threshold.

1. Documents with equal sets are one class; from here on a class is one row, so copies cost nothing more.
2. Each class has a MinHash signature, cut into bands. Rows and bands are chosen so that a pair at the threshold shares
   a band with the target recall. Classes are shuffled by band hash; a bucket of one is dropped.
3. In a bucket, pairs whose signatures agree by far less than the threshold would (`LEAST_ESTIMATE`, six deviations
   below) are dropped, the others are candidates. Buckets of at most `BUCKET` classes are compared in one task. A larger
   one is compared with its smallest class, by a join that adaptive execution can split; classes that are not near that
   one are compared with all of the bucket in pairs of blocks, of which only edges of components leave a task.
4. Candidates are not emitted as pairs but as families: connected components, with as many edges as classes.
5. Each family's n-gram sets are fetched once, and all pairs in it are verified in blocks, so that one task gets two
   blocks at most; a task returns a count of links for each class and its components, never pairs.

Defined results: a document without words (null, empty or white space) has no n-grams and links with nothing. Copies
link with each other. Null ids and repeated ids are allowed; equal rows are copies. Extra columns are kept out of the
way: only id and text are read. n-grams are told apart by 64-bit hashes, sets by 128 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import connected_components, deleted, free_names, small_pieces, take_over, written

WORDS = 5
THRESHOLD = (4, 5)  # as a fraction
RECALL = 0.99999
MOST_HASHES = 160
LEAST_ESTIMATE = 0.6
BUCKET = 256
BLOCK = 128
#: Classes of a block whose sets are compared with another's, and of one whose signatures are.
MOST_BLOCK = 1024
MOST_CELL = 4096
MOST_REMEMBERED = 200_000
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def choose_bands(threshold: float, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows with which a pair at the threshold shares a band with the recall asked for."""
    best = (1, 1)
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > most:
            break
        best = bands, rows
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * M1
        x = (x ^ (x >> np.uint64(27))) * M2
        return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= MOST_REMEMBERED:
                self.clear()
            self[word] = h
        return h


_words = _Hashes()


def grams(text: bytes, words: int = WORDS) -> np.ndarray:
    """The set of a text's n-grams, as sorted 64-bit hashes."""
    found = text.split()
    h = np.fromiter(map(_words.__getitem__, found), np.uint64, len(found))
    n = min(words, len(h))
    if not n:
        return h
    with np.errstate(over="ignore"):
        whole = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            whole = whole * M2 + h[k : len(h) - n + 1 + k]
    return np.unique(_mix(whole))


class MinHash:
    def __init__(self, bands: int, rows: int, seed: int = 1):
        self.bands, self.rows = bands, rows
        rng = np.random.default_rng(seed)
        self.by = rng.integers(0, 1 << 63, bands * rows, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
        self.fold = rng.integers(0, 1 << 63, rows, np.uint64) * np.uint64(2) + np.uint64(1)
        self.band = _mix(np.arange(1, bands + 1, dtype=np.uint64))

    def signature(self, grams: np.ndarray) -> np.ndarray:
        low = np.full(self.bands * self.rows, np.iinfo(np.uint64).max)
        with np.errstate(over="ignore"):
            for at in range(0, len(grams), 512):
                np.minimum(low, (grams[at : at + 512] * self.by).min(axis=1), out=low)
        return _mix(low)

    def keys(self, signature: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mix((signature.reshape(self.bands, self.rows) * self.fold).sum(axis=1) ^ self.band)

    @staticmethod
    def brief(signature: np.ndarray) -> bytes:
        """One byte of each value: enough to estimate a similarity."""
        return (signature & np.uint64(255)).astype(np.uint8).tobytes()


class Union:
    """Components of a few items by number; the root is the smallest."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


EDGE = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _bucket_edges(least: int):
    """Edges between near classes of small buckets: rows (key, node, brief), sorted by key."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple[bytes, bytes]] = []

        def close() -> None:
            if len(held) > 1:
                nodes = [r[1] for r in held]
                sigs = np.frombuffer(b"".join(r[2] for r in held), np.uint8).reshape(len(held), -1)
                sets = Union(len(held))
                for k in range(len(held) - 1):
                    for j in np.flatnonzero((sigs[k + 1 :] == sigs[k]).sum(axis=1) >= least):
                        sets.join(k, k + 1 + int(j))
                out.extend((nodes[k], nodes[sets.root(k)]) for k in range(len(nodes)) if sets.root(k) != k)
            held.clear()

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "node", "brief")), strict=True):
                if held and held[0][0] != row[0]:
                    close()
                held.append(row)
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*out, strict=True)], schema=EDGE)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*out, strict=True)], schema=EDGE)

    return found


def agreement(a: str, b: str) -> Column:
    """How many bytes of two brief signatures agree."""

    @F.arrow_udf("int")
    def agree(a: pa.Array, b: pa.Array) -> pa.Array:
        out = [0 if x is None or y is None else int((np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)).sum()) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)]
        return pa.array(out, pa.int32())

    return agree(F.col(a), F.col(b))


def _cell_edges(least: int):
    """Edges between the others and near classes of all their bucket: rows (key, i, j, node, brief, other), sorted by
    cell (key, i, j), which has a block of the bucket's others and a block of all its classes."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        cell = None

        def result() -> pa.RecordBatch:
            names = sorted({r[0] for r in held})
            number = {x: k for k, x in enumerate(names)}
            sides = [[r for r in held if r[2] == side] for side in (True, False)]
            sets, out = Union(len(names)), []
            if all(sides):
                own = np.array([number[r[0]] for r in sides[1]])
                sigs = np.frombuffer(b"".join(r[1] for r in sides[1]), np.uint8).reshape(len(own), -1)
                for node, brief, _ in sides[0]:
                    for j in own[(sigs == np.frombuffer(brief, np.uint8)).sum(axis=1) >= least].tolist():
                        sets.join(number[node], j)
                out = [(names[k], names[sets.root(k)]) for k in range(len(names)) if sets.root(k) != k]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in list(zip(*out, strict=True)) or [[]] * 2], schema=EDGE)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j", "node", "brief", "other")), strict=True):
                if row[:3] != cell:
                    if held:
                        yield result()
                    held, cell = [], row[:3]
                held.append(row[3:])
        if held:
            yield result()

    return found


def candidate_edges(rows: DataFrame, briefs: DataFrame, least: int) -> DataFrame:
    """Edges (a, b) that tie near classes together: rows (key, node) say which classes meet, briefs has (node, brief)."""
    # written, so that the join can be split where one bucket is very large
    sizes = written(rows.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "jaccard-buckets")
    met = written(rows.join(sizes, "key").join(briefs, "node"), "jaccard-met")
    small = met.where(F.col("m") <= BUCKET).select("key", "node", "brief").repartition("key").sortWithinPartitions("key", "node")
    edges = small.mapInArrow(_bucket_edges(least), "a binary, b binary")
    large = met.where(F.col("m") > BUCKET)
    first = large.groupBy("key").agg(F.min("node").alias("c")).join(briefs.select(F.col("node").alias("c"), F.col("brief").alias("cb")), "c")
    near = written(large.join(first, "key").select("key", "node", "brief", "m", "c", (agreement("brief", "cb") >= least).alias("near")), "jaccard-large")
    edges = edges.union(near.where("near AND node != c").select(F.col("node").alias("a"), F.col("c").alias("b")))
    # those near the centre are one family already; the others meet all of their bucket, in cells of two blocks
    step = F.greatest(F.lit(BUCKET), F.least(F.lit(MOST_CELL), F.expr("m div 64")))
    others = written(near.where("NOT near").groupBy("key").agg(F.count("*").alias("n")), "jaccard-others")
    dealt = near.join(others, "key").select("key", "node", "brief", "near", F.ceil(F.col("n") / step).alias("is"), F.ceil(F.col("m") / step).alias("js"), F.xxhash64("node").alias("h"))
    block, every = lambda n: F.pmod("h", F.col(n)), lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    cells = dealt.where("NOT near").select("key", block("is").alias("i"), every("js").alias("j"), "node", "brief", F.lit(True).alias("other"))
    cells = cells.union(dealt.select("key", every("is").alias("i"), block("js").alias("j"), "node", "brief", F.lit(False).alias("other")))
    cells = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return written(edges.union(cells.mapInArrow(_cell_edges(least), "a binary, b binary")).distinct(), "jaccard-edges")


def _verified(threshold: tuple[int, int]):
    """Links of each class in each cell of a family: rows (family, i, j, node, block, copies, grams), sorted by cell."""
    up, down = threshold

    def links(rows: list[tuple], i: int, j: int) -> list[tuple]:
        rows.sort(key=lambda r: r[0])
        n = len(rows)
        sizes = np.array([len(r[3]) // 8 for r in rows])
        copies = np.array([r[2] for r in rows], np.int64)
        block = np.array([r[1] for r in rows])
        every = np.frombuffer(b"".join(r[3] for r in rows), np.uint64)
        owner = np.repeat(np.arange(n), sizes)
        _, place, counts = np.unique(every, return_inverse=True, return_counts=True)
        shared = counts[place] > 1  # an n-gram of one class adds nothing to any intersection
        number = np.cumsum(counts > 1) - 1
        owner, place = owner[shared], number[place[shared]]
        common = np.zeros((n, n), np.float32)
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        width = max(256, (8 << 20) // (4 * n))
        for at in range(0, int(place[-1]) + 1 if len(place) else 0, width):
            a, b = np.searchsorted(place, (at, at + width))
            part = np.zeros((n, width), np.float32)
            part[owner[a:b], place[a:b] - at] = 1
            common += part @ part.T  # whole numbers below 2^24: exact
        meet = np.rint(common).astype(np.int64)
        near = meet * (up + down) >= up * (sizes[:, None] + sizes[None, :])
        np.fill_diagonal(near, False)
        if i != j:
            near &= block[:, None] != block[None, :]
        sets = Union(n)
        for a, b in zip(*np.nonzero(np.triu(near)), strict=True):
            sets.join(int(a), int(b))
        total = near @ copies
        return [(rows[k][0], int(total[k]), rows[sets.root(k)][0]) for k in np.flatnonzero(total)]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        cell = None
        kinds = (pa.binary(), pa.int64(), pa.binary())

        def result() -> pa.RecordBatch:
            out = links(held, cell[1], cell[2]) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(list(zip(*out, strict=True)) or [[]] * 3, kinds, strict=True)], ["node", "links", "root"])

        for batch in small_pieces(batches, 4 << 20, "grams"):
            for row in zip(*(batch.column(c).to_pylist() for c in ("family", "i", "j", "node", "block", "copies", "grams")), strict=True):
                if row[:3] != cell:
                    if held:
                        yield result()
                    held, cell = [], row[:3]
                if not held or held[-1][0] != row[3]:  # else the same class, fetched twice
                    held.append(row[3:])
        if held:
            yield result()

    return found


def join(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS, threshold: tuple[int, int] = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row for each document: id, tie (a hash of the text), class_id (smallest id with the same set), n_links (other
    documents linked), component_id (smallest id that links reach), n_grams, and first: whether the row's id and tie are
    the smallest of its component (rows that are equal in both are all marked)."""
    bands, rows = choose_bands(threshold[0] / threshold[1], recall)
    least = math.floor(LEAST_ESTIMATE * bands * rows)
    data = docs.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    data = data.select("id", F.xxhash64("text").alias("tie"), F.col("text").cast("binary").alias("text"))
    kind = data.schema["id"].dataType.simpleString()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("jaccard", _words.clear)
        minhash = MinHash(bands, rows)
        for batch in small_pieces(batches):
            nodes, sizes, briefs, keys = [], [], [], []
            for x in batch.column("text").to_pylist():
                own = grams(x, words)
                sizes.append(len(own))
                if len(own):
                    signature = minhash.signature(own)
                    nodes.append(xxhash.xxh3_128_digest(own.tobytes()))
                    briefs.append(minhash.brief(signature))
                    keys.append(minhash.keys(signature).tobytes())
                else:
                    for column in (nodes, briefs, keys):
                        column.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("tie"), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(briefs, pa.binary()), pa.array(keys, pa.binary())], ["id", "tie", "node", "n_grams", "brief", "keys"])

    every = written(data.mapInArrow(signed, f"id {kind}, tie long, node binary, n_grams long, brief binary, keys binary"), "jaccard-signatures")
    first = F.min(F.struct("id", "tie", "brief", "keys"))
    classes = every.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"), first.alias("one"))
    classes = written(classes.select("node", "copies", "one.*"), "jaccard-classes")

    piece = F.substring("keys", F.col("at") * 8 + 1, F.lit(8))
    keyed = classes.select("node", "keys", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("at"))
    keyed = keyed.select("node", F.conv(F.hex(piece), 16, -10).cast("long").alias("key"))
    edges = candidate_edges(keyed, classes.select("node", "brief"), least)
    families = written(connected_components(edges).withColumnRenamed("component", "family"), "jaccard-families")

    # the n-gram sets of families, each dealt to the cells of its block
    sizes = families.groupBy("family").agg(F.count("*").alias("m"))
    block = F.greatest(F.lit(BLOCK), F.least(F.lit(MOST_BLOCK), F.expr("m div 64")))
    wanted = classes.select("node", "copies", F.col("id").alias("wid"), F.col("tie").alias("wtie")).join(families, "node").join(sizes, "family")
    wanted = wanted.withColumn("blocks", F.ceil(F.col("m") / block).cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).drop("m")
    texts = data.join(wanted, F.col("id").eqNullSafe(F.col("wid")) & (F.col("tie") == F.col("wtie")))

    def in_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("jaccard", _words.clear)
        for batch in small_pieces(batches):
            sets = [grams(x, words).tobytes() for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("family", "node", "copies", "blocks", "block")), pa.array(sets, pa.binary())], ["family", "node", "copies", "blocks", "block", "grams"])

    sets = texts.select("family", "node", "copies", "blocks", "block", "text").mapInArrow(in_sets, "family binary, node binary, copies long, blocks int, block int, grams binary")
    cells = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "block", "copies", "grams")
    cells = cells.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "node")
    links = written(cells.mapInArrow(_verified(threshold), "node binary, links long, root binary"), "jaccard-links")

    components = connected_components(links.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_class = classes.select("node", "copies", F.col("id").alias("class_id"), F.col("tie").alias("class_tie"))
    per_class = per_class.join(links.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(components, "node", "left")
    per_class = per_class.withColumn("component", F.coalesce("component", "node"))
    # written, both of them, so that the join can be split where one component is very large
    per_class = written(per_class, "jaccard-classes-linked")
    heads = written(per_class.groupBy("component").agg(F.min(F.struct("class_id", "class_tie")).alias("head")), "jaccard-heads")
    per_class = per_class.join(heads, "component").select(F.col("node").alias("n"), "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "head")
    out = every.select("id", "tie", "node", "n_grams").join(per_class, F.col("node") == F.col("n"), "left")
    single = F.col("node").isNull()
    deleted(edges)
    return out.select(
        "id", "tie", F.when(single, F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(single, F.col("id")).otherwise(F.col("head.class_id")).alias("component_id"), "n_grams",
        (single | (F.col("id").eqNullSafe(F.col("head.class_id")) & (F.col("tie") == F.col("head.class_tie")))).alias("first"),
    )


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs with one row of each component: the smallest id and, of equal rows, any one. All columns are kept."""
    i, t, tie, own = free_names(docs, "i", "t", "tie", "own")
    kept = join(docs, id_column, text, **options).where("first").select(F.col("id").alias(i), F.col("tie").alias(t)).distinct()
    data = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    left = docs.withColumn(tie, F.xxhash64(data))
    left = left.join(kept, F.col(f"`{id_column}`").eqNullSafe(F.col(i)) & (F.col(tie) == F.col(t)), "left_semi")
    # rows without words are no copies of each other: each has a number of its own
    empty = F.trim(F.regexp_replace(data, r"[\x20\x09-\x0D]+", "")) == ""
    left = left.withColumn(own, F.when(empty, F.monotonically_increasing_id()))
    return left.dropDuplicates([id_column, tie, own]).drop(tie, own)
