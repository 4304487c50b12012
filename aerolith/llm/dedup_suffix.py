"""Operator 8: removal of long repeated strings by blockwise suffix sorting with a difference cover.

Each text is a string of UTF-8 bytes. A byte goes if a string of DEPTH bytes that covers it starts anywhere else as
well, in another text or in the same one. Beside that, and in the same pass, texts are strings of words: passages are
the bytes in strings of PASSAGE_WORDS words, from the first one's start to the last one's end, that start anywhere else
as well, whatever white space is between the words. These are reported, and cut only if that is asked for: a passage of
over 50 words is often shorter than 400 bytes.

Levels. What follows holds for both: the symbols of a text are its bytes, or the 64-bit digests of its words.

Buckets. A suffix is put into the bucket of its anchor: of the hashes of the short strings that lie in its first `depth`
symbols, the smallest, the last of equal ones. The anchor depends on these symbols alone, so equal strings get the same
anchor at the same offset, and a bucket holds whole every set of equal strings. The stretch of suffixes that have one
occurrence of an anchor has a context: the symbols from the first one's start to the last one's end. Only digests of
contexts are shuffled at first. Where a bucket has one context only, seen once, none of its suffixes repeats; where a
context is seen again, all of its suffixes do, as equal contexts are equal strings. What remains are contexts that share
an anchor with others but are themselves unique: the ends of repeated passages. Only their texts are fetched.

Sorting. Buckets are sorted one at a time. The contexts of a bucket are aligned at their anchor. Ranks of the strings at
the positions of a difference cover (residues COVER modulo PERIOD, so that any two suffixes have a common shift to a
position of the cover) are precomputed by doubling: strings of 2n symbols are ranked by the ranks of their halves. Then
suffixes are sorted by the symbols before their first cover position, and long ties are resolved by the rank there,
never by comparing `depth` symbols. Memory is bounded by the bucket. A bucket of more than BUCKET_CONTEXTS contexts is
not sorted in one task: its suffixes are dealt out by the digest of their `depth` symbols and counted, which gives the
same result with any number of tasks.

Contexts are told apart by 64 bits besides the 64 of their anchor, suffixes of large buckets by 128, words by 64.

Scale: tables that are joined on an anchor are written before, so that adaptive execution can split the join where one
anchor has very many rows; sums by anchor are combined before they are shuffled.

Defined results: a null text is empty, and loses nothing, as does every text of fewer than DEPTH bytes; a text of fewer
than PASSAGE_WORDS words has no passage. Equal rows are copies of each other: from DEPTH bytes on all of both goes.
Extra columns are kept, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import deleted, free_names, small_pieces, take_over, values, written

DEPTH = 400
ANCHOR = 100
#: A passage is a string of this many words, or longer: over 50.
PASSAGE_WORDS = 51
PASSAGE_ANCHOR = 12
BUCKET_CONTEXTS = 4096
PERIOD = 32
#: A difference cover modulo 32: every residue is a difference of two of these.
COVER = (0, 1, 2, 3, 7, 11, 19)
BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2^64."""
    global _powers, _inverse
    if len(_powers) < n:
        size = 1 << n.bit_length()
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, BASE)]), dtype=np.uint64)
            _inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, np.uint64(pow(int(BASE), -1, 1 << 64)))]), dtype=np.uint64)
    return _powers, _inverse


def prefix_sums(text: np.ndarray) -> np.ndarray:
    """Of the symbols of an array, times powers of the base."""
    powers, _ = _tables(len(text) + 1)
    sums = np.zeros(len(text) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers[: len(text)], out=sums[1:])
    return sums


def string_hashes(sums: np.ndarray, first: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
    """A hash of the strings between places of an array, from its prefix sums; equal strings have equal hashes."""
    _, inverse = _tables(len(sums))
    with np.errstate(over="ignore"):
        h = (sums[end] - sums[first]) * inverse[first]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(text: np.ndarray) -> np.ndarray:
    """(from, to) of the words of a uint8 array."""
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = ~_BLANK[text]
    return np.flatnonzero(np.diff(inside)).reshape(-1, 2)


def window_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` values, the place of its smallest by the upper 32 bits, the last of equal ones."""
    n, size = len(h) - width + 1, len(h)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(size - 1, -1, -1, dtype=np.uint64)
    blocks = np.concatenate([key, np.full(-size % width, np.iinfo(np.uint64).max)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
    return size - 1 - (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


class Level(NamedTuple):
    """What the symbols of a text are (of one byte: its bytes; of eight: digests of its words), how many of them make a
    string that may repeat, and how many a short string of which one is its anchor."""

    width: int
    depth: int
    anchor: int


def symbols(text: bytes, level: Level) -> tuple[np.ndarray, np.ndarray]:
    """A text's symbols and their prefix sums. A word's is a hash of its bytes and its length."""
    own = np.frombuffer(text, np.uint8)
    sums = prefix_sums(own)
    return (own, sums) if level.width == 1 else words_of(own, sums)


def words_of(text: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = word_spans(text)
    with np.errstate(over="ignore"):
        own = string_hashes(sums, at[:, 0], at[:, 1]) + (at[:, 1] - at[:, 0]).astype(np.uint64) * BASE
    return own, prefix_sums(own)


def anchors(sums: np.ndarray, level: Level) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first, last) of each stretch of suffixes with one anchor, from the prefix sums of symbols; every
    suffix of depth symbols is in one."""
    n = len(sums) - 1
    if n < level.depth:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    h = string_hashes(sums, slice(0, n - level.anchor + 1), slice(level.anchor, n + 1))
    at = window_argmin(h, level.depth - level.anchor + 1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    place = at[first]
    return h[place], place, first, last


CONTEXTS = "k1 long, k2 long, level int, anchor long, context long, first int, last int, at int"


def _contexts(levels: Sequence[Level]):
    """The first level is that of bytes."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("dedup_suffix", dict)
        for batch in small_pieces(batches):
            columns: list[list] = [[] for _ in range(8)]
            for text, k1, k2 in zip(batch.column("text").to_pylist(), batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True):
                whole = symbols(text, levels[0])
                for number, level in enumerate(levels):
                    own, sums = whole if level.width == 1 else words_of(*whole)
                    h, place, first, last = anchors(sums, level)
                    if not len(h):
                        continue
                    at, own, w = place - first, own.tobytes(), level.width
                    # where the anchor lies in the context is part of its digest: equal contexts are aligned
                    digests = [xxhash.xxh3_64_intdigest(own[w * a : w * (b + level.depth)], x) for a, b, x in zip(first.tolist(), last.tolist(), at.tolist(), strict=True)]
                    n = len(h)
                    for column, x in zip(columns, (np.full(n, k1), np.full(n, k2), np.full(n, number), h.view(np.int64), np.array(digests, np.uint64).view(np.int64), first, last, at), strict=True):
                        column.append(x)
            if columns[0]:
                kinds = [pa.int64()] * 2 + [pa.int32()] + [pa.int64()] * 2 + [pa.int32()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()).cast(kind) for x, kind in zip(columns, kinds, strict=True)], [x.split()[0] for x in CONTEXTS.split(", ")])

    return found


def cover_shift(start: int) -> int:
    """How far it is from a position to the next one of the difference cover."""
    residue = start % PERIOD
    return min((c - residue) % PERIOD for c in COVER)


def _ranked(*keys: np.ndarray) -> np.ndarray:
    """Dense ranks of rows by several integer keys, the first the most important."""
    order = np.lexsort(keys[::-1])
    change = np.zeros(len(order), bool)
    for key in keys:
        held = key[order]
        change[1:] |= held[1:] != held[:-1]
    ranks = np.empty(len(order), np.int32)
    ranks[order] = np.cumsum(change)
    return ranks


class CoverRanks:
    """Ranks of the strings of any length at cover positions, of aligned texts of equal width."""

    def __init__(self, texts: np.ndarray):
        """texts: uint8 or uint64, a row for each context, padded to a common width."""
        self.texts = texts
        #: Symbols that are compared at once.
        self.base = 8 // texts.itemsize
        self.level: dict[tuple[int, int], np.ndarray] = {}

    def forget(self, before: int) -> None:
        """Drop the ranks of positions that are not needed any more."""
        for key in [k for k in self.level if k[0] < before]:
            del self.level[key]

    def words(self, at: int, n: int) -> np.ndarray:
        if self.base == 1:
            return self.texts[:, at]
        part = np.zeros((len(self.texts), 8), np.uint8)
        part[:, :n] = self.texts[:, at : at + n]
        return part.view(">u8").ravel().astype(np.uint64)

    def ranks(self, at: int, length: int) -> np.ndarray:
        """Ranks of the strings of `length` symbols at position `at`, by doubling: halves that start PERIOD * 2^k apart
        are at cover positions too, so they are shared by all that need them."""
        key = at, length
        if key not in self.level:
            if length <= self.base:
                self.level[key] = _ranked(self.words(at, length))
            else:
                half = self.base
                while half * 2 < length:
                    half *= 2
                self.level[key] = _ranked(self.ranks(at, half), self.ranks(at + half, length - half))
        return self.level[key]


def sort_buckets(buckets: list[int], texts: list[bytes], anchor_at: list[int], level: Level) -> list[np.ndarray]:
    """For each context, a boolean for each of its suffixes: whether its first depth symbols occur twice in its bucket.

    buckets are the contexts' buckets, anchor_at the place of the anchor in each. Suffixes of a bucket are compared
    with those of the same offset to the anchor: at each offset the rows are sorted by bucket, by the symbols before the
    next cover position and, where these tie, by the rank of the rest there."""
    kind, depth = np.dtype(np.uint8 if level.width == 1 else "<u8"), level.depth
    rows = [np.frombuffer(t, kind) for t in texts]
    most = max(anchor_at)
    begin = np.array([most - a for a in anchor_at])
    n = np.array([len(t) - depth + 1 for t in rows])
    grid = np.zeros((len(rows), int((begin + n).max()) + depth + 8), kind)
    for k, t in enumerate(rows):
        grid[k, begin[k] : begin[k] + len(t)] = t
    own = np.array(buckets, np.int64)
    cover = CoverRanks(grid)
    hit = np.zeros((len(rows), int((begin + n).max())), bool)
    for at in range(int(begin.min()), hit.shape[1]):
        some = np.flatnonzero((begin <= at) & (at < begin + n))
        if len(some) < 2:
            continue
        shift = cover_shift(at)
        cover.forget(at)
        keys = [own[some]]
        keys += [cover.words(at + b, min(cover.base, shift - b))[some] for b in range(0, shift, cover.base)]
        keys.append(cover.ranks(at + shift, depth - shift)[some])
        ranks = _ranked(*keys)
        hit[some, at] = np.bincount(ranks)[ranks] > 1
    return [hit[k, b : b + m] for k, (b, m) in enumerate(zip(begin.tolist(), n.tolist(), strict=True))]


HITS = "level int, anchor long, context long, spans binary"
#: Contexts whose buckets are sorted side by side.
BATCH_CONTEXTS = 1000


def _spans(hit: np.ndarray) -> bytes:
    """Runs of true, as little-endian 32-bit pairs (first, last)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return (edge.reshape(-1, 2) - [0, 1]).astype("<i4").tobytes()


def _hits(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["level", "anchor", "context", "spans"])


def _sorted_buckets(levels: Sequence[Level]):
    """Rows (level, anchor, context, bytes, at), sorted by the first three."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # whole buckets of one level, and the one that is coming in

        def results() -> pa.RecordBatch:
            hits = sort_buckets([r[1] for r in held], [r[3] for r in held], [r[4] for r in held], levels[held[0][0]])
            return _hits([(*row[:3], _spans(hit)) for row, hit in zip(held, hits, strict=True) if hit.any()])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("level", "anchor", "context", "bytes", "at")), strict=True):
                if held and held[-1][:3] == row[:3]:
                    continue  # the same context, fetched twice
                if held and (held[-1][0] != row[0] or len(held) >= BATCH_CONTEXTS and held[-1][1] != row[1]):
                    yield results()
                    held.clear()
                held.append(row)
        if held:
            yield results()

    return found


def _suffixes(levels: Sequence[Level]):
    names = ["level", "anchor", "context", "start", "s1", "s2"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_pieces(batches, 128 << 10, "bytes"):
            texts, own = batch.column("bytes").to_pylist(), [levels[k] for k in batch.column("level").to_pylist()]
            n = np.array([len(t) // v.width - v.depth + 1 for t, v in zip(texts, own, strict=True)])
            digests = b"".join(xxhash.xxh3_128_digest(t[v.width * k : v.width * (k + v.depth)]) for t, v, m in zip(texts, own, n.tolist(), strict=True) for k in range(m))
            both = np.frombuffer(digests, "<i8").reshape(-1, 2)
            starts = np.concatenate([np.arange(m) for m in n]) if len(n) else np.zeros(0, int)
            keys = [pa.array(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), n)) for c in names[:3]]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(starts, pa.int32()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names)

    return found


FETCHED = "level int, anchor long, context long, contexts long, bytes binary, at int"


def _fetched(levels: Sequence[Level]):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in small_pieces(batches, 4 << 20):
            rows: list[tuple] = []
            for k1, k2, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "text", "wanted")), strict=True):
                if (k1, k2) == last:  # a copy of the text before
                    continue
                last, own = (k1, k2), {}
                for w in wanted:
                    number, level = w["level"], levels[w["level"]]
                    if number not in own:
                        own[number] = symbols(text, level)[0].tobytes()
                    part = own[number][level.width * w["first"] : level.width * (w["last"] + level.depth)]
                    rows.append((number, w["anchor"], w["context"], w["contexts"], part, w["at"]))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(list(zip(*rows, strict=True)) or [[]] * 6, kinds, strict=True)], [x.split()[0] for x in FETCHED.split(", ")])

    return found


def spans(docs: DataFrame, levels: Sequence[Level], bucket_contexts: int = BUCKET_CONTEXTS) -> DataFrame:
    """(k1, k2, spans) of docs(k1, k2, text binary) for texts that hold repeated strings: spans lists stretches of
    suffixes (level, first, last, spans), of which all repeat if spans is null, else those in its little-endian 32-bit
    pairs (first, last), counted from first. k1, k2 is a digest of the text: copies have the same."""
    bucket, context = ["level", "anchor"], ["level", "anchor", "context"]
    seen = written(docs.where(F.octet_length("text") >= min(v.depth for v in levels)).mapInArrow(_contexts(levels), CONTEXTS), "suffix-contexts")
    again = written(seen.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1").select(*bucket), "suffix-anchors")
    # a row for each stretch of each text whose anchor is found twice, with how many copies the text has
    met = written(seen.join(again, bucket), "suffix-met")
    deleted(seen)
    found = written(met.groupBy(*context, "k1", "k2", "first", "last", "at").agg(F.count("*").alias("copies")), "suffix-stretches")
    deleted(met)
    contexts = found.groupBy(*context).agg(F.sum("copies").alias("n"), F.min(F.struct("k1", "k2", "first", "last", "at")).alias("one"))
    contexts = written(contexts, "suffix-digests")
    several = written(contexts.groupBy(*bucket).agg(F.count("*").alias("contexts")).where("contexts > 1"), "suffix-several")

    # buckets with several contexts: each context's symbols are fetched from one text
    mixed = contexts.join(several, bucket).select(*context, "contexts", "one.*")
    wanted = mixed.groupBy("k1", "k2").agg(F.collect_list(F.struct(*context, "contexts", "first", "last", "at")).alias("wanted"))
    fetched = written(docs.join(wanted, ["k1", "k2"]).select("k1", "k2", "text", "wanted").mapInArrow(_fetched(levels), FETCHED), "suffix-bytes")
    small = fetched.where(F.col("contexts") <= bucket_contexts).repartition(*bucket).sortWithinPartitions(*context)
    in_small = small.select(*context, "bytes", "at").mapInArrow(_sorted_buckets(levels), HITS)

    # the exact way for buckets that one task should not hold: count the digests of all their suffixes
    large = fetched.where(F.col("contexts") > bucket_contexts).dropDuplicates(context).select(*context, "bytes")
    large = written(large.mapInArrow(_suffixes(levels), "level int, anchor long, context long, start int, s1 long, s2 long"), "suffix-large")
    twice = large.groupBy("s1", "s2").agg(F.count("*").alias("n")).where("n > 1").select("s1", "s2")

    @F.arrow_udf("binary")
    def runs(starts: pa.Array) -> pa.Array:
        rows = []
        for x in starts.to_pylist():
            hit = np.zeros(max(x) + 1, bool)
            hit[x] = True
            rows.append(_spans(hit))
        return pa.array(rows, pa.binary())

    in_large = large.join(twice, ["s1", "s2"]).groupBy(*context).agg(F.collect_list("start").alias("s")).select(*context, runs("s").alias("spans"))

    # contexts seen twice repeat whole; of the others, sorting or counting says which suffixes do
    whole = contexts.where("n > 1").select(*context, F.lit(None).cast("binary").alias("spans"))
    alone = in_small.union(in_large).join(contexts.where("n = 1").select(*context), context)
    hits = written(whole.union(alone), "suffix-hits")
    texts = found.join(hits, context).select("k1", "k2", F.struct("level", "first", "last", "spans").alias("s"))
    return written(texts.groupBy("k1", "k2").agg(F.collect_list("s").alias("spans")), "suffix-spans")


def covered(found: list[dict], depth: int) -> np.ndarray:
    """The maximal runs (from, to) of symbols in repeated strings, from the spans of one level."""
    if not found:
        return np.zeros((0, 2), np.int64)
    starts = []
    for s in found:
        pairs = np.array([[0, s["last"] - s["first"]]]) if s["spans"] is None else np.frombuffer(s["spans"], "<i4").reshape(-1, 2).astype(np.int64)
        starts.append(pairs + s["first"])
    return _merged(np.concatenate(starts) + [0, depth])


def _merged(rows: np.ndarray) -> np.ndarray:
    """Runs (from, to) as maximal ones, in order."""
    if not len(rows):
        return rows.reshape(0, 2)
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    ends = np.maximum.accumulate(rows[:, 1])
    at = np.flatnonzero(np.concatenate([[True], rows[1:, 0] > ends[:-1]]))
    return np.stack([rows[at, 0], ends[np.concatenate([at[1:], [len(rows)]]) - 1]], axis=1)


def passage_runs(text: bytes, found: list[dict], words: int) -> np.ndarray:
    """The runs (from, to) of a text's bytes that lie in repeated strings of words."""
    runs = covered(found, words)
    if not len(runs):
        return runs
    at = word_spans(np.frombuffer(text, np.uint8))
    return np.stack([at[runs[:, 0], 0], at[runs[:, 1] - 1, 1]], axis=1)


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, runs array<struct<from: int, to: int>>, n_passages long, n_passage_bytes long, kept binary"


def remove(docs: DataFrame, text: str = "text", column: str = "repeats", depth: int = DEPTH, anchor: int = ANCHOR, words: int = PASSAGE_WORDS,
           cut_passages: bool = False, bucket_contexts: int = BUCKET_CONTEXTS, texts: bool = True) -> DataFrame:
    """docs with a struct of n_bytes, n_removed, n_spans, kept_sha256, runs (the removed runs: from, to), n_passages and
    n_passage_bytes (maximal runs of repeated strings of `words` words, and bytes in them), and kept (the remaining bytes;
    null unless texts). Passages are removed as well if cut_passages."""
    levels = (Level(1, depth, anchor), Level(8, words, min(PASSAGE_ANCHOR, max(1, words // 2))))
    data = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    half = lambda k: F.conv(F.substring(F.md5(data), k, 16), 16, -10).cast("long")
    found = spans(docs.select(half(1).alias("k1"), half(17).alias("k2"), data.alias("text")), levels, bucket_contexts)

    @F.arrow_udf(RESULT)
    def cut(column: pa.Array, spans: pa.Array) -> pa.Array:
        take_over("dedup_suffix", dict)
        rows = []
        for x, s in zip(values(column), spans.to_pylist(), strict=True):
            by_level = [[r for r in s or () if r["level"] == k] for k in (0, 1)]
            runs, passages = covered(by_level[0], depth), passage_runs(x, by_level[1], words)
            if cut_passages:
                runs = _merged(np.concatenate([runs, passages]))
            kept = x
            if len(runs):
                edges = [0, *runs.ravel().tolist(), len(x)]
                kept = b"".join(x[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            rows.append({
                "n_bytes": len(x), "n_removed": len(x) - len(kept), "n_spans": len(runs), "kept_sha256": hashlib.sha256(kept).hexdigest(), "runs": [{"from": a, "to": b} for a, b in runs.tolist()],
                "n_passages": len(passages), "n_passage_bytes": int((passages[:, 1] - passages[:, 0]).sum()), "kept": kept if texts else None,
            })
        whole = [(name, pa.int64()) for name in ("n_passages", "n_passage_bytes")]
        runs_kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
        kind = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("runs", runs_kind), *whole, ("kept", pa.binary())])
        return pa.array(rows, kind)

    k1, k2, s1, s2, own = free_names(docs, "k1", "k2", "s1", "s2", "spans")
    keyed = docs.withColumn(k1, half(1)).withColumn(k2, half(17))
    side = found.select(F.col("k1").alias(s1), F.col("k2").alias(s2), F.col("spans").alias(own))
    joined = keyed.join(side, (F.col(k1) == F.col(s1)) & (F.col(k2) == F.col(s2)), "left")
    return joined.withColumn(column, cut(data, F.col(own))).drop(k1, k2, s1, s2, own)


def whole_characters(kept: Column) -> Column:
    """Bytes as text, without the rest of characters that a cut went through."""

    @F.arrow_udf("string")
    def decoded(kept: pa.Array) -> pa.Array:
        return pa.array([None if x is None else x.decode("utf-8", "ignore") for x in values(kept)], pa.string())

    return decoded(kept)
