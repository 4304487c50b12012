"""Operator 6: language identification by words first, then shorter and shorter character n-grams.

A word that the model knows is scored by its log frequency in each language. An unseen word is scored by its character
n-grams: the longest length of which the model knows any, from `LONGEST` down to 1, gives the mean of these n-grams' log
frequencies. A text's score in a language is the sum over its words; the prediction is the largest, and the score its
share among the languages, from the mean over the words.

Words are runs of letters, lower-cased, with marks of start and end around them for the n-grams.

The log frequency of a known word is that of words, an unseen word's that of n-grams of one length; both are compared
between languages only, where the difference of scales is the same for all.

The model is a classifier fitted on a bounded sample of labelled rows: of each language about `SAMPLE_DOCS` documents at
most, and as many as make its share of `SAMPLE_BYTES` bytes of text, chosen by a digest of their id and text; a text that
is longer than an eighth of that share, by powers of two, teaches nothing. All words and n-grams of the sample are in it, however rare, so no
language's evidence is crowded out by another's; a sample that has more than `MOST_ENTRIES` of them is halved until it
has not. The model is collected and broadcast: for each entry it holds the languages that have it, not all of them. All
documents are predicted over their whole texts, a stretch of words at a time.

Defined results: a text that is null or has no letter is `und` with score 0, as is every text if nothing could be
learned. Of languages with equal scores the first by name is taken. Rows with a null text or language teach nothing.
The driver holds a row for each language. Extra columns are kept, but one that has the result's name.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import deleted, small_pieces, take_over, values, written

SAMPLE_DOCS = 600
SAMPLE_BYTES = 48 << 20
MOST_ENTRIES = 4_000_000
LONGEST = 5
#: Languages whose shares are broadcast; more of them are joined.
MOST_BROADCAST = 10_000
#: Bytes of the scores of words that a worker remembers, and of those that it sums up at a time.
MOST_REMEMBERED_BYTES = 64 << 20
STRETCH_BYTES = 32 << 20
#: Languages of an entry that are added up one by one.
FEW = 16
#: Characters of a text in which words are found at a time.
PIECE_CHARS = 1 << 20
RUN = re.compile(r"[^\W\d_]+")
BETWEEN = re.compile(r"[\W\d_]")
UND = "und"


def words_of(text: str) -> list[str]:
    return RUN.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[k : k + n] for k in range(len(marked) - n + 1)] if n > 1 else list(word)


def stretches(text: str, size: int) -> Iterator[list[str]]:
    """The words of a text, so many at a time, found a piece of the text at a time; pieces end between words."""
    low, at = text.lower(), 0
    while at < len(low):
        end = at + PIECE_CHARS
        gap = BETWEEN.search(low, end) if end < len(low) else None
        end = gap.start() if gap else len(low)
        words = RUN.findall(low, at, end)
        for k in range(0, len(words), size):
            yield words[k : k + size]
        at = end


@dataclass
class Entries:
    """Words, or n-grams of one length: the row of each, and for each row the languages that have it and by how much its
    log frequency there is above that of an entry that a language lacks."""

    place: dict[str, int]
    start: array
    language: array
    above: array
    lacking: np.ndarray  # by language

    def scores(self, rows: list[int]) -> np.ndarray:
        """By language, the mean log frequency of these rows."""
        start, language, above = self.start, self.language, self.above
        out, few = self.lacking, [0.0] * len(self.lacking)
        for row in rows:
            a, b = start[row], start[row + 1]
            if b - a > FEW:
                more = np.zeros(len(few))
                more[np.frombuffer(language, np.int32)[a:b]] = np.frombuffer(above, np.float32)[a:b]
                out = out + more / len(rows)
            else:  # plain numbers are faster than short arrays
                for k in range(a, b):
                    few[language[k]] += above[k]
        return out + np.array(few) / len(rows)


class Model:
    """Log frequencies of words and n-grams by language."""

    def __init__(self, languages: list[str], entries: Iterable[tuple[int, str, int, int]]):
        """entries: (n, string, language number, count); n is 0 for a word, else the length of an n-gram."""
        size = len(languages)
        places: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        where: list[tuple[array, array, array]] = [(array("q"), array("q"), array("q")) for _ in places]  # row, language, count
        for n, text, language, count in entries:
            row = places[n].setdefault(text, len(places[n]))
            for column, x in zip(where[n], (row, language, count), strict=True):
                column.append(x)
        tables = []
        for place, columns in zip(places, where, strict=True):
            rows, numbers, counts = (np.frombuffer(c, np.int64) if len(c) else np.zeros(0, np.int64) for c in columns)
            order = np.argsort(rows, kind="stable")
            start = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(place)))]).astype(np.int64)
            totals = np.bincount(numbers, counts, size) if size else np.zeros(0)
            lacking = np.log(0.5) - np.log(totals + 0.5 * (len(place) + 1))
            above = np.log(counts[order] + 0.5) - np.log(0.5)
            tables.append(Entries(place, array("q", start.tobytes()), array("i", numbers[order].astype(np.int32).tobytes()), array("f", above.astype(np.float32).tobytes()), lacking))
        self.learn(languages, tables)

    def learn(self, languages: list[str], tables: list[Entries]) -> None:
        self.languages, self.tables = languages, tables
        self.place: dict[str, int] = _Places(self)
        width = 8 * max(1, len(languages))
        self.most, self.stretch = max(1024, MOST_REMEMBERED_BYTES // width), max(1024, STRETCH_BYTES // width)
        self.table = np.zeros((1024, len(languages)))

    @classmethod
    def of(cls, languages: list[str], tables: list[Entries]) -> Model:
        out = cls.__new__(cls)
        out.learn(languages, tables)
        return out

    def word(self, word: str) -> np.ndarray:
        at = self.tables[0].place.get(word)
        if at is not None:
            return self.tables[0].scores([at])
        for n in range(LONGEST, 0, -1):
            held = self.tables[n].place
            found = [held[g] for g in grams(word, n) if g in held]
            if found:
                return self.tables[n].scores(found)
        return np.zeros(len(self.languages))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages:
            return UND, 0.0
        n, letters, sums = 0, False, np.zeros(len(self.languages))
        for words in stretches(text, self.stretch):
            if len(self.place) > self.most:
                self.place.clear()
            letters = letters or any(c.isalpha() for w in words for c in w)
            places = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))  # the table may grow
            sums += self.table[places].sum(axis=0)
            n += len(words)
        if not n or not letters:
            return UND, 0.0
        best = int(np.argmax(sums))
        shares = np.exp((sums - sums[best]) / n)
        return self.languages[best], float(1 / shares.sum())

    def remember(self, word: str) -> int:
        at = len(self.place)
        if at >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at] = self.word(word)
        return at


class _Places(dict):
    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> int:
        at = self.model.remember(word)
        self[word] = at
        return at


def fit(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model of the languages of docs (rows with a null language are left out)."""
    source, label = F.col(f"`{text}`").cast("string"), F.col(f"`{lang}`").cast("string")
    rows = docs.select(F.xxhash64(F.col(f"`{id_column}`").cast("string"), source).alias("h"), source.alias("text"), F.octet_length(source).alias("size"), label.alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    # texts by the power of two above their size: what may teach is known once the number of languages is
    held = rows.groupBy("lang", F.length(F.bin("size")).alias("power")).agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()
    languages = sorted({r.lang for r in held})
    if not languages:
        return Model([], [])
    own = sample_bytes / len(languages)
    longest = max(8, math.floor(math.log2(max(2.0, own / 8))))
    good = [r for r in held if r.power <= longest]
    docs_of, bytes_of = Counter(), Counter()
    for r in good:
        docs_of[r.lang] += r.n
        bytes_of[r.lang] += r.bytes
    shares = [(name, k, min(1.0, sample_docs / max(1, docs_of[name]), own / max(1, bytes_of[name]))) for k, name in enumerate(languages)]
    few = len(shares) <= MOST_BROADCAST
    shares = docs.sparkSession.createDataFrame(shares, "of string, number int, share double")
    shares = F.broadcast(shares) if few else shares
    labelled = rows.where(F.length(F.bin("size")) <= longest).join(shares, F.col("lang") == F.col("of")).withColumn("at", F.pmod("h", F.lit(1 << 30)) / (F.col("share") * (1 << 30)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(seen)
            columns = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.string()), pa.array(list(seen.values()), pa.int64())]
            seen.clear()
            return pa.RecordBatch.from_arrays(columns, ["language", "n", "entry", "count"])

        for batch in small_pieces(batches):
            words: dict[int, Counter] = {}
            for language, text in zip(batch.column("number").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words.setdefault(language, Counter()).update(words_of(text))
            for language, found in words.items():
                for word, count in found.items():
                    seen[language, 0, word] += count
                    for n in range(1, LONGEST + 1):
                        for gram in grams(word, n):
                            seen[language, n, gram] += count
            if len(seen) > 500_000:
                yield out()
        yield out()

    part = 1.0
    while True:
        some = labelled.where(F.col("at") < part).select("number", "text")
        counts = some.mapInArrow(counted, "language int, n int, entry string, count long").groupBy("language", "n", "entry").agg(F.sum("count").alias("count"))
        counts = written(counts, "language-counts")
        if counts.count() <= MOST_ENTRIES:
            break
        deleted(counts)
        part /= 2
    every = counts.select("n", "entry", "language", "count").toArrow()
    return Model(languages, zip(*(values(every.column(k).combine_chunks()) for k in range(4)), strict=True))


def identified(text: Column, model: Model, spark) -> Column:
    """A struct of lang_pred and score of a text column."""
    shared = spark.sparkContext.broadcast((model.languages, model.tables))
    models: dict[int, Model] = {}

    @F.arrow_udf("lang_pred string, score double")
    def language(column: pa.Array) -> pa.Array:
        take_over("langid", models.clear)
        if not models:
            models[0] = Model.of(*shared.value)
        found = [models[0].predict(x) for x in values(column)]
        return pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["lang_pred", "score"])

    return language(text)


def identify(docs: DataFrame, model: Model, text: str = "text", column: str = "language") -> DataFrame:
    """docs with a struct of lang_pred and score."""
    return docs.withColumn(column, identified(F.col(f"`{text}`").cast("string"), model, docs.sparkSession))
