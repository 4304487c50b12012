"""What is asked outside: translations, extraction, places. A provider is a function of a DataFrame with a column key and
what the question needs, to (key, answer); without one nothing is asked and every answer is null, as without a licence.

Each distinct question is asked once. A provider that calls a service by single questions is made by `one_by_one`: its
calls run in a few tasks, spaced so that all of them together keep the service's rate, and are tried again. A call that
fails in the end gives no row: its question has no answer, which is not the same as an answer that says nothing.
`operators.answers` keeps answers from run to run.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.text import strip_language_blocks
from aerolith.operators.match import first_row

Provider = Callable[[DataFrame], DataFrame]
TRANSLATIONS = "map<string,struct<headline:string,description:string>>"
#: Shorter texts are not worth a call.
LEAST_EXTRACTED = 30


class Busy(Exception):
    """A call that may succeed later: the service is overloaded or can't be reached."""


class FAILED:
    """What a call that was tried in vain gives; a class, so that it is the same in every process."""


def polite(call: Callable[[str], str | None], gap: float = 1.0, attempts: int = 3, clock=time.monotonic, sleep=time.sleep) -> Callable[[str], object]:
    """call, at most once in `gap` seconds; a Busy one is tried again after 1, 2, 4 ... seconds, and is FAILED in the
    end."""
    last = [-gap]

    def ask(question: str) -> object:
        for attempt in range(attempts):
            sleep(max(0.0, gap - (clock() - last[0])))
            last[0] = clock()
            try:
                return call(question)
            except Busy:
                if attempt + 1 < attempts:
                    sleep(2.0**attempt)
        return FAILED

    return ask


def one_by_one(call: Callable[[str], str | None], column: str = "key", gap: float = 1.0, lanes: int = 4, **options) -> Provider:
    """A provider of strings from a function of one string, called at most once in `gap` seconds on the whole: in each of
    `lanes` tasks, once in `lanes` times the gap."""

    def provider(questions: DataFrame) -> DataFrame:
        def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ask = polite(call, gap * lanes, **options)
            for batch in batches:
                told = [(k, ask(q)) for k, q in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
                told = [x for x in told if x[1] is not FAILED]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in told], pa.string()), pa.array([x for _, x in told], pa.string())], ["key", "answer"])

        rows = questions.select(F.col("key").cast("string").alias("key"), F.col(column).cast("string").alias("question"))
        return rows.repartition(lanes, "key").mapInArrow(asked, "key string, answer string")

    return provider


def asked(df: DataFrame, key: Column, provider: Provider | None, kind: str, column: str, **needed: Column) -> DataFrame:
    """df with a provider's answer (of a type) to each row's question; rows with a null key have none. needed are columns
    of the question; of rows with equal keys one asks."""
    if provider is None:
        return df.withColumn(column, F.lit(None).cast(kind))
    keyed = df.withColumn("__key", key)
    questions = keyed.where("__key IS NOT NULL").select(F.col("__key").alias("key"), *[c.alias(n) for n, c in needed.items()])
    answers = provider(first_row(questions, ["key"], [F.col(n) for n in needed] or [F.col("key")]))
    side = answers.select(F.col("key").alias("__k"), F.col("answer").cast(kind).alias(column)).dropDuplicates(["__k"])
    return keyed.join(side, F.col("__key") == F.col("__k"), "left").drop("__key", "__k")


def translated(df: DataFrame, headline: str, description: str, provider: Provider | None, locale: Column | None = None, column: str = "translations") -> DataFrame:
    """df with a map of language to headline and description. What is asked for is the text's first language block."""
    text = strip_language_blocks(F.coalesce(F.col(description), F.lit("")))
    locale = F.lit("de") if locale is None else locale
    key = F.sha1(F.concat_ws("\x1f", F.col(headline), text, locale))
    return asked(df, F.when(F.col(headline).isNotNull(), key), provider, TRANSLATIONS, column, headline=F.col(headline), description=text, locale=locale)


def extracted(df: DataFrame, text: Column, provider: Provider | None, kind: str, column: str = "extracted") -> DataFrame:
    """df with what a provider reads out of texts of thirty characters or more."""
    key = F.when(F.length(F.trim(text)) >= LEAST_EXTRACTED, F.sha1(text))
    return asked(df, key, provider, kind, column, text=text)
