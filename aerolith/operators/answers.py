"""Answers kept from run to run: what a provider has said to a question is not asked again.

A folder holds a table of answers by key, those that say "nothing" included, with the time at which they were given. A run
reads the parts of the table that its questions fall in, asks what they don't answer, and adds what it was told. A
question whose call failed has no answer and is asked again next time; answers can be given an age after which they are
asked for again, those that say nothing another one. The new answers count once a manifest names them, so a run that fails
half-way leaves the table as it was.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators.providers import Provider
from aerolith.operators.scratch import written
from aerolith.streaming.store import PARTS, Kept, Store


def answer_store(spark: SparkSession, folder: str, kind: str = "string", parts: int = PARTS) -> Store:
    return Store(spark, folder, {"answers": Kept(f"key string, answer {kind}, asked_at timestamp_ntz", ("key",))}, parts)


def remembered(provider: Provider, folder: str, now: Column, kind: str = "string", most_age: timedelta | None = None, most_age_of_none: timedelta | None = None, parts: int = PARTS) -> Provider:
    """A provider that asks another one only what the folder's table has no answer to that is young enough. now is the
    time of the run; kind the answers' type."""

    def young(age: timedelta | None) -> Column:
        return F.lit(True) if age is None else F.col("asked_at") >= now - F.make_dt_interval(secs=F.lit(age.total_seconds()))

    def ask(questions: DataFrame) -> DataFrame:
        spark = questions.sparkSession
        store = answer_store(spark, folder, kind, parts)
        batch = store.begin(max(store.batches(), default=-1) + 1)
        questions = written(questions.where("key IS NOT NULL"), "questions")
        known = batch.meet("answers", questions.select("key"))
        good = F.when(F.col("answer").isNull(), young(most_age if most_age_of_none is None else most_age_of_none)).otherwise(young(most_age))
        there = written(known.where(good).join(questions.select("key").distinct(), "key", "left_semi"), "known-answers")
        open_ = questions.join(there.select("key"), "key", "left_anti")
        if open_.isEmpty():
            return there.select("key", "answer")
        told = provider(open_).select("key", F.col("answer").cast(kind).alias("answer"), now.cast("timestamp_ntz").alias("asked_at")).dropDuplicates(["key"])
        told = written(told, "new-answers")
        if not told.isEmpty():
            batch.put("answers", known.join(told.select("key"), "key", "left_anti").unionByName(told))
            batch.commit()
        return there.select("key", "answer").union(told.select("key", "answer"))

    return ask
