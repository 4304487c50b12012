"""Duplicates across sources and across runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions.classify import source_priority
from aerolith.operators.scratch import written
from aerolith.operators.validate import is_claimed


def best_sources(df: DataFrame, key: str, source: str, arrival: str) -> DataFrame:
    """For each key (__k) the source of highest priority, earliest arrival and first name (__best.s)."""
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__k")).agg(F.max(F.struct(source_priority(F.col(source)).alias("p"), (-F.col(arrival).cast("double")).alias("a"), F.col(source).alias("s"))).alias("__best"))


def priority_winners(df: DataFrame, key: str, source: str, arrival: str, outcome: str = "outcome") -> DataFrame:
    """df with an outcome: of the sources that share a key, the one of highest priority, earliest arrival and first name
    wins, with all its rows (`kept`); rows of others are `lower_priority_duplicate`. Rows without a key are kept.

    A set-based form of one-by-one comparison: the winner of each key is an aggregate, combined before the shuffle. It is
    written before it is joined back: adaptive execution can split a key that a third of the rows share only where both
    sides of the join are dealt for it alone."""
    best = best_sources(df, key, source, arrival)
    best = written(best, "winners")
    joined = df.join(best, F.col(key) == F.col("__k"), "left")
    lost = F.col("__k").isNotNull() & (F.col(source) != F.col("__best.s"))
    return joined.withColumn(outcome, F.when(lost, "lower_priority_duplicate").otherwise("kept")).drop("__k", "__best")


def against_stored(df: DataFrame, stored: DataFrame, key: str, source: str, decision: str = "decision") -> tuple[DataFrame, DataFrame]:
    """(df with a decision, the stored rows that go), for rows of which each key has one source, as after
    priority_winners, and stored rows with key, source, is_external and claimed_at.

    A row whose key no other source has stored is `kept`. Where another source has, a row of higher priority is
    `superseding` and the stored rows of the others go; a row of lower or equal priority is a
    `lower_priority_duplicate`, as is one that meets a claimed row: such rows are never removed. Null keys meet nothing.

    What a batch knows of a key is one row before it meets the stored ones, and both sides of each join are dealt for it
    alone, so that a key of very many rows can be split."""
    k, s = F.col("__k"), F.col("__s")
    asking = written(df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__k")).agg(F.min(source).alias("__s")), "asking-keys")
    met = written(_verdicts(asking, stored, key, source), "met-keys")
    decided = df.join(met, F.col(key) == k, "left")
    verdict = F.when(F.col("__wins"), "superseding").when(~F.col("__wins"), "lower_priority_duplicate").otherwise("kept")
    going = stored.join(asking.join(met.where("__wins"), "__k"), F.col(key) == k).where(~F.col(source).eqNullSafe(s))
    return decided.withColumn(decision, verdict).drop("__k", "__wins"), going.select(*stored.columns)


def _verdicts(asking: DataFrame, stored: DataFrame, key: str, source: str) -> DataFrame:
    """Whether the source (__s) of each key asked for (__k) replaces what other sources have stored of it (__wins); only
    keys that others have."""
    s = F.col("__s")
    others = stored.join(asking, F.col(key) == F.col("__k")).where(~F.col(source).eqNullSafe(s))
    held = F.max(source_priority(F.col(source))).alias("__p"), F.bool_or(is_claimed("is_external", "claimed_at")).alias("__c")
    met = others.groupBy("__k", "__s").agg(*held).withColumn("__wins", (source_priority(s) > F.col("__p")) & ~F.coalesce("__c", F.lit(False)))
    return met.select("__k", "__wins")


def decided(df: DataFrame, best: DataFrame, stored: DataFrame, key: str, source: str, decision: str = "decision") -> tuple[DataFrame, DataFrame]:
    """priority_winners() and against_stored() in one, for best_sources() of df that are written: rows meet one table of
    keys, with its best source and what the stored rows say to it, so that they are dealt and written once."""
    k, s = F.col("__k"), F.col("__s")
    asking = best.select("__k", F.col("__best.s").alias("__s"))
    met = written(_verdicts(asking, stored, key, source), "met-keys")
    none = met.isEmpty()
    keys = asking.withColumn("__wins", F.lit(None).cast("boolean")) if none else written(asking.join(met, "__k", "left"), "decided-keys")
    lost = F.col("__k").isNotNull() & (F.col(source) != s)
    verdict = F.when(lost | ~F.col("__wins"), "lower_priority_duplicate").when(F.col("__wins"), "superseding").otherwise("kept")
    out = df.join(keys, F.col(key) == k, "left").withColumn(decision, verdict).drop("__k", "__s", "__wins")
    if none:
        return out, stored.where(F.lit(False))
    return out, stored.join(keys.where("__wins"), F.col(key) == k).where(~F.col(source).eqNullSafe(s)).select(*stored.columns)


def unchanged(df: DataFrame, known: DataFrame, key: str, digest: str, column: str = "unchanged") -> DataFrame:
    """df with a flag: the known row of the same key has the same digest."""
    side = known.select(F.col(key).alias("__k"), F.col(digest).alias("__d"))
    return df.join(side, F.col(key) == F.col("__k"), "left").withColumn(column, F.coalesce(F.col(digest) == F.col("__d"), F.lit(False))).drop("__k", "__d")


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
