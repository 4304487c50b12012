"""Seeding of reference specifications: five passes over one table, each a projection of the one before.

Answers of providers come as tables keyed by manufacturer, model and variant; a row without an answer stays as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.core import missing
from aerolith.operators.merge import fill_missing
from aerolith.operators.upsert import insert_missing

KEYS = ("manufacturer", "model", "variant")


def _answered(df: DataFrame, answers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df with columns __c of the answers to its keys; null and empty keys are equal."""
    key = [F.coalesce(F.col(k), F.lit("")) for k in KEYS]
    side = answers.select(*[c.alias(f"__k{n}") for n, c in enumerate(key)], *[F.col(c).alias(f"__{c}") for c in columns]).dropDuplicates([f"__k{n}" for n in range(len(KEYS))])
    same = [c == F.col(f"__k{n}") for n, c in enumerate(key)]
    return df.join(side, same[0] & same[1] & same[2], "left").drop(*[f"__k{n}" for n in range(len(KEYS))])


def seed(target: DataFrame, seeds: DataFrame, figures: DataFrame, texts: DataFrame, categories: DataFrame, translations: DataFrame, measures: Sequence[str], default_category: str) -> DataFrame:
    """The target after all passes: seeds are inserted if absent; rows without any measure get figures; missing
    descriptions get texts; the default or no category gets a better one; missing translations are added."""
    empty = [c for c in target.columns if c not in seeds.columns]
    fresh = insert_missing(seeds, target, list(KEYS)).withColumns({c: F.lit(None).cast(target.schema[c].dataType) for c in empty})
    rows = target.unionByName(fresh.select(*target.columns))

    skeleton: Column = F.lit(True)
    for c in measures:
        skeleton = skeleton & missing(F.col(c))
    rows = _answered(rows, figures, measures).withColumn("__bare", skeleton)
    rows = rows.withColumns({c: F.when(F.col("__bare"), fill_missing(F.col(c), F.col(f"__{c}"))).otherwise(F.col(c)) for c in measures}).select(*target.columns)

    rows = _answered(rows, texts, ["description"])
    rows = rows.withColumn("description", fill_missing(F.col("description"), F.col("__description"))).select(*target.columns)

    rows = _answered(rows, categories, ["category"])
    plain = missing(F.col("category")) | (F.col("category") == default_category)
    rows = rows.withColumn("category", F.when(plain, F.coalesce("__category", "category")).otherwise(F.col("category"))).select(*target.columns)

    rows = _answered(rows, translations, ["translations"])
    return rows.withColumn("translations", F.coalesce("translations", "__translations")).select(*target.columns)
