"""Keyed upserts without MERGE: a join of staged rows with the target gives each row's outcome and the new snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.operators.match import first_row
from aerolith.operators.scratch import written
from aerolith.operators.validate import is_claimed


def outcomes(staged: DataFrame, target: DataFrame, key: str, digest: str | None = None, order: list[Column] | None = None) -> DataFrame:
    """staged (the first row of each key by order) with outcome (inserted, updated, skipped) and reason (claimed,
    unchanged). target has key, is_external, claimed_at and, if asked for, the digest."""
    one = first_row(staged, [key], order) if order else staged.dropDuplicates([key])
    side = target.select(F.col(key).alias("__k"), F.col("is_external").alias("__external"), F.col("claimed_at").alias("__claimed"), *([F.col(digest).alias("__d")] if digest else []))
    joined = one.join(side, F.col(key) == F.col("__k"), "left")
    same = F.coalesce(F.col("__d") == F.col(digest), F.lit(False)) if digest else F.lit(False)
    known = F.col("__k").isNotNull()
    reason = F.when(known & is_claimed("__external", "__claimed"), "claimed").when(known & same, "unchanged")
    return joined.withColumn("reason", reason).withColumn("outcome", F.when(F.col("reason").isNotNull(), "skipped").when(known, "updated").otherwise("inserted")).drop("__k", "__d", "__external", "__claimed")


def snapshot(staged: DataFrame, target: DataFrame, key: str, changing: list[str]) -> DataFrame:
    """The target after an upsert: claimed rows stay, known ones change in the columns given, new ones are added."""
    s, t = staged.alias("s"), target.alias("t")
    both = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    new = F.col(f"t.{key}").isNull()
    free = F.col(f"s.{key}").isNotNull() & ~((F.coalesce(F.col("t.is_external"), F.lit(True)) == F.lit(False)) | F.col("t.claimed_at").isNotNull())
    columns = []
    for c in target.columns:
        old = F.col(f"t.{c}")
        if c == key:
            columns.append(F.coalesce(old, F.col(f"s.{c}")).alias(c))
        elif c in staged.columns:
            columns.append(F.when(new, F.col(f"s.{c}")).when(free, F.col(f"s.{c}") if c in changing else old).otherwise(old).alias(c))
        else:
            columns.append(old.alias(c))
    return both.select(*columns)


def reachable(spark, path: str, columns: list[str]) -> str | None:
    """Why a target table can't be used, null if it can: a check before a run that only warns."""
    try:
        have = set(spark.read.parquet(path).columns)
    except Exception as error:  # whatever a store says
        return f"{path} can't be read: {str(error).splitlines()[0][:200]}"
    lacking = [c for c in columns if c not in have]
    return f"{path} lacks {', '.join(lacking)}" if lacking else None


#: What a store's refusal of a row means: a rule that the row breaks, or a row that another run has stored meanwhile.
REFUSALS = (("check constraint", "fatal"), ("duplicate key", "benign"), ("source_url_unique", "benign"), ("23505", "benign"))


def refusal(message: Column) -> Column:
    """fatal, benign or unknown, by the first mark that a message holds; null without a message."""
    low = F.lower(message)
    out = F.when(message.isNull(), F.lit(None).cast("string"))
    for mark, kind in REFUSALS:
        out = out.when(low.contains(mark), kind)
    return out.otherwise("unknown")


def images_to_refresh(images: Column, host: str) -> Column:
    """Whether any stored image is not on a host: only then an update stores images anew."""
    return F.coalesce(F.exists(images, lambda x: ~F.coalesce(x["url"].contains(host), F.lit(False))), F.lit(False))


def insert_missing(rows: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys the target does not have, each key once. Null counts as the empty string in keys."""
    plain = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"__{k}") for k in keys]
    fresh = rows.select("*", *plain).dropDuplicates([f"__{k}" for k in keys])
    return fresh.join(target.select(*plain), [f"__{k}" for k in keys], "left_anti").drop(*[f"__{k}" for k in keys])


def numbered(rows: DataFrame, order: list[str], start: Column | int = 0, column: str = "listing_number", buckets: int | None = None) -> DataFrame:
    """rows with consecutive numbers in an order, without a sort in one task: rows are dealt by ranges of the order, counts
    by range are summed, and rows are numbered within their range. Ranges are as many as Spark deals (buckets, if given);
    rows that are equal in the order are dealt by their place in the input, so that any number of them is spread too.
    Rows and the number of their range are written first, so that both uses agree whatever happens to an executor."""
    from pyspark.sql import Window

    tied = rows.withColumn("__t", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*([buckets] if buckets else []), *order, "__t")
    ranged = written(dealt.withColumn("__p", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("__p").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__s"))
    inside = Window.partitionBy("__p").orderBy(*order, "__t")
    start = start if isinstance(start, Column) else F.lit(start)
    return ranged.join(F.broadcast(starts), "__p").withColumn(column, F.col("__s") + F.row_number().over(inside) + start).drop("__p", "__s", "__t")
