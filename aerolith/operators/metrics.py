"""Run statistics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aerolith.rules import tables as T


def run_stats(df: DataFrame, source: str = "source", outcome: str = "outcome", error: str | None = None) -> DataFrame:
    """found, inserted, updated, skipped and errors of each source."""
    failed = F.count_if(F.col(error).isNotNull()) if error else F.lit(0).cast("long")
    kinds = [F.count_if(F.col(outcome) == k).alias(k) for k in ("inserted", "updated", "skipped")]
    return df.groupBy(source).agg(F.count("*").alias("found"), *kinds, failed.alias("errors"))


STATS = "source string, found long, inserted long, updated long, skipped long, errors long"


def observed_run(df: DataFrame, sources: Iterable[str], source: str = "source", outcome: str = "outcome", error: str | None = None, amounts: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """(df, an observation): the counts of run_stats for the sources named, and sums of amounts (bytes, tokens) over all
    rows, taken while df is written, without a second pass. `observed_stats` reads them when the write is done."""
    watched = Observation("run")
    failed = F.col(error).isNotNull() if error else F.lit(False)
    tests = {"found": F.lit(True), "errors": failed} | {k: F.col(outcome) == k for k in ("inserted", "updated", "skipped")}
    own = [F.count_if((F.col(source) == s) & t).alias(f"{name}:{s}") for s in sources for name, t in tests.items()]
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"amount:{name}") for name, c in (amounts or {}).items()]
    return df.observe(watched, F.count("*").alias("rows"), *own, *sums), watched


def observed_stats(spark: SparkSession, watched: Observation) -> tuple[DataFrame, dict[str, int]]:
    """(counts of each source that had rows, amounts and rows in all) of a finished write."""
    seen = watched.get
    names = [k.split(":", 1)[1] for k in seen if k.startswith("found:") and seen[k]]
    rows = [(n, *(seen[f"{k}:{n}"] for k in ("found", "inserted", "updated", "skipped", "errors"))) for n in names]
    return spark.createDataFrame(rows, STATS), {"rows": seen["rows"]} | {k.removeprefix("amount:"): v for k, v in seen.items() if k.startswith("amount:")}


def skip_reasons(df: DataFrame, source: str = "source", reason: str = "reason") -> DataFrame:
    return df.where(F.col(reason).isNotNull()).groupBy(source, reason).agg(F.count("*").alias("n"))


def drop_summary(reasons: DataFrame, source: str = "source", reason: str = "reason", n: str = "n") -> DataFrame:
    """A line for each source: the total and the reasons, most frequent first, equally frequent ones as a dictionary has
    them (case and accents decide last); normal reasons are left out."""
    ranked = F.struct((-F.col(n)).alias("m"), F.collate(F.col(reason), "UNICODE").alias("r"))
    listed = reasons.where(~F.col(reason).isin(*T.NORMAL_SKIP_REASONS)).groupBy(source).agg(F.sum(n).alias("total"), F.array_sort(F.collect_list(ranked)).alias("rs"))
    parts = F.array_join(F.transform("rs", lambda x: F.concat(F.collate(x["r"], "UTF8_BINARY"), F.lit(": "), (-x["m"]).cast("string"))), ", ")
    return listed.select(source, F.concat(F.lit("validation drops: "), F.col("total").cast("string"), F.lit(" ("), parts, F.lit(")")).alias("summary"))


def zero_row_sources(expected: DataFrame, stats: DataFrame, source: str = "source") -> DataFrame:
    """Sources of which a run found nothing and which had no error."""
    joined = expected.join(stats, source, "left")
    return joined.where((F.coalesce("found", F.lit(0)) == 0) & (F.coalesce("errors", F.lit(0)) == 0)).select(source)


def capped_warnings(warnings: Column, most: int = 100) -> Column:
    return F.slice(warnings, 1, most)


def modal_value(df: DataFrame, by: str, value: str) -> DataFrame:
    """The most frequent value of each key, of equally frequent ones the smallest."""
    counts = df.groupBy(by, value).agg(F.count("*").alias("n"))
    best = counts.groupBy(by).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(value).alias("v"))).alias("x"))
    return best.select(by, F.col("x.v").alias(value), (-F.col("x.m")).alias("n"))
