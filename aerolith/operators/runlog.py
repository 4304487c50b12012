"""The log of runs: a row when a run of a source starts, and one when it is completed or has failed.

Rows are appended; the state of a run is its last row. A report is made in the driver, from one row for each source.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.functions import text as X
from aerolith.operators import metrics
from aerolith.operators.match import first_row

COLUMNS = (
    "run_id string, source_name string, target string, status string, found long, inserted long, updated long, skipped long, errors long, started_at timestamp_ntz, ended_at timestamp_ntz, "
    "duration_ms long, duration string, warnings array<string>, error_message string, usage map<string,long>"
)
MOST_WARNINGS = 100


def _typed(df: DataFrame) -> DataFrame:
    kinds = [x.rsplit(" ", 1) for x in COLUMNS.replace("string,long", "string;long").split(", ")]
    have = set(df.columns)
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(k.replace(";", ",")).alias(n) for n, k in kinds])


def _times(started: Column, ended: Column) -> dict[str, Column]:
    ms = F.unix_millis(ended.cast("timestamp")) - F.unix_millis(started.cast("timestamp"))
    return {"started_at": started, "ended_at": ended, "duration_ms": ms, "duration": X.elapsed(ms)}


def started(spark: SparkSession, run_id: str, sources: Iterable[str], target: str, at: Column) -> DataFrame:
    """A row for each source of a run that begins."""
    rows = spark.createDataFrame([(run_id, s, target, "running") for s in sources], "run_id string, source_name string, target string, status string")
    return _typed(rows.withColumn("started_at", at))


def completed(outcomes: DataFrame, run_id: str, target: str, begun: Column, ended: Column, source: str = "external_source", expected: DataFrame | None = None, drops: DataFrame | None = None, usage: DataFrame | None = None) -> DataFrame:
    """A row for each source of a run that ends well, from the outcomes of its rows: counts, duration, and warnings (a
    summary of validation drops, what parsers dropped, nothing found; at most 100). expected lists the sources of the
    run (source_name), drops is what parsers dropped (source_name, drop_reason, n), usage has (source_name, usage)."""
    stats = metrics.run_stats(outcomes, source).withColumnRenamed(source, "source_name")
    summary = metrics.drop_summary(metrics.skip_reasons(outcomes, source), source).withColumnRenamed(source, "source_name")
    if expected is not None:
        stats = expected.select("source_name").distinct().join(stats, "source_name", "left").na.fill(0)
    joined = stats.join(summary, "source_name", "left")
    if drops is not None:
        parts = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col("drop_reason").alias("r")))), lambda x: F.concat(x["r"], F.lit(": "), (-x["m"]).cast("string")))
        joined = joined.join(drops.groupBy("source_name").agg(F.concat(F.lit("parser drops: "), F.array_join(parts, ", ")).alias("dropped")), "source_name", "left")
    else:
        joined = joined.withColumn("dropped", F.lit(None).cast("string"))
    if usage is not None:
        joined = joined.join(usage, "source_name", "left")
    nothing = F.when((F.col("found") == 0) & (F.col("errors") == 0), F.lit("nothing found"))
    warnings = metrics.capped_warnings(F.array_compact(F.array("summary", "dropped", nothing)), MOST_WARNINGS)
    return _typed(joined.withColumns({"run_id": F.lit(run_id), "target": F.lit(target), "status": F.lit("completed"), "warnings": warnings} | _times(begun, ended)))


def failed(spark: SparkSession, run_id: str, source: str, target: str, message: str, begun: Column, ended: Column) -> DataFrame:
    rows = spark.createDataFrame([(run_id, source, target, "failed", message)], "run_id string, source_name string, target string, status string, error_message string")
    return _typed(rows.withColumns(_times(begun, ended)))


def latest(log: DataFrame) -> DataFrame:
    """The state of each run of a source: its end, if it has one."""
    rows = log.withColumn("__open", F.col("status") == "running")
    return first_row(rows, ["run_id", "source_name"], [F.col("__open"), F.col("ended_at")]).drop("__open")


def usage(df: DataFrame, source: str, **amounts: Column) -> DataFrame:
    """(source_name, usage): sums of what calls have used, by name: bytes, tokens."""
    sums = df.groupBy(F.col(source).alias("source_name")).agg(*[F.sum(c).cast("long").alias(n) for n, c in amounts.items()])
    return sums.select("source_name", F.create_map(*[x for n in amounts for x in (F.lit(n), F.col(n))]).alias("usage"))


def summary(log: DataFrame) -> tuple[str, int]:
    """A run's report as text, and the exit code: 1 if any source failed or had errors."""
    lines, code = ["=== Run summary ==="], 0
    for r in latest(log).orderBy("source_name").toLocalIterator():
        code = code or int(r.status == "failed" or (r.errors or 0) > 0)
        lines.append(f"[{(r.target or '').upper()}] {r.source_name}: {r.status}")
        lines += [f"  {n.capitalize()}: {r[n] or 0}" for n in ("found", "inserted", "updated", "skipped", "errors")]
        lines += [f"    - {r.error_message}"] * bool(r.error_message) + [f"    - {w}" for w in r.warnings or ()] + [f"  Duration: {r.duration}"] * bool(r.duration)
    return "\n".join(lines), code
