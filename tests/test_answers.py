"""Answers kept across runs, constraints, counts while writing, keyed state."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from aerolith.operators import answers, constraints, metrics, providers, upsert


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def test_a_second_run_asks_nothing(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def call(q):
        with open(log / "all", "a") as f:
            f.write(q + "\n")
        if q.startswith("busy"):
            raise providers.Busy
        return None if q == "nothing" else q.upper()

    def run(names, now, **ages):
        if (log / "all").exists():
            (log / "all").unlink()
        ask = answers.remembered(providers.one_by_one(call, gap=0.0, sleep=lambda s: None), f"{tmp_path}/answers", at(now), parts=4, **ages)
        df = spark.createDataFrame([(n,) for n in names], "q string")
        got = {r.q: r.x for r in providers.asked(df, F.col("q"), ask, "string", "x").collect()}
        return got, sorted((log / "all").read_text().split()) if (log / "all").exists() else []

    assert run(["a", "a", "nothing", "busy", None], "2026-01-01") == ({"a": "A", "nothing": None, "busy": None, None: None}, ["a", "busy", "busy", "busy", "nothing"])
    # what failed is asked again, what says nothing is not
    assert run(["a", "nothing", "busy"], "2026-01-02")[1] == ["busy"] * 3
    assert run(["a", "nothing"], "2026-01-03") == ({"a": "A", "nothing": None}, [])
    assert run(["b"], "2026-01-10") == ({"b": "B"}, ["b"])
    # answers of an age are asked for again, those that say nothing sooner
    assert run(["a", "b", "nothing"], "2026-01-11", most_age=timedelta(days=30), most_age_of_none=timedelta(days=5))[1] == ["nothing"]
    assert run(["a", "b", "nothing"], "2026-01-12", most_age=timedelta(days=5))[1] == ["a"]
    assert run([], "2026-01-13") == ({}, [])
    kept = answers.answer_store(spark, f"{tmp_path}/answers", parts=4).current("answers")
    assert sorted((r.key, r.answer, str(r.asked_at)[:10]) for r in kept.collect()) == [("a", "A", "2026-01-12"), ("b", "B", "2026-01-10"), ("nothing", None, "2026-01-11")]


def test_constraints_are_told_by_name(spark):
    kind = "id int, source_url string, status string, description string"
    rows = [(1, "u", "active", "long enough"), (2, "u", "expired", "long enough"), (3, "u", "paused", "short"), (4, None, "active", None), (5, None, "active", "long enough"), (6, "v", "active", "long enough"), (7, "w", None, "long enough")]
    df = spark.createDataFrame(rows, kind)
    stored = spark.createDataFrame([("v", "paused"), ("w", "active"), ("u", "expired"), (None, "active")], "source_url string, status string")
    parts = constraints.CONSTRAINTS["parts_listings"]
    got = {r.id: r.violations for r in constraints.violations(df, parts, [F.col("id")], stored).collect()}
    key = "parts_listings_source_url_unique"
    assert got == {1: [], 2: [], 3: [key, "description_check"], 4: [], 5: [], 6: [key], 7: []}
    log = spark.createDataFrame([("r", None), (None, None)], "run_id string, status string")
    marked = constraints.violations(log, constraints.CONSTRAINTS["crawler_runs"], [F.col("run_id")])
    assert sorted(r.violations for r in marked.collect()) == [["run_id_not_null", "status_not_null"], ["status_not_null"]]
    message = constraints.refused(F.col("violations"), constraints.CONSTRAINTS["crawler_runs"])
    assert marked.select(message).distinct().count() == 2 and constraints.violations(df.limit(0), parts, [F.col("id")]).count() == 0
    told = constraints.violations(df, parts, [F.col("id")], stored).select("id", constraints.refused(F.col("violations"), parts).alias("m"))
    assert {r.id: (r.m, r.k) for r in told.select("id", "m", upsert.refusal(F.col("m")).alias("k")).collect() if r.m} == {
        3: (f'duplicate key value violates unique constraint "{key}"', "benign"), 6: (f'duplicate key value violates unique constraint "{key}"', "benign"),
    }
    assert constraints.violations(df, [constraints.Check("c", "length(description) > 5")], [F.col("id")]).where("size(violations) > 0").first().id == 3


def test_counts_come_with_the_write(spark, tmp_path):
    df = spark.createDataFrame([("a", "inserted", None, 3), ("a", "skipped", "x", 4), ("b", "updated", None, None), ("other", "inserted", None, 1), (None, None, None, 2)], "source string, outcome string, error string, n int")
    out, watched = metrics.observed_run(df, ["a", "b", "c"], error="error", amounts={"bytes": F.col("n")})
    out.write.parquet(f"{tmp_path}/out")
    stats, amounts = metrics.observed_stats(spark, watched)
    expected = metrics.run_stats(df.where("source IN ('a', 'b')"), error="error")
    assert sorted(map(tuple, stats.collect())) == sorted(map(tuple, expected.collect())) and amounts == {"rows": 5, "bytes": 10}


@pytest.mark.parametrize("late", [False, True])
def test_keyed_state_is_let_go(spark, tmp_path, late):
    from aerolith.streaming import incremental
    from aerolith.streaming.keyed import latest_by_key

    kind = "k string, at timestamp, id string, v string"

    def wave(*rows):
        data = [(k, i, v, a) for k, a, i, v in rows]
        made = spark.createDataFrame(data, "k string, id string, v string, a string").select("k", F.col("a").cast("timestamp").alias("at"), "id", "v")
        made.write.mode("append").parquet(f"{tmp_path}/in")
        stream = latest_by_key(spark.readStream.schema(kind).parquet(f"{tmp_path}/in"), "k", "at", "id", "v", "1 hour", timedelta(days=2))
        incremental.to_completion(stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").outputMode("append"))
        return sorted(((r.key, r.outcome, r.content, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()), key=str)

    seen = wave(("a", "2024-01-01 10:00:00", "1", "x"), ("a", "2024-01-01 09:00:00", "2", "old"), (None, "2024-01-01 10:00:00", "3", "n"))
    assert seen == [("a", "inserted", "x", 2), (None, "inserted", "n", 1)]
    if late:  # behind the watermark: left out
        again = wave(("a", "2024-01-01 08:00:00", "9", "late"))
        assert len(again) == len(seen)
        return
    seen = wave(("a", "2024-01-02 10:00:00", "1", "y"), ("b", "2024-01-03 12:00:00", "1", "z"))
    assert ("a", "updated", "y", 1) in seen and ("b", "inserted", "z", 1) in seen and not any(r[1] == "expired" and r[0] == "a" for r in seen)
    seen = wave(("b", "2024-01-05 12:00:00", "2", "z"))
    assert ("b", "unchanged", "z", 1) in seen and ("a", "expired", "y", 0) in seen
    assert ("a", "inserted", "y", 1) in wave(("a", "2024-01-05 12:00:00", "5", "y"))
