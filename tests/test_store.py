from pyspark.sql import functions as F

from aerolith.operators import dedup
from aerolith.plans import runs
from aerolith.streaming import incremental
from aerolith.streaming.store import Kept, Store
from tests_helpers import menu, now

ROW = "external_source string, source_url string, canonical_key string, digest string, arrival long, v long"


def events(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def told(df):
    return sorted((r.external_source, r.source_url, r.outcome, r.reason or "") for r in df.collect())


def kept(store):
    return sorted((r.external_source, r.source_url, r.canonical_key, r.v) for r in store.current("events").collect())


def index(store):
    return sorted((r.canonical_key, r.external_source) for r in store.current("by_key").collect())


def test_batches_meet_what_other_sources_have_stored(spark, tmp_path):
    store = incremental.event_store(spark, f"{tmp_path}/s", "v long", parts=4)
    order = [F.col("v")]
    first = events(spark, ("iata.org", "a", "K", "1", 5, 1), ("iata.org", "b", "K", "1", 5, 1), ("ulforum.de", "c", "L", "1", 5, 1), ("iata.org", "n", None, "1", 5, 1), ("pilot-frank.de", "x", "K", "1", 1, 1))
    assert told(incremental.event_batch(first, store, 0, order)) == [("iata.org", "a", "inserted", ""), ("iata.org", "b", "inserted", ""), ("iata.org", "n", "inserted", ""), ("pilot-frank.de", "x", "skipped", "lower_priority_duplicate"), ("ulforum.de", "c", "inserted", "")]
    # dulv.de replaces both rows of K; iata.org is refused at L; ulforum.de moves its row from L to M, frank meets nothing
    second = events(spark, ("dulv.de", "a", "K", "1", 5, 2), ("iata.org", "l", "L", "1", 5, 2), ("ulforum.de", "c", "M", "2", 5, 2), ("pilot-frank.de", "x", "N", "1", 5, 2))
    for _ in range(2):
        got = told(incremental.event_batch(second, store, 1, order))
        assert got == [("dulv.de", "a", "inserted", ""), ("iata.org", "a", "deleted", "superseded"), ("iata.org", "b", "deleted", "superseded"), ("iata.org", "l", "skipped", "lower_priority_duplicate"), ("pilot-frank.de", "x", "inserted", ""), ("ulforum.de", "c", "updated", "")]
        assert kept(store) == [("dulv.de", "a", "K", 2), ("iata.org", "n", None, 1), ("pilot-frank.de", "x", "N", 2), ("ulforum.de", "c", "M", 2)]
        assert index(store) == [("K", "dulv.de"), ("M", "ulforum.de"), ("N", "pilot-frank.de")]
    # L is free now; equal content is unchanged; an empty batch changes nothing
    third = events(spark, ("iata.org", "l", "L", "1", 5, 3), ("dulv.de", "a", "K", "1", 5, 3))
    assert told(incremental.event_batch(third, store, 2, order)) == [("dulv.de", "a", "skipped", "unchanged"), ("iata.org", "l", "inserted", "")]
    assert told(incremental.event_batch(third.limit(0), store, 3, order)) == [] and len(kept(store)) == 5


def test_whole_rows_of_a_batch_are_written_twice_at_most(spark, tmp_path):
    """Once with what is decided of them, once as what they leave behind; decisions are tables of keys."""
    from pathlib import Path

    from aerolith.operators.scratch import shared_dir

    there = lambda: set(Path(shared_dir(spark).removeprefix("file://"), "aerolith").glob("*"))
    store = incremental.event_store(spark, f"{tmp_path}/s", "v long", parts=2)
    for number, source in enumerate(("iata.org", "dulv.de", "pilot-frank.de")):
        before = there()
        rows = events(spark, (source, "a", "K", "1", 5, number), (source, "b", None, "1", 5, number), (source, "b", "M", "2", 4, number + 10))
        incremental.event_batch(rows, store, number, [F.col("v")])
        made = [p for p in there() - before if "digest" in spark.read.parquet(f"{p}").columns]
        assert len(made) == 2


def test_claimed_rows_are_not_removed(spark):
    stored = spark.createDataFrame([("K", "iata.org", False, None), ("L", "iata.org", True, "2024-01-01"), ("M", "dulv.de", True, None), ("M", "iata.org", None, None), (None, "iata.org", True, None)], "k string, s string, is_external boolean, claimed_at string")
    rows = spark.createDataFrame([("K", "dulv.de"), ("L", "dulv.de"), ("M", "ics-feed"), (None, "dulv.de"), ("Z", "dulv.de")], "k string, s string")
    decided, going = dedup.against_stored(rows, stored, "k", "s")
    low = "lower_priority_duplicate"
    assert {r.k: r.decision for r in decided.collect()} == {"K": low, "L": low, "M": low, None: "kept", "Z": "kept"} and going.count() == 0
    decided, going = dedup.against_stored(rows.where("k = 'M'").withColumn("s", F.lit("dulv.de")), stored, "k", "s")
    assert [r.decision for r in decided.collect()] == ["superseding"] and [(r.k, r.s) for r in going.collect()] == [("M", "iata.org")]


def test_a_hot_key_is_split(spark):
    rows = spark.range(300_000).select(F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.when(F.col("id") % 2 == 0, "iata.org").otherwise("dulv.de").alias("s"), "id", F.repeat(F.lit("x"), F.lit(40)).alias("more"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = dedup.priority_winners(rows, "k", "s", "id")
        plan = out.where("outcome = 'kept'")
        assert plan.count() > 100_000
        plan.write.format("noop").mode("overwrite").save()
        counted = plan.select(F.sum("id"))
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_parts_grow_with_the_table(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/g", {"t": Kept("k long, v string", ("k",))}, parts=2, most_rows=100)

    def run(number, low, high):
        batch = store.begin(number)
        rows = spark.range(low, high).select(F.col("id").alias("k"), F.lit(f"b{number}").alias("v"))
        old = batch.meet("t", rows).join(rows, "k", "left_anti")
        batch.put("t", old.unionByName(rows))
        batch.commit()
        return next(p.parts for p in store.state(number)["t"].values())

    assert run(0, 0, 1000) == 2  # counted when it is there
    assert run(1, 990, 1100) == 32 and run(2, 0, 10) == 32
    got = {r.v: r.n for r in store.current("t").groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert got == {"b0": 980, "b1": 110, "b2": 10}
    assert run(3, 0, 10) == 32 and not list((tmp_path / "g/t/parts=2").glob("part=*/version=*"))


def test_an_event_run_meets_stored_events(spark):
    landed = spark.createDataFrame([("nbaa.org", "https://n/", menu("Forum", "Oct. 18, 2026") + menu("Other", "Oct. 19, 2026") + menu("Third", "Oct. 20, 2026"))], "source string, page_url string, payload string")
    kind = "external_source string, source_url string, canonical_key string, is_external boolean, claimed_at timestamp_ntz, digest string, title string"
    none = spark.createDataFrame([], kind)
    from aerolith.operators.rows import event_rows
    from aerolith.sources import event_pages

    key = {r.title: r.canonical_key for r in event_rows(event_pages.events(landed, now(), ["nbaa.org"])).collect()}
    assert all(key.values()) and {r.outcome for r in runs.event_run(landed, none, now(), ["nbaa.org"]).collect()} == {"inserted"}
    target = spark.createDataFrame([("dulv.de", "u1", key["Forum"], True, None, "x", "Forum"), ("unknown.example", "u2", key["Other"], True, None, "x", "Other"), ("pilot-frank.de", "https://nbaa.org/Third", "else", True, None, "x", "Third")], kind)
    got = {(r.external_source, r.title): (r.outcome, r.reason) for r in runs.event_run(landed, target, now(), ["nbaa.org"]).collect()}
    from aerolith.rules.tables import DEFAULT_PRIORITY, SOURCE_PRIORITY

    other = ("inserted", None) if SOURCE_PRIORITY.get("nbaa.org", DEFAULT_PRIORITY) > DEFAULT_PRIORITY else ("skipped", "lower_priority_duplicate")
    assert got[("nbaa.org", "Forum")] == ("skipped", "lower_priority_duplicate") and got[("nbaa.org", "Other")] == other and got[("nbaa.org", "Third")] == ("inserted", None)
    assert (got.get(("unknown.example", "Other")) == ("deleted", "superseded")) == (other[0] == "inserted")


def test_scratch_tables_of_a_batch_are_freed(spark, tmp_path):
    from pathlib import Path

    from aerolith.operators.scratch import freed, shared_dir, written

    there = lambda: {p.name for p in Path(shared_dir(spark).removeprefix("file://"), "aerolith").glob("*")}
    kept = written(spark.range(3), "kept")
    before = there()
    with freed(spark):
        a = written(spark.range(5), "inner")
        with freed(spark):
            written(a, "innermost")
            assert len(there() - before) == 2
        assert len(there() - before) == 1 and a.count() == 5
    assert there() == before and kept.count() == 3
    rows = events(spark, ("iata.org", "a", "K", "1", 5, 1))
    rows.write.parquet(f"{tmp_path}/in")
    store = incremental.event_store(spark, f"{tmp_path}/s", "v long", parts=2)
    incremental.to_completion(incremental.event_writer(spark.readStream.schema(ROW).parquet(f"{tmp_path}/in"), store, [F.col("v")]))
    assert there() == before and kept_rows(store) == 1


def kept_rows(store):
    return store.current("events").count()
