import re
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from aerolith.operators import dedup, match, merge, metrics, recurrence, upsert, validate
from aerolith.operators.filldown import fill_down
from aerolith.sources import ics
from aerolith.sources.landing import decoded, reachable
from aerolith.streaming import incremental

ROOT = Path(__file__).resolve().parent.parent


def expand(spark, start, rule, horizon="2027-01-01 00:00:00", ex=(), rd=()):
    df = spark.createDataFrame([(start, rule, list(ex), list(rd))], "s string, r string, ex array<string>, rd array<string>")
    ts = F.col("s").cast("timestamp_ntz")
    df = df.select(ts.alias("start"), (ts + F.expr("INTERVAL 1 HOUR")).alias("end"), F.col("r").alias("rrule"), F.col("ex").cast("array<timestamp_ntz>").alias("exdates"), F.col("rd").cast("array<timestamp_ntz>").alias("rdates"))
    return [str(r.start)[:10] for r in recurrence.expand(df, F.lit(horizon).cast("timestamp_ntz")).orderBy("occurrence").collect()]


@pytest.mark.parametrize("start,rule,expected,more", [
    ("2026-01-15 10:00:00", "FREQ=MONTHLY;BYMONTHDAY=15;COUNT=3", ["2026-01-15", "2026-02-15", "2026-03-15"], {}),
    ("2026-01-01 10:00:00", "FREQ=MONTHLY;BYMONTHDAY=1,15;COUNT=4", ["2026-01-01", "2026-01-15", "2026-02-01", "2026-02-15"], {}),
    ("2026-01-30 10:00:00", "FREQ=MONTHLY;BYMONTHDAY=30;COUNT=4", ["2026-01-30", "2026-03-30", "2026-04-30", "2026-05-30"], {}),
    ("2026-06-01 10:00:00", "FREQ=WEEKLY;COUNT=4", ["2026-06-01", "2026-06-08", "2026-06-22"], {"ex": ["2026-06-15 10:00:00"]}),
    ("2026-01-01 10:00:00", "FREQ=MONTHLY;BYDAY=2TU;COUNT=4", ["2026-01-01", "2026-01-13", "2026-02-10", "2026-03-10"], {}),
    ("2026-01-01 10:00:00", "FREQ=MONTHLY;BYDAY=-1FR;COUNT=4", ["2026-01-01", "2026-01-30", "2026-02-27", "2026-03-27"], {}),
    ("2026-02-01 10:00:00", "FREQ=MONTHLY;BYDAY=5SU;COUNT=2", ["2026-02-01"], {"horizon": "2026-02-28 00:00:00"}),
    ("2026-01-31 10:00:00", "FREQ=MONTHLY;COUNT=3", ["2026-01-31", "2026-03-03", "2026-04-03"], {}),
    ("2026-01-07 10:00:00", "FREQ=WEEKLY;BYDAY=MO,WE;UNTIL=20260120T000000Z", ["2026-01-07", "2026-01-12", "2026-01-14", "2026-01-19", "2026-03-01"], {"rd": ["2026-03-01 00:00:00"]}),
    ("2026-01-07 10:00:00", "FREQ=YEARLY", ["2026-01-07"], {}),
    ("2026-01-07 10:00:00", None, ["2026-01-07"], {}),
    ("2026-01-07 10:00:00", "FREQ=DAILY;COUNT=1", ["2026-01-07"], {}),
    ("2026-02-01 10:00:00", "FREQ=MONTHLY;BYDAY=6MO", ["2026-02-01"], {}),
    ("2026-01-07 10:00:00", "FREQ=DAILY", None, {}),
])
def test_recurrences(spark, start, rule, expected, more):
    got = expand(spark, start, rule, **more)
    assert got == expected if expected is not None else len(got) == recurrence.MOST_OCCURRENCES


CALENDAR = "﻿BEGIN:VCALENDAR\r\nX-WR-TIMEZONE:America/New_York\r\nBEGIN:VEVENT\r\nUID:1\r\nSUMMARY:Fly\\, In and a line\r\n  that goes on\r\nDTSTART:20260601T190000\r\nDURATION:PT2H\r\nLOCATION:Platz (EDMT)\\, 89077 Ulm\r\nCATEGORIES:Foo,Trade Fair\r\nRRULE:FREQ=WEEKLY;COUNT=3\r\nEXDATE:20260608T190000\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nUID:2\r\nSUMMARY:Weg\r\nDTSTART;VALUE=DATE:20260602\r\nSTATUS:CANCELLED\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nSUMMARY:Ohne UID\r\nDTSTART:20260602\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n"


def test_calendars(spark):
    feeds = spark.createDataFrame([("Club", "https://c/1.ics", "DE", "meetup", None, None, None, CALENDAR), ("Wand", "https://c/2.ics", "DE", "meetup", None, None, None, "<html>BEGIN:VCALENDAR</html>")], "name string, url string, country string, default_category string, timezone string, source_locale string, organiser_name string, payload string")
    got = ics.calendar_events(feeds, F.lit("2026-05-01").cast("timestamp_ntz")).orderBy("start").collect()
    assert [str(r.start) for r in got] == ["2026-06-01 23:00:00", "2026-06-15 23:00:00"]
    assert {(r.title, r.category, r.timezone, r.city, r.organiser) for r in got} == {("Fly, In and a line that goes on", "trade-fair", "America/New_York", "Ulm", "Club")}
    assert str(got[0].end) == "2026-06-02 01:00:00" and got[0].source_url.startswith("https://c/1.ics#")
    html = "<a href='/k.ics'>x</a><a href='webcal://w/k'>y</a><a href='/n.htm'>z</a><link rel='alternate' type='text/calendar' href='l.ical'>"
    links = spark.createDataFrame([(html,)], "h string").select(ics.feed_links(F.col("h"), F.lit("https://h/p/q"))).first()[0]
    assert links == ["https://h/k.ics", "webcal://w/k", "https://h/p/l.ical"]


def test_lines_of_an_event_are_not_listed_for_each_property(spark):
    """Properties come from one look each at the event's text: the last line of a name counts, in any case."""
    event = "BEGIN:VEVENT\nuid:1\nSUMMARY;LANGUAGE=de:Alt\nSummary:Neu\\nund\\; mehr\nDTSTART;TZID=Europe/Rome:20260701T120000\nDTEND:20260731T240000Z\nX-SUMMARY:nein\nDESCRIPTION:SUMMARY:auch nicht\nEXDATE:20260801T000000Z,kaputt\nEXDATE;TZID=Asia/Tokyo:20260802T090000\nRDATE:\nEND:VEVENT\n"
    rows = ics.parsed(spark.createDataFrame([(f"BEGIN:VCALENDAR\n{event}END:VCALENDAR",), ("BEGIN:VCALENDAR\nEND:VCALENDAR",)], "payload string"))
    (r,) = rows.collect()
    assert (r.uid, r.summary, r.description, str(r.start), str(r.end)) == ("1", "Neu\nund; mehr", "SUMMARY:auch nicht", "2026-07-01 10:00:00", "2026-08-01 00:00:00")
    assert [str(x) for x in r.exdates] == ["2026-08-01 00:00:00", "2026-08-02 00:00:00"] and r.rdates == []
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert plan.count("filter(") <= 2  # of categories; lists of lines were filtered thirteen times


def test_first_broken_rule(spark):
    kind = "title string, source_url string, category string, country string, start timestamp_ntz, end timestamp_ntz, icao string, latitude double, longitude double"
    good = ("Fest", "u", "c", "DE", "2026-01-02", "2026-01-03", None, 0.0, 0.0)
    bad = [({"title": " "}, "missing_title"), ({"title": "ab"}, "title_too_short"), ({"source_url": None}, "missing_source_url"), ({"category": ""}, "missing_category"), ({"country": " "}, "missing_country"), ({"start": None}, "invalid_start_date"),
           ({"end": None}, "invalid_end_date"), ({"end": "2026-01-01"}, "end_before_start"), ({"end": "2026-06-01"}, "duration_exceeds_max"), ({"start": "2025-01-01", "end": "2025-01-02"}, "ended_too_long_ago"),
           ({"start": "2031-01-03", "end": "2031-01-04"}, "starts_too_far_in_future"), ({"icao": "EDx"}, "invalid_icao"), ({"latitude": 91.0}, "invalid_coordinates"), ({"longitude": -181.0}, "invalid_coordinates"), ({}, None)]
    names = [x.split()[0] for x in kind.split(", ")]
    rows = [tuple((dict(zip(names, good)) | change)[n] for n in names) for change, _ in bad]
    df = spark.createDataFrame(rows, kind.replace("timestamp_ntz", "string")).withColumn("start", F.col("start").cast("timestamp_ntz")).withColumn("end", F.col("end").cast("timestamp_ntz")).coalesce(1)
    got = [r[0] for r in df.select(validate.event_reason(F.lit("2026-01-01").cast("timestamp_ntz"))).collect()]
    assert got == [reason for _, reason in bad]


def test_winners_by_priority_then_arrival(spark):
    rows = [(1, "k", "iata.org", 1), (2, "k", "dulv.de", 5), (3, "k", "dulv.de", 6), (4, "k", "nbaa.org", 4), (5, None, "iata.org", 1), (6, "l", "x", 1)]
    got = {r.i: r.outcome for r in dedup.priority_winners(spark.createDataFrame(rows, "i int, k string, s string, a int"), "k", "s", "a").collect()}
    assert got == {1: "lower_priority_duplicate", 2: "lower_priority_duplicate", 3: "lower_priority_duplicate", 4: "kept", 5: "kept", 6: "kept"}


def test_summary_line(spark):
    reasons = spark.createDataFrame([("s", "missing_title", 5), ("s", "end_before_start", 7), ("s", "unchanged", 99), ("t", "unchanged", 1)], "source string, reason string, n long")
    assert [tuple(r) for r in metrics.drop_summary(reasons).collect()] == [("s", "validation drops: 12 (end_before_start: 7, missing_title: 5)")]


def test_upserts_are_idempotent(spark):
    target = spark.createDataFrame([("a", True, None, "d1", 1), ("b", False, None, "d1", 2), ("c", True, "2026-01-01", "d1", 3)], "k string, is_external boolean, claimed_at string, digest string, v int").withColumn("claimed_at", F.col("claimed_at").cast("timestamp_ntz"))
    staged = spark.createDataFrame([("a", "d2", 10), ("b", "d2", 20), ("c", "d2", 30), ("d", "d2", 40)], "k string, digest string, v int")
    got = {r.k: (r.outcome, r.reason) for r in upsert.outcomes(staged, target, "k", "digest").collect()}
    assert got == {"a": ("updated", None), "b": ("skipped", "claimed"), "c": ("skipped", "claimed"), "d": ("inserted", None)}
    fresh = staged.withColumns({"is_external": F.lit(True), "claimed_at": F.lit(None).cast("timestamp_ntz")})
    after = upsert.snapshot(fresh, target, "k", ["v", "digest"])
    assert {r.k: r.v for r in after.collect()} == {"a": 10, "b": 2, "c": 3, "d": 40}
    again = {r.k: r.reason for r in upsert.outcomes(staged, after, "k", "digest").collect()}
    assert again == {"a": "unchanged", "b": "claimed", "c": "claimed", "d": "unchanged"}


@pytest.mark.parametrize("few,most", [(64, 1000), (0, 1000), (0, 2)])
def test_names_held_by_texts(spark, monkeypatch, few, most):
    texts = spark.createDataFrame([(1, "my robin dr400"), (2, "robinson r44"), (3, "a cub"), (4, "nothing"), (5, None), (6, "")], "k int, t string")
    dim = spark.createDataFrame([("robin",), ("robinson",), ("cub",), ("dr",), ("",), (None,), ("cub",)], "n string")
    held = {r.k: sorted(r.h) for r in match.held_names(texts, F.col("t"), dim, "h", few, most).collect()}
    assert held == {1: ["dr", "robin"], 2: ["robin", "robinson"], 3: ["cub"], 4: [], 5: [], 6: []}
    monkeypatch.setattr(match, "FEW_NAMES", few)
    makers = match.manufacturer(texts, "k", "t", spark.createDataFrame([("Robin",), ("ROBIN",), ("cub",), ("bcu",)], "name string"))
    assert {r.k: r.manufacturer for r in makers.collect()} == {1: "ROBIN", 2: "Robinson", 3: "cub", 4: None, 5: None, 6: None}


def brute_spec(text, specs):
    best = (0, None)
    for order, (maker, model, variant) in enumerate(specs):
        word = re.search(rf"(?a:\b){re.escape(model)}(?a:\b)", text) if len(model) <= 3 else model in text
        score = 2 * (maker in text) + 3 * bool(word) + bool(variant and variant in text)
        if score > best[0]:
            best = score, order
    return best if best[0] >= 3 else None


@pytest.mark.parametrize("few", [0, 64])
def test_specs_by_score_against_brute_force(spark, monkeypatch, few):
    import random

    monkeypatch.setattr(match, "FEW_NAMES", few)
    rng = random.Random(few)
    makers, models, variants = ["cessna", "piper", "robin", "x+y"], ["172", "j3", "cub", "dr400", "r44", "super cub"], ["", None, "ii", "tdi", "a"]
    specs = [(rng.choice(makers), rng.choice(models), rng.choice(variants)) for _ in range(40)]
    texts = [" ".join(rng.choice([*makers, *models, "ii", "tdi", "a172", "j3x", "(172)", "und"]) for _ in range(rng.randint(0, 4))) for _ in range(200)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    dim = spark.createDataFrame([(a.upper(), b, c, k) for k, (a, b, c) in enumerate(specs)], "maker string, model string, variant string, ord int")
    got = {r.k: (r.score, r.ord) for r in match.best_spec(df, "k", "t", dim, "maker", "model", "variant", "ord").collect()}
    assert got == {k: b for k, t in enumerate(texts) if (b := brute_spec(t or "", [(a, b, c or "") for a, b, c in specs]))}


def test_merging(spark):
    df = spark.createDataFrame([(None, None, "50", "kt"), ("", "mph", "50", "kt"), ("7", None, "50", "kt"), (None, None, None, "kt")], "cruise_speed string, cruise_speed_unit string, spec_cruise_speed string, spec_cruise_speed_unit string")
    assert [(r.cruise_speed, r.cruise_speed_unit) for r in merge.apply_specs(df).collect()] == [("50", "kt"), ("50", "mph"), ("7", None), (None, None)]
    assert merge.update_columns(spark.createDataFrame([(1, 2, 3, 4)], "k int, headline_de int, images int, price int")) == ["k", "price"]
    back = merge.backfill(spark.createDataFrame([("", "x" * 100)], "city string, description string"), {"city": F.lit("Ulm")}, F.lit("y" * 30)).first()
    assert (back.city, back.description, back.changed) == ("Ulm", "y" * 30, ["city", "description"])
    ladder = spark.createDataFrame([(None, "ein langer Text hier", "T", 1990), ("kurz", "kurz", "T", 1990)], "e string, o string, t string, y int").select(merge.description_ladder(F.col("e"), F.col("o"), F.col("t"), F.col("y")))
    assert [r[0] for r in ladder.collect()] == ["ein langer Text hier", "T — 1990"]


def test_fill_down_and_numbers(spark):
    df = spark.createDataFrame([("p", 1, None), ("p", 2, "a"), ("p", 3, None), ("q", 1, None)], "p string, i int, h string")
    assert sorted(tuple(r) for r in fill_down(df, ["p"], [F.col("i")], "h", "c", "-").select("p", "i", "c").collect()) == [("p", 1, "-"), ("p", 2, "a"), ("p", 3, "a"), ("q", 1, "-")]
    n = upsert.numbered(spark.range(1000).select(F.col("id")), ["id"], 5)
    assert n.where("listing_number <> id + 6").count() == 0
    fresh = upsert.insert_missing(spark.createDataFrame([("a", None), ("a", ""), ("b", "x")], "m string, v string"), spark.createDataFrame([("b", "x")], "m string, v string"), ["m", "v"])
    assert [r.m for r in fresh.collect()] == ["a"]


def test_frontier_and_charsets(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "page_url string, next_url string")
    assert sorted(tuple(r) for r in reachable(spark.createDataFrame([("a",)], "page_url string"), links).collect()) == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]
    data = spark.createDataFrame([(bytearray("ü".encode("latin-1")), bytearray("ü".encode()))], "a binary, b binary")
    assert tuple(data.select(decoded(F.col("a"), "latin-1"), decoded(F.col("b"))).first()) == ("ü", "ü")


def test_streamed_upserts(spark, tmp_path):
    schema = "k string, v int, digest string, is_external boolean, claimed_at timestamp_ntz"
    for n, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2), ("c", 1)], [("a", 2)]]):
        spark.createDataFrame(rows, "k string, v int").withColumn("digest", F.sha1(F.col("v").cast("string"))).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("k string, v int, digest string").parquet(f"{tmp_path}/in")
        incremental.upsert_writer(stream, f"{tmp_path}/t", "k", "digest", ["v", "digest"], [-F.col("v")], schema).trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.k, r.v) for r in incremental.current(spark, f"{tmp_path}/t", schema).collect()) == [("a", 2), ("b", 1), ("c", 1)]
    outcomes = spark.read.parquet(f"{tmp_path}/t/outcomes")
    assert sorted((r.batch, r.k, r.outcome, r.reason) for r in outcomes.collect()) == [(0, "a", "inserted", None), (0, "b", "inserted", None), (1, "a", "updated", None), (1, "c", "inserted", None), (2, "a", "skipped", "unchanged")]


def test_a_batch_that_is_run_again_gives_the_same(spark, tmp_path):
    folder, schema = f"{tmp_path}/t", "k string, v long"
    add = lambda rows, target: rows.unionByName(target).groupBy("k").agg(F.sum("v").alias("v"))
    batch = lambda *rows: spark.createDataFrame(rows, schema)
    state = lambda: sorted(tuple(r) for r in incremental.current(spark, folder, schema).collect())
    for number, rows in enumerate([[("a", 1), ("b", 2)], [("a", 10)], [], [("c", 5), ("a", 100)], [("b", 1)]]):
        for _ in range(2):
            incremental.upsert(batch(*rows), folder, schema, "k", number, add, parts=8)
    assert state() == [("a", 111), ("b", 3), ("c", 5)]
    assert len(list((tmp_path / "t/manifest").glob("batch=*"))) <= 3
    assert all(len(list(p.glob("version=*"))) <= 2 for p in (tmp_path / "t/target").glob("part=*"))


def test_streamed_winners_have_one_row_for_each_key(spark, tmp_path):
    rows = [("u", "iata.org", "2019-12-01 00:00:00"), ("u", "iata.org", "2020-01-15 00:00:00"), ("v", "iata.org", "2020-01-01 00:00:00")], [("u", "dulv.de", "2031-01-01 00:00:00"), (None, "dulv.de", None)]
    for part in rows:
        spark.createDataFrame(part, "k string, s string, t string").select("k", "s", F.col("t").cast("timestamp_ntz").alias("t")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("k string, s string, t timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        incremental.to_completion(incremental.winners_writer(stream, f"{tmp_path}/w", "k", "s", "t", "k string"))
    got = {r.k: (r.winner, r.n) for r in incremental.winners(spark, f"{tmp_path}/w", "k string").collect()}
    assert got == {"u": ("dulv.de", 3), "v": ("iata.org", 1), None: ("dulv.de", 1)}


def test_landed_files_have_a_row_or_a_reason(spark, tmp_path):
    from aerolith.sources import landing

    for name, data in (("a", b"gut"), ("b", b""), ("c", b"x" * 101), ("d", b"\xff\xc3\xa4 \xc3")):
        (tmp_path / name).write_bytes(data)
    got = {r.page_url[-1]: (r.payload, r.drop_reason) for r in landing.files(spark, str(tmp_path), most_bytes=100).collect()}
    assert got == {"a": ("gut", None), "b": (None, "empty"), "c": (None, "too-large"), "d": ("\ufffdä \ufffd", None)}
    assert landing.texts(spark, str(tmp_path), most_bytes=100).count() == 2


def test_long_texts_lose_their_repeats_in_little_time(spark):
    from aerolith.functions.text import deduplicate_description

    many = " ".join(f"Das ist der lange Satz Nummer {k % 40_000}." for k in range(60_000))
    df = spark.createDataFrame([(many,), ("Kurz. Kurz. Ein Satz, der lang genug ist. ein Satz, der  lang genug ist. Ende",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(deduplicate_description(F.col("t"))).collect()]
    assert got[0] == " ".join(f"Das ist der lange Satz Nummer {k}." for k in range(40_000))
    assert got[1:] == ["Kurz. Kurz. Ein Satz, der lang genug ist. Ende", "", None]


def test_the_rest_works_without_the_subpackage(tmp_path):
    import shutil

    shutil.copytree(ROOT / "aerolith", tmp_path / "aerolith", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "aerolith/llm/__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'validate_events' in q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert e.oracle_sql().keys() <= q.keys()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path), "HOME": "/tmp"})


def test_reasons_are_in_the_order_of_a_dictionary(spark):
    rows = [("s", r, 2) for r in ("Zebra", "apfel", "ärger", "Apfel", "b_c", "ba", "Ähre")] + [("s", "most", 9)]
    (r,) = metrics.drop_summary(spark.createDataFrame(rows, "source string, reason string, n long")).collect()
    assert r.summary == "validation drops: 23 (most: 9, Ähre: 2, apfel: 2, Apfel: 2, ärger: 2, b_c: 2, ba: 2, Zebra: 2)"
    assert metrics.drop_summary(spark.createDataFrame(rows, "source string, reason string, n long")).schema["summary"].dataType.simpleString() == "string"


def test_texts_by_parts_are_the_same_as_whole_ones(spark):
    import random

    from aerolith.functions.text import deduplicate_description
    from aerolith.operators.sentences import without_repeats

    rng = random.Random(3)
    some = ["Das ist ein langer Satz Nummer eins.", "das ist  ein langer Satz nummer EINS.", "Kurz.", "Ja!", "Noch ein Satz, der lang genug ist?", " ", "\u00a0Und einer mit Rand.", "Ohne Ende", "x" * 30_000 + "."]
    texts = [None, "", "  ", "\n\n", "\n \n\n  a"] + ["".join(rng.choice(some) + rng.choice([" ", "  ", "\n", "\n\n", "\n  \n"]) for _ in range(rng.randint(1, 12))) for _ in range(120)]
    df = spark.createDataFrame([(k % 50, t, "clash") for k, t in enumerate(texts)], "id int, text string, part string")
    both = without_repeats(df.withColumn("whole", deduplicate_description(F.col("text"))), "text", "id", "whole", "part").collect()
    assert len(both) == len(texts) and all(r.text == r.whole for r in both) and {r.part for r in both} == {"clash"}
    assert all((r.n_sentences > 0) == bool(r.text) for r in both) and without_repeats(df.limit(0), "text").count() == 0
    long = " ".join(f"Das ist der lange Satz Nummer {k % 20_000}." for k in range(30_000))
    (r,) = without_repeats(spark.createDataFrame([(long,)], "text string"), "text").collect()
    assert r.n_sentences == 20_000


def test_sentences_go_by_the_rules_of_their_sql(spark, tmp_path):
    """Paragraphs are no parts, an empty text is one sentence, one that is null none, and rows of an id are one text."""
    import hashlib
    import random

    import __spark_entry__ as entry

    two = "Ein Absatz, der lang genug ist\n\nEin Absatz, der lang genug ist"
    rows = [(1, two), (2, None), (3, ""), (4, " \n\x0b "), (5, "Kurz. Ein Satz, der lang genug ist. Kurz."), (5, "Kurz. Ein Satz, der lang genug ist. Kurz."), (None, "a"), (None, "a"), (6, "Die ΟΔΟΣ ist eine Straße. Die οδος ist eine Straße."), (7, "Ende mit Rand.\u00a0Ende mit Rand.\u00a0 ")]
    want = {1: (two, 1), 3: ("", 1), 4: ("", 1), 5: ("Kurz. Kurz. Ein Satz, der lang genug ist. Kurz. Kurz.", 5), None: ("a a", 2), 6: (rows[8][1], 2), 7: ("Ende mit Rand.\u00a0Ende mit Rand.\u00a0", 1)}
    some = ["Das ist ein langer Satz Nummer eins.", "das ist  ein langer Satz nummer EINS.", "Kurz.", "Ja!", "kurz.", "Noch ein Satz, der \u00a0lang \x0b genug ist?", "İst das ein Satz, der zählt?", "ist das ein Satz, der zählt?", "Genau zwanzig Buchst", "ein\x01Zeichen", "\u2029", "\U0001f600 " * 9 + "!", ""]
    rng = random.Random(5)
    more = ["".join(rng.choice(some) + rng.choice(["", " ", "  ", "\n", "\n\n", "\t\f", "\x0b", "\u00a0", "\ufeff ", "\x85", " \u2003"]) for _ in range(rng.randint(0, 9))) for _ in range(300)]
    rows += [(100 + k, t) for k, t in enumerate(more) for _ in range(1 + (k % 9 == 0))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in entry.queries()["sentence_dedup"](spark, str(tmp_path)).collect()}
    assert {r for r in got if (r[0] or 0) < 100} == {(k, hashlib.md5(t.encode()).hexdigest(), n) for k, (t, n) in want.items()}
    con = pytest.importorskip("duckdb").connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == set(con.execute(entry.oracle_sql()["sentence_dedup"]).fetchall())


def test_category_of_maker_meets_entries_by_names(spark):
    """Titles meet the first entry of each kind of score by the names that they hold, not all entries of their maker."""
    from aerolith.operators import match

    specs = spark.createDataFrame(
        [("Ace", "One", "x", "a", 5), ("Ace", "One", None, "b", 3), ("Ace", "Two", "y", "c", 1), ("Ace", "", "z", "d", 9), ("Ace", None, "One", "e", 2), ("Bee", "One", "x", "f", 0), ("Ace", "Zzz", "", "", -1)],
        "maker string, model string, variant string, category string, ord int",
    )
    titles = spark.createDataFrame([(1, "one x", "ACE"), (2, "one", "ace"), (3, "y one", "Ace"), (4, "none", "Ace"), (5, None, "Ace"), (6, "q", "Bee"), (7, "q", None), (8, "q", "Cee"), (9, "z q", "Ace")], "k int, title string, maker string")
    got = match.category_of_maker(titles, "k", "title", "maker", specs, "maker", "model", "variant", "category", "ord")
    want = {}
    for k, t, m in [tuple(r) for r in titles.collect()]:
        own = [(-(1 + 3 * (md is not None and t is not None and md.lower() in t) + (bool(va) and t is not None and va.lower() in t)), o, c) for mk, md, va, c, o in [tuple(r) for r in specs.collect()] if c and m and mk.lower() == m.lower()]
        if own:
            want[k] = min(own)[2]
    assert {r.k: r.category for r in got.collect()} == want
    many = titles.withColumn("title", F.lit("one x")).crossJoin(spark.range(300).select(F.col("id").alias("n"))).withColumn("k", F.expr("k * 1000 + n"))
    wide = match.category_of_maker(many, "k", "title", "maker", specs, "maker", "model", "variant", "category", "ord")
    assert "Aggregate" not in wide._jdf.queryExecution().optimizedPlan().toString()  # titles are not aggregated over pairs
    assert wide.count() == 7 * 300
