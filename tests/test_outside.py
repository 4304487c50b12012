"""The log of runs, providers, the blob store, the registry of sources and checks before a run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerolith.functions.classify import category_name, normal_category
from aerolith.functions.keys import logo_slug
from aerolith.operators import blobs, match, providers, runlog, upsert
from aerolith.rules import tables as T
from aerolith.sources import ics, landing


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def test_the_log_of_a_run(spark):
    begin, end = at("2026-01-01 10:00:00"), at("2026-01-01 10:01:05")
    log = runlog.started(spark, "r1", ["a.org", "b.org", "c.org"], "events", begin)
    outcomes = spark.createDataFrame([("a.org", "inserted", None), ("a.org", "skipped", "missing_title"), ("a.org", "skipped", "missing_title")], "external_source string, outcome string, reason string")
    expected = spark.createDataFrame([("a.org",), ("b.org",)], "source_name string")
    drops = spark.createDataFrame([("a.org", "no-date", 4), ("a.org", "no-title", 7)], "source_name string, drop_reason string, n long")
    calls = spark.createDataFrame([("a.org", 10, 100), ("a.org", 5, 50)], "s string, tokens_in int, proxied int")
    usage = runlog.usage(calls, "s", input_tokens=F.col("tokens_in"), bytes=F.col("proxied"))
    done = runlog.completed(outcomes, "r1", "events", begin, end, expected=expected, drops=drops, usage=usage)
    lost = runlog.failed(spark, "r1", "c.org", "events", "no answer", begin, end)
    whole = log.unionByName(done).unionByName(lost)
    state = {r.source_name: r for r in runlog.latest(whole).collect()}
    assert {k: r.status for k, r in state.items()} == {"a.org": "completed", "b.org": "completed", "c.org": "failed"}
    a = state["a.org"]
    assert (a.found, a.inserted, a.skipped, a.duration, a.usage) == (3, 1, 2, "1m 5s", {"input_tokens": 15, "bytes": 150})
    assert a.warnings == ["validation drops: 2 (missing_title: 2)", "parser drops: no-title: 7, no-date: 4"] and state["b.org"].warnings == ["nothing found"]
    assert a.started_at == dt.datetime(2026, 1, 1, 10)
    text, code = runlog.summary(whole)
    assert code == 1 and "[EVENTS] c.org: failed" in text and "no answer" in text
    assert runlog.summary(done)[1] == 0
    assert {r.status for r in runlog.latest(log).collect()} == {"running"}


def test_calls_are_spaced_and_tried_again():
    now, slept, asked = [0.0], [], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    def call(q):
        asked.append((q, now[0]))
        if q == "busy" or q == "once" and len([x for x, _ in asked if x == "once"]) < 2:
            raise providers.Busy
        return q.upper()

    ask = providers.polite(call, 1.0, 3, lambda: now[0], sleep)
    assert [ask("a"), ask("b"), ask("once"), ask("busy")] == ["A", "B", "ONCE", providers.FAILED]
    times = [t for _, t in asked]
    assert all(b - a >= 1.0 for a, b in zip(times, times[1:])) and len(asked) == 2 + 2 + 3


def test_providers_are_asked_once_for_each_question(spark, tmp_path):
    log = f"{tmp_path}/calls"

    def call(q):
        with open(log, "a") as f:
            f.write(q + "\n")
        return None if q == "bad" else q + "!"

    df = spark.createDataFrame([("a",), ("a",), ("bad",), (None,), ("b",)], "q string")
    out = providers.asked(df, F.col("q"), providers.one_by_one(call, gap=0.0), "string", "x")
    assert sorted(((r.q, r.x) for r in out.collect()), key=str) == sorted([("a", "a!"), ("a", "a!"), ("bad", None), (None, None), ("b", "b!")], key=str)
    assert sorted(open(log).read().split()) == ["a", "b", "bad"]
    assert [r.x for r in providers.asked(df, F.col("q"), None, "string", "x").collect()] == [None] * 5

    texts = spark.createDataFrame([("T", "Ein Text, der lang genug ist, um ihn zu lesen."), ("T", "kurz"), (None, None)], "h string, d string")
    none = providers.translated(texts, "h", "d", None)
    assert none.schema["translations"].dataType.simpleString() == "map<string,struct<headline:string,description:string>>"
    english = lambda q: q.select("key", F.create_map(F.lit("en"), F.struct(F.concat("headline", F.lit(" en")).alias("headline"), F.col("description"))).alias("answer"))
    assert sorted(str(r.translations and r.translations["en"].headline) for r in providers.translated(texts, "h", "d", english).collect()) == ["None", "T en", "T en"]
    seen = providers.extracted(texts, F.col("d"), lambda q: q.select("key", F.length("text").alias("answer")), "int")
    assert sorted(str(r.extracted) for r in seen.collect()) == ["46", "None", "None"]


def test_payloads_are_stored_once(spark, tmp_path):
    jpeg, png = bytes.fromhex("FFD8FF") + b"\0" * 20, bytes.fromhex("89504E47") + b"\0" * 20
    df = spark.createDataFrame([(1, bytearray(jpeg)), (2, bytearray(jpeg)), (3, bytearray(png)), (4, bytearray(b"what is this?")), (5, None)], "k int, data binary")
    for _ in range(2):
        named = {r.k: r.blob_name for r in blobs.store(df, "data", f"{tmp_path}/blobs").collect()}
    assert named[1] == named[2] != named[3] and named[1].endswith(".jpeg") and named[4] is named[5] is None
    kept = blobs.stored(spark, f"{tmp_path}/blobs").collect()
    assert sorted(r.name for r in kept) == sorted({named[1], named[3]}) and {bytes(r.data) for r in kept} == {jpeg, png}


def test_sources_and_disabled_pages(spark):
    sources = landing.source_table(spark).collect()
    assert len({r.source for r in sources}) == 14 and {r.kind for r in sources} == {"aircraft", "parts", "events"}
    assert {r.source: r.priority for r in sources}["aircraft24.de"] == T.DEFAULT_PRIORITY
    pages = landing.page_table(spark, ["https://www.aero-expo.de/"])
    landed = spark.createDataFrame([("aero-expo.com", "https://www.aero-expo.de/", "x"), ("aero-expo.com", "https://www.aero-expo.com/", "x"), ("dulv.de", "https://www.dulv.de/Veranstaltungen?page=1", "x")], "source string, page_url string, payload string")
    assert {r.page_url for r in landing.enabled(landed, pages).collect()} == {"https://www.aero-expo.com/", "https://www.dulv.de/Veranstaltungen?page=1"}
    pages = spark.createDataFrame([("Club", "https://c/", "<a href='k.ics'>x</a>"), ("Ohne", "https://o/", "")], "name string, url string, html string")
    assert sorted((r.name, r.n_feeds, r.json) for r in ics.discovery(pages).collect()) == [("Club", 1, '{"name":"Club","url":"https://c/","feeds":["https://c/k.ics"]}'), ("Ohne", 0, '{"name":"Ohne","url":"https://o/","feeds":[]}')]


def test_checks_and_lookups_that_fail(spark, tmp_path):
    from pyspark.errors import PySparkException

    users = spark.createDataFrame([("a@x", 1), ("b@x", 2)], "email string, id int")
    assert match.single(users.where("email = 'a@x'"), "id", "no user") == 1
    assert match.single(users.where("false"), "id", "no user", override=7) == 7
    for rows in (users, users.where("false")):
        with pytest.raises(LookupError):
            match.single(rows, "id", "no user")
    df = spark.createDataFrame([("A@X",), ("c@x",)], "m string")
    assert {r.m: r.id for r in match.lookup(df, {"m": "email"}, users, "id", "id").collect()} == {"A@X": 1, "c@x": None}
    with pytest.raises(PySparkException, match="unknown user"):
        match.lookup(df, {"m": "email"}, users, "id", "id", required="unknown user").collect()
    assert upsert.reachable(spark, f"{tmp_path}/none", ["id"]).startswith(f"{tmp_path}/none can't be read")
    users.write.parquet(f"{tmp_path}/users")
    assert upsert.reachable(spark, f"{tmp_path}/users", ["id"]) is None and upsert.reachable(spark, f"{tmp_path}/users", ["id", "x"]).endswith("lacks x")
    messages = spark.createDataFrame([("violates CHECK constraint x",), ("duplicate key value",), ("23505",), ("what",), (None,)], "m string")
    assert [r[0] for r in messages.select(upsert.refusal(F.col("m"))).collect()] == ["fatal", "benign", "benign", "unknown", None]
    stored = spark.createDataFrame([([("https://own/a",)],), ([("https://own/a",), ("https://b/",)],), ([],), (None,)], "images array<struct<url:string>>")
    assert [r[0] for r in stored.select(upsert.images_to_refresh(F.col("images"), "own")).collect()] == [False, True, False, False]


def test_names_and_categories(spark):
    with pytest.raises(ValueError):
        T.check_langs(T.LANGS[:-1])
    df = spark.createDataFrame([("Röbin & Co.  KG-", "LSA", "D-1234", "Jet"), ("-A--b-", "Jet", None, "Jet"), (None, "Nichts", None, None)], "n string, c string, r string, s string")
    assert [r[0] for r in df.select(logo_slug(F.col("n"))).collect()] == ["rbin-co-kg", "a-b", None]
    assert [r[0] for r in df.select(normal_category(F.col("c"), ("Jet", "Ultralight / Light Sport Aircraft (LSA)"))).collect()] == ["Ultralight / Light Sport Aircraft (LSA)", "Jet", None]
    none = F.lit(None).cast("string")
    legacy, other = (category_name(F.col("r"), F.col("s"), none, F.lit("Learjet 45"), specs_first=x) for x in (False, True))
    assert [tuple(r) for r in df.select(legacy, other).collect()] == [("Glider", "Jet"), ("Jet", "Jet"), ("Jet", "Jet")]
