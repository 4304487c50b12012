from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.operators import rows
from aerolith.plans import runs
from aerolith.sources.listing_pages import _typed
from tests_helpers import menu, now


def test_an_event_run_and_its_log(spark):
    node = '<div class="node--event"><div class="field--promo-title"><h3>{0}</h3></div><div class="field--date-range"><time datetime="2026-10-18">x</time></div><div class="card-footer"><a href="/{0}">more</a></div></div>'
    landed = spark.createDataFrame(
        [("nbaa.org", "https://n/", menu("Forum", "Oct. 18, 2026") + menu("Alt", "May 1, 2020") + menu("Known", "May 5, 2026")), ("eurocontrol.int", "https://e/", node.format("Other")), ("eurocontrol.int", "https://e/2", None)],
        "source string, page_url string, payload string",
    )
    target = spark.createDataFrame([("https://nbaa.org/Known", False, None, "x")], "source_url string, is_external boolean, claimed_at timestamp_ntz, digest string")
    found = runs.event_run(landed, target, now(), ["nbaa.org", "eurocontrol.int"])
    assert {r.source_url: (r.outcome, r.reason) for r in found.collect()} == {
        "https://nbaa.org/Forum": ("inserted", None), "https://nbaa.org/Alt": ("skipped", "ended_too_long_ago"), "https://nbaa.org/Known": ("skipped", "claimed"), "https://www.eurocontrol.int/Other": ("inserted", None),
    }
    log = {r.source_name: r for r in runs.run_log(found, "run", now(), now() + F.expr("INTERVAL 61 SECONDS")).collect()}
    assert (log["nbaa.org"].found, log["nbaa.org"].inserted, log["nbaa.org"].skipped, log["nbaa.org"].duration) == (3, 1, 2, "1m 1s")
    assert log["nbaa.org"].warnings == ["validation drops: 2 (claimed: 1, ended_too_long_ago: 1)"] and log["eurocontrol.int"].warnings == []


def test_a_listing_run(spark):
    listings = _typed(spark.createDataFrame([
        ("1", "u", "s", "Cessna 172 Skyhawk", "Sehr gepflegtes Flugzeug", 1980, 1000.0, ["a.jpg"], "D-EABC"), ("2", "u", "s", "Cessna 172", "x", 1980, 1.0, [], None), ("3", "u", "s", "Cessna 172", "x", 0, 1.0, ["a.jpg"], None),
        ("4", "u", "s", "912 ULS", "x", 1980, 1.0, ["a.jpg"], None), ("5", "u", "s", "Cessna 182 Skylane", "Beschreibung fehlt nicht", 1990, None, ["a.jpg"], None),
    ], "source_id string, source_url string, source_name string, title string, description string, year int, price double, image_urls array<string>, registration string"), schemas.LISTING)
    makers = spark.createDataFrame([(7, "CESSNA")], "id int, name string")
    specs = spark.createDataFrame([("Cessna", "172", "Skyhawk", "Single Engine Piston", 1)], "maker string, model string, variant string, category string, ord int")
    categories = spark.createDataFrame([(3, "single engine piston")], "id int, name string")
    target = spark.createDataFrame([("5", True, None)], "source_url string, is_external boolean, claimed_at timestamp_ntz")
    got = {r.source_url: (r.outcome, r.reason) for r in runs.listing_run(listings, makers, specs, categories, target, "none@example.org").collect()}
    assert got == {"1": ("inserted", None), "2": ("skipped", "no_images"), "3": ("skipped", "no_year"), "4": ("skipped", "no_clean_model"), "5": ("updated", None)}


def test_a_listing_run_asks_for_what_decides(spark, monkeypatch):
    """Measures, prices and contacts are not computed for outcomes, a title's model is cut out once for a row."""
    from aerolith.functions.classify import aircraft_category, is_clean_model, model_of_title
    from aerolith.rules import tables as T

    tables, real = {}, runs.written
    monkeypatch.setattr(runs, "written", lambda df, label: tables.setdefault(label, real(df, label)))
    row = "source_id string, source_url string, source_name string, title string, description string, year int, image_urls array<string>, registration string"
    listings = _typed(spark.createDataFrame([("1", "u", "s", "Cessna 172 Skyhawk", "x", 1980, ["a.jpg"], "D-EABC")], row), schemas.LISTING).withColumn("mtow", F.raise_error(F.lit("asked for")).cast("double"))
    specs = spark.createDataFrame([("Cessna", "172", "Skyhawk", "jet", 1)], "maker string, model string, variant string, category string, ord int")
    target = spark.createDataFrame([], "source_url string, is_external boolean, claimed_at timestamp_ntz")
    got = runs.listing_run(listings, spark.createDataFrame([(7, "Cessna")], "id int, name string"), specs, spark.createDataFrame([(3, "jet")], "id int, name string"), target, "none@example.org").first()
    assert (got.headline, got.model, got.manufacturer_id, got.outcome) == ("Cessna 172 Skyhawk", "172 Skyhawk", 7, "inserted")
    assert "mtow" not in tables["parsed-listings"].columns + tables["gated-listings"].columns

    df = spark.createDataFrame([("a", "b")], "title string, maker string")
    plan = lambda c: df.select(c.alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan(model_of_title(F.col("title"), F.col("maker"), F.lit(None).cast("string"))).count(T.MODEL_ENDS) == 1
    assert plan(is_clean_model(F.col("title"))).count("title#") <= 5 and plan(aircraft_category(F.col("title"), F.col("title"))).count("lower(title#") == 1


def test_part_rows(spark):
    parts = _typed(spark.createDataFrame([("1", "Garmin GTX", "avionics", None), ("2", "Propeller alt", "rescue", 5.0)], "source_id string, title string, category string, price double"), schemas.PART)
    got = sorted((r.source_url, r.category_id, r.manufacturer, r.price_on_request) for r in rows.part_rows(parts, "none@example.org").collect())
    assert got == [("1", 1, "Garmin", True), ("2", 5, "Propeller", False)]
