"""A run from landed payloads to outcomes, as one plan: parse, validate, key, decide, upsert, count."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions import text as X
from aerolith.functions.classify import category_name, is_clean_model, model_of_title
from aerolith.operators import dedup, match, merge, rows, runlog, upsert, validate
from aerolith.operators.scratch import written
from aerolith.plans.catalog import query
from aerolith.session import table
from aerolith.sources import event_pages
from aerolith.sources import listing_pages as L
from aerolith.sources.landing import enabled


def event_run(landed: DataFrame, target: DataFrame, now: Column, sources: Iterable[str] = tuple(event_pages.PARSERS), calendars: DataFrame | None = None,
              pages: DataFrame | None = None, enrich: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Outcomes of all events of landed payloads: external_source, source_url, title, start, outcome, reason. target has
    source_url, is_external, claimed_at and digest; with external_source and canonical_key, rows are known by source and
    URL, and events that another source has stored are met by their key: those of lower or equal priority are refused,
    and stored rows that a higher one replaces are listed with outcome deleted. calendars has the settings of feeds,
    pages which pages are enabled. enrich may change parsed events before they are validated (titles from pages of their
    own, say). Pages are parsed once; what they yield is written."""
    landed = landed if pages is None else enabled(landed, pages)
    found = event_pages.events(landed, now, sources, calendars)
    parsed = written((enrich(found) if enrich else found).withColumn("invalid", validate.event_reason(now)), "parsed-events")
    made = rows.event_rows(parsed.where("invalid IS NULL")).withColumn("arrival", F.unix_micros(F.col("start").cast("timestamp")))
    decided = dedup.priority_winners(made, "canonical_key", "external_source", "arrival", "decision")
    columns = ["external_source", "source_url", "title", "start"]
    lost = decided.where("decision <> 'kept'")
    kept = decided.where("decision = 'kept'")
    url, more = "source_url", []
    if {"external_source", "canonical_key"} <= set(target.columns):
        kept, going = dedup.against_stored(written(kept.drop("decision"), "kept-events"), target, "canonical_key", "external_source")
        kept, going = written(kept, "met-events"), written(going, "going-events")
        lost = lost.unionByName(kept.where("decision = 'lower_priority_duplicate'"))
        kept = kept.where("decision <> 'lower_priority_duplicate'")
        none = {"title": "string", "start": "timestamp_ntz"}
        told = [F.col(c) if c in target.columns else F.lit(None).cast(none[c]).alias(c) for c in columns]
        more = [going.select(*told, F.lit("deleted").alias("outcome"), F.lit("superseded").alias("reason"))]
        uid = F.struct("external_source", "source_url")
        target = target.withColumn("__uid", uid).join(going.select(uid.alias("__uid")), "__uid", "left_anti")
        url, kept = "__uid", kept.withColumn("__uid", uid)
    out = upsert.outcomes(kept.drop("decision"), target, url, "digest", [F.col("start"), F.col("title")]).select(*columns, "outcome", "reason")
    bad = parsed.where("invalid IS NOT NULL").select(F.col("source_name").alias("external_source"), "source_url", "title", "start", F.lit("skipped").alias("outcome"), F.col("invalid").alias("reason"))
    for also in (lost.select(*columns, F.lit("skipped").alias("outcome"), F.col("decision").alias("reason")), bad, *more):
        out = out.unionByName(also)
    return out


#: What of a listing (schemas.LISTING) the outcome of a run comes from.
DECISIVE = ("source_id", "source_url", "source_name", "title", "description", "year", "engine", "registration", "image_urls")


def listing_run(listings: DataFrame, makers: DataFrame, specs: DataFrame, categories: DataFrame, target: DataFrame, contact_email: str, specs_first: bool = False) -> DataFrame:
    """Outcomes of listings (schemas.LISTING): matched with makers (id, name) and specs (maker, model, variant, category,
    ord), gated, mapped to target rows and held against the target. specs_first lets an entry's category go before that
    of the registration. Listings are computed once and written, and so are they with their model and category: the matches
    below and both ends of the gate read them again. An outcome shows where a listing stands and what it was matched with,
    so the columns that neither comes from (prices, measures, contacts) are not asked of the parser."""
    df = written(listings.select(*DECISIVE).withColumn("clean_title", X.strip_title_date_prefix(F.col("title"))), "parsed-listings")
    df = match.manufacturer(df, "source_id", "clean_title", specs.select(F.col("maker").alias("name")))
    df = match.lookup(df, {"manufacturer": "name"}, makers, "id", "manufacturer_id")
    best = match.best_spec(df.withColumn("__text", F.concat_ws(" ", "clean_title", "description", "engine")), "source_id", "__text", specs, "maker", "model", "variant", "ord")
    known = best.select(F.col("source_id").alias("__s"), F.concat_ws(" ", "model", F.when(F.col("variant") != "", F.col("variant"))).alias("__m"), F.col("category").alias("__c"))
    df = df.join(known, F.col("source_id") == F.col("__s"), "left").withColumn("model", model_of_title(F.col("clean_title"), F.col("manufacturer"), F.col("__m")))
    # a model that still looks like a headline gives way to the longest known one in it
    scanned = match.headline_models(df, "source_id", "clean_title", "manufacturer", specs, "maker", "model", "variant", "ord")
    df = df.join(scanned.select(F.col("source_id").alias("__h"), F.col("model").alias("__f")), F.col("source_id") == F.col("__h"), "left")
    raw = F.col("__m").isNull() & ((F.length("model") > 40) | (F.size(F.split("model", r"\s+")) > 4) | ~is_clean_model(F.col("model")))
    df = df.withColumn("model", F.when(raw & (F.length("__f") <= 80), F.col("__f")).otherwise(F.col("model")))
    category = category_name(F.col("registration"), F.col("__c"), F.col("source_url"), F.col("clean_title"), specs_first)
    df = match.lookup(df.withColumn("category", category), {"category": "name"}, categories, "id", "category_id")
    df = written(df.drop("__s", "__m", "__c", "__h", "__f").withColumn("gate", validate.listing_reason()), "gated-listings")
    df = df.withColumn("description", merge.description_ladder(F.lit(None).cast("string"), F.col("description"), F.col("clean_title"), F.col("year")))
    told = ("source_name", "model", "manufacturer_id", "category_id")
    made = upsert.outcomes(rows.listing_rows(df.where("gate IS NULL"), contact_email, only=("source_url", "headline", *told)), target, "source_url")
    shut = df.where("gate IS NOT NULL").select(F.col("source_id").alias("source_url"), F.col("clean_title").alias("headline"), *told, F.lit("skipped").alias("outcome"), F.col("gate").alias("reason"))
    return made.select("source_url", "headline", *told, "outcome", "reason").unionByName(shut)


def part_run(parts: DataFrame, target: DataFrame, contact_email: str, host: str) -> DataFrame:
    """Outcomes of parts (schemas.PART): source_url, headline, description, outcome, reason, image_urls. target has
    source_url, is_external, claimed_at and images (url). A new part needs ten characters of description: its own, else
    its title, else its title and what it is; image_urls are those to be stored: all of a new part, and of a known one
    only if it has images that are not on the host yet."""
    made = rows.part_rows(parts, contact_email).join(parts.select(F.col("source_id").alias("__s"), "image_urls").dropDuplicates(["__s"]), F.col("source_url") == F.col("__s"), "left").drop("__s")
    found = upsert.outcomes(made, target, "source_url")
    stored = target.select(F.col("source_url").alias("__u"), F.col("images").alias("__images"))
    found = found.join(stored, F.col("source_url") == F.col("__u"), "left")
    new, told = F.col("outcome") == "inserted", X.new_part_description(F.col("description"), F.col("headline"))
    found = found.withColumn("description", F.when(new, told).otherwise(F.col("description")))
    bare = new & F.col("description").isNull()
    asked = F.when(F.col("outcome") == "updated", upsert.images_to_refresh(F.col("__images"), host)).otherwise(new & ~bare)
    found = found.withColumns({"image_urls": F.when(asked & (F.size("image_urls") > 0), F.col("image_urls")), "reason": F.when(bare, "no_description").otherwise(F.col("reason")), "outcome": F.when(bare, "skipped").otherwise(F.col("outcome"))})
    return found.select("source_url", "headline", "description", "category_id", "manufacturer", "price", "price_on_request", "outcome", "reason", "image_urls")


def listing_rows_of(source: str, landed: DataFrame) -> DataFrame:
    """Listings (schemas.LISTING) of a source's landed pages."""
    return L.LISTING_PARSERS[source](landed.where((F.col("source") == source) & F.col("payload").isNotNull()).select("page_url", "payload"))


def run_log(found: DataFrame, run_id: str, started: Column, ended: Column, source: str = "external_source", **options) -> DataFrame:
    """A row for each source of a run of events."""
    return runlog.completed(found, run_id, "events", started, ended, source, **options)


@query("""SELECT 'P' || p_partkey AS source_url, p_name AS headline, coalesce(CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END, 0) AS price, CASE WHEN p_partkey % 4 <> 0 THEN p_partkey % 2 = 0 ELSE TRUE END AS price_negotiable,
CASE p_partkey % 3 WHEN 0 THEN 'Germany' WHEN 1 THEN 'Austria' ELSE 'Germany' END AS country, CASE WHEN p_size % 5 <> 0 THEN p_size::VARCHAR END AS cruise_speed, 'none@example.org' AS contact_email FROM part""")
def listing_row_mapping(spark, folder):
    from aerolith import schemas
    from aerolith.sources.listing_pages import _typed

    k = F.col("p_partkey")
    p = table(spark, folder, "part").select(
        F.concat(F.lit("P"), k.cast("string")).alias("source_id"), F.lit("src").alias("source_name"), F.concat(F.lit("01.02.2024 "), F.col("p_name")).alias("title"), F.when(k % 4 != 0, F.col("p_retailprice")).alias("price"), (k % 2 == 0).alias("price_negotiable"),
        F.when(k % 3 == 0, "Deutschland").alias("country"), F.when(k % 3 == 1, "OE-ABC").alias("registration"), F.when(F.col("p_size") % 5 != 0, F.col("p_size")).otherwise(0).alias("cruise_speed"))
    full = _typed(p, schemas.LISTING).withColumns({"model": F.lit("m"), "manufacturer_id": F.lit(1), "category_id": F.lit(1)})
    return rows.listing_rows(full, "none@example.org").select("source_url", "headline", "price", "price_negotiable", "country", "cruise_speed", "contact_email")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE 'own' END AS city, CASE WHEN p_size % 3 = 0 THEN 'a shorter description here' ELSE repeat('long text ', 10) END AS description, concat_ws(',', CASE WHEN p_size % 2 = 0 THEN 'city' END, CASE WHEN p_size % 3 = 0 THEN 'description' END) AS changed FROM part")
def backfill_update(spark, folder):
    """Only what is missing is filled; a description only by a shorter one of twenty characters."""
    p = table(spark, folder, "part").select("p_partkey", F.when(F.col("p_size") % 2 != 0, "own").alias("city"), F.repeat(F.lit("long text "), F.lit(10)).alias("description"), "p_brand", "p_size")
    filled = merge.backfill(p, {"city": F.col("p_brand")}, F.when(F.col("p_size") % 3 == 0, "a shorter description here").otherwise("too short"))
    return filled.select("p_partkey", "city", "description", F.array_join("changed", ",").alias("changed"))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority ILIKE '%urgent%' ORDER BY o_orderdate DESC, o_orderkey LIMIT 50")
def backfill_scan(spark, folder):
    """A work list: the 50 newest rows that a backfill would look at."""
    o = table(spark, folder, "orders").where((F.col("o_orderstatus") == "O") & F.col("o_orderpriority").ilike("%urgent%"))
    return o.select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(50)


@query("SELECT count(*) FILTER (email IS NULL) AS without_email, count(*) FILTER (email IS NULL OR phone IS NULL) AS skeletons, count(*) AS n FROM (SELECT nullif(regexp_extract(text, '[\\w.+-]+@[\\w-]+'), '') AS email, nullif(regexp_extract(text, '\\d{5,}'), '') AS phone FROM documents)")
def null_scans(spark, folder):
    from aerolith.functions.core import given

    d = table(spark, folder, "documents").select(given(F.regexp_extract("text", r"[\w.+-]+@[\w-]+", 0)).alias("email"), given(F.regexp_extract("text", r"\d{5,}", 0)).alias("phone"))
    return d.agg(F.count_if(F.col("email").isNull()).alias("without_email"), F.count_if(F.col("email").isNull() | F.col("phone").isNull()).alias("skeletons"), F.count("*").alias("n"))


def _some_parts(spark, folder) -> DataFrame:
    """Parts for sale made from the part table."""
    from aerolith import schemas
    from aerolith.sources.listing_pages import _typed

    k = F.col("p_partkey")
    p = table(spark, folder, "part")
    told = F.when(k % 5 == 0, "kurz").when(k % 5 == 1, "<b>ein</b> <i>Teil</i>").when(k % 5 == 2, F.concat(F.lit("<p>Gebraucht, gut erhalten: "), F.col("p_type"), F.lit("</p>")))
    return _typed(p.select(F.concat(F.lit("T"), k.cast("string")).alias("source_id"), F.when(k % 7 == 0, "Rad").when(k % 7 == 1, "Garmin G5").otherwise(F.col("p_name")).alias("title"), told.alias("description"), F.element_at(F.array(*[F.lit(x) for x in ("avionics", "rescue", "engines")]), (k % 3 + 1).cast("int")).alias("category"),
                           F.when(k % 4 != 0, F.col("p_retailprice")).alias("price"), F.when(k % 2 == 0, F.array(F.concat(F.lit("https://x.example/"), k.cast("string")))).otherwise(F.array().cast("array<string>")).alias("image_urls")), schemas.PART)


@query("""WITH p AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 7 = 0 THEN 'Rad' WHEN p_partkey % 7 = 1 THEN 'Garmin G5' ELSE p_name END AS headline, CASE p_partkey % 5 WHEN 0 THEN 'kurz' WHEN 1 THEN 'ein Teil' WHEN 2 THEN 'Gebraucht, gut erhalten: ' || p_type END AS plain,
  CASE p_partkey % 5 WHEN 0 THEN 'kurz' WHEN 1 THEN '<b>ein</b> <i>Teil</i>' WHEN 2 THEN '<p>Gebraucht, gut erhalten: ' || p_type || '</p>' END AS own, p_partkey % 3 = 0 AS known, p_partkey % 9 = 0 AS claimed, p_partkey % 6 = 0 AS outside, p_retailprice FROM part),
d AS (SELECT *, CASE WHEN length(plain) >= 10 THEN plain WHEN length(headline) >= 10 THEN headline ELSE headline || ' — parts listing' END AS told FROM p)
SELECT 'T' || k AS source_url, headline, CASE WHEN known THEN own ELSE told END AS description, (CASE k % 3 WHEN 0 THEN 1 WHEN 1 THEN 5 ELSE 2 END)::INT AS category_id, k % 4 = 0 AS price_on_request, CASE WHEN claimed THEN 'skipped' WHEN known THEN 'updated' ELSE 'inserted' END AS outcome,
CASE WHEN claimed THEN 'claimed' END AS reason, CASE WHEN k % 2 = 0 AND NOT claimed AND (outside OR NOT known) THEN 'https://x.example/' || k END AS images FROM d""")
def parts_for_sale(spark, folder):
    """A run of parts against a target that knows every third: claimed ones stay, images are stored anew only where some
    are elsewhere, new ones get a description."""
    parts = _some_parts(spark, folder)
    k = F.col("p_partkey")
    target = table(spark, folder, "part").where(k % 3 == 0).select(F.concat(F.lit("T"), k.cast("string")).alias("source_url"), F.lit(True).alias("is_external"), F.when(k % 9 == 0, F.lit("2024-01-01").cast("timestamp_ntz")).alias("claimed_at"),
                                                                 F.array(F.struct(F.when(k % 6 == 0, "https://elsewhere.example/a.jpg").otherwise("https://own.example/a.jpg").alias("url"))).alias("images"))
    out = part_run(parts, target, "none@example.org", "own.example")
    return out.select("source_url", "headline", "description", F.col("category_id").cast("int").alias("category_id"), "price_on_request", "outcome", "reason", F.array_join("image_urls", ",").alias("images"))


@query("""WITH r AS (SELECT o_orderkey, CASE WHEN o_custkey % 4 <> 0 THEN 'u' || o_custkey END AS source_url, CASE o_orderkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'paused' ELSE 'expired' END AS status, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_comment END AS description,
  CASE WHEN o_orderkey % 13 <> 0 THEN 'm' || o_custkey % 50 END AS manufacturer, o_orderpriority AS model, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate::VARCHAR END AS variant FROM (SELECT *, substr(repeat('x', (o_orderkey % 30)::INT) || ' ', 1, 12) AS o_comment FROM orders)),
l AS (SELECT *, source_url IS NOT NULL AND status <> 'expired' AS live FROM r), s AS (SELECT *, live AND (row_number() OVER (PARTITION BY source_url, live ORDER BY o_orderkey) > 1 OR source_url IN (SELECT 'u' || c_custkey FROM customer WHERE c_custkey % 10 = 7)) AS twice,
  manufacturer IS NOT NULL AND variant IS NOT NULL AND row_number() OVER (PARTITION BY manufacturer, model, variant ORDER BY o_orderkey) > 1 AS again FROM l)
SELECT o_orderkey, concat_ws(',', CASE WHEN twice THEN 'parts_listings_source_url_unique' END, CASE WHEN length(trim(description)) < 10 THEN 'description_check' END) AS listing, concat_ws(',', CASE WHEN manufacturer IS NULL THEN 'manufacturer_not_null' END, CASE WHEN again THEN 'aircraft_reference_specs_manufacturer_model_variant_key' END) AS spec,
CASE WHEN twice THEN 'benign' WHEN length(trim(description)) < 10 THEN 'fatal' END AS refusal FROM s""")
def constraint_violations(spark, folder):
    """Rows that would break a required column, a check, a key or a key of live rows alone, among themselves and against
    stored rows, by the names of the constraints, and what a store's refusal would mean."""
    from aerolith.operators.constraints import CONSTRAINTS, refused, violations

    i = F.col("o_orderkey")
    text = F.substring(F.concat(F.repeat(F.lit("x"), (i % 30).cast("int")), F.lit(" ")), 1, 12)
    rows_ = table(spark, folder, "orders").select(
        i, F.when(F.col("o_custkey") % 4 != 0, F.concat(F.lit("u"), F.col("o_custkey").cast("string"))).alias("source_url"), F.when(i % 3 == 0, "active").when(i % 3 == 1, "paused").otherwise("expired").alias("status"), F.when(i % 11 != 0, text).alias("description"),
        F.when(i % 13 != 0, F.concat(F.lit("m"), (F.col("o_custkey") % 50).cast("string"))).alias("manufacturer"), F.col("o_orderpriority").alias("model"), F.when(i % 2 == 0, F.col("o_orderdate").cast("string")).alias("variant"))
    stored = table(spark, folder, "customer").where("c_custkey % 10 = 7").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("source_url"), F.lit("active").alias("status"))
    listed = violations(rows_, CONSTRAINTS["parts_listings"], [i], stored, "listing")
    both = violations(listed, CONSTRAINTS["aircraft_reference_specs"], [i], column="spec")
    return both.select("o_orderkey", F.array_join("listing", ",").alias("listing"), F.array_join("spec", ",").alias("spec"), upsert.refusal(refused(F.col("listing"), CONSTRAINTS["parts_listings"])).alias("refusal"))


@query("""SELECT c_custkey, CASE WHEN k % 5 <> 0 THEN k || '!' END AS answer, CASE WHEN c_custkey % 2 = 0 AND k % 7 <> 0 THEN 1 ELSE 2 END AS told_in FROM (SELECT *, c_custkey // 2 AS k FROM customer)""")
def answers_across_runs(spark, folder):
    """Two runs with questions in common, and a third that asks nothing: what the second one asks is what the first one
    did not, and those whose call had failed. Answers that say nothing are kept as well."""
    from aerolith.operators import providers
    from aerolith.operators.answers import remembered
    from aerolith.operators.scratch import scratch_path

    below = scratch_path(spark, "answers")
    c = table(spark, folder, "customer").select("c_custkey", F.concat(F.lit("q"), F.floor(F.col("c_custkey") / 2).cast("string"), F.when(F.col("c_custkey") % 2 == 0, "a").otherwise("b")).alias("q"))
    n = F.regexp_extract("key", r"(\d+)", 1).cast("long")

    def provider(run: int):
        def ask(questions):
            told = F.when(n % 5 != 0, F.concat_ws("!", n.cast("string"), F.lit("")))
            return questions.where((F.lit(run) > 1) | (n % 7 != 0)).select("key", F.to_json(F.struct(told.alias("answer"), F.lit(run).alias("run"))).alias("answer"))

        return ask

    def run(rows_, number: int):
        ask = remembered(provider(number), below, F.lit("2026-01-01").cast("timestamp_ntz"), parts=8)
        return written(providers.asked(rows_, F.col("q"), ask, "string", "told"), "told")

    run(c.where("c_custkey % 2 = 0"), 1)
    run(c, 2)
    last = run(c, 3)
    return last.select("c_custkey", F.get_json_object("told", "$.answer").alias("answer"), F.get_json_object("told", "$.run").cast("int").alias("told_in"))
