"""Rows of the target tables from parsed rows: defaults, truthiness rules and names of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions import classify as C
from aerolith.functions import keys as K
from aerolith.functions import text as X
from aerolith.functions.core import given, looked_up
from aerolith.operators.merge import event_description
from aerolith.rules import tables as T


def _text_if_set(c: Column) -> Column:
    """A number as text; 0 counts as missing."""
    return F.when(F.coalesce(c, F.lit(0.0)) != 0, F.regexp_replace(c.cast("string"), r"\.0$", ""))


def listing_rows(df: DataFrame, contact_email: str, country: str = "Germany", currency: str = "EUR", seats: str = "2", only: Sequence[str] = ()) -> DataFrame:
    """Listings (schemas.LISTING, with model, manufacturer_id and category_id) as rows of the target: a missing price is
    0 and negotiable; weights and speeds are text; empty strings stand for missing names. `only` names the columns that
    are asked for, if not all are: df then needs but what these come from."""
    title = X.strip_title_date_prefix(F.col("title"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    numbers = ("empty_weight", "max_takeoff_weight", "fuel_capacity", "cruise_speed", "max_speed", "max_range", "service_ceiling")
    every = {
        "source_url": F.col("source_id"), "headline": title, "model": F.col("model"), "description": F.col("description"), "year": F.col("year"), "price": F.coalesce("price", F.lit(0.0)), "currency": F.lit(currency),
        "price_negotiable": F.when(F.coalesce("price", F.lit(0.0)) != 0, F.col("price_negotiable")).otherwise(True), "total_time": F.col("total_time"), "engine_hours": F.col("engine_hours"), "engine_type_name": F.col("engine"), "location": text("location"),
        "country": F.coalesce(X.clean_country(F.col("country")), C.registration_country(F.col("registration")), F.lit(country)), "city": X.clean_city(F.col("city")), "icaocode": X.clean_icao(F.col("icao")),
        "registration": text("registration"), "serial_number": text("serial_number"), "manufacturer_id": F.col("manufacturer_id"), "category_id": F.col("category_id"), "status": F.lit("active"), "source_name": F.col("source_name"), "is_external": F.lit(True), "was_external": F.lit(True),
        "contact_name": F.coalesce("contact_name", "source_name"), "contact_email": F.coalesce("contact_email", F.lit(contact_email)), "contact_phone": text("contact_phone"), "seats": F.lit(seats), "fuel_type": F.col("fuel_type"),
        **{c: _text_if_set(F.col(c)) for c in numbers}, "avionics_other": F.col("avionics"),
    }
    return df.select(*[every[name].alias(name) for name in only or every])


def part_rows(df: DataFrame, contact_email: str, currency: str = "EUR") -> DataFrame:
    """Parts (schemas.PART) as rows of the target: without a price they are on request."""
    return df.select(
        F.col("source_id").alias("source_url"), X.strip_title_date_prefix(F.col("title")).alias("headline"), "description", looked_up(F.col("category"), T.PARTS_CATEGORY_IDS).alias("category_id"), C.part_brand(F.col("title")).alias("manufacturer"),
        "price", F.lit(currency).alias("currency"), F.col("price").isNull().alias("price_on_request"), "price_negotiable", "vat_included", "condition", "total_time", F.coalesce("location", F.lit("")).alias("location"), F.lit("active").alias("status"),
        "source_name", F.lit(True).alias("is_external"), F.coalesce("contact_name", "source_name").alias("contact_name"), F.coalesce("contact_email", F.lit(contact_email)).alias("contact_email"), F.coalesce("contact_phone", F.lit("")).alias("contact_phone"),
    )


def event_rows(df: DataFrame) -> DataFrame:
    """Events (schemas.EVENT) as rows of the target: with keys, slug, digest, and a description made up of what is known
    where there is none of ten characters."""
    from aerolith.functions.dates import iso

    made = event_description(F.col("subtitle"), F.col("date_range_text"), F.col("venue"), F.col("organiser"))
    described = F.when(F.length(F.trim(F.coalesce("description", F.lit("")))) >= 10, F.col("description")).otherwise(made)
    df = df.withColumn("description", described)
    return df.select(
        F.col("source_name").alias("external_source"), "source_url", F.col("category").alias("category_code"), "title", "description", X.slug(F.col("title")).alias("slug_base"), K.unique_slug(F.col("title")).alias("slug"), "start", "end", "timezone",
        F.coalesce(K.country_iso(F.col("country")), F.col("country")).alias("country"), "city", F.col("venue").alias("venue_name"), "icao", F.col("organiser").alias("organizer_name"), "event_url", "latitude", "longitude",
        K.canonical_key(F.col("title"), iso(F.col("start")), F.col("icao"), F.col("city"), F.col("venue")).alias("canonical_key"), K.content_hash(F.col("title"), F.col("description")).alias("digest"),
        K.geocode_key(F.col("venue"), F.col("city"), F.col("icao"), F.col("country")).alias("geocode_key"), F.coalesce(given(F.col("source_locale")), F.lit("de")).alias("source_locale"),
    )
