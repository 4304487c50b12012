"""Filling, merging and projecting rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.core import missing
from aerolith.functions.text import sanitize, slug
from aerolith.rules import tables as T

#: Columns with units that reference specifications fill: column of the row -> column of the specification.
SPEC_COLUMNS = {
    "cruise_speed": "cruise_speed", "max_speed": "max_speed", "max_range": "max_range", "service_ceiling": "service_ceiling",
    "performance_climb_rate": "climb_rate", "performance_takeoff_distance": "takeoff_distance", "performance_landing_distance": "landing_distance",
    "performance_fuel_consumption": "fuel_consumption", "empty_weight": "empty_weight", "max_takeoff_weight": "max_takeoff_weight", "max_payload": "max_payload",
    "fuel_capacity": "fuel_capacity",
}
SPEC_PLAIN = {"engine_type_name": "engine_type", "engine_power": "engine_power", "engine_power_unit": "engine_power_unit", "fuel_type": "fuel_type", "seats": "seats"}


def fill_missing(own: Column, other: Column) -> Column:
    """own, or other where own is null or empty and other is neither."""
    return F.when(missing(own) & ~missing(other), other).otherwise(own)


def fill_falsy(own: Column, other: Column, numeric: bool = False) -> Column:
    """own, or other where own is null, empty (or 0 for numbers) and other is not."""
    empty = lambda c: missing(c) | (F.coalesce(c == 0, F.lit(False)) if numeric else F.lit(False))
    return F.when(empty(own) & ~empty(other), other).otherwise(own)


def apply_specs(df: DataFrame, prefix: str = "spec_") -> DataFrame:
    """Fill a row's performance columns from columns of the same row with a prefix. A unit is only filled together with
    its value."""
    out = {}
    for column, spec in SPEC_COLUMNS.items():
        if column in df.columns and prefix + spec in df.columns:
            own, other = F.col(column), F.col(prefix + spec)
            out[column] = fill_falsy(own, other)
            unit, other_unit = f"{column}_unit", f"{prefix}{spec}_unit"
            if unit in df.columns and other_unit in df.columns:
                out[unit] = F.when(missing(own) & ~missing(other), fill_falsy(F.col(unit), F.col(other_unit))).otherwise(F.col(unit))
    for column, spec in SPEC_PLAIN.items():
        if column in df.columns and prefix + spec in df.columns:
            out[column] = fill_falsy(F.col(column), F.col(prefix + spec))
    return df.withColumns(out)


def apply_extracted(df: DataFrame, columns: Mapping[str, Column], features: str | None = None, more_features: Column | None = None, description: Column | None = None) -> DataFrame:
    """Fill missing columns from extracted ones, unite features, and take an extracted description of 20 characters."""
    out = {c: fill_missing(F.col(c), v) for c, v in columns.items() if c in df.columns}
    if features and more_features is not None:
        empty = F.array().cast("array<string>")
        out[features] = F.when(F.size(F.coalesce(more_features, empty)) > 0, F.array_union(F.coalesce(F.col(features), empty), more_features)).otherwise(F.col(features))
    if description is not None:
        out["description"] = F.when(F.length(F.trim(description)) >= 20, description).otherwise(F.col("description"))
    return df.withColumns(out)


def over(detail: Column, card: Column) -> Column:
    return F.coalesce(detail, card)


def event_description(subtitle: Column, dates: Column, venue: Column, organiser: Column) -> Column:
    """What is known of an event, joined by dashes; empty parts are left out."""
    some = lambda c: F.when(c != "", c)
    return F.concat_ws(" – ", some(subtitle), some(dates), some(venue), F.concat(F.lit("Veranstalter: "), some(organiser)))


def german_thousands(c: Column) -> Column:
    """A number with German separators and up to three decimals."""
    text = F.translate(F.format_number(c, 3), ",.", ".,")
    return F.regexp_replace(F.regexp_replace(text, r"(,\d*?)0+$", "$1"), ",$", "")


def listing_description(maker: Column, model: Column, year: Column, price: Column, negotiable: Column, closing: str) -> Column:
    some = lambda c: F.when(c != "", c)
    named = F.when(maker != "", F.trim(F.concat_ws(" ", maker, some(model))))
    built = F.when(year >= 1900, F.concat(F.lit("Baujahr "), year.cast("string")))
    priced = F.when(F.coalesce(price, F.lit(0.0)) != 0, F.concat(F.lit("Preis: "), german_thousands(price), F.lit(" EUR"))).when(negotiable, "Preis Verhandlungssache").otherwise("Preis auf Anfrage")
    return F.concat(F.concat_ws(". ", named, built, priced, F.lit(closing)), F.lit("."))


def description_ladder(extracted: Column, own: Column, title: Column, year: Column) -> Column:
    """The cleaned text, if ten characters or more; else the row's own, if as long; else title and year."""
    from aerolith.functions.text import deduplicate_description

    best = deduplicate_description(F.coalesce(extracted, own, F.lit("")))
    named = F.trim(F.concat(title, F.lit(" — "), F.coalesce(year.cast("string"), F.lit(""))))
    return F.when(F.length(F.trim(best)) >= 10, best).when(F.length(F.trim(own)) >= 10, own).otherwise(named)


def locale_columns(headline: Column, description: Column, translations: Column, name: str = "headline", langs: Sequence[str] = T.LANGS) -> list[Column]:
    """A headline, description and slug for each language; the source's own where there is no translation.
    translations is a map of language to struct of headline and description."""
    out = []
    for lang in langs:
        one = F.try_element_at(translations, F.lit(lang))
        h = F.coalesce(one["headline"], headline)
        out += [h.alias(f"{name}_{lang}"), F.coalesce(one["description"], description).alias(f"description_{lang}"), slug(h).alias(f"slug_{lang}")]
    return out


def event_locale_columns(title: Column, description: Column, translations: Column, source_locale: Column, langs: Sequence[str] = T.LANGS) -> list[Column]:
    """Title, description and slug for each language that has both translated; the source's language is always set."""
    out = []
    for lang in langs:
        one = F.try_element_at(translations, F.lit(lang))
        whole = (F.coalesce(one["headline"], F.lit("")) != "") & (F.coalesce(one["description"], F.lit("")) != "")
        own = source_locale == lang
        some = lambda c: F.when(c != "", sanitize(c))
        out += [
            F.when(whole, sanitize(one["headline"])).when(own, some(title)).alias(f"title_{lang}"),
            F.when(whole, sanitize(one["description"])).when(own, some(description)).alias(f"description_{lang}"),
            F.when(whole, slug(one["headline"])).alias(f"slug_{lang}"),
        ]
    return out


def image_structs(urls: Column, title: Column, translations: Column, langs: Sequence[str] = T.LANGS) -> Column:
    """An array of structs: url, alternative text, order, and an alternative text for each language."""

    def one(url, k):
        label = F.concat(F.lit(" - Image "), (k + 1).cast("string"))
        texts = [F.concat(F.coalesce(F.try_element_at(translations, F.lit(lang))["headline"], title), label).alias(f"alt_text_{lang}") for lang in langs]
        return F.struct(url.alias("url"), title.alias("alt_text"), F.lit(False).alias("auto_translate"), k.alias("sort_order"), *texts)

    return F.transform(urls, one)


def update_columns(df: DataFrame, langs: Sequence[str] = T.LANGS) -> list[str]:
    """The columns that an update of a known row may change: no translations, slugs, images or audit columns."""
    kept_out = re.compile(rf"^((headline|description|slug)_({'|'.join(langs)})|slug|images|was_external|claimed_at|claimed_from_source)$")
    return [c for c in df.columns if not kept_out.match(c)]


def backfill(df: DataFrame, updates: Mapping[str, Column], description: Column | None = None) -> DataFrame:
    """Only columns that are missing are filled; a description is replaced by one of at least 20 characters that is
    shorter than 0.9 of it. `changed` lists the columns that changed."""
    out = {c: fill_missing(F.col(c), v) for c, v in updates.items()}
    if description is not None:
        shorter = (F.length(F.trim(description)) >= 20) & (F.length(description) < 0.9 * F.length("description"))
        out["description"] = F.when(shorter, description).otherwise(F.col("description"))
    changed = F.array_compact(F.array(*[F.when(~v.eqNullSafe(F.col(c)), F.lit(c)) for c, v in out.items()]))
    return df.withColumns(out | {"changed": changed})
