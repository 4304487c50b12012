"""Identity keys and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.functions.core import chain, given, looked_up, trimmed
from aerolith.functions.text import slug_for_key, strip_diacritics
from aerolith.rules import tables as T


def short_sha1(c: Column, n: int = 16) -> Column:
    return F.substring(F.sha1(c), 1, n)


def positional_id(page_url: Column, index: Column, posted: Column) -> Column:
    base = F.concat(page_url, F.lit("#"), index.cast("string"))
    return F.when(given(posted).isNotNull(), F.concat(base, F.lit("@"), posted)).otherwise(base)


def content_id(page_url: Column, *parts: Column) -> Column:
    """page#, and 16 hexadecimal digits of the parts' digest."""
    return F.concat(page_url, F.lit("#"), short_sha1(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])))


def canonical_key(title: Column, start_iso: Column, icao: Column, city: Column, venue: Column) -> Column:
    """The key of an event, whatever its source: day, place and the title's first 40 slug characters. Null without a
    title, a day or a place. An empty city does not give way to the venue."""
    name = F.substring(slug_for_key(F.coalesce(title, F.lit(""))), 1, 40)
    day = F.replace(F.substring(F.coalesce(start_iso, F.lit("")), 1, 10), F.lit("-"), F.lit(""))
    place = F.coalesce(given(trimmed(icao)), slug_for_key(F.coalesce(city, venue, F.lit(""))))
    return F.when((name != "") & day.rlike(r"^\d{8}$") & (place != ""), F.sha1(F.concat_ws("|", day, place, name)))


def content_hash(title: Column, description: Column) -> Column:
    return F.sha1(F.concat(title, F.lit(" "), description))


def unique_slug(title: Column) -> Column:
    base = F.regexp_replace(F.regexp_replace(strip_diacritics(F.lower(title)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.concat(F.coalesce(given(F.substring(base, 1, 60)), F.lit("event")), F.lit("-"), short_sha1(title, 8))


def logo_slug(name: Column) -> Column:
    """A file's name from a maker's: ASCII letters, digits and single hyphens."""
    return chain(F.lower(name), (r"[^a-z0-9\s-]", ""), (r"\s+", "-"), ("-+", "-"), ("^-+|-+$", ""))


def image_name(data: Column, extension: Column) -> Column:
    return F.concat(F.substring(F.sha2(data, 256), 1, 24), F.lit("."), extension)


def country_iso(c: Column) -> Column:
    name = trimmed(c)
    return F.when(name.rlike("(?i)^[a-z]{2}$"), F.upper(name)).otherwise(looked_up(F.lower(name), T.COUNTRY_ISO))


def geocode_key(venue: Column, city: Column, icao: Column, country: Column) -> Column:
    text = lambda c: trimmed(F.coalesce(c, F.lit("")))
    return F.concat_ws("|", F.lower(text(venue)), F.lower(text(city)), F.upper(text(icao)), F.upper(text(F.coalesce(country_iso(country), country))))
