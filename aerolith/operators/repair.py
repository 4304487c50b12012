"""Repairs of whole tables: ordered rules of which the last that fits wins, and city clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.core import chain, first_case, pattern

#: Words that make a city's text junk.
JUNK_WORDS = "verkauf|privatverkauf|biete|angeboten|baujahr|motor|rotax|stunden|flugstunden|einsitzer|doppelsitzer|ultraleicht|cessna|piper|beechcraft|fallen|defekt|unfall|telefon|email|kontakt|hersteller|southwest|northwest|northeast|southeast|flugplatz|flughafen|airport|hangar|lagerung|werkstatt|museum"
COUNTRY_WORDS = "deutschland|germany|frankreich|france|italien|italy|österreich|austria|schweiz|switzerland|niederlande|netherlands|polen|poland|ungarn|hungary|spanien|spain|dänemark|denmark|belgien|belgium|brasilien|brazil"
CITY_ICAO = "ED|ET|LO|LS|LF|LE|LI|EH|EB|EP|LK|ES|EN|EK|LG|LT"


def last_wins(rules: Sequence[tuple[Column, object]], otherwise: Column) -> Column:
    """One CASE for updates that would be made one after the other."""
    return first_case(*reversed(rules), otherwise=otherwise)


def clean_city_column(c: Column) -> Column:
    """Junk to null, then code, place, postal code, code in parentheses and what follows a comma cut off."""
    junk = (
        c.rlike(r"\d") | (F.length(c) > 35) | (F.size(F.split(c, " ")) > 4) | c.rlike("^[a-zäöü]")
        | F.lower(c).rlike(pattern(rf"\b({JUNK_WORDS})\b", "")) | F.lower(c).rlike(pattern(rf"\b({COUNTRY_WORDS})\b", ""))
    )
    x = F.when(~junk, c)
    x = F.when(x.rlike(r"\s+[A-Z]{4}$") & x.rlike(rf"\s+({CITY_ICAO})"), F.regexp_replace(x, r"\s+[A-Z]{4}$", "")).otherwise(x)
    x = chain(x, (r"(?i)^(Flugplatz|Flughafen|Airport|Airfield)\s+", ""), (r"^\d{4,5}\s+", ""))
    x = F.regexp_replace(x, r"^(.*?)\s*\([A-Z]{4}\)", "$1")
    x = F.trim(F.element_at(F.split(x, ","), 1))
    return F.when(x != "", x)


def recategorised(rows: DataFrame, key: str, maker: str, category: str, modal: DataFrame, only: Sequence[str]) -> DataFrame:
    """rows whose category, if it is one of `only`, becomes the modal one of the maker."""
    side = modal.select(F.lower(maker).alias("__m"), F.col(category).alias("__c"))
    joined = rows.join(side, F.lower(F.col(maker)) == F.col("__m"), "left")
    return joined.withColumn(category, F.when(F.col("__c").isNotNull() & F.col(category).isin(*only), F.col("__c")).otherwise(F.col(category))).drop("__m", "__c")
