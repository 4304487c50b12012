"""Validation: the first rule that a row breaks, as a column. Nothing is dropped here; sinks filter, metrics count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.core import first_case, trimmed
from aerolith.rules import tables as T

DAY = "INTERVAL 1 DAY"


def _empty(c: Column) -> Column:
    return F.coalesce(trimmed(c) == "", F.lit(True))


def event_reason(now: Column, title="title", source_url="source_url", category="category", country="country", start="start", end="end", icao="icao", latitude="latitude", longitude="longitude") -> Column:
    """Why an event is not valid, null if it is. start, end and now are timestamps without a zone, in UTC."""
    s, e, c = F.col(start), F.col(end), F.col
    later = F.make_ym_interval(F.lit(T.FUTURE_TOLERANCE_YEARS), F.lit(0))
    rules = (
        _empty(c(title)), F.length(trimmed(c(title))) < T.MIN_TITLE_LENGTH, _empty(c(source_url)), _empty(c(category)), _empty(c(country)), s.isNull(), e.isNull(),
        e < s, e > s + F.expr(f"INTERVAL {T.MAX_DURATION_DAYS} DAYS"), e < now - F.expr(f"INTERVAL {T.PAST_TOLERANCE_DAYS} DAYS"), s > now + later,
        c(icao).isNotNull() & ~trimmed(c(icao)).rlike("^[A-Z]{4}$"), ~c(latitude).between(-90, 90) | ~c(longitude).between(-180, 180),
    )
    return first_case(*[(F.coalesce(rule, F.lit(False)), reason) for rule, reason in zip(rules, T.VALIDATION_REASONS, strict=True)])


def listing_reason(images: str = "image_urls", year: str = "year", model: str = "model") -> Column:
    """Why a listing is not taken: without images, without a year, without a clean model."""
    from aerolith.functions.classify import is_clean_model

    return first_case(
        (F.coalesce(F.size(F.col(images)), F.lit(0)) <= 0, "no_images"),
        (F.coalesce(F.col(year), F.lit(0)) == 0, "no_year"),
        (~is_clean_model(F.coalesce(F.col(model), F.lit(""))), "no_clean_model"),
    )


def is_claimed(external: str = "is_external", claimed_at: str = "claimed_at") -> Column:
    return (F.coalesce(F.col(external), F.lit(True)) == F.lit(False)) | F.col(claimed_at).isNotNull()


def invite_eligible(df: DataFrame, enabled: Column, email: str, suppressed: DataFrame, suppressed_email: str, fallback: str) -> DataFrame:
    """Rows whose source invites, whose address is given and not the fallback, and not on the suppression list."""
    ready = df.where(enabled & F.col(email).isNotNull() & (F.col(email) != "") & (F.lower(F.col(email)) != fallback.lower()))
    return ready.join(suppressed.select(F.lower(F.col(suppressed_email)).alias("__e")), F.lower(F.col(email)) == F.col("__e"), "left_anti")
