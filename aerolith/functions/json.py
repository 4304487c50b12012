"""JSON that was cut short or decorated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.functions.core import chain


def _count(c: Column, sign: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(sign), F.lit("")))


def unfenced(c: Column) -> Column:
    return F.regexp_replace(F.trim(chain(c, ("```json\n?", ""), ("```\n?", ""))), r",\s*([\]}])", "$1")


def repaired(c: Column) -> Column:
    """Without fences and trailing commas; if it doesn't parse then, with an odd quote, braces and brackets closed."""
    text = unfenced(c)
    quotes = F.size(F.regexp_extract_all(text, F.lit(r'(?<!\\)"'), F.lit(0)))
    x = F.when(quotes % 2 != 0, F.concat(text, F.lit('"'))).otherwise(text)
    x = F.concat(x, F.repeat(F.lit("}"), F.greatest(_count(text, "{") - _count(text, "}"), F.lit(0))))
    x = F.concat(x, F.repeat(F.lit("]"), F.greatest(_count(text, "[") - _count(text, "]"), F.lit(0))))
    x = F.regexp_replace(x, r",\s*([\]}])", "$1")
    return F.when(F.try_parse_json(text).isNotNull(), text).when(F.try_parse_json(x).isNotNull(), x)


def number_or_null(c: Column) -> Column:
    """A number from JSON text; anything else, and 0, is null."""
    n = F.trim(c).try_cast("double")
    return F.when((n != 0) & ~F.isnan(n), n)


def date_or_null(c: Column) -> Column:
    """yyyy-mm-dd if it is a date, m/yyyy or m.yyyy as the first of the month, else null."""
    x = F.trim(c)
    short = r"^(\d{1,2})[./](\d{4})$"
    first = F.concat(F.regexp_extract(x, short, 2), F.lit("-"), F.lpad(F.regexp_extract(x, short, 1), 2, "0"), F.lit("-01"))
    return F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}$") & x.try_cast("date").isNotNull(), x).when(x.rlike(short), first)
