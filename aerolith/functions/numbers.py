"""Numbers and prices in German notation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.functions.core import SPACE, chain, found, led, let, pattern


def leading_number(c: Column) -> Column:
    """The number that a text starts with, null if it starts with none."""
    return found(c, rf"^{SPACE}*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)").try_cast("double")


def german_number(c: Column) -> Column:
    """Points dropped, the first comma taken for the decimal point."""
    return leading_number(F.regexp_replace(F.replace(c, F.lit("."), F.lit("")), "^([^,]*),", "$1."))


def parse_price(c: Column) -> Column:
    """A struct of amount and negotiable."""
    return let(c, _price)


def _price(c: Column) -> Column:
    negotiable = c.rlike(pattern(r"\bVB\b|\bVHB\b", "i"))
    bare = chain(c, ("€", ""), (pattern(r"\b(VB|VHB|FP)\b", "i"), ""), (",-", ""), (rf"{SPACE}+", ""))
    german = lambda x: x.rlike(r"^\d{1,3}(\.\d{3})*(,\d{1,2})?$")
    amount = let(bare, lambda x: F.when(german(x), german_number(x)).when(x != "", leading_number(x)))
    return F.struct(amount.alias("amount"), negotiable.alias("negotiable"))


def extract_number(c: Column) -> Column:
    """The first number: up to three digits and groups of three, with a decimal comma. So 2500 gives 250."""
    return german_number(found(c, r"(\d{1,3}(?:\.\d{3})*(?:,\d+)?)"))


def parse_number(c: Column) -> Column:
    """The first number, whole: like extract_number, but 2500 gives 2500."""
    return german_number(found(c, r"(\d+(?:\.\d{3})*(?:,\d+)?)"))


_PRICES = (
    r"(?iu)(?:Preis|€|EUR)\s*:?\s*([\d.,]+)\s*(?:€|EUR)?\s*,?-?\s*(VB|VHB|FP)?",
    r"(?iu)€\s*([\d.,]+)\s*,?-?\s*(VB|VHB|FP)?",
    r"(?iu)([\d.,]{2,})\s*(?:€|EUR)\s*(VB|VHB|FP)?",
)


def price_in_text(c: Column) -> Column:
    """A struct of amount (0 as null) and negotiable, from free text."""
    phrase = c.rlike(led(r"(?iu)verhandelbar|Verhandlungsbasis|auf\s+Anfrage|nach\s+Vereinbarung"))
    raw = F.lit(None).cast("string")
    for regex in map(led, reversed(_PRICES)):
        raw = F.when(c.rlike(regex), F.concat(F.lit("€"), F.regexp_extract(c, regex, 1), F.lit(" "), F.regexp_extract(c, regex, 2))).otherwise(raw)
    return let(parse_price(raw), lambda p: F.struct(F.when(p["amount"] != 0, p["amount"]).alias("amount"), (phrase | F.coalesce(p["negotiable"], F.lit(False))).alias("negotiable")))


def card_price(c: Column) -> Column:
    """A struct of amount and negotiable: EUR or € before or after the number; negotiable without one."""
    raw = F.coalesce(found(c, r"(?i)(?:EUR|€)\s*([\d.,]+)"), found(c, r"(?i)([\d.]+)\s*(?:EUR|€)"))
    return F.struct(german_number(raw).alias("amount"), raw.isNull().alias("negotiable"))


def labelled_price(c: Column) -> Column:
    """A struct of amount and negotiable from a price label: on request, negotiable, or a number with €."""
    asked, open_ = c.contains("Preis auf Anfrage"), c.contains("Verhandlungssache")
    after, before = found(c, r"([\d.,]+)\s*€"), found(c, r"€\s*([\d.,]+)")
    raw = F.when(open_, after).otherwise(F.coalesce(after, before))
    return F.struct(F.when(~asked, german_number(raw)).alias("amount"), (asked | open_).alias("negotiable"))
