"""Classifiers: ordered rules compiled to CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.functions.core import any_of, first_case, led, let, looked_up, lowered, pattern, trimmed
from aerolith.rules import tables as T


def aircraft_category(url: Column, title: Column) -> Column:
    """A category by the first rule whose marks are in the URL or the title; marks are plain parts of words."""
    def ruled(both: Column) -> Column:
        u, t = both["u"], both["t"]
        cases = []
        for name, in_url, in_title, patterns in T.CATEGORY_RULES:
            hit = any_of(u, in_url) | any_of(t, in_title)
            for p in patterns:
                hit = hit | t.rlike(pattern(p, ""))
            cases.append((hit, name))
        return first_case(*cases)

    return let(F.struct(F.lower(F.coalesce(url, F.lit(""))).alias("u"), F.lower(title).alias("t")), ruled)


def normal_category(c: Column, known: tuple[str, ...] | None = None) -> Column:
    """A category by its usual name; null if it is none of the known ones."""
    name = F.coalesce(looked_up(c, T.CATEGORY_ALIASES), c)
    return name if known is None else F.when(name.isin(*known), name)


def category_name(registration: Column, by_spec: Column, url: Column, title: Column, specs_first: bool = False) -> Column:
    """A listing's category: by its registration, else by its reference entry (or the other way round), else by marks in
    the URL or title."""
    first = (by_spec, registration_category(registration))
    return F.coalesce(*(first if specs_first else first[::-1]), aircraft_category(url, title))


def _registration(c: Column) -> Column:
    return F.regexp_replace(F.upper(c), r"\s+", "")


def registration_category(c: Column) -> Column:
    return let(_registration(c), lambda reg: first_case(*[(reg.rlike(f"^{form}$"), name) for form, name in T.REGISTRATION_CATEGORIES]))


def registration_country(c: Column) -> Column:
    reg = _registration(c)
    return first_case(*[(reg.startswith(start), name) for start, name in T.REGISTRATION_COUNTRIES])


def event_category(source: str, title: Column, kind: Column | None = None) -> Column:
    """An event's category by the rules of its source; one source names kinds of events, another headlines."""
    low = F.lower(title)
    if source == "fliegermagazin.de" and kind is not None:
        low = F.concat_ws("\n", F.lower(kind), low)
    rules = first_case(*[(low.rlike(pattern(p, "")) if p else F.lit(True), name) for p, name in T.EVENT_RULES[source]])
    if source == "eurocontrol.int" and kind is not None:
        named = F.lower(trimmed(kind))
        return F.when(named == "webinar", "webinar").when(named.isin("workshop", "training", "conference", "forum"), "seminar").otherwise(rules)
    return rules


def calendar_category(categories: Column, default: Column) -> Column:
    """The first of an event's own categories that is one, else the calendar's if it is one, else general."""
    known = F.filter(F.transform(categories, lambda x: F.regexp_replace(lowered(x), r"\s+", "-")), lambda x: x.isin(*T.EVENT_CATEGORIES))
    return F.coalesce(F.try_element_at(known, F.lit(1)), F.when(default.isin(*T.EVENT_CATEGORIES), default), F.lit("general"))


def category_of_number(c: Column) -> Column:
    return looked_up(c, T.CATEGORY_NUMBERS, "general")


def parts_heading(block: Column) -> Column:
    """The parts category that a block announces; null if it looks like a listing (date, price or much text)."""
    text = trimmed(F.regexp_replace(block, "<[^>]+>", ""))
    low = F.lower(text)
    listing = text.rlike(r"\d{2}\.\d{2}\.\d{4}") | low.rlike(r"€|eur|\d+[.,]\d{2}") | (F.length(text) > 200)
    return F.when(~listing, first_case(*[(low.rlike(p), name) for p, name in T.PARTS_HEADINGS]))


def text_country(c: Column) -> Column:
    """A country code by names in a text; Germany without any."""
    low = F.lower(c)
    return first_case(*[(low.rlike(pattern(rf"\b(?:{names})\b", "")), code) for names, code in T.TEXT_COUNTRIES], otherwise="DE")


def venue_country(c: Column) -> Column:
    """A struct of city and country code of `city, country`; XX for unknown ones."""
    from aerolith.functions.text import clean_text

    parts = F.filter(F.transform(F.split(clean_text(c), ","), lambda x: F.trim(x)), lambda x: x != "")
    n = F.size(parts)
    code = looked_up(F.lower(F.try_element_at(parts, F.lit(-1))), T.VENUE_COUNTRY_ISO, "XX")
    return F.struct(F.when(n >= 2, parts[0]).alias("city"), code.alias("country"))


def source_priority(source: Column) -> Column:
    return looked_up(source, T.SOURCE_PRIORITY, T.DEFAULT_PRIORITY)


def compare_priority(new: Column, old: Column) -> Column:
    a, b = source_priority(new), source_priority(old)
    return F.when(a > b, "higher").when(a < b, "lower").otherwise("equal")


def fuel_type(c: Column) -> Column:
    return F.when(c.rlike(led("(?iu)MOGAS|Normalbenzin|Super(?!flug)")), "MOGAS").when(c.rlike(led(r"(?iu)AVGAS|100LL|Aviation\s*Gasoline")), "AVGAS").when(c.rlike(led("(?iu)Jet.?A|Kerosin|Diesel|JET")), "Jet-A")


def airworthy(c: Column) -> Column:
    no = c.rlike(led(r"(?iu)nicht\s*(?:luft|verkehrs)tüchtig|not\s+airworthy"))
    return F.when(no, False).when(c.rlike(led(r"(?iu)(?:luft|verkehrs)tüchtig(?!\s*zeugnis)|LTB\s+vorhanden|airworthy")), True)


def vat_included(c: Column) -> Column:
    return F.when(c.rlike(r"(?i)MWSt\s*ausweisbar"), True).when(c.rlike(r"(?i)MWSt\s*nicht\s*ausweisbar"), False)


def is_clean_model(c: Column) -> Column:
    """Whether a string can be a model's name."""
    bad = pattern("|".join(f"(?:{p})" for p in T.NOT_MODEL))
    clean = let(trimmed(c), lambda x: ~x.rlike(bad) & (F.size(F.split(x, r"\s+")) <= 6))
    return F.coalesce((F.length(c) >= 2) & clean, F.lit(False))


def model_of_title(title: Column, manufacturer: Column, known: Column) -> Column:
    """The model: the known one, else the title without maker, phrases of sale and what follows the model, whole if it
    is clean, else its first three, two or one words; empty if none of them is. What a title is cut down to is computed
    once, and only where no model is known."""
    quoted = F.regexp_replace(F.coalesce(manufacturer, F.lit("")), r"([.*+?^$\{}()|\[\]\\])", r"\\$1")
    x = trimmed(F.when(manufacturer.isNotNull(), F.regexp_replace(title, F.concat(F.lit("(?i)^(.*?)"), quoted), F.lit("$1"))).otherwise(title))
    for p in T.SALE_PREFIXES:
        x = F.regexp_replace(x, f"(?i){p}", "")
    x = trimmed(F.element_at(F.split(trimmed(x), f"(?iu){T.MODEL_ENDS}"), 1))
    x = trimmed(F.regexp_replace(x, r"[\s,;:.!]+$", ""))
    clean = lambda n: lambda s: F.when(is_clean_model(s), F.substring(s, 1, n) if n else s)
    first = lambda words: F.coalesce(*[F.when(F.size(words) >= n, let(F.array_join(F.slice(words, 1, n), " "), clean(0))) for n in (3, 2, 1)], F.lit(""))
    short = lambda x: let(F.filter(F.split(x, r"\s+"), lambda w: w != ""), first)
    return F.coalesce(known, let(x, lambda x: F.coalesce(clean(80)(x), short(x))))


def part_brand(title: Column) -> Column:
    low = F.lower(title)
    return first_case(*[(low.contains(b.lower()), b) for b in T.PART_BRANDS], otherwise=F.element_at(F.split(title, r"\s+"), 1))


def is_advertisement(url: Column) -> Column:
    hit = F.lit(False)
    for p in T.AD_PATTERNS:
        hit = hit | url.rlike(pattern(p, "i"))
    return hit


def allowed_image_host(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("HOST")).isin(*T.IMAGE_HOSTS), F.lit(False))


def image_format(data: Column) -> Column:
    """jpeg, png or webp by the first bytes of at least twelve."""
    head = F.hex(F.substring(data, 1, 12))
    kind = F.when(head.startswith("FFD8FF"), "jpeg").when(head.startswith("89504E47"), "png").when(head.startswith("52494646") & (F.substring(head, 17, 8) == "57454250"), "webp")
    return F.when(F.octet_length(data) >= 12, kind)
