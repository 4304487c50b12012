"""String functions: cleaning, slugs, contacts, places, duplicate text."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.functions.core import SPACE, chain, found, given, let, looked_up, pattern, trimmed
from aerolith.rules import tables as T


def clean_text(c: Column) -> Column:
    """Without tags, with the usual entities decoded (ampersands first), white space collapsed."""
    c = F.regexp_replace(c, "<[^>]*>", " ")
    for entity, sign in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")):
        c = F.replace(c, F.lit(entity), F.lit(sign))
    return trimmed(F.regexp_replace(c, rf"{SPACE}+", " "))


def sanitize(c: Column) -> Column:
    """Without tags, script URLs and event handlers."""
    return trimmed(chain(c, ("<[^>]*>", ""), ("(?i)javascript:", ""), (rf"(?i)on\w+{SPACE}*=", "")))


def decode_email(c: Column) -> Column:
    """%XX as characters of that number, [at], (at), [dot] and (dot) as signs."""
    parts = F.regexp_extract_all(c, F.lit("(?s)%[0-9a-fA-F]{2}|[^%]+|%"), F.lit(0))
    one = lambda p: F.when(p.rlike("^%[0-9a-fA-F]{2}$"), F.decode(F.unhex(F.substring(p, 2, 2)), "ISO-8859-1")).otherwise(p)
    decoded = F.array_join(F.transform(parts, one), "")
    for word, sign in (("at", "@"), ("dot", ".")):
        decoded = chain(decoded, (rf"(?i){SPACE}*\[{word}\]{SPACE}*", sign), (rf"(?i){SPACE}*\({word}\){SPACE}*", sign))
    return trimmed(decoded)


def _plain_letters() -> tuple[str, str]:
    """Letters with marks, and the letters below: a rule over Latin blocks, by canonical decomposition."""
    marked, plain = [], []
    for k in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0x386, 0x3CF), *range(0x400, 0x460)]:
        parts = [x for x in unicodedata.normalize("NFD", chr(k)) if unicodedata.category(x) != "Mn"]
        if len(parts) == 1 and parts[0] != chr(k):
            marked.append(chr(k))
            plain.append(parts[0])
    return "".join(marked), "".join(plain)


MARKED, PLAIN = _plain_letters()


def strip_diacritics(c: Column) -> Column:
    """Letters without their marks, as canonical decomposition leaves them."""
    return F.regexp_replace(F.translate(c, MARKED, PLAIN), r"[\x{0300}-\x{036F}]", "")


def _hyphened(c: Column) -> Column:
    return chain(c, ("[^a-z0-9]+", "-"), ("^-+|-+$", ""))


def transliterate(c: Column) -> Column:
    """Lower case, with Cyrillic, Greek and Turkish letters in Latin ones."""
    letters = T.CYRILLIC | T.GREEK | T.TURKISH
    c = F.regexp_replace(F.lower(c), r"\x{0307}", "")
    for letter, by in letters.items():
        if len(by) > 1:
            c = F.replace(c, F.lit(letter), F.lit(by))
    single = {k: v for k, v in letters.items() if len(v) == 1}
    gone = "".join(k for k, v in letters.items() if not v)
    return F.translate(c, "".join(single) + gone, "".join(single.values()))


def slug(c: Column, number: Column | None = None) -> Column:
    """Lower-case ASCII words and hyphens, at most 80 characters, cut at a hyphen where one is near, with a number."""
    s = F.substring(_hyphened(strip_diacritics(transliterate(c))), 1, 80)
    last = F.lit(80) - F.instr(F.reverse(s), "-")
    s = F.when((F.length(s) == 80) & (F.instr(s, "-") > 0) & (last >= 60), s.substr(F.lit(1), last)).otherwise(s)
    s = F.regexp_replace(s, "-+$", "")
    if number is not None:
        s = F.when(F.coalesce(number, F.lit(0)) != 0, F.concat(s, F.lit("-"), number.cast("string"))).otherwise(s)
    return chain(s, ("-+", "-"), ("^-+|-+$", ""))


def slug_for_key(c: Column) -> Column:
    return _hyphened(F.lower(strip_diacritics(c)))


def strip_title_date_prefix(c: Column) -> Column:
    return trimmed(F.regexp_replace(c, rf"(?i)^(?:update{SPACE}+)?\d{{1,2}}\.\d{{2}}\.\d{{4}}{SPACE}*", ""))


def title_of(bold: Column, text: Column) -> Column:
    """A title: bold text of 4 to 199 characters, else the first line that can be one, else the first 100 characters."""
    lines = F.filter(F.transform(F.split(text, "\n"), trimmed), lambda x: (F.length(x) > 3) & ~x.rlike(r"^\d{1,2}\.\d{2}\.\d{4}$") & ~x.startswith("•") & (F.length(x) < 200))
    own = let(trimmed(bold), lambda x: F.when((F.length(x) > 3) & (F.length(x) < 200), clean_text(x)))
    return strip_title_date_prefix(F.coalesce(own, F.try_element_at(lines, F.lit(1)), F.substring(text, 1, 100)))


def is_navigation(c: Column) -> Column:
    low = F.lower(c)
    hit = F.lit(False)
    for word in T.NAVIGATION_WORDS:
        hit = hit | low.contains(word)
    return (F.length(c) < 200) & hit


def blocks(html: Column, least: int = 50) -> Column:
    """Parts of a page between rules (<hr> or * * *) that have more than `least` visible characters."""
    parts = F.split(html, r"(?i)<hr\s*/?>|\*\s*\*\s*\*")
    return F.filter(parts, lambda x: F.length(trimmed(F.regexp_replace(x, "<[^>]+>", ""))) > least)


def keep_first(parts: Column, least: int, key) -> Column:
    """An array without later elements whose key was seen; elements with keys shorter than `least` all stay. Equal keys
    come side by side by sorting, so that long texts take little more than their length."""

    def row(x: Column, i: Column) -> Column:
        return let(key(x), lambda k: F.struct(F.when(F.length(k) < least, i).otherwise(-1).alias("own"), k.alias("k"), i.alias("i"), x.alias("x")))

    def firsts(rows: Column) -> Column:
        new = lambda r, j: (j == 0) | (F.get(rows, j - 1)["own"] != r["own"]) | (F.get(rows, j - 1)["k"] != r["k"])
        return F.transform(F.filter(rows, new), lambda r: F.struct(r["i"].alias("i"), r["x"].alias("x")))

    return F.transform(F.sort_array(let(F.sort_array(F.transform(parts, row)), firsts)), lambda r: r["x"])


def deduplicate_description(c: Column) -> Column:
    """Each paragraph (of ten characters or more) and each sentence (of twenty or more) once, the first time."""
    key = lambda x: trimmed(F.regexp_replace(F.lower(x), rf"{SPACE}+", " "))
    paragraphs = F.filter(F.transform(F.split(c, rf"\n{SPACE}*\n"), trimmed), lambda x: x != "")
    joined = F.array_join(keep_first(paragraphs, 10, key), "\n\n")
    sentences = F.split(joined, rf"(?<=[.!?]){SPACE}+")
    return F.when(c == "", c).otherwise(trimmed(F.array_join(keep_first(sentences, 20, key), " ")))


def tech_terms(c: Column) -> Column:
    """The technical terms and numbers of a text, in upper case, each once."""
    terms = F.regexp_extract_all(c, F.lit(pattern(r"\b(?:TT|TTAF|SMOH|TTSN|TBO|IFR|VFR|MTOW|\d{3,}[hH]?|\d+\.\d+)\b", "")), F.lit(0))
    return F.array_distinct(F.transform(terms, F.upper))


def term_overlap(a: Column, b: Column) -> Column:
    """Shared terms as a share of the smaller set."""
    return F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b))


#: What separates a text from the same in another language.
LANGUAGE_MARKS = (
    r"\n\s*[-_]{3,}\s*\n", r"(?iu)\n\s*(?:English|Englisch|Anglais|Inglés|Inglese)\s*[:：]\s*\n", r"(?iu)\n\s*(?:German|Deutsch|Allemand|Alemán|Tedesco)\s*[:：]\s*\n",
    r"(?iu)\n\s*(?:French|Français|Französisch)\s*[:：]\s*\n", r"(?iu)\n\s*(?:Translation|Übersetzung|Traduction)\s*[:：]\s*\n",
)


def strip_language_blocks(c: Column) -> Column:
    """The first of several blocks in different languages: before a mark, or the first half if both halves are about
    as long and share most of their technical terms."""
    sentences = F.split(c, rf"(?<=[.!?]){SPACE}+")
    middle = F.floor(F.size(sentences) / 2).cast("int")
    first, second = F.array_join(F.slice(sentences, 1, middle), " "), F.array_join(F.slice(sentences, middle + 1, F.size(sentences)), " ")
    ratio = F.length(first) / F.length(second)
    a, b = tech_terms(first), tech_terms(second)
    same = (F.size(sentences) >= 6) & (F.length(second) > 0) & (ratio > 0.6) & (ratio < 1.7) & (F.size(a) >= 2) & (F.size(b) >= 2) & (term_overlap(a, b) > 0.5)
    out = F.when(F.length(c) < 100, c)
    for mark in LANGUAGE_MARKS:
        primary = trimmed(F.element_at(F.split(c, mark, 2), 1))
        out = out.when(c.rlike(mark) & (F.length(primary) >= 50), primary)
    return out.when(same, first).otherwise(c)


def contact(html: Column, text: Column) -> Column:
    """A struct of name, email and phone."""
    spelled = found(text, r"(?i)[\w.-]+\s*\[at\]\s*[\w.-]+\.\w+", 0)  # tried at every word, so only where there is one
    mail = F.coalesce(found(html, r"(?i)mailto:([^\"'\s]+)"), F.when(text.rlike(r"(?i)\[at\]"), spelled))
    phone = found(text, r"(?i)(?:Tel\.?|Telefon|Mobil|Handy|Phone)[:\s]*([\d\s/+()-]{7,20})")
    name = found(text, r"(?iu)(?:Kontakt|Ansprechpartner|Verkäufer)[:\s]*([A-ZÄÖÜ][a-zäöüß]+\s+[A-ZÄÖÜ][a-zäöüß]+)")
    return F.struct(name.alias("name"), decode_email(mail).alias("email"), trimmed(phone).alias("phone"))


def location(c: Column) -> Column:
    marked = found(c, r"(?iu)(?:Standort|Raum|Region|Nähe|stationiert\s+(?:in|bei))[:\s]*([A-ZÄÖÜ][a-zäöüß]+(?:[\s-][A-ZÄÖÜ]?[a-zäöüß]+){0,3})")
    postal = r"(\d{5})\s+([A-ZÄÖÜ][a-zäöüß]+(?:[\s-][A-ZÄÖÜ][a-zäöüß]+){0,2})"
    coded = clean_text(F.concat(F.regexp_extract(c, postal, 1), F.lit(" "), F.regexp_extract(c, postal, 2)))
    return F.coalesce(clean_text(marked), F.when(c.rlike(postal), coded))


def city_of(place: Column) -> Column:
    """The city in a location."""
    c = trimmed(chain(place, (r"(?iu)^(?:Standort|Raum|Region|Nähe)[:\s]*", ""), (r"^\d{5}\s*", "")))
    c = trimmed(F.element_at(F.split(c, r"\s*[/()]\s*"), 1))
    return F.when((F.length(c) >= 2) & c.rlike("(?iu)^[A-ZÄÖÜ]"), c)


def airfield(c: Column) -> Column:
    """A struct of the airfield's name and ICAO code."""
    code = pattern(rf"\b((?:{T.ICAO_TEXT_STARTS})[A-Z]{{2}})\b", "")
    named = found(c, r"(?iu)(?:Flugplatz|Flughafen|Heimatflugplatz|Heimatflughafen|Flugfeld|Sonderlandeplatz|Verkehrslandeplatz|Landeplatz|UL-Gelände|UL-Platz|stationiert\s+(?:in|am|auf))[:\s]*([^\n•,]+)")
    return F.struct(given(trimmed(F.regexp_replace(clean_text(named), code, ""))).alias("name"), found(c, code).alias("icao"))


def venue_icao(c: Column) -> Column:
    """A struct of a venue's name and ICAO code, in parentheses at the end or anywhere in the text."""
    end = r"^(.*?)\s*\(\s*([A-Z]{4})\s*\)\s*$"
    inline = pattern(r"\b([A-Z]{4})\b", "")

    def parts(text: Column) -> Column:
        return F.struct(text.alias("text"), text.rlike(end).alias("ends"), found(text, inline).alias("code"))

    def of(p: Column) -> Column:
        text, code = p["text"], p["code"]
        name = trimmed(chain(F.regexp_replace(text, F.concat(F.lit("^(.*?)"), code), F.lit("$1")), (r"\(\s*\)", ""), (rf"{SPACE}+", " ")))
        inside = F.when(code.isNotNull(), let(name, lambda n: F.when(n == "", text).otherwise(n))).otherwise(F.coalesce(text, F.lit("")))
        return F.struct(
            F.when(p["ends"], trimmed(F.regexp_extract(text, end, 1))).otherwise(inside).alias("name"),
            F.when(p["ends"], F.regexp_extract(text, end, 2)).otherwise(code).alias("icao"),
        )

    return let(let(clean_text(c), parts), of)


def venue_city(c: Column) -> Column:
    postal = pattern(r"\b\d{5}\s+([A-Za-zÄÖÜäöüß\s-]+)\b", "")
    return F.coalesce(trimmed(found(c, postal)), trimmed(found(c, r"^[^,]+,\s*([A-Za-zÄÖÜäöüß\s-]+)$")))


def is_icao(c: Column) -> Column:
    return F.coalesce(c.rlike("^[A-Z]{4}$") & c.rlike(f"^({T.ICAO_STARTS})"), F.lit(False))


def clean_icao(c: Column) -> Column:
    code = F.upper(trimmed(c))
    return F.when(is_icao(code), code)


def clean_country(c: Column) -> Column:
    return F.when(c != "", F.coalesce(looked_up(F.lower(trimmed(c)), T.COUNTRY_ENGLISH), trimmed(c)))


def clean_city(c: Column) -> Column:
    """A city's name without country, airfield, postal code and the like; null where no name of a city is left."""
    whole = trimmed(c)
    country = rf"(?iu)^(?:{T.CITY_COUNTRY_PREFIXES}),?\s*(.+)$"
    x = F.when(whole.rlike(country), trimmed(F.regexp_extract(whole, country, 1))).otherwise(whole)
    ended = r"^(.+?)\s+([A-Z]{4})$"
    x = F.when(x.rlike(ended) & is_icao(F.regexp_extract(x, ended, 2)), trimmed(F.regexp_extract(x, ended, 1))).otherwise(x)
    for step in (r"\s*\([A-Z]{4}\)\s*", "/[A-Z]{4}$", rf"(?iu)^(?:{T.CITY_PLACE_PREFIXES})\s+", rf"(?iu)\s+(?:{T.CITY_TRAILERS}).*$", r"^\d{4,5}\s+", r"(?i)^\d+\s*NM\s+\w+\s+(?:of|von)\s+", r"(?iu)^nähe\s+(?:von\s+)?"):
        x = trimmed(F.regexp_replace(x, step, ""))
    x = trimmed(F.element_at(F.split(x, ","), 1))
    words = F.split(F.lower(x), r"\s+")
    bad = (
        F.lower(whole).isin(*T.COUNTRY_NAMES) | F.arrays_overlap(words, F.array(*[F.lit(w) for w in T.NOT_CITY_WORDS])) | x.rlike(r"\d")
        | (F.length(x) < 2) | (F.length(x) > 35) | (F.size(words) > 4) | x.rlike("^[a-zäöü]")
    )
    return F.when((whole != "") & ~bad, x)


def split_title_location(c: Column) -> Column:
    """A struct of title and location: the location follows the last dash."""
    normal = chain(c, (r"\x{00A0}", " "), (rf"{SPACE}+[-–—]{SPACE}+", " – "))
    parts = F.filter(F.transform(F.split(normal, " – "), trimmed), lambda x: x != "")
    n = F.size(parts)
    title = F.when(n == 0, trimmed(c)).when(n == 1, parts[0]).otherwise(F.array_join(F.slice(parts, F.lit(1), F.greatest(n - 1, F.lit(1))), " – "))
    return F.struct(title.alias("title"), F.when(n > 1, F.element_at(parts, -1)).alias("location"))


def unfold_ics(c: Column) -> Column:
    return chain(c, ("\r\n?", "\n"), ("\n[ \t]", ""))


def unescape_ics(c: Column) -> Column:
    return chain(c, (r"(?i)\\n", "\n"), (r"\\,", ","), (r"\\;", ";"), (r"\\\\", r"\\"))


def redact_credentials(c: Column) -> Column:
    return F.regexp_replace(c, "//[^:]+:[^@]+@", "//***@")


def elapsed(ms: Column) -> Column:
    """Milliseconds as `ms`, `s` or `m s`."""
    s = F.floor(ms / 1000 + 0.5)
    return F.when(ms < 1000, F.concat(ms.cast("string"), F.lit("ms"))).when(s < 60, F.concat(s.cast("string"), F.lit("s"))).otherwise(F.concat(F.floor(s / 60).cast("string"), F.lit("m "), (s % 60).cast("string"), F.lit("s")))


def feed_description(c: Column) -> Column:
    return given(clean_text(chain(c, ("<img[^>]*>", ""), ("The post .* appeared first on .*", ""))))


def new_part_description(description: Column, title: Column) -> Column:
    """Ten characters at least: the plain description, else the title, else the title and what it is; null without."""
    plain = F.trim(F.regexp_replace(F.coalesce(description, F.lit("")), "<[^>]*>", ""))
    named = F.trim(F.concat(title, F.lit(" — parts listing")))
    return F.when(F.length(plain) >= 10, plain).when(F.length(F.trim(title)) >= 10, title).when(F.length(named) >= 10, named)
