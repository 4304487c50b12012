"""Listing pages: blocks of prose, semi-structured cards and card grids, as rows of schemas.LISTING and schemas.PART."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.functions import classify as C
from aerolith.functions import dates as D
from aerolith.functions import keys as K
from aerolith.functions import numbers as N
from aerolith.functions import text as X
from aerolith.functions.core import chain, found, given, let, looked_up, once, pattern
from aerolith.functions.urls import on_site, origin, segments
from aerolith.operators.filldown import fill_down
from aerolith.operators.merge import listing_description, over
from aerolith.rules import tables as T
from aerolith.sources.cards import Cards, Folds, cards, cards_and_folds

SERIAL = r"(?iu)(?:Werk[- ]?Nr\.?|S/N|Seriennummer|Serial)[:\s]*([A-Z0-9][\w-]{1,20})"
MARKED_REGISTRATION = r"(?iu)(?:Kennzeichen|Kennz\.?|Zulassung|Registration)[:\s]*([A-Z]{1,2}-[A-Z0-9]{2,5})"
FREE_REGISTRATION = pattern(r"\b(D-[A-Z0-9]{3,4}|OE-[A-Z]{3}|HB-[A-Z]{3}|G-[A-Z]{4}|F-[A-Z]{4}|I-[A-Z]{4}|N[0-9]{1,5}[A-Z]{0,2}|SP-[A-Z]{3}|OY-[A-Z]{3}|OK-[A-Z]{3}|SE-[A-Z]{3}|LN-[A-Z]{3}|PH-[A-Z]{3})\b", "")
ANY_REGISTRATION = pattern(r"\b([A-Z]{1,2}-[A-Z0-9]{2,5})\b", "")
ICAO_IN_TEXT = pattern(rf"\b((?:{T.ICAO_TEXT_STARTS})[A-Z]{{2}})\b", "")

#: Numbers with labels and units in German prose.
MEASURES = {
    "engine_hours": r"(?iu)(?:Motorstunden|TTSN|Motorbetriebsstunden|Motor-Std|Motor-BZ)[:\s]*([\d.,]+)",
    "cycles": r"(?iu)(?:Landungen|Starts|Zyklen|LDG|Ldg\.?)[:\s]*([\d.,]+)",
    "mtow": r"(?iu)MTOW[:\s]*([\d.,]+)\s*kg",
    "empty_weight": r"(?iu)(?:Leergewicht|Leermasse|Leer(?:gewicht)?)[:\s]*([\d.,]+)\s*kg",
    "max_takeoff_weight": r"(?iu)(?:MTOW|Abflugmasse|Abfluggewicht|max\.?\s*Abfluggewicht|MAUW)[:\s]*([\d.,]+)\s*kg",
    "fuel_capacity": r"(?iu)(?:Tankinhalt|Kraftstoffmenge|Tankvolumen|Tank)[:\s]*([\d.,]+)\s*l",
    "cruise_speed": r"(?iu)(?:Reisegeschwindigkeit|Reise(?:geschw\.?)?|Vcr|Vc)[:\s]*([\d.,]+)\s*(?:km/h|kts?|mph)",
    "max_speed": r"(?iu)(?:Höchstgeschwindigkeit|Vne|Vmax|max\.?\s*Geschwindigkeit)[:\s]*([\d.,]+)\s*(?:km/h|kts?|mph)",
    "max_range": r"(?iu)(?:Reichweite|Aktionsradius|Range)[:\s]*([\d.,]+)\s*(?:km|nm|mi)",
    "service_ceiling": r"(?iu)(?:Gipfelhöhe|Dienstgipfelhöhe|Betriebshöhe|Service\s*Ceiling)[:\s]*([\d.,]+)\s*(?:m|ft)",
    "climb_rate": r"(?iu)(?:Steigleistung|Steigrate|Climb\s*Rate)[:\s]*([\d.,]+)\s*(?:m/s|ft/min|fpm)",
    "fuel_consumption": r"(?iu)(?:Verbrauch|Kraftstoffverbrauch|Consumption)[:\s]*([\d.,]+)\s*(?:l/h|ltr/h|gal/h)",
}
#: What is no part of a description any more once it has a column of its own.
RESIDUE = (
    r"(?iu)Baujahr[:\s]*\d{4}", r"(?iu)Motor[:\s]*[^•\n]+", r"(?iu)(?:Betriebsstunden|TT|Flugstunden)[:\s]*[\d.,]+", r"(?iu)MTOW[:\s]*[\d.,]+\s*kg", r"(?iu)Rettung[:\s]*[^•\n]+",
    r"(?iu)(?:JNP|Jahresnachprüfung)[:\s]*[^\n•]+", r"(?iu)DULV[- ]?Kennblatt[:\s]*[^\n•]+", r"(?iu)€[\d.,]+\s*,?-?\s*(?:VB|VHB|FP)?", r"(?iu)(?:Tel\.?|Telefon|Mobil)[:\s]*[\d\s/+()-]+",
)


def specs(text: Column) -> dict[str, Column]:
    """The columns that a listing's prose yields, one expression each."""
    engine = X.clean_text(found(text, pattern(r"\bMotor\s*:\s*([^•\n]{3,80})")))
    engine = F.trim(chain(engine, (pattern(r"\s*(?:Motorstunden|Motorbetriebsstunden|Motor-Std|Motor-BZ|TTSN|TTAF|Zelle|Ausstattung|Baujahr|\bTT\b|\b\d{3,}\s*h\b).*"), ""), (r"(?iu)\s+-\s+(?:Funk|Transponder|Flarm|GPS|MGL|Garmin|ADS|VHF|UKW|Stratos|ELT|Avionik).*", "")))
    hours = F.coalesce(found(text, r"(?iu)(?:Betriebsstunden|TT(?:AF)?|Flugstunden)[:\s]*([\d.,]+)"), found(text, pattern(r"(\d+)\s*(?:Stunden|Std|h)\b")))
    check = found(text, r"(?iu)(?:JNP|Jahresnachprüfung)[:\s]*(\d{2}\.\d{2}\.\d{4}|\d{2}/\d{4}|\w+\s+\d{4})")
    parts = F.filter(F.transform(F.split(text, "[•\n]"), lambda x: F.trim(x)), lambda s: (F.length(s) > 2) & (F.length(s) < 200) & s.rlike("|".join(T.AVIONICS_WORDS)))
    out = {
        "year": found(text, r"(?iu)Baujahr[:\s]*(\d{4})").try_cast("int"),
        "engine": let(engine, lambda x: F.when(F.length(x) >= 3, x)),
        "total_time": N.extract_number(hours),
        "rescue_system": X.clean_text(found(text, r"(?iu)Rettung[:\s]*([^•\n]+)")),
        "annual_inspection": let(check, lambda x: F.coalesce(D.german_date(x), x)),
        "dulv_ref": X.clean_text(found(text, r"(?iu)DULV[- ]?Kennblatt[:\s]*([^\n•]+)")),
        "registration": F.upper(F.coalesce(found(text, MARKED_REGISTRATION), found(text, FREE_REGISTRATION))),
        "serial_number": found(text, SERIAL),
        "airworthy": C.airworthy(text),
        "avionics": given(F.array_join(parts, "; ")),
        "fuel_type": C.fuel_type(text),
    }
    return out | {name: N.extract_number(found(text, regex)) for name, regex in MEASURES.items()}


def residue(text: Column, title: Column) -> Column:
    """A description: the text without what has columns of its own, without the title in front."""
    untitled = lambda x: F.when(x.startswith(title) & (title != ""), F.substring(x, F.length(title) + 1, F.length(x))).otherwise(x)
    x = let(chain(text, *[(p, "") for p in RESIDUE]), untitled)
    x = F.trim(chain(x, ("•", ""), (r"\s+", " ")))
    return F.coalesce(given(x), title)


def images(html: Column, page: Column) -> Column:
    """Absolute URLs of a block's images, without tiny ones."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<img\s[^>]*>"), F.lit(0))
    size = lambda t, k: F.coalesce(given(F.regexp_extract(t, rf"""(?i)\s{k}\s*=\s*["']?(\d+)""", 1)).try_cast("int"), F.lit(999))
    large = F.filter(tags, lambda t: (size(t, "width") >= 50) & (size(t, "height") >= 50))
    sources = F.filter(F.transform(large, lambda t: F.regexp_extract(t, r"""(?i)\ssrc\s*=\s*["']([^"']+)""", 1)), lambda s: s != "")
    folder = F.regexp_extract(page, "^(.*/)", 1)
    whole = F.transform(sources, lambda s: F.when(s.startswith("http"), s).when(s.startswith("/"), F.concat(origin(page), s)).otherwise(F.concat(folder, s)))
    return F.filter(whole, lambda u: u.rlike(r"(?i)\.(jpg|jpeg|png|gif|webp)"))


def _typed(df: DataFrame, schema: str) -> DataFrame:
    """The columns of a schema; those that df doesn't have are null."""
    have = set(df.columns)
    parts = [x.strip().rsplit(" ", 1) for x in schema.split(",")]
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(k).alias(n) for n, k in parts])


def _blocks(pages: DataFrame, least: int) -> DataFrame:
    body = F.coalesce(given(F.regexp_extract("payload", r"(?is)<body[^>]*>(.*)</body>", 1)), F.col("payload"))
    df = pages.withColumn("__b", X.blocks(body, least)).select("*", F.posexplode("__b").alias("index", "block")).drop("payload", "__b")
    plain = F.regexp_replace("block", r"(?is)<(script|style)[^>]*>.*?</\1>", "")
    return once(df, {"text": X.clean_text(F.regexp_replace(plain, "<[^>]*>", ""))})  # some forty expressions read it


def _block_columns(df: DataFrame, source: str) -> DataFrame:
    """What aircraft and parts blocks share."""
    bold = F.regexp_replace(F.regexp_extract("block", r"(?is)<(?:b|strong)(?:\s[^>]*)?>(.*?)</(?:b|strong)>", 1), "<[^>]*>", "")
    posted = D.german_date(found(F.col("text"), r"(\d{2}\.\d{2}\.\d{4})"))
    df = once(df.where(~X.is_navigation(F.col("text"))), {"title": X.title_of(bold, F.col("text"))}).where(F.length("title") >= 3)
    df = once(df, {"posted_date": posted, "__price": N.price_in_text(F.col("text")), "__contact": X.contact(F.col("block"), F.col("text")), "location": X.location(F.col("text"))})
    return df.withColumns({
        "source_id": K.positional_id(F.col("page_url"), F.col("index"), F.col("posted_date")), "source_url": F.col("page_url"), "source_name": F.lit(source), "price": F.col("__price.amount"),
        "price_negotiable": F.col("__price.negotiable"), "contact_name": F.col("__contact.name"), "contact_email": F.col("__contact.email"), "contact_phone": F.col("__contact.phone"),
        "image_urls": images(F.col("block"), F.col("page_url")),
    })


def prose_aircraft(pages: DataFrame, source: str) -> DataFrame:
    """Aircraft in blocks of prose between rules."""
    df = _block_columns(_blocks(pages, 50), source)
    df = df.withColumns(specs(F.col("text"))).withColumn("__a", X.airfield(F.col("text")))
    df = df.withColumns({"description": residue(F.col("text"), F.col("title")), "city": X.city_of(F.col("location")), "airfield_name": F.col("__a.name"), "icao": F.col("__a.icao")})
    return _typed(df, schemas.LISTING)


def prose_parts(pages: DataFrame, source: str) -> DataFrame:
    """Parts in blocks of prose; short blocks announce the category of those that follow."""
    df = _blocks(pages, 30).withColumn("head", C.parts_heading(F.col("block")))
    df = fill_down(df, ["page_url"], [F.col("index")], "head", "category", "miscellaneous").where("head IS NULL")
    df = _block_columns(df, source)
    text = F.col("text")
    df = df.withColumns({
        "total_time": N.extract_number(found(text, r"(?iu)(?:TTSN|Betriebsstunden|TT|Laufzeit)[:\s]*([\d.,]+)")), "condition": X.clean_text(found(text, r"(?iu)(?:Zustand|Condition)[:\s]*([^\n•,]+)")),
        "vat_included": C.vat_included(text), "description": F.substring(text, 1, 2000),
    })
    return _typed(df, schemas.PART)


INDEX_CARDS = Cards(".listing, .result-item, tr.item, .aircraft-item", {"html": ("", "html"), "text": ("", "text"), "link": ("a[href*='--xi']", "last:href"), "images": ("img", "all:src")}, {"title": (("a", "text"), ("b, strong", "text"))},
                    least_html=50, parents_of="a[href*='--xi']", least_parent=30)
TITLE_ENDS = (
    r"(?su)€\s*[\d.,]+.*$", r"(?siu)Preis auf Anfrage.*$", pattern(r"\bBj\.?\s*:?\s*\d{4}.*$", "siu"), pattern(r"\bTTAF\b.*$", "siu"), pattern(r"\bStandort\b.*$", "siu"), pattern(r"\bEU versteuert.*$", "siu"),
    pattern(r"\bNettopreis\b.*$", "siu"), pattern(r"\bSeriennr\.?\b.*$", "siu"), pattern(r"\bReg\.?\s*Nr\.?\b.*$", "siu"), pattern(r"\bJahresnachpr[üu]fung\b.*$", "siu"), pattern(r"\bTyp:\s*\w+.*$", "siu"), r"(?siu)CHF\s*[\d.,]+.*$",
)


def _place(c: Column) -> Column:
    """A struct of city, ICAO code and country of a comma list: countries by name, codes alone, in parentheses or behind
    a slash, and the first other part as the city."""
    parts = F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")
    country = F.filter(F.transform(parts, lambda x: looked_up(F.lower(x), T.COUNTRY_ENGLISH | {"brasilien": "Brazil", "portugal": "Portugal", "finnland": "Finland"})), lambda x: x.isNotNull())
    code = lambda x: F.when(x.rlike(r"\([A-Z]{4}\)"), F.regexp_extract(x, r"\(([A-Z]{4})\)", 1)).when(x.rlike("/[A-Z]{4}$"), F.regexp_extract(x, "/([A-Z]{4})$", 1)).when(X.is_icao(x), x)
    codes = F.array_compact(F.transform(parts, code))
    named = F.filter(parts, lambda x: looked_up(F.lower(x), T.COUNTRY_ENGLISH).isNull() & ~X.is_icao(x) & (F.length(x) >= 2))
    cities = F.transform(named, lambda x: F.trim(F.regexp_replace(x, r"\s*\([A-Z]{4}\)|/[A-Z]{4}$", "")))
    return F.struct(F.try_element_at(cities, F.lit(1)).alias("city"), F.try_element_at(codes, F.lit(-1)).alias("icao"), F.try_element_at(country, F.lit(-1)).alias("country"))


def index_cards(pages: DataFrame, source: str) -> DataFrame:
    """Semi-structured cards of index and model pages."""
    df = pages.withColumn("__r", cards(F.col("payload"), INDEX_CARDS)).select("page_url", F.posexplode("__r").alias("index", "c"))
    get = lambda k: F.col("c").getItem(k)
    df = df.withColumn("text", X.clean_text(get("text"))).where(F.length("text") >= 20)
    title = F.trim(chain(F.trim(F.coalesce(get("title"), F.substring("text", 1, 100))), *[(p, "") for p in TITLE_ENDS]))
    df = df.withColumn("title", title).where(F.length("title") >= 3)
    text = F.col("text")
    df = df.withColumn("__p", N.card_price(text)).withColumn("location", X.clean_text(found(text, r"(?iu)(?:Standort|Location)[:\s]*([^;|\n]+)"))).withColumn("__l", _place(F.col("location"))).withColumn("__c", X.contact(get("html"), text))
    link = get("link")
    number = lambda regex: N.german_number(found(text, regex))
    pictures = F.filter(F.split(F.coalesce(get("images"), F.lit("")), "\n"), lambda s: (s != "") & ~s.rlike("logo|icon|banner"))
    df = df.withColumn("icao", F.coalesce(F.col("__l.icao"), found(text, ICAO_IN_TEXT)))
    df = df.withColumns({
        "source_id": F.when(link.isNotNull(), F.concat(F.lit(f"{source}:"), link)).otherwise(K.positional_id(F.col("page_url"), F.col("index"), F.lit(None).cast("string"))),
        "source_url": F.col("page_url"), "source_name": F.lit(source), "description": text, "year": found(text, r"(?i)Bj\.?\s*:?\s*(\d{4})").try_cast("int"), "total_time": number(r"(?i)(?:TTAF|TT(?:AF)?|TSN)[:\s]*([\d.,]+)"),
        "engine_hours": number(r"(?i)(?:TTE|TSOH|TTSN|Motorstunden|Motor)[:\s]*([\d.,]+)"), "cycles": F.floor(number(r"(?i)(?:LDG|Ldg\.?|Landungen|Zyklen)[:\s]*([\d.,]+)")),
        "annual_inspection": F.trim(found(text, r"(?iu)(?:TP|JNP|HU|Jahresnachpr[üu]fung|Prüfung)[:\s]*([\d./]+(?:\s*\d{4})?)")), "price": F.col("__p.amount"), "price_negotiable": F.col("__p.negotiable"), "city": F.col("__l.city"),
        "country": F.coalesce(F.col("__l.country"), looked_up(F.substring("icao", 1, 2), T.ICAO_COUNTRIES)), "registration": found(text, ANY_REGISTRATION), "serial_number": found(text, SERIAL), "airworthy": C.airworthy(text),
        "contact_name": F.col("__c.name"), "contact_email": F.col("__c.email"), "contact_phone": F.col("__c.phone"),
        "image_urls": F.transform(pictures, lambda s: F.when(s.startswith("http"), s).when(s.startswith("/"), F.concat(origin(F.col("page_url")), s)).otherwise(F.concat(origin(F.col("page_url")), F.lit("/"), s))),
    })
    return _typed(df, schemas.LISTING)


def url_hints(page_url: Column) -> Column:
    """A struct of category and maker that a page's URL names."""
    s = segments(page_url)
    return F.struct(looked_up(F.try_element_at(s, F.lit(1)), T.URL_CATEGORY_HINTS).alias("category"), F.trim(F.regexp_replace(F.try_element_at(s, F.lit(2)), "-", " ")).alias("manufacturer"))


def model_links(html: Column, page: Column) -> Column:
    """Distinct URLs of model pages."""
    hrefs = F.regexp_extract_all(html, F.lit(r"""(?is)<a\s[^>]*href=["']([^"']*--xm[^"']*\.htm)["']"""), F.lit(1))
    return F.array_distinct(F.transform(hrefs, lambda h: F.when(h.startswith("http"), h).when(h.startswith("/"), F.concat(origin(page), h)).otherwise(F.concat(origin(page), F.lit("/"), h))))


def next_page(html: Column, page: Column) -> Column:
    """The URL behind `Weiter` or », or a pager's next link."""
    from aerolith.functions.urls import absolute

    word = r"""(?is)<a\s[^>]*href=["']([^"']+)["'][^>]*>\s*(?:Weiter|»|&raquo;)\s*</a>"""
    pager = r"""(?is)<li[^>]*class=["'][^"']*page-next[^"']*["'][^>]*>\s*<a\s[^>]*href=["']([^"']+)["']"""
    href = F.coalesce(F.try_element_at(F.regexp_extract_all(html, F.lit(word), F.lit(1)), F.lit(-1)), found(html, pager))
    return absolute(href, page)


GRID = Cards(
    "div.listview-item",
    {"maker": (".new-lfz-description h2 strong", "text"), "model": (".new-lfz-description h3 strong", "text"), "price": ("p.price span", "text"), "text": ("", "text"), "html": ("", "html"), "images": ("img.img-fluid", "all:src")},
    {"link": ((".new-lfz-description h2 a", "attr:href"), ("a[href][title]", "attr:href"))},
)


def _grid(pages: DataFrame, source: str, site: str) -> DataFrame:
    df = pages.withColumn("__r", cards(F.col("payload"), GRID)).select("page_url", F.explode("__r").alias("c"))
    get = lambda k: F.col("c").getItem(k)
    df = df.withColumns({"maker": F.trim(F.coalesce(get("maker"), F.lit(""))), "model": F.trim(F.coalesce(get("model"), F.lit(""))), "text": F.coalesce(get("text"), F.lit("")), "link": get("link")})
    df = df.withColumn("title", F.trim(F.concat_ws(" ", given(F.col("maker")), given(F.col("model"))))).where(F.length("title") >= 3)
    pictures = F.filter(F.split(F.coalesce(get("images"), F.lit("")), "\n"), lambda s: (s != "") & ~s.rlike("no_image|banner|logo"))
    df = df.withColumn("__p", N.labelled_price(F.coalesce(get("price"), F.lit("")))).withColumn("__c", X.contact(get("html"), F.col("text")))
    url = F.when(F.col("link").isNotNull(), on_site(F.col("link"), site)).otherwise(F.col("page_url"))
    return df.withColumns({
        "source_id": url, "source_url": url, "source_name": F.lit(source), "price": F.col("__p.amount"), "image_urls": F.transform(pictures, lambda s: on_site(s, site)),
        "contact_name": F.col("__c.name"), "contact_email": F.col("__c.email"), "contact_phone": F.col("__c.phone"),
    })


def grid_aircraft(pages: DataFrame, source: str, site: str, closing: str) -> DataFrame:
    """Cards of a grid; those of years before 1900 are dropped. closing ends the description."""
    df = _grid(pages, source, site)
    text = F.col("text")
    number = lambda regex: N.german_number(found(text, regex))
    df = df.withColumn("year", found(text, r"Baujahr:\s*(\d{4})").try_cast("int")).where("year IS NULL OR year >= 1900")
    place = F.trim(F.element_at(F.split(F.trim(found(text, r"(?iu)(?:Standort|Ort)[:\s]*([A-Za-zÄÖÜäöüß\s\-,]+)")), "[\n,]"), 1))
    df = df.withColumn("location", place)
    df = df.withColumns({
        "price_negotiable": F.col("__p.negotiable"), "total_time": number(r"(?i)(?:TTAF|TT(?:AF)?|Betriebsstunden|Flugstunden)[:\s]*([\d.,]+)"), "engine_hours": number(r"(?i)(?:Motorstunden|TTSN|TTE)[:\s]*([\d.,]+)"),
        "cycles": F.floor(number(r"(?i)(?:Landungen|LDG|Ldg\.?)[:\s]*([\d.,]+)")), "city": given(F.trim(F.element_at(F.split("location", "[/(,]"), 1))), "icao": found(F.col("location"), r"\(([A-Z]{4})\)"),
        "description": listing_description(F.col("maker"), F.col("model"), F.col("year"), F.col("price"), F.col("__p.negotiable"), closing),
    })
    return _typed(df, schemas.LISTING)


def grid_parts(pages: DataFrame, source: str, site: str) -> DataFrame:
    """Cards of parts; the page's URL names the category."""
    df = _grid(pages, source, site)
    url = F.lower("page_url")
    kind = F.when(url.contains("avionik") | url.contains("instrumente"), "avionics").when(url.contains("triebwerk"), "engines").otherwise("miscellaneous")
    return _typed(df.withColumns({"category": kind, "price_negotiable": F.col("price").isNull(), "description": F.col("title")}), schemas.PART)


DETAIL = Cards("html, body", {"text": ("main, .cms-page, .container--main, #content, article", "text"), "body": ("body", "text"), "images": (".product-image-gallery img, .gallery-slider img, .product-images img, .cms-block-gallery img", "all:src")})
FOLDS = Folds(
    "main, .cms-page, .container--main, #content, article",
    (
        ("within", ".accordion-item", ".accordion-button, .accordion-header button, .accordion-header h3, .accordion-header h4, .accordion-header .h5", ".accordion-body, .accordion-collapse"),
        ("target", "[data-bs-toggle='collapse'], [data-toggle='collapse']"),
        ("rest", "details", "summary"),
        ("next", ".card-header, .panel-heading, .collapsible-header", ".card-body, .panel-body, .collapsible-body, .collapse"),
    ),
)
#: The names of the sections that a detail page may have, in the order in which they are looked for.
SECTIONS = {
    "more": ("sonstige informationen", "sonstige", "additional information"), "inside": ("interior", "innen", "innenausstattung"),
    "gear": ("avionik & instrumente", "avionik", "instruments"), "outside": ("exterior", "außen", "aussenbereich"),
}

#: Labels of a detail page, with a unit where one is needed.
DETAIL_NUMBERS = {
    "total_time": r"(?iu)(?:Total\s*Time|Betriebsstunden|TTAF|TT(?:AF)?|Flugstunden|time\s+state\s+Airframe)[:\s]*([\d.,]+)",
    "engine_hours": r"(?iu)(?:Motorstunden|TTSN|TTE|Motorbetriebs|Engine\s+Hours)[:\s]*([\d.,]+)",
    "cycles": r"(?iu)(?:Landungen|LDG|Ldg\.?|Zyklen|Landings)[:\s]*([\d.,]+)",
    "empty_weight": r"(?iu)(?:Leergewicht|Leermasse|Empty\s+Weight)[:\s]*([\d.,]+)\s*(?:kg|lbs?)",
    "max_takeoff_weight": r"(?iu)(?:MTOW|Abflugmasse|Abfluggewicht|MAUW|Max.*Takeoff)[:\s]*([\d.,]+)\s*(?:kg|lbs?)",
    "fuel_capacity": r"(?iu)(?:Tankinhalt|Kraftstoffmenge|Tank\s+capacity|Fuel\s+Capacity|Tank)[:\s]*([\d.,]+)\s*(?:l|gal)",
    "cruise_speed": r"(?iu)(?:Reisegeschwindigkeit|Reise(?:geschw\.?)?|Vcr|cruise\s+at)[:\s]*([\d.,]+)\s*(?:km/h|kts?|knots?)",
    "max_speed": r"(?iu)(?:Höchstgeschwindigkeit|Vne|Vmax|Max.*speed)[:\s]*([\d.,]+)\s*(?:km/h|kts?)",
    "max_range": r"(?iu)(?:Reichweite|Range)[:\s]*([\d.,]+)\s*(?:km|nm)",
    "service_ceiling": r"(?iu)(?:Gipfelhöhe|Dienstgipfelhöhe|Betriebshöhe|Service\s+Ceiling)[:\s]*([\d.,]+)\s*(?:m|ft)",
    "climb_rate": r"(?iu)(?:Steigleistung|Steigrate|Climb\s+Rate)[:\s]*([\d.,]+)\s*(?:m/s|ft/min|fpm)",
    "fuel_consumption": r"(?iu)(?:Verbrauch|Kraftstoffverbrauch|Fuel\s+Consumption)[:\s]*([\d.,]+)\s*(?:l/h|ltr/h|gal/h)",
}


def with_details(listings: DataFrame, details: DataFrame) -> DataFrame:
    """Listings with what their detail pages (page_url, payload) add; a detail wins over the card, and a listing without
    a page stays as it is."""
    d = details.select(F.col("page_url").alias("__u"), F.col("payload").alias("__h"), cards_and_folds(F.col("payload"), DETAIL, FOLDS).alias("__p"))
    d = d.select("__u", "__h", F.col("__p.cards")[0].alias("__c"), F.col("__p.folds").alias("__s"))
    d = d.withColumn("__t", F.regexp_replace(F.coalesce(F.col("__c").getItem("text"), F.col("__c").getItem("body"), F.lit("")), r"\s+", " "))
    d = d.withColumns({f"__{name}": F.coalesce(*[F.try_element_at("__s", F.lit(x)) for x in heads]) for name, heads in SECTIONS.items()})
    text = F.when(F.length("__more") > 50, F.concat_ws(" ", "__more", "__t")).otherwise(F.col("__t"))
    d = d.withColumn("__x", text).withColumn("__k", X.contact(F.col("__h"), F.col("__x")))
    joined = listings.join(d, F.col("source_url") == F.col("__u"), "left")
    x = F.col("__x")
    furnished = F.length("__inside") > 20
    told = F.concat(F.col("__more"), F.when(furnished, F.concat(F.lit(" Interior: "), F.col("__inside"))).otherwise(""))
    own = F.coalesce("description", F.lit(""))
    told = F.when(F.length("__more") > 50, F.when(F.length(told) > F.length(own), told)).when(furnished & ~own.contains(F.substring("__inside", 1, 30)), F.concat_ws(" ", given(own), F.col("__inside")))
    place = F.trim(found(x, r"(?iu)(?:Standort|Heimatflugplatz)[:\s]*([^\n;,]{3,60})"))
    code = F.coalesce(found(place, r"\(([A-Z]{4})\)"), found(place, "/([A-Z]{4})$"), found(x, ICAO_IN_TEXT))
    pictures = F.filter(F.split(F.coalesce(F.col("__c").getItem("images"), F.lit("")), "\n"), lambda s: (s != "") & ~s.rlike("logo|icon|no_image|banner|placeholder"))
    # equipment: the parts of both sections, each once whatever its case, else lines with words of avionics
    parts = F.flatten(F.transform(F.filter(F.array("__outside", "__gear"), lambda s: F.length(s) > 10), lambda s: F.transform(F.split(s, r"(?<=[a-zA-Z0-9])\s{2,}|[•·-]\s*"), lambda p: F.trim(p))))
    parts = X.keep_first(F.filter(parts, lambda s: (F.length(s) > 3) & (F.length(s) < 300)), 0, F.lower)
    lines = F.filter(F.transform(F.split(x, "[•\n]"), lambda s: F.trim(s)), lambda s: (F.length(s) > 2) & (F.length(s) < 200) & s.rlike("|".join(T.DETAIL_AVIONICS_WORDS)))
    gear = F.coalesce(given(F.array_join(parts, "; ")), given(F.array_join(lines, "; ")))
    new = {name: N.german_number(found(x, regex)) for name, regex in DETAIL_NUMBERS.items()} | {
        "description": told, "avionics": gear,
        "annual_inspection": F.trim(found(x, r"(?iu)(?:Jahresnachpr[üu]fung|JNP|Annual\s+Inspection|TP|HU)[:\s]*([\w\s./]+?\d{4})")), "engine": F.trim(found(x, r"(?iu)(?:Triebwerk|Motortyp|Motor)\s*:\s*([^;\n,.]{5,60})")),
        "registration": F.coalesce(found(x, MARKED_REGISTRATION), found(x, ANY_REGISTRATION)), "serial_number": found(x, SERIAL), "airworthy": C.airworthy(x), "fuel_type": C.fuel_type(x), "location": place,
        "city": given(F.trim(F.element_at(F.split(place, "[/(,]"), 1))), "icao": code, "country": looked_up(F.substring(code, 1, 2), T.ICAO_COUNTRIES), "contact_name": F.col("__k.name"), "contact_email": F.col("__k.email"),
        "contact_phone": F.col("__k.phone"), "image_urls": F.when(F.size(pictures) > 0, F.transform(pictures, lambda s: F.when(s.startswith("http"), s).otherwise(F.concat(origin(F.col("source_url")), s)))),
    }
    return _typed(joined.withColumns({k: over(v, F.col(k)) for k, v in new.items()}), schemas.LISTING)


#: What a grid's descriptions end with.
GRID_SITE, GRID_CLOSING = "https://www.aeromarkt.net", "Angebot auf aeromarkt.net"
#: Source -> function from pages (page_url, payload) to listings, and to parts.
LISTING_PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "helmuts-ul-seiten.de": lambda pages: prose_aircraft(pages, "helmuts-ul-seiten.de"),
    "aircraft24.de": lambda pages: index_cards(pages, "aircraft24.de"),
    "aeromarkt.net": lambda pages: grid_aircraft(pages, "aeromarkt.net", GRID_SITE, GRID_CLOSING),
}
PART_PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "helmuts-ul-seiten.de": lambda pages: prose_parts(pages, "helmuts-ul-seiten.de"),
    "aeromarkt.net": lambda pages: grid_parts(pages, "aeromarkt.net", GRID_SITE),
}
