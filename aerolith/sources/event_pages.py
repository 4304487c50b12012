"""Event pages of the sources: which cards a page has, and what their strings mean.

Each source is a function from landed payloads (page_url, payload) to events (schemas.EVENT) and drop_reason. Cards are
cut out of the page once, as strings; titles, dates, places and keys are column expressions. Rows that lack what a source
must have get the first reason why they are dropped, as the sources' rules say; everything else is left to validation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.functions import dates as D
from aerolith.functions import text as X
from aerolith.functions.classify import category_of_number, event_category, text_country, venue_country
from aerolith.functions.core import first_case, found, given, once
from aerolith.functions.keys import content_id
from aerolith.functions.urls import https as _https
from aerolith.functions.urls import on_site
from aerolith.operators.scratch import scratch_path
from aerolith.rules import tables as T
from aerolith.sources import ics
from aerolith.sources.cards import Cards, Sections, cards, sections

BERLIN = "Europe/Berlin"


def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _exploded(pages: DataFrame, rows: Column) -> DataFrame:
    return pages.withColumn("__rows", rows).select("*", F.posexplode("__rows").alias("__pos", "c")).drop("__rows", "payload")


def _field(name: str) -> Column:
    return F.col("c").getItem(name)


def _clean(name: str) -> Column:
    return X.clean_text(F.coalesce(_field(name), F.lit("")))


def _gate(df: DataFrame, ok: Column | str, reason: str) -> DataFrame:
    """df with a reason for rows that fail a test and have none yet."""
    ok = F.expr(ok) if isinstance(ok, str) else ok
    failed = F.when(~F.coalesce(ok, F.lit(False)), reason)
    return df.withColumn("drop_reason", F.coalesce("drop_reason", failed) if "drop_reason" in df.columns else failed)


def _range(df: DataFrame, range_: Column) -> DataFrame:
    return _gate(once(df, {"r": range_}), "r IS NOT NULL", "no-date").withColumn("start", F.col("r.start").cast("timestamp_ntz")).withColumn("end", F.col("r.end").cast("timestamp_ntz"))


def _event(df: DataFrame, source: str, **columns) -> DataFrame:
    """Events from columns; those that aren't given are null, or what most sources have."""
    base = {
        "source_url": F.col("page_url"), "source_category_id": F.lit(0), "subtitle": _null(), "date_range_text": _null(), "timezone": F.lit(BERLIN), "country": F.lit("DE"), "city": _null(),
        "icao": _null(), "description": _null(), "event_url": _null(), "latitude": _null("double"), "longitude": _null("double"), "source_locale": F.lit("de"),
    } | columns
    order = ("page_url", "source_category_id", "category", "title", "subtitle", "date_range_text", "start", "end", "timezone", "country", "city", "venue", "icao", "organiser", "description", "event_url", "latitude", "longitude", "source_locale")
    base |= {k: F.col(k) for k in order if k not in base}
    url = base["source_url"]
    return df.select(base.get("source_id", url).alias("source_id"), url.alias("source_url"), F.lit(source).alias("source_name"), *[base[k].alias(k) for k in order], "drop_reason")


TABLE_ROWS = Cards("tr", {"title": (".pubcal_title", "text"), "date": (".pubcal_daterange.icon-clock", "text"), "subtitle": (".pubcal_daterange.icon-info", "text"), "venue": (".pubcal_location", "text"), "organiser": (".pubcal_cidname", "text")})


def vereinsflieger(pages: DataFrame) -> DataFrame:
    """Rows of a public calendar's table; the page's URL names the category."""
    df = _exploded(pages, cards(F.col("payload"), TABLE_ROWS)).withColumn("title", _clean("title"))
    df = _range(_gate(df, "title <> ''", "no-title"), D.german_range(_clean("date"))).withColumn("organiser", _clean("organiser"))
    df = _gate(df, "organiser <> ''", "no-organiser")
    number = found(F.col("page_url"), r"[?&]category=(\d+)").try_cast("int")
    number = F.when(number.between(1, 6), number).otherwise(6)
    df = df.withColumn("v", X.venue_icao(F.coalesce(_field("venue"), F.lit("")))).withColumn("number", number)
    url = content_id(F.col("page_url"), F.col("title"), D.iso(F.col("start")), F.col("organiser"))
    return _event(df, "vereinsflieger.de", source_url=url, source_category_id=F.col("number"), category=category_of_number(F.col("number")), subtitle=given(_clean("subtitle")), date_range_text=given(_clean("date")),
                  city=X.venue_city(F.col("v.name")), venue=F.coalesce(given(F.col("v.name")), F.lit("Unbekannt")), icao=F.col("v.icao"), source_locale=_null())


CMS_BLOCKS = Cards(
    "[data-history-node-id]",
    {
        "node": ("", "attr:data-history-node-id"), "start": (".field--name-field-startdatum .field__item", "text"), "end": (".field--name-field-enddatum .field__item", "text"),
        "venue": (".field--name-field-ort .field__item", "text"), "description": (".field--name-field-beschreibung .field__item", "html"), "alt": (".field--name-field-bild img", "attr:alt"),
        "heading": (".field--name-field-beschreibung h3, .field--name-field-beschreibung h4", "text"),
    },
)


def dulv(pages: DataFrame) -> DataFrame:
    df = _exploded(pages, cards(F.col("payload"), CMS_BLOCKS)).withColumn("node", F.trim(_field("node")))
    df = _gate(df, "node <> ''", "no-node")
    start, end = _clean("start"), _clean("end")
    df = df.withColumn("dates", F.when((end != "") & (end != start), F.concat(start, F.lit(" - "), end)).otherwise(start))
    df = _range(df, D.german_range(F.col("dates"))).withColumn("description", F.substring(_clean("description"), 1, 1200))
    alt, heading = _clean("alt"), _clean("heading")
    sentence = F.trim(F.element_at(F.split("description", r"(?<=(?<!\d)[.!?])\s+"), 1))
    title = F.when((alt != "") & alt.rlike(r"[\s-]"), alt).when(heading != "", heading).when(sentence != "", F.trim(F.substring(sentence, 1, 120))).when(alt != "", alt).otherwise("DULV Veranstaltung")
    df = df.withColumn("title", title).withColumn("venue_raw", _clean("venue"))
    df = df.withColumn("v", X.venue_icao(F.coalesce(given(F.col("venue_raw")), F.col("title"))))
    url = F.concat(F.lit("https://www.dulv.de/node/"), F.col("node"))
    city = F.coalesce(X.venue_city(F.col("venue_raw")), given(F.trim(F.element_at(F.split(F.col("v.name"), "[,(]"), 1))))
    return _event(df, "dulv.de", source_url=url, category=event_category("dulv.de", F.col("title")), date_range_text=F.col("dates"), city=city, venue=F.coalesce(given(F.col("v.name")), F.col("title")), icao=F.col("v.icao"),
                  organiser=F.lit("DULV"), description=given(F.col("description")), event_url=url)


PROSE = Sections("h2", "p", {"cancelled": ("del", "has"), "link": ("a", "attr:href")})


def pilotenausbildung(pages: DataFrame) -> DataFrame:
    """Lines of prose below headings: date, title and place, joined by dashes. Struck-out lines are cancelled."""
    df = _exploded(pages, sections(F.col("payload"), PROSE))
    df = _gate(df, _field("cancelled").isNull(), "cancelled")
    head = F.lower(_clean("head"))
    df = df.withColumn("category", first_case(*[(head.contains(part), code) for part, code in T.EVENT_SECTIONS])).withColumn("text", _clean("text"))
    df = _gate(_gate(df, "category IS NOT NULL", "other-section"), "text <> ''", "no-text")
    df = _range(df, D.loose_german_range(F.col("text"))).withColumn("d", D.strip_leading_date(F.col("text")))
    df = _gate(df.withColumn("t", X.split_title_location(F.col("d.rest"))).withColumn("title", F.col("t.title")), "title <> ''", "no-title")
    place = F.concat_ws(" ", F.coalesce(F.col("t.location"), F.lit("")), F.col("title"))
    df = df.withColumn("link", given(F.trim(_field("link")))).withColumn("v1", X.venue_icao(F.coalesce(F.col("t.location"), F.lit("")))).withColumn("v", F.when(F.col("v1.icao").isNotNull(), F.col("v1")).otherwise(X.venue_icao(place)))
    url = content_id(F.col("page_url"), F.col("title"), D.iso(F.col("start")), F.col("link"))
    described = F.when(F.col("t.location").isNotNull(), F.concat(F.col("title"), F.lit(" – "), F.col("t.location"))).otherwise(F.col("title"))
    return _event(df, "pilotenausbildung.net", source_url=url, date_range_text=F.col("d.date"), country=text_country(place), venue=F.coalesce(given(F.col("v.name")), F.col("t.location"), F.col("title")), icao=F.col("v.icao"),
                  organiser=F.lit("pilotenausbildung.net"), description=described, event_url=F.col("link"))


LIST_ITEMS = Cards("a.global-event-list-item", {"href": ("", "attr:href"), "title": (".global-event-list-title", "text"), "venue": (".global-event-list-item-venue", "text"), "date": (".global-event-list-item-date", "text")})


def iata(pages: DataFrame, now: Column) -> DataFrame:
    """Cards whose dates have no year: it follows from now."""
    df = _exploded(pages, cards(F.col("payload"), LIST_ITEMS)).withColumn("href", F.trim(F.coalesce(_field("href"), F.lit("")))).withColumn("title", _clean("title"))
    df = _gate(_gate(df, "href <> ''", "no-link"), "title <> ''", "no-title")
    df = _range(df, D.yearless_range(_clean("date"), now)).withColumn("v", _clean("venue")).withColumn("p", venue_country(F.col("v")))
    url = on_site(F.col("href"), "https://www.iata.org")
    described = F.when(F.col("v") != "", F.concat(F.col("title"), F.lit(" – "), F.col("v"))).otherwise(F.col("title"))
    return _event(df, "iata.org", source_url=url, category=event_category("iata.org", F.col("title")), date_range_text=given(_clean("date")), timezone=F.lit("UTC"), country=F.col("p.country"), city=F.col("p.city"),
                  venue=F.coalesce(given(F.col("v")), F.col("title")), organiser=F.lit("IATA"), description=described, event_url=url, source_locale=F.lit("en"))


ARTICLES = Cards(
    "article", {"link": ("h3 a", "attr:href"), "title": ("h3 a", "text"), "date": (".article-time", "text")},
    {"headline": ((".article-item-content [data-headline], .article-item-content .article-headline, .article-headline", "text"),)},
)


def map_coordinates(payload: Column) -> Column:
    """map of URL to (lat, lon) from a page's embedded map data."""
    raw = F.regexp_replace(F.regexp_extract(payload, r"data-data='(\{[^']+\})'", 1), "&quot;", '"')
    entries = F.map_values(F.from_json(raw, "map<string,struct<lat:string,long:string,url:string>>"))
    good = F.filter(entries, lambda e: (e["url"] != "") & e["lat"].try_cast("double").isNotNull() & e["long"].try_cast("double").isNotNull())
    pairs = F.transform(good, lambda e: F.struct(e["url"].alias("key"), F.struct(e["lat"].try_cast("double").alias("lat"), e["long"].try_cast("double").alias("lon")).alias("value")))
    # the last of equal URLs counts
    last = F.filter(pairs, lambda p, k: ~F.exists(F.slice(pairs, k + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def fliegermagazin(pages: DataFrame) -> DataFrame:
    df = _exploded(pages.withColumn("coords", map_coordinates(F.col("payload"))), cards(F.col("payload"), ARTICLES))
    df = df.withColumn("link", F.trim(F.coalesce(_field("link"), F.lit("")))).withColumn("title", _clean("title"))
    df = _gate(_gate(df, "link LIKE '%/termine/%'", "other-link"), "title <> ''", "no-title")
    df = _range(df, D.german_range(D._spaced(_clean("date")))).withColumn("at", F.try_element_at("coords", F.col("link")))
    kind = _clean("headline")
    return _event(df, "fliegermagazin.de", source_url=F.col("link"), category=event_category("fliegermagazin.de", F.col("title"), kind), subtitle=given(kind), date_range_text=given(_clean("date")), venue=F.col("title"),
                  organiser=F.lit("fliegermagazin.de"), event_url=F.col("link"), latitude=F.col("at.lat"), longitude=F.col("at.lon"))


def ulforum(pages: DataFrame) -> DataFrame:
    """JSON-LD events, one or an array in each script: each script is parsed once, to a variant, and fields are taken from
    that, whatever they hold; a field of another kind than asked for is its text."""
    scripts = F.regexp_extract_all("payload", F.lit(r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""), F.lit(1))
    df = once(pages.withColumn("raw", F.explode(scripts)).drop("payload"), {"__v": F.try_parse_json(F.trim("raw"))}).where("__v IS NOT NULL")
    many = F.schema_of_variant("__v").startswith("ARRAY")
    df = df.withColumn("__e", F.explode(F.when(many, F.try_variant_get("__v", "$", "array<variant>")).otherwise(F.array("__v"))))
    at = lambda path: F.try_variant_get("__e", path, "string")
    paths = {"type": "$['@type']", "name": "$.name", "status": "$.eventStatus", "start": "$.startDate", "end": "$.endDate", "place": "$.location.name", "address": "$.location.address", "street": "$.location.address.streetAddress",
             "organizer": "$.organizer.name", "offer": "$.offers.url", "url": "$.url", "description": "$.description"}
    df = once(df, {"e": F.struct(*[at(path).alias(name) for name, path in paths.items()])}).drop("__v", "__e", "raw").where("e.type = 'Event'")
    df = df.withColumn("title", X.clean_text(F.coalesce(F.col("e.name"), F.lit(""))))
    df = _gate(_gate(df, "title <> ''", "no-title"), "NOT coalesce(e.status LIKE '%EventCancelled%', false)", "cancelled")
    df = _gate(df.withColumn("start", D.midnight(F.col("e.start")).cast("timestamp_ntz")), "start IS NOT NULL", "no-date").withColumn("end", F.coalesce(D.midnight(F.col("e.end")).cast("timestamp_ntz"), F.col("start")))
    raw_venue = F.coalesce(F.col("e.place"), F.lit(""))
    address = F.when(F.col("e.address").startswith("{"), F.col("e.street")).otherwise(F.col("e.address"))
    df = df.withColumn("v", X.venue_icao(raw_venue)).withColumn("organiser", F.coalesce(given(F.trim("e.organizer")), F.lit("ulforum.de"))).withColumn("link", F.coalesce(given(F.trim("e.offer")), given(F.trim("e.url"))))
    url = F.coalesce(F.col("link"), content_id(F.col("page_url"), F.col("title"), F.date_format("start", "yyyy-MM-dd"), F.col("organiser")))
    return _event(df, "ulforum.de", source_url=url, category=event_category("ulforum.de", F.col("title")), city=F.coalesce(X.venue_city(F.coalesce(address, F.lit(""))), X.venue_city(raw_venue)), venue=F.coalesce(given(F.col("v.name")), F.lit("Unbekannt")),
                  icao=F.col("v.icao"), description=given(X.clean_text(F.col("e.description"))), event_url=F.col("link"))


MENU = Cards(
    ".menu-event-single", {"date": (".event-date", "text"), "location": (".location", "text"), "excerpt": (".menu-event-excerpt p", "text")},
    {"title": ((".menu-event-title a", "text"), (".menu-event-title", "text")), "href": ((".menu-event-title a", "attr:href"), ("a.image-wrapper", "attr:href"))},
)


def nbaa(pages: DataFrame) -> DataFrame:
    df = _gate(_exploded(pages, cards(F.col("payload"), MENU)).withColumn("title", _clean("title")), "title <> ''", "no-title")
    df = _range(df, D.us_range(_clean("date"))).withColumn("place", _clean("location"))
    link = F.when(F.coalesce(F.trim(_field("href")), F.lit("")) != "", on_site(F.trim(_field("href")), "https://nbaa.org"))
    df = df.withColumn("link", link)
    state = r"^([^,]+),\s*([A-Z]{2})$"
    city = F.when(F.col("place").rlike(state), F.trim(F.regexp_extract("place", state, 1))).when(~F.col("place").rlike("(?i)^(online|virtual)$"), given(F.col("place")))
    url = F.coalesce(F.col("link"), content_id(F.col("page_url"), F.col("title"), D.iso(F.col("start"))))
    return _event(df, "nbaa.org", source_url=url, category=event_category("nbaa.org", F.col("title")), date_range_text=given(_clean("date")), timezone=F.lit("UTC"), country=F.lit("US"), city=city,
                  venue=F.coalesce(given(F.col("place")), F.col("title")), organiser=F.lit("NBAA"), description=given(_clean("excerpt")), event_url=F.col("link"), source_locale=F.lit("en"))


NODES = Cards(
    ".node--event", {"start": (".field--date-range time", "attr:datetime"), "end": (".field--date-range time", "last:datetime"), "dates": (".field--date-range", "text"), "kind": (".field--ref-event-type", "text"), "href": (".card-footer a", "attr:href")},
    {"title": ((".field--promo-title h3", "text"), (".field--promo-title", "text"))},
)


def eurocontrol(pages: DataFrame) -> DataFrame:
    df = _gate(_exploded(pages, cards(F.col("payload"), NODES)).withColumn("title", _clean("title")), "title <> ''", "no-title")
    start, end = D.midnight(_field("start")), D.midnight(F.coalesce(_field("end"), _field("start")))
    df = _range(df, F.when(start.isNotNull() & end.isNotNull(), F.struct(start.alias("start"), end.alias("end")))).withColumn("kind", _clean("kind"))
    df = df.withColumn("link", F.when(F.coalesce(F.trim(_field("href")), F.lit("")) != "", on_site(F.trim(_field("href")), "https://www.eurocontrol.int")))
    url = F.coalesce(F.col("link"), content_id(F.col("page_url"), F.col("title"), D.iso(F.col("start"))))
    described = F.when(F.col("kind") != "", F.concat(F.col("kind"), F.lit(" — "), F.col("title"))).otherwise(F.col("title"))
    return _event(df, "eurocontrol.int", source_url=url, category=event_category("eurocontrol.int", F.col("title"), F.col("kind")), subtitle=given(F.col("kind")), date_range_text=given(_clean("dates")), timezone=F.lit("UTC"), country=F.lit("BE"),
                  venue=F.col("title"), organiser=F.lit("Eurocontrol"), description=described, event_url=F.col("link"), source_locale=F.lit("en"))


HOME = Cards("html", {"lang": ("", "attr:lang"), "page_title": ("title", "text"), "date": (".date", "text"), "body": ("body", "text"), "og": ("meta[property='og:description']", "attr:content"), "meta": ("meta[name='description']", "attr:content")})
FAIR_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December|Januar|Februar|März|Mai|Juni|Juli|Oktober|Dezember"


def aero(pages: DataFrame) -> DataFrame:
    """A fair's home page: the date in the title, in a block of its own, or in the text."""
    df = _exploded(pages, cards(F.col("payload"), HOME))
    in_title = F.trim(found(F.coalesce(_field("page_title"), F.lit("")), r"(?i)^([^|]+?)\s*\|\s*AERO"))
    in_text = found(_clean("body"), rf"(?iu)(?<![A-Za-z0-9_])(?:{FAIR_MONTHS})\s+\d{{1,2}}\s*(?:[-–—]\s*(?:(?:{FAIR_MONTHS})\s+)?\d{{1,2}})?,?\s*\d{{4}}", 0)
    tries = F.array(*[F.struct(x.alias("text"), D.fair_range(x).alias("range")) for x in (in_title, _clean("date"), in_text)])
    df = df.withColumn("best", F.try_element_at(F.filter(tries, lambda t: t["range"].isNotNull()), F.lit(1)))
    df = _range(df, F.col("best.range")).withColumn("year", F.date_format("start", "yyyy"))
    german = F.coalesce(F.lower(_field("lang")).startswith("de"), F.lit(False))
    text = X.clean_text(F.coalesce(given(_field("og")), _field("meta"), F.lit("")))
    url = F.concat(F.regexp_replace("page_url", "/$", ""), F.lit("/#"), F.col("year"))
    return _event(df, "aero-expo.com", source_url=url, category=F.lit("trade-fair"), title=F.concat(F.lit("AERO Friedrichshafen "), F.col("year")), subtitle=F.when(german, "Die Leitmesse für die Allgemeine Luftfahrt").otherwise("The Leading Show for General Aviation"),
                  date_range_text=F.col("best.text"), city=F.lit("Friedrichshafen"), venue=F.lit("Messe Friedrichshafen"), icao=F.lit("EDNY"), organiser=F.lit("Messe Friedrichshafen GmbH"), description=given(text), event_url=F.col("page_url"),
                  latitude=F.lit(47.6716), longitude=F.lit(9.5111), source_locale=F.when(german, "de").otherwise("en"))


#: What is read of a feed; an element that comes several times counts once, the first time.
FEED_TAGS = ("title", "link", "description", "dc:creator", "mec:startDate", "mec:endDate", "mec:location")
FEED = "channel struct<item: array<struct<" + ", ".join(f"`{x}`: array<string>" for x in FEED_TAGS) + ">>>"


def pilot_frank(pages: DataFrame) -> DataFrame:
    """An RSS feed with elements of two other namespaces, read by Spark's XML parser. Anything but XML has no events; XML
    that doesn't parse has a row with a reason. Entities that XML does not know are left for the texts' own cleaning."""
    sound = F.regexp_replace(F.ltrim("payload"), "&(?!(?:amp|lt|gt|quot|apos|#\\d+|#x[0-9A-Fa-f]+);)", "&amp;")
    df = once(pages.where(F.ltrim("payload").startswith("<?xml")), {"__x": F.from_xml(sound, FEED)}).drop("payload")
    kind = df.select("__x.channel.item").schema["item"].dataType
    items = F.when(F.col("__x.channel").isNull(), F.array(F.lit(None)).cast(kind)).otherwise(F.coalesce("__x.channel.item", F.array().cast(kind)))
    df = df.withColumn("item", F.explode(items)).drop("__x")
    tag = lambda name: F.coalesce(F.try_element_at(F.col(f"item.`{name}`"), F.lit(1)), F.lit(""))
    df = _gate(df, F.col("item").isNotNull(), "malformed-xml").withColumn("title", X.clean_text(tag("title")))
    df = _gate(df, "title <> ''", "no-title").withColumn("start", D.midnight(tag("mec:startDate")).cast("timestamp_ntz"))
    df = _gate(df, "start IS NOT NULL", "no-date").withColumn("end", F.coalesce(D.midnight(tag("mec:endDate")).cast("timestamp_ntz"), F.col("start")))
    df = df.withColumn("link", given(F.trim(tag("link")))).withColumn("place", X.clean_text(tag("mec:location"))).withColumn("organiser", F.coalesce(given(X.clean_text(tag("dc:creator"))), F.lit("pilot-frank.de"))).withColumn("v", X.venue_icao(F.col("place")))
    url = F.coalesce(F.col("link"), content_id(F.col("page_url"), F.col("title"), F.date_format("start", "yyyy-MM-dd"), F.col("organiser")))
    return _event(df, "pilot-frank.de", source_url=url, category=event_category("pilot-frank.de", F.col("title")), city=X.venue_city(F.col("place")), venue=F.coalesce(given(F.col("v.name")), given(F.col("place")), F.col("title")),
                  icao=F.coalesce(F.col("v.icao"), found(F.col("title"), r"\(\s*([A-Z]{4})\s*\)")), description=X.feed_description(tag("description")), event_url=F.col("link"))


def calendar_feeds(pages: DataFrame, now: Column, calendars: DataFrame | None) -> DataFrame:
    """Calendars: each feed's settings (schemas.CALENDAR) are those of its URL; a feed without any has none but its URL."""
    names = [x.split()[0] for x in schemas.CALENDAR.split(", ")]
    if calendars is None:
        calendars = pages.sparkSession.createDataFrame([], schemas.CALENDAR)
    known = calendars.select(_https(F.col("url")).alias("__u"), *[F.col(n).alias(f"__{n}") for n in names if n != "url"])
    feeds = pages.join(known, _https(F.col("page_url")) == F.col("__u"), "left")
    own = {n: F.col(f"__{n}") for n in names if n != "url"}
    own["name"] = F.coalesce(own["name"], "page_url")
    return ics.calendar_rows(feeds.select(F.col("page_url").alias("url"), "payload", *[v.alias(n) for n, v in own.items()]), now)


#: Source -> function from pages to events and drop_reason.
PARSERS: dict[str, Callable[..., DataFrame]] = {
    "vereinsflieger.de": vereinsflieger, "dulv.de": dulv, "pilotenausbildung.net": pilotenausbildung, "iata.org": iata, "fliegermagazin.de": fliegermagazin, "ulforum.de": ulforum,
    "nbaa.org": nbaa, "eurocontrol.int": eurocontrol, "aero-expo.com": aero, "pilot-frank.de": pilot_frank, "ics-feed": calendar_feeds,
}


def page_count(source: str, payload: Column) -> Column:
    """How many pages a source's list has, by what one page says, with the source's own limit; 1 for others."""
    numbers = lambda regex: F.coalesce(F.array_max(F.transform(F.regexp_extract_all(payload, F.lit(regex), F.lit(1)), lambda x: x.try_cast("int"))), F.lit(0))
    if source == "fliegermagazin.de":
        n = found(F.regexp_replace(payload, "<[^>]*>", ""), r"(?i)Seite\s+\d+\s+von\s+(\d+)").try_cast("int")
        return F.when(n > 0, F.least(n, F.lit(20))).otherwise(1)
    if source == "iata.org":
        return F.least(F.greatest(numbers(r"""(?is)<a\s[^>]*href=["'][^"']*page=[^"']*["'][^>]*>\s*(\d+)\s*</a>"""), F.lit(1)), F.lit(20))
    if source in ("dulv.de", "eurocontrol.int"):
        return F.least(numbers(r"""(?is)<a\s[^>]*href=["'][^"']*[?&](?:amp;)?page=(\d+)"""), F.lit(9 if source == "dulv.de" else 19)) + 1
    return F.lit(1)


def page_urls(source: str, first: Column, pages: Column) -> Column:
    """The URLs of a list's pages, the first one included."""
    if source == "fliegermagazin.de":
        rest = lambda k: F.concat(F.regexp_replace(first, "/$", ""), F.lit("/seite/"), k.cast("string"), F.lit("/"))
        return F.transform(F.sequence(F.lit(1), pages), lambda k: F.when(k == 1, first).otherwise(rest(k)))
    start = 1 if source == "iata.org" else 0
    sign = F.when(first.contains("?"), "&page=").otherwise("?page=")
    return F.transform(F.sequence(F.lit(0), pages - 1), lambda k: F.when(k == 0, first).otherwise(F.concat(first, sign, (k + start).cast("string"))))


def rows_of(source: str, pages: DataFrame, now: Column, calendars: DataFrame | None = None) -> DataFrame:
    """Events of a source's pages (page_url, payload), with drop_reason."""
    pages = pages.where("payload IS NOT NULL").select("page_url", "payload")
    if source == "ics-feed":
        return calendar_feeds(pages, now, calendars)
    return PARSERS[source](pages, now) if source == "iata.org" else PARSERS[source](pages)


def parse(source: str, pages: DataFrame, now: Column, calendars: DataFrame | None = None) -> DataFrame:
    """The events of a source's pages that are not dropped."""
    return rows_of(source, pages, now, calendars).where("drop_reason IS NULL").drop("drop_reason")


def all_rows(landed: DataFrame, now: Column, sources: Iterable[str] = tuple(PARSERS), calendars: DataFrame | None = None) -> DataFrame:
    """Events of landed payloads (source, page_url, payload) of these sources, with drop_reason. A payload that is null
    has no events. For several sources the payloads are read once, and written to a folder for each source, of which
    each parser reads its own."""
    sources = list(sources)
    some = landed.where(F.col("source").isin(sources) & F.col("payload").isNotNull()).select("source", "page_url", "payload")
    if len(sources) > 1:
        path = scratch_path(landed.sparkSession, "landed")
        some.write.partitionBy("source").parquet(path)
        some = landed.sparkSession.read.schema("page_url string, payload string, source string").parquet(path)
    out = None
    for source in sources:
        found_ = rows_of(source, some.where(F.col("source") == source), now, calendars)
        out = found_ if out is None else out.unionByName(found_)
    return out


def events(landed: DataFrame, now: Column, sources: Iterable[str] = tuple(PARSERS), calendars: DataFrame | None = None) -> DataFrame:
    """The events of landed payloads that are not dropped."""
    return all_rows(landed, now, sources, calendars).where("drop_reason IS NULL").drop("drop_reason")


def drop_counts(rows: DataFrame) -> DataFrame:
    """(source_name, drop_reason, n) of the rows that parsers drop."""
    return rows.where("drop_reason IS NOT NULL").groupBy("source_name", "drop_reason").agg(F.count("*").alias("n"))
