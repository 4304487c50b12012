"""Queries over parsers: pages of each source's make are written from rows of tables, forty rows a page, and read back.

Rows break a source's rules in turn (no date, no organiser, cancelled), so that what is dropped is compared as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.plans.catalog import query
from aerolith.session import table
from aerolith.sources import event_pages, listing_pages

NOW = "2026-04-25 00:00:00"
PAGE = 40
SHOWN = (
    "source_url", "category", "title", "subtitle", "date_range_text", "start_day", "end_day", "timezone", "country", "city", "venue", "icao", "organiser", "description", "event_url", "source_locale",
    "latitude", "longitude",
)
BASE = f"""c AS (SELECT c_custkey AS k, c_custkey // {PAGE} AS p, c_nationkey AS n, c_mktsegment AS seg, DATE '2026-05-01' + (c_custkey % 200)::INT AS d,
  DATE '2026-05-01' + (c_custkey % 200 + c_custkey % 5)::INT AS e FROM customer)"""
ISO = "strftime(d, '%Y-%m-%dT00:00:00.000Z')"


def _oracle(where: str = "TRUE", **columns: str) -> str:
    """SQL of the columns that are shown; those that aren't given are null or what most sources have."""
    base = {name: "NULL::VARCHAR" for name in SHOWN} | {"latitude": "NULL::DOUBLE", "longitude": "NULL::DOUBLE", "timezone": "'Europe/Berlin'", "country": "'DE'", "start_day": "strftime(d, '%Y-%m-%d')", "end_day": "strftime(d, '%Y-%m-%d')", "source_locale": "'de'"}
    return f"WITH {BASE} SELECT {', '.join(f'{x} AS {name}' for name, x in (base | columns).items())} FROM c WHERE {where}"


def _shown(df: DataFrame) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return df.withColumn("start_day", day("start")).withColumn("end_day", day("end")).select(*SHOWN)


def _text(*parts) -> Column:
    """Strings and columns side by side; keys of rows are columns named k, n, p, seg, d and e."""
    return F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])


def _keys() -> list[Column]:
    return [F.col(x) for x in ("k", "n", "p", "seg", "d", "e")]


def _rows(spark, folder) -> DataFrame:
    first, k = F.lit("2026-05-01").cast("date"), F.col("c_custkey")
    c = table(spark, folder, "customer")
    return c.select(k.alias("k"), F.expr(f"c_custkey div {PAGE}").alias("p"), F.col("c_nationkey").alias("n"), F.col("c_mktsegment").alias("seg"), F.date_add(first, (k % 200).cast("int")).alias("d"), F.date_add(first, (k % 200 + k % 5).cast("int")).alias("e"))


def _pages(rows: DataFrame, url: Column, row: Column, head: Column | str = "", tail: str = "", order: str = "k", by: str = "p", joiner: str = "") -> DataFrame:
    """(page_url, payload): the rows of a page in order, between head and tail (head may use p and the first k)."""
    whole = rows.groupBy(by).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order), row.alias("row")))), lambda x: x["row"]), joiner).alias("rows"))
    return whole.select(url.alias("page_url"), _text(head if isinstance(head, Column) else F.lit(head), F.col("rows"), tail).alias("payload"))


def _parsed(source: str, pages: DataFrame) -> DataFrame:
    return _shown(event_pages.parse(source, pages, F.lit(NOW).cast("timestamp_ntz")))


def _case(key: Column, *values) -> Column:
    """The value of a key's remainder."""
    out = None
    for k, v in enumerate(values):
        v = v if isinstance(v, Column) else F.lit(v)
        out = F.when(F.pmod(key, F.lit(len(values))) == k, v) if out is None else out.when(F.pmod(key, F.lit(len(values))) == k, v)
    return out


def _day(c: Column, form: str = "dd.MM.yyyy") -> Column:
    return F.date_format(c, form)


_DE = "strftime({}, '%d.%m.%Y')"


@query(_oracle(
    "k % 11 <> 0 AND k % 7 <> 0",
    source_url=f"'https://v.example/?category=' || p % 8 || '#' || substr(sha1('Treffen & ' || seg || ' ' || k || '|' || {ISO} || '|LSV ' || n), 1, 16)",
    category="(['general','seminar','competition','flying-camp','airfield-festival','trade-fair','general','general'])[(p % 8 + 1)::INT]", title="'Treffen & ' || seg || ' ' || k",
    subtitle="CASE WHEN k % 3 > 0 THEN 'Info ' || k END", date_range_text=f"{_DE.format('d')} || CASE WHEN k % 2 = 0 THEN ' - ' || {_DE.format('e')} ELSE '' END", end_day="strftime(CASE WHEN k % 2 = 0 THEN e ELSE d END, '%Y-%m-%d')",
    city="CASE WHEN k % 4 = 2 THEN 'Ulm' END", venue="(['Unbekannt', 'Tannheim', 'Halle, Ulm', 'Flugplatz Nord'])[(k % 4 + 1)::INT]", icao="CASE k % 4 WHEN 1 THEN 'EDMT' WHEN 3 THEN 'EDNY' END", organiser="'LSV ' || n", source_locale="NULL::VARCHAR",
))
def parse_public_calendar(spark, folder):
    """Rows of a table, one page for each category and part of the members."""
    K, N, P, SEG, D, E = _keys()
    date = F.when(K % 11 == 0, "bald").when(K % 2 == 0, _text(_day(D), " - ", _day(E))).otherwise(_day(D))
    row = _text('<tr><td class="pubcal_title">Treffen &amp; ', SEG, " ", K, '</td><td class="pubcal_daterange icon-clock">', date, '</td><td class="pubcal_daterange icon-info">', F.when(K % 3 > 0, _text("Info ", K)).otherwise(""),
                '</td><td class="pubcal_location">', _case(K, "", "Tannheim (EDMT)", "Halle, Ulm", "Flugplatz EDNY Nord"), '</td><td class="pubcal_cidname">', F.when(K % 7 > 0, _text("LSV ", N)).otherwise(""), "</td></tr>")
    return _parsed("vereinsflieger.de", _pages(_rows(spark, folder), _text("https://v.example/?category=", P % 8), row, "<table>", "</table>"))


@query(_oracle(
    "k % 11 <> 0",
    source_url="'https://www.dulv.de/node/' || k", category="CASE WHEN k % 4 = 0 THEN 'seminar' ELSE 'meetup' END", title="CASE k % 4 WHEN 0 THEN 'Infotag UL ' || k WHEN 1 THEN 'Treffen ' || k WHEN 2 THEN 'Ein Satz hier.' ELSE 'plakat' END",
    date_range_text=f"{_DE.format('d')} || CASE WHEN k % 2 = 0 AND e <> d THEN ' - ' || {_DE.format('e')} ELSE '' END", end_day="strftime(CASE WHEN k % 2 = 0 THEN e ELSE d END, '%Y-%m-%d')",
    city="CASE k % 3 WHEN 0 THEN 'Ulm' WHEN 1 THEN 'Tannheim' ELSE CASE k % 4 WHEN 0 THEN 'Infotag UL ' || k WHEN 1 THEN 'Treffen ' || k WHEN 2 THEN 'Ein Satz hier.' ELSE 'plakat' END END",
    venue="CASE k % 3 WHEN 0 THEN 'Flugplatz, Ulm' WHEN 1 THEN 'Tannheim' ELSE CASE k % 4 WHEN 0 THEN 'Infotag UL ' || k WHEN 1 THEN 'Treffen ' || k WHEN 2 THEN 'Ein Satz hier.' ELSE 'plakat' END END", icao="CASE WHEN k % 3 = 1 THEN 'EDMT' END",
    organiser="'DULV'", description="CASE k % 4 WHEN 0 THEN 'Mehr ' || k WHEN 1 THEN 'Treffen ' || k || ' Text.' WHEN 2 THEN 'Ein Satz hier. Zweiter ' || k || '.' END", event_url="'https://www.dulv.de/node/' || k",
))
def parse_cms_blocks(spark, folder):
    K, _, P, _, D, E = _keys()
    start = F.when(K % 11 > 0, _day(D)).otherwise("")
    end = F.when(K % 11 == 0, "").when(K % 2 == 0, _day(E)).otherwise(_day(D))
    more = _case(K, _text("<p>Mehr ", K, "</p>"), _text("<h3>Treffen ", K, "</h3><p>Text.</p>"), _text("<p>Ein Satz hier. Zweiter ", K, ".</p>"), "")
    field = lambda name, x: _text(f'<div class="field--name-field-{name}"><div class="field__item">', x, "</div></div>")
    row = _text('<div data-history-node-id="', K, '"><div class="field--name-field-bild"><img alt="', F.when(K % 4 == 0, _text("Infotag UL ", K)).otherwise("plakat"), '"></div>', field("startdatum", start), field("enddatum", end),
                field("ort", _case(K, "Flugplatz, Ulm", "Tannheim (EDMT)", "")), field("beschreibung", more), "</div>")
    return _parsed("dulv.de", _pages(_rows(spark, folder), _text("https://l.example/", P), row))


_PROSE_DATE = "CASE WHEN k % 2 = 0 THEN strftime(d, '%d.%m.%Y') ELSE '3. – 5.' || strftime(d, '%m.%Y') END"
_PROSE_START = "CASE WHEN k % 2 = 0 THEN strftime(d, '%Y-%m-%d') ELSE strftime(d, '%Y-%m-03') END"


@query(_oracle(
    "k % 13 <> 0 AND k % 17 <> 0",
    source_url=f"'https://l.example/' || p || '#' || substr(sha1('Titel ' || seg || ' ' || k || '|' || {_PROSE_START} || 'T00:00:00.000Z|https://t.example/' || k), 1, 16)", category="(['trade-fair', 'airshow', 'meetup'])[(p % 3 + 1)::INT]", title="'Titel ' || seg || ' ' || k",
    date_range_text=f"{_PROSE_DATE} || ' –'", start_day=_PROSE_START, end_day="CASE WHEN k % 2 = 0 THEN strftime(d, '%Y-%m-%d') ELSE strftime(d, '%Y-%m-05') END",
    country="CASE WHEN k % 5 = 2 THEN 'AT' ELSE 'DE' END", venue="CASE k % 5 WHEN 0 THEN 'Titel ' || seg || ' ' || k WHEN 2 THEN 'Wels, Austria Titel ' || seg || ' ' || k ELSE 'Tannheim' END", icao="CASE WHEN k % 5 NOT IN (0, 2) THEN 'EDMT' END", organiser="'pilotenausbildung.net'",
    description="'Titel ' || seg || ' ' || k || CASE k % 5 WHEN 0 THEN '' WHEN 2 THEN ' – Wels, Austria' ELSE ' – Tannheim (EDMT)' END", event_url="'https://t.example/' || k",
))
def parse_prose_lines(spark, folder):
    """Lines below headings of three kinds, and below one that is no category."""
    K, _, P, SEG, D, _ = _keys()
    date = F.when(K % 17 == 0, "demnächst").when(K % 2 == 0, _day(D)).otherwise(_text("3. – 5.", _day(D, "MM.yyyy")))
    line = _text(date, ' – <a href="https://t.example/', K, '">Titel ', SEG, " ", K, "</a>", _case(K, "", " – Tannheim (EDMT)", " – Wels, Austria", " – Tannheim (EDMT)", " – Tannheim (EDMT)"))
    row = F.when(K % 13 == 0, _text("<p><del>", line, "</del></p>")).otherwise(_text("<p>", line, "</p>"))
    head = _text("<h2>", _case(P, "Luftfahrt Messen 2026", "Airshows", "Fly-Inns und Pilotentreffen"), "</h2>")
    return _parsed("pilotenausbildung.net", _pages(_rows(spark, folder), _text("https://l.example/", P), row, head, "<h2>Museen</h2><p>01.06.2026 – Nichts – Ulm</p>"))


_ROLLED = "strftime(d, '%-d %B') || CASE WHEN k % 2 = 1 THEN ' - ' || strftime(e, '%-d %B') ELSE '' END"


@query(_oracle(
    "k % 11 <> 0",
    source_url="'https://www.iata.org/e/' || k", category="(['seminar', 'trade-fair', 'general'])[(k % 3 + 1)::INT]", title="'World ' || (['Forum', 'Expo', 'Gala'])[(k % 3 + 1)::INT] || ' ' || k", date_range_text=_ROLLED,
    end_day="strftime(CASE WHEN k % 2 = 1 THEN e ELSE d END, '%Y-%m-%d')", timezone="'UTC'", country="(['CH', 'QA', 'XX', 'XX'])[(k % 4 + 1)::INT]", city="CASE k % 4 WHEN 0 THEN 'Geneva' WHEN 1 THEN 'Doha' END",
    venue="CASE k % 4 WHEN 0 THEN 'Geneva, Switzerland' WHEN 1 THEN 'Doha, Qatar' WHEN 2 THEN 'World ' || (['Forum', 'Expo', 'Gala'])[(k % 3 + 1)::INT] || ' ' || k ELSE 'Online' END", organiser="'IATA'",
    description="'World ' || (['Forum', 'Expo', 'Gala'])[(k % 3 + 1)::INT] || ' ' || k || (['  – Geneva, Switzerland', ' – Doha, Qatar', '', ' – Online'])[(k % 4 + 1)::INT]".replace("'  –", "' –"), event_url="'https://www.iata.org/e/' || k", source_locale="'en'",
))
def parse_list_items(spark, folder):
    K, _, P, _, D, E = _keys()
    date = F.when(K % 2 == 1, _text(_day(D, "d MMMM"), " - ", _day(E, "d MMMM"))).otherwise(_day(D, "d MMMM"))
    title = F.when(K % 11 == 0, "").otherwise(_text("World ", _case(K, "Forum", "Expo", "Gala"), " ", K))
    row = _text('<a class="global-event-list-item" href="/e/', K, '"><div class="global-event-list-title">', title, '</div><div class="global-event-list-item-venue">', _case(K, "Geneva, Switzerland", "Doha, Qatar", "", "Online"),
                '</div><div class="global-event-list-item-date">', date, "</div></a>")
    return _parsed("iata.org", _pages(_rows(spark, folder), _text("https://l.example/", P), row))


@query(_oracle(
    "k % 7 <> 0",
    source_url="'https://f.example/termine/' || k", category="(['airfield-festival', 'trade-fair', 'general'])[(k % 3 + 1)::INT]", title="'Sommerfest ' || seg || ' ' || k", subtitle="CASE k % 3 WHEN 0 THEN 'Flugtag' WHEN 1 THEN 'Messe' END",
    date_range_text=_DE.format("d"), venue="'Sommerfest ' || seg || ' ' || k", organiser="'fliegermagazin.de'", event_url="'https://f.example/termine/' || k", latitude="CASE WHEN k % 2 = 0 THEN 40 + n / 10 END", longitude="CASE WHEN k % 2 = 0 THEN 9.5 END",
))
def parse_articles(spark, folder):
    """Articles, and a map with places of every second one in the page's head."""
    K, N, P, SEG, D, _ = _keys()
    rows = _rows(spark, folder)
    link = _text("https://f.example/", F.when(K % 7 == 0, "andere/").otherwise("termine/"), K)
    kind = F.when(K % 3 < 2, _text('<span class="article-headline">', _case(K, "Flugtag", "Messe", ""), "</span>")).otherwise("")
    row = _text("<article>", kind, '<h3><a href="', link, '">Sommerfest ', SEG, " ", K, '</a></h3><time class="article-time">', _day(D), "</time></article>")
    entry = F.when(K % 2 == 0, _text('"', K, '":{"lat":"', F.format_number(40 + N / 10, 1), '","long":"9.5","url":"https://f.example/termine/', K, '"}'))
    heads = rows.groupBy("p").agg(F.array_join(F.collect_list(entry), ",").alias("entries"))
    pages = _pages(rows.join(heads, "p"), _text("https://l.example/", P), row, "").join(heads.select(_text("https://l.example/", P).alias("page_url"), "entries"), "page_url")
    return _parsed("fliegermagazin.de", pages.select("page_url", _text("<div data-data='{", F.col("entries"), "}'></div>", F.col("payload")).alias("payload")))


@query(_oracle(
    "k % 9 <> 0",
    source_url="'https://u.example/' || k", category="'meetup'", title="'Fly-In ' || seg || ' ' || k", end_day="strftime(CASE WHEN k % 2 = 0 THEN e ELSE d END, '%Y-%m-%d')", city="'Ulm'", venue="'Ulm'", icao="'EDUM'",
    organiser="CASE WHEN k % 5 = 0 THEN 'ulforum.de' ELSE 'LSV ' || n END", description="CASE WHEN k % 3 = 0 THEN 'Mehr & mehr' END", event_url="'https://u.example/' || k",
))
def parse_json_ld(spark, folder):
    K, N, P, SEG, D, E = _keys()
    address = F.when(K % 3 == 1, '"Hauptstr. 1, Ulm"').otherwise('{"streetAddress":"89077 Ulm"}')
    one = _text('{"@type":"Event","name":"Fly-In ', SEG, " ", K, '","startDate":"', _day(D, "yyyy-MM-dd"), 'T10:00:00"', F.when(K % 2 == 0, _text(',"endDate":"', _day(E, "yyyy-MM-dd"), '"')).otherwise(""),
                ',"location":{"name":"Ulm (EDUM)","address":', address, "}", F.when(K % 5 > 0, _text(',"organizer":{"name":"LSV ', N, '"}')).otherwise(F.when(K % 2 == 0, ',"organizer":"nur ein Name"').otherwise(',"organizer":["a"]')), F.when(K % 9 == 0, ',"eventStatus":"https://schema.org/EventCancelled"').otherwise(""),
                F.when(K % 3 == 0, ',"description":"Mehr &amp; <b>mehr</b>"').otherwise(""), ',"offers":{"url":"https://u.example/', K, '"}}')
    row = _text('<script type="application/ld+json">', F.when(K % 2 == 1, _text("[", one, ',{"@type":"Place","name":"P"},{"@type":["Event","Thing"],"name":"Q"},{"@type":"Event","name":"","location":"hier"},7]')).otherwise(one), "</script>")
    return _parsed("ulforum.de", _pages(_rows(spark, folder), _text("https://l.example/", P), row, "<html>", '<script type="application/ld+json">{broken</script></html>'))


_MENU_TITLE = "(['Workshop ', 'Convention ', 'Gala ', 'Forum '])[(k % 4 + 1)::INT] || k"


@query(_oracle(
    "k % 13 <> 0",
    source_url=f"CASE WHEN k % 5 = 0 THEN 'https://l.example/' || p || '#' || substr(sha1({_MENU_TITLE} || '|' || {ISO}), 1, 16) ELSE 'https://nbaa.org/e/' || k END", category="(['seminar', 'trade-fair', 'general', 'seminar'])[(k % 4 + 1)::INT]", title=_MENU_TITLE,
    date_range_text="CASE WHEN k % 2 = 0 THEN strftime(d, '%b. %-d, %Y') ELSE strftime(d, '%B %-d') || ' - ' || strftime(e, '%B %-d, %Y') END", end_day="strftime(CASE WHEN k % 2 = 1 THEN e ELSE d END, '%Y-%m-%d')", timezone="'UTC'", country="'US'",
    city="CASE k % 3 WHEN 0 THEN 'Denver' WHEN 2 THEN 'Geneva' END", venue="(['Denver, CO', 'Online', 'Geneva'])[(k % 3 + 1)::INT]", organiser="'NBAA'", description="CASE WHEN k % 2 = 0 THEN 'Mehr ' || k END", event_url="CASE WHEN k % 5 > 0 THEN 'https://nbaa.org/e/' || k END",
    source_locale="'en'",
))
def parse_menu(spark, folder):
    K, _, P, _, D, E = _keys()
    title = _text(_case(K, "Workshop ", "Convention ", "Gala ", "Forum "), K)
    date = F.when(K % 13 == 0, "TBD").when(K % 2 == 0, _day(D, "MMM'.' d, yyyy")).otherwise(_text(_day(D, "MMMM d"), " - ", _day(E, "MMMM d, yyyy")))
    row = _text('<div class="menu-event-single"><div class="menu-event-title">', F.when(K % 5 == 0, title).otherwise(_text('<a href="/e/', K, '">', title, "</a>")), '</div><div class="event-date">', date, '</div><div class="location">',
                _case(K, "Denver, CO", "Online", "Geneva"), "</div>", F.when(K % 2 == 0, _text('<div class="menu-event-excerpt"><p>Mehr ', K, "</p></div>")).otherwise(""), "</div>")
    return _parsed("nbaa.org", _pages(_rows(spark, folder), _text("https://l.example/", P), row))


_NODE_TITLE = "(['Big Forum ', 'Gala '])[(k % 2 + 1)::INT] || k"


@query(_oracle(
    "k % 13 <> 0",
    source_url="'https://www.eurocontrol.int/e/' || k", category="CASE k % 3 WHEN 0 THEN 'webinar' WHEN 1 THEN 'seminar' ELSE CASE WHEN k % 2 = 0 THEN 'seminar' ELSE 'general' END END", title=_NODE_TITLE, subtitle="CASE k % 3 WHEN 0 THEN 'Webinar' WHEN 1 THEN 'Workshop' END",
    date_range_text="CASE WHEN k % 5 = 0 THEN 'von' ELSE 'von - bis' END", end_day="strftime(CASE WHEN k % 5 = 0 THEN d ELSE e END, '%Y-%m-%d')", timezone="'UTC'", country="'BE'", venue=_NODE_TITLE, organiser="'Eurocontrol'",
    description=f"CASE k % 3 WHEN 0 THEN 'Webinar — ' WHEN 1 THEN 'Workshop — ' ELSE '' END || {_NODE_TITLE}", event_url="'https://www.eurocontrol.int/e/' || k", source_locale="'en'",
))
def parse_machine_times(spark, folder):
    K, _, P, _, D, E = _keys()
    time = lambda c, x: _text('<time datetime="', _day(c, "yyyy-MM-dd"), f'T09:00:00Z">{x}</time>')
    title = F.when(K % 13 == 0, "").otherwise(_text(_case(K, "Big Forum ", "Gala "), K))
    row = _text('<div class="node--event"><div class="field--promo-title"><h3>', title, '</h3></div><div class="field--date-range">', time(D, "von"), F.when(K % 5 > 0, _text(" - ", time(E, "bis"))).otherwise(""),
                '</div><div class="field--ref-event-type">', _case(K, "Webinar", "Workshop", ""), '</div><div class="card-footer"><a href="/e/', K, '">more</a></div></div>')
    return _parsed("eurocontrol.int", _pages(_rows(spark, folder), _text("https://l.example/", P), row))


GERMAN_MONTHS = ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember")
_GERMAN = "strftime(d, '%-d. ') || ([" + ", ".join(f"'{x}'" for x in GERMAN_MONTHS) + "])[month(d)] || ' 2026'"


@query(_oracle(
    "k % 13 <> 0",
    source_url="'https://a.example/' || k || '/#2026'", category="'trade-fair'", title="'AERO Friedrichshafen 2026'", subtitle="CASE WHEN k % 2 = 0 THEN 'Die Leitmesse für die Allgemeine Luftfahrt' ELSE 'The Leading Show for General Aviation' END",
    date_range_text=f"CASE k % 3 WHEN 1 THEN {_GERMAN} ELSE strftime(d, '%B %-d, %Y') END", city="'Friedrichshafen'", venue="'Messe Friedrichshafen'", icao="'EDNY'", organiser="'Messe Friedrichshafen GmbH'", description="CASE WHEN k % 2 = 0 THEN 'Text ' || k END",
    event_url="'https://a.example/' || k || '/'", source_locale="CASE WHEN k % 2 = 0 THEN 'de' ELSE 'en' END", latitude="47.6716::DOUBLE", longitude="9.5111::DOUBLE",
))
def parse_fair_home(spark, folder):
    """Home pages whose date is in the title, in a block of its own, or in the text."""
    K, _, _, _, D, _ = _keys()
    english, german = _day(D, "MMMM d, yyyy"), _text(_day(D, "d'. '"), F.element_at(F.array(*[F.lit(x) for x in GERMAN_MONTHS]), F.month(D)), " 2026")
    none = K % 13 == 0
    page = _text(F.when(K % 2 == 0, '<html lang="de-DE">').otherwise('<html lang="en">'), "<head><title>", F.when((K % 3 == 0) & ~none, _text(english, " | AERO Friedrichshafen")).otherwise("AERO"), "</title>",
                 F.when(K % 2 == 0, _text('<meta property="og:description" content="Text ', K, '">')).otherwise(""), "</head><body>", F.when((K % 3 == 1) & ~none, _text('<div class="date">', german, "</div>")).otherwise(""),
                 F.when((K % 3 == 2) & ~none, _text("Am ", english, " geht es los")).otherwise("Nichts"), "</body></html>")
    return _parsed("aero-expo.com", _rows(spark, folder).select(_text("https://a.example/", K, "/").alias("page_url"), page.alias("payload")))


@query(_oracle(
    "k % 7 <> 0",
    source_url="'https://p.example/' || k", category="'meetup'", title="'Hangar-Treffen ' || k || ' (EDMT)'", end_day="strftime(CASE WHEN k % 2 = 0 THEN e ELSE d END, '%Y-%m-%d')", city="CASE WHEN k % 3 = 2 THEN 'Ulm' END",
    venue="CASE k % 3 WHEN 0 THEN 'Hangar-Treffen ' || k || ' (EDMT)' WHEN 1 THEN 'Tannheim' ELSE 'Halle, Ulm' END", icao="'EDMT'", organiser="CASE WHEN k % 2 = 1 THEN 'pilot-frank.de' ELSE 'Frank' END", description="'Schön ' || CASE WHEN k % 5 = 0 THEN '& gut ' ELSE '' END || k || '.'", event_url="'https://p.example/' || k",
))
def parse_feed(spark, folder):
    K, _, P, _, D, E = _keys()
    row = _text("<item>", F.when(K % 3 == 0, '<title lang="de" kind=\'a\'>').otherwise("<title>"), F.when(K % 4 == 1, _text("<![CDATA[Hangar]]>-Treffen")).otherwise("Hangar-Treffen"), " ", K, " (EDMT)</title><link>https://p.example/", K, "</link>", F.when(K % 2 == 0, "<dc:creator><![CDATA[Frank]]></dc:creator>").otherwise(""), '<description><![CDATA[<img src="x">Schön ', F.when(K % 5 == 0, "]]>&amp;amp; gut<![CDATA[ ").otherwise(""), K,
                ". The post X appeared first on Y.]]></description><description>nicht diese</description>", F.when(K % 7 > 0, _text("<mec:startDate>", _day(D, "yyyy-MM-dd"), "</mec:startDate>")).otherwise(""), F.when(K % 2 == 0, _text("<mec:endDate>", _day(E, "yyyy-MM-dd"), "</mec:endDate>")).otherwise(""),
                "<mec:location>", _case(K, "", "Tannheim", "Halle, Ulm"), "</mec:location></item>")
    return _parsed("pilot-frank.de", _pages(_rows(spark, folder), _text("https://l.example/", P), row, '<?xml version="1.0"?><rss version="2.0" xmlns:mec="urn:m"><channel><title>Termine &amp; mehr</title>', "</channel></rss>"))


@query(f"""WITH {BASE} SELECT 'nbaa.org' AS source, k, {_MENU_TITLE} AS title, (['Denver, CO', 'Online', 'Geneva'])[(k % 3 + 1)::INT] AS place FROM c UNION ALL SELECT 'iata.org', k, 'World ' || k, NULL FROM c""")
def page_rows_in_sql(spark, folder):
    """Pages of two sources in one SQL statement: a table function gives the cards of each by its source."""
    from aerolith.sources import sql

    K, _, P, _, _, _ = _keys()
    menu = _text('<div class="menu-event-single"><div class="menu-event-title">', _case(K, "Workshop ", "Convention ", "Gala ", "Forum "), K, '</div><div class="location">', _case(K, "Denver, CO", "Online", "Geneva"), "</div></div>")
    item = _text('<a class="global-event-list-item" href="/e/', K, '"><div class="global-event-list-title">World ', K, "</div></a>")
    rows = _rows(spark, folder)
    landed = None
    for source, row in (("nbaa.org", menu), ("iata.org", item), ("unknown.example", item)):
        one = _pages(rows, _text("https://l.example/", P), row).withColumn("source", F.lit(source))
        landed = one if landed is None else landed.unionByName(one)
    sql.register(spark)
    statement = "SELECT l.source, r.title, r.location FROM {landed} l, LATERAL page_rows(l.source, l.payload, 'title, location') r"
    out = spark.sql(statement, landed=landed)
    return out.select("source", F.regexp_extract("title", r"(\d+)$", 1).cast("long").alias("k"), "title", F.col("location").alias("place"))


@query(f"""WITH {BASE}, r AS (SELECT *, CASE WHEN k % 13 = 0 THEN 'no-date' END AS dropped, CASE WHEN k % 19 = 0 THEN 'ended_too_long_ago' END AS invalid FROM c),
s AS (SELECT *, CASE WHEN k % 4 = 0 THEN k % 8 = 0 ELSE NULL END AS claimed FROM r WHERE dropped IS NULL)
SELECT 'nbaa.org' AS external_source, 'https://nbaa.org/e/' || k AS source_url, 'Seminar ' || seg || ' ' || k AS title, CASE WHEN invalid IS NOT NULL THEN '2020-05-01' ELSE strftime(d, '%Y-%m-%d') END AS start_day,
CASE WHEN invalid IS NOT NULL OR claimed THEN 'skipped' WHEN claimed IS NOT NULL THEN 'updated' ELSE 'inserted' END AS outcome, CASE WHEN invalid IS NOT NULL THEN invalid WHEN claimed THEN 'claimed' END AS reason FROM s
UNION ALL SELECT 'nbaa.org', NULL, NULL, NULL, 'dropped', dropped || ' ' || count(*) FROM r WHERE dropped IS NOT NULL GROUP BY dropped""")
def event_run_pages(spark, folder):
    """A run over pages: parsed, validated, keyed, decided and upserted, and what the parser dropped."""
    K, _, P, SEG, D, _ = _keys()
    from aerolith.plans.runs import event_run

    date = F.when(K % 13 == 0, "TBD").when(K % 19 == 0, "May 1, 2020").otherwise(_day(D, "MMMM d, yyyy"))
    row = _text('<div class="menu-event-single"><div class="menu-event-title"><a href="/e/', K, '">Seminar ', SEG, " ", K, '</a></div><div class="event-date">', date, '</div><div class="location">Denver, CO</div></div>')
    rows = _rows(spark, folder)
    landed = _pages(rows, _text("https://nbaa.org/list/", P), row).withColumn("source", F.lit("nbaa.org"))
    target = rows.where(K % 4 == 0).select(_text("https://nbaa.org/e/", K).alias("source_url"), (K % 8 != 0).alias("is_external"), F.lit(None).cast("timestamp_ntz").alias("claimed_at"), F.lit("old").alias("digest"))
    now = F.lit(NOW).cast("timestamp_ntz")
    out = event_run(landed, target, now, ["nbaa.org"]).select("external_source", "source_url", "title", _day("start", "yyyy-MM-dd").alias("start_day"), "outcome", "reason")
    drops = event_pages.drop_counts(event_pages.all_rows(landed, now, ["nbaa.org"]))
    none = F.lit(None).cast("string")
    return out.unionByName(drops.select(F.col("source_name").alias("external_source"), none.alias("source_url"), none.alias("title"), none.alias("start_day"), F.lit("dropped").alias("outcome"), _text(F.col("drop_reason"), " ", F.col("n")).alias("reason")))


# listings: one for each part
LISTED = f"""l AS (SELECT p_partkey AS k, p_partkey // {PAGE} AS p, p_name AS name, p_brand AS brand, p_size AS size, round(p_retailprice) AS price,
  row_number() OVER (PARTITION BY p_partkey // {PAGE} ORDER BY p_partkey) - 1 AS i FROM part)"""


def _listed() -> list[Column]:
    return [F.col(x) for x in ("k", "p", "name", "brand", "size", "price")]


def _parts(spark, folder) -> DataFrame:
    p = table(spark, folder, "part")
    return p.select(F.col("p_partkey").alias("k"), F.expr(f"p_partkey div {PAGE}").alias("p"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.round("p_retailprice").cast("long").alias("price"))


def _joined(c: str) -> Column:
    return F.array_join(c, " ")


@query(f"""WITH {LISTED} SELECT 'https://h.example/' || p || '.html#' || i || '@2026-02-03' AS source_id, brand || ' ' || name AS title, '2026-02-03' AS posted_date, (1950 + size)::INT AS year, 'Rotax 912 ULS' AS engine, (100 + size)::DOUBLE AS total_time, (400 + size)::DOUBLE AS mtow,
price::DOUBLE AS price, k % 2 = 0 AS price_negotiable, 'D-M' || (['ABC', 'XYZ', 'KLM'])[(k % 3 + 1)::INT] AS registration, 'info@x.de' AS contact_email, 'https://h.example/bild' || k || '.jpg' AS images, CASE WHEN k % 2 = 0 THEN TRUE END AS airworthy, 'AVGAS' AS fuel_type FROM l""")
def parse_prose_aircraft(spark, folder):
    """Blocks of prose between rules: labels, units, obfuscated addresses, tiny images."""
    K, P, NAME, BRAND, SIZE, PRICE = _listed()
    row = _text("<hr><b>", BRAND, " ", NAME, "</b> 03.02.2026 <br>Baujahr: ", 1950 + SIZE, " • Motor: Rotax 912 ULS • TT: ", 100 + SIZE, " • MTOW: ", 400 + SIZE, " kg • AVGAS • ", F.when(K % 2 == 0, "lufttüchtig • ").otherwise(""), "Preis: €", PRICE, F.when(K % 2 == 0, " VB").otherwise(""),
                ' <a href="mailto:%69nfo@x.de">Mail</a> Kennzeichen: D-M', _case(K, "ABC", "XYZ", "KLM"), ' <img src="/bild', K, '.jpg" width="300" height="200"><img src="/icon.gif" width="10" height="10">')
    pages = _pages(_parts(spark, folder), _text("https://h.example/", P, ".html"), row, "<body><p>Startseite Impressum</p>", "</body>")
    out = listing_pages.prose_aircraft(pages, "h.example")
    return out.select("source_id", "title", "posted_date", "year", "engine", "total_time", "mtow", "price", "price_negotiable", "registration", "contact_email", _joined("image_urls").alias("images"), "airworthy", "fuel_type")


@query(f"""WITH {LISTED} SELECT brand || ' ' || name AS title, (['avionics', 'propellers', 'rescue'])[(p % 3 + 1)::INT] AS category, 'gut' AS condition, price::DOUBLE AS price, CASE k % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS vat_included, (100 + size)::DOUBLE AS total_time FROM l""")
def parse_prose_parts(spark, folder):
    """Parts below a block that announces their category."""
    K, P, NAME, BRAND, SIZE, PRICE = _listed()
    row = _text("<hr><b>", BRAND, " ", NAME, "</b> 01.01.2026 Zustand: gut, Preis: ", PRICE, " EUR, Laufzeit: ", 100 + SIZE, F.when(K % 3 == 0, " MWSt ausweisbar").when(K % 3 == 1, " MWSt nicht ausweisbar").otherwise(""), ", kaum gebraucht und gepflegt")
    head = _text("<body><h2>", _case(P, "Avionik und Funkgeräte", "Propeller aller Art", "Rettungsgeräte"), "</h2> und mehr davon hier unten")
    out = listing_pages.prose_parts(_pages(_parts(spark, folder), _text("https://h.example/", P, ".html"), row, head, "</body>"), "h.example")
    return out.select("title", "category", "condition", "price", "vat_included", "total_time")


@query(f"""WITH {LISTED} SELECT 'a.example:/singleprop/x/y--xi' || k || '.htm' AS source_id, brand || ' ' || name AS title, (1950 + size)::INT AS year, (2000 + size)::DOUBLE AS total_time, price::DOUBLE AS price, FALSE AS price_negotiable,
CASE WHEN k % 2 = 0 THEN 'Strausberg' ELSE 'Wels' END AS city, CASE WHEN k % 2 = 0 THEN 'EDAY' END AS icao, CASE WHEN k % 2 = 0 THEN 'Germany' ELSE 'Austria' END AS country, 'D-EABC' AS registration, 'https://www.a.example/a' || k || '.jpg' AS images FROM l""")
def parse_index_cards(spark, folder):
    """Semi-structured cards of an index: by their classes on some pages, by the parents of links on others."""
    K, P, NAME, BRAND, SIZE, PRICE = _listed()
    row = _text(F.when(P % 2 == 0, '<div class="listing">').otherwise("<div>"), '<a href="/singleprop/x/y--xi', K, '.htm">', BRAND, " ", NAME, " Bj.: ", 1950 + SIZE, "</a> Bj.: ", 1950 + SIZE, "; TTAF: 2.", F.lpad(SIZE.cast("string"), 3, "0"), "; Standort: ", _case(K, "Strausberg/EDAY, Deutschland", "Wels, Österreich"), "; € ", PRICE,
                ' D-EABC <img src="/logo.png"><img src="/a', K, '.jpg"></div>')
    out = listing_pages.index_cards(_pages(_parts(spark, folder), _text("https://www.a.example/singleprop/", P, ".htm"), row), "a.example")
    return out.select("source_id", "title", "year", "total_time", "price", "price_negotiable", "city", "icao", "country", "registration", _joined("image_urls").alias("images"))


def _grid_pages(spark, folder) -> DataFrame:
    K, P, NAME, BRAND, SIZE, PRICE = _listed()
    row = _text('<div class="listview-item"><div class="new-lfz-description"><h2><a href="/d/', K, '"><strong>', BRAND, "</strong></a></h2><h3><strong>", NAME, '</strong></h3></div><p class="price"><span>', F.when(K % 3 == 0, "Preis auf Anfrage").otherwise(_text(PRICE, ",50 €")),
                "</span></p>Baujahr: ", F.when(K % 7 == 0, 1800).otherwise(1950 + SIZE), " Standort: Ulm", '<img class="img-fluid" src="/p', K, '.jpg"></div>')
    return _pages(_parts(spark, folder), _text("https://www.aeromarkt.net/Triebwerke/?p=", P), row)


@query(f"""WITH {LISTED} SELECT 'https://www.aeromarkt.net/d/' || k AS source_id, brand || ' ' || name AS title, (1950 + size)::INT AS year, CASE WHEN k % 3 > 0 THEN price + 0.5 END AS price, k % 3 = 0 AS price_negotiable, 'Ulm' AS city, 'https://www.aeromarkt.net/p' || k || '.jpg' AS images,
brand || ' ' || name || '. Baujahr ' || (1950 + size) || '. ' || CASE WHEN k % 3 = 0 THEN 'Preis Verhandlungssache' ELSE 'Preis: ' || replace(printf('%,d', price::BIGINT), ',', '.') || ',5 EUR' END || '. Angebot auf aeromarkt.net.' AS description FROM l WHERE k % 7 <> 0""")
def parse_grid_aircraft(spark, folder):
    out = listing_pages.LISTING_PARSERS["aeromarkt.net"](_grid_pages(spark, folder))
    return out.select("source_id", "title", "year", "price", "price_negotiable", "city", _joined("image_urls").alias("images"), "description")


@query(f"WITH {LISTED} SELECT 'https://www.aeromarkt.net/d/' || k AS source_id, brand || ' ' || name AS title, 'engines' AS category, CASE WHEN k % 3 > 0 THEN price + 0.5 END AS price, k % 3 = 0 AS price_negotiable FROM l")
def parse_grid_parts(spark, folder):
    out = listing_pages.PART_PARSERS["aeromarkt.net"](_grid_pages(spark, folder))
    return out.select("source_id", "title", "category", "price", "price_negotiable")


@query(f"""WITH {LISTED} SELECT 'https://www.aeromarkt.net/d/' || k AS source_id, CASE WHEN k % 2 = 0 THEN (1000 + size)::DOUBLE END AS total_time, CASE WHEN k % 2 = 0 THEN (600 + size)::DOUBLE END AS empty_weight, CASE WHEN k % 2 = 0 THEN 'D-EFGH' END AS registration,
CASE WHEN k % 2 = 0 THEN 'EDUM' END AS icao, CASE WHEN k % 2 = 0 THEN 'Germany' END AS country, 'Ulm' AS city, CASE WHEN k % 2 = 0 THEN 'Garmin 430; Becker Funk' END AS avionics, (1950 + size)::INT AS year, CASE WHEN k % 2 = 0 THEN 'Gepflegtes Flugzeug Nummer ' || k || ' aus erster Hand, stets in der Halle, viel Zubehör, mit einem langen Bericht über Wartung, Motor, Zelle, Lack und alle Reparaturen der letzten Jahre' END AS told FROM l WHERE k % 7 <> 0""")
def parse_grid_details(spark, folder):
    """Every second listing has a detail page, which wins over the card; its sections fold in one of four ways."""
    K, _, _, _, SIZE, _ = _listed()
    cards = listing_pages.LISTING_PARSERS["aeromarkt.net"](_grid_pages(spark, folder))
    gear, more = "Garmin 430 • Becker Funk", _text("Gepflegtes Flugzeug Nummer ", K, " aus erster Hand, stets in der Halle, viel Zubehör, mit einem langen Bericht über Wartung, Motor, Zelle, Lack und alle Reparaturen der letzten Jahre")
    folded = lambda how: _text(*[how(head, body, name) for head, body, name in (("Avionik &amp; Instrumente", gear, "a"), ("Sonstige Informationen", more, "b"))])
    ways = (
        lambda head, body, name: _text('<div class="accordion-item"><h2 class="accordion-header"><button class="accordion-button">', head, '</button></h2><div class="accordion-collapse"><div class="accordion-body">', body, "</div></div></div>"),
        lambda head, body, name: _text('<a data-bs-toggle="collapse" href="#', name, '">', head, "</a> und <p>anderes</p><div><div id='", name, "'>", body, "</div></div>"),
        lambda head, body, name: _text("<details><summary>", head, "</summary>", body, "</details>"),
        lambda head, body, name: _text('<div><div class="card-header">', head, '</div>\n<div class="card-body">', body, "</div></div>"),
    )
    way = F.when(K % 8 == 0, folded(ways[0])).when(K % 8 == 2, folded(ways[1])).when(K % 8 == 4, folded(ways[2])).otherwise(folded(ways[3]))
    page = _text("<html><body><main>Betriebsstunden: 1.", F.lpad(SIZE.cast("string"), 3, "0"), " Leergewicht: ", 600 + SIZE, " kg Kennzeichen: D-EFGH AVGAS Standort: Ulm (EDUM)", way, "</main></body></html>")
    details = _parts(spark, folder).where(K % 2 == 0).select(_text("https://www.aeromarkt.net/d/", K).alias("page_url"), page.alias("payload"))
    out = listing_pages.with_details(cards, details)
    told = F.when(F.col("description").startswith("Gepflegt"), F.col("description")).alias("told")
    return out.select("source_id", "total_time", "empty_weight", "registration", "icao", "country", "city", "avionics", "year", told)


@query(f"""WITH {LISTED} SELECT 'https://h.example/' || p || '.html#' || i || '@2026-02-03' AS source_id, size + 0.5::DOUBLE AS engine_hours, (1000 + size)::DOUBLE AS cycles, CASE WHEN k % 2 = 0 THEN (400 + size)::DOUBLE END AS mtow, (200 + size)::DOUBLE AS empty_weight, (400 + size)::DOUBLE AS max_takeoff_weight,
(50 + size)::DOUBLE AS fuel_capacity, (100 + size)::DOUBLE AS cruise_speed, (200 + size)::DOUBLE AS max_speed, (600 + size)::DOUBLE AS max_range, (3000 + size)::DOUBLE AS service_ceiling, size + 0.25::DOUBLE AS climb_rate, CASE WHEN k % 3 > 0 THEN 12.5::DOUBLE END AS fuel_consumption,
'Junkers Magnum' AS rescue_system, CASE WHEN k % 2 = 0 THEN '2026-06-05' ELSE '2026-03-01' END AS annual_inspection, '61193.' || size AS dulv_ref, 'AB-' || k AS serial_number, 'Garmin G5; Becker Transponder' AS avionics, 'Ulm' AS location, 'Ulm' AS city, 'Ulm-Erbach' AS airfield_name, 'EDNE' AS icao, 'Eva Muster' AS contact_name, '0731 123456' AS contact_phone,
'03.02.2026 Landungen: 1.' || printf('%03d', size) || ' Leergewicht: ' || (200 + size) || ' kg ' || CASE WHEN k % 2 > 0 THEN 'Abflugmasse: ' || (400 + size) || ' kg ' ELSE '' END || 'Tankinhalt: ' || (50 + size) || ' l Vcr ' || (100 + size) || ' km/h Vne: ' || (200 + size) || ' km/h Reichweite: ' || (600 + size) || ' km Dienstgipfelhöhe: 3.' || printf('%03d', size) || ' m Steigleistung: ' || size || ',25 m/s '
 || CASE WHEN k % 3 > 0 THEN 'Verbrauch: 12,5 l/h ' ELSE '' END || 'DULV-Kennbla Werk-Nr. AB-' || k || ' Garmin G5 Becker Transponder Standort: Ulm Flugplatz: Ulm-Erbach EDNE Kontakt: Eva Muster' AS description FROM l""")
def parse_prose_measures(spark, folder):
    """Labels with units, places and contacts in prose, and what is left of it as a description. Labels are taken out in
    order, and hours (TT) before type certificates, so that a number behind `Kennblatt` takes two of its letters along."""
    K, P, NAME, BRAND, SIZE, _ = _listed()
    thousands = F.lpad(SIZE.cast("string"), 3, "0")
    row = _text("<hr><b>", BRAND, " ", NAME, "</b> 03.02.2026 <br>Motorstunden: ", SIZE, ",5 • Landungen: 1.", thousands, " • Leergewicht: ", 200 + SIZE, " kg • ", F.when(K % 2 == 0, "MTOW: ").otherwise("Abflugmasse: "), 400 + SIZE, " kg • Tankinhalt: ", 50 + SIZE, " l • Vcr ", 100 + SIZE, " km/h • Vne: ", 200 + SIZE,
                " km/h • Reichweite: ", 600 + SIZE, " km • Dienstgipfelhöhe: 3.", thousands, " m • Steigleistung: ", SIZE, ",25 m/s • ", F.when(K % 3 > 0, "Verbrauch: 12,5 l/h • ").otherwise(""), "Rettung: Junkers Magnum • JNP: ", F.when(K % 2 == 0, "05.06.2026").otherwise("03/2026"), " • DULV-Kennblatt: 61193.", SIZE,
                " • Werk-Nr. AB-", K, " • Garmin G5 • Becker Transponder • Standort: Ulm • Flugplatz: Ulm-Erbach EDNE • Kontakt: Eva Muster • Tel: 0731 123456")
    pages = _pages(_parts(spark, folder), _text("https://h.example/", P, ".html"), row, "<body>", "</body>")
    return listing_pages.prose_aircraft(pages, "h.example").select(
        "source_id", "engine_hours", "cycles", "mtow", "empty_weight", "max_takeoff_weight", "fuel_capacity", "cruise_speed", "max_speed", "max_range", "service_ceiling", "climb_rate", "fuel_consumption",
        "rescue_system", "annual_inspection", "dulv_ref", "serial_number", "avionics", "location", "city", "airfield_name", "icao", "contact_name", "contact_phone", "description",
    )


@query(f"WITH {LISTED} SELECT 'a.example:/y--xi' || k || '.htm' AS source_id, brand || ' ' || name AS title FROM l")
def title_endings(spark, folder):
    """Headlines of cards lose what is no name: each of the endings in turn."""
    K, P, NAME, BRAND, SIZE, _ = _listed()
    ends = ("€ 5.000 VB", "Preis auf Anfrage", "Bj. 1999 top", "TTAF 200", "Standort Ulm", "EU versteuert", "Nettopreis 5", "Seriennr. 12", "Reg.Nr. D-EABC", "Jahresnachprüfung 05/2026", "Typ: M20 lang", "CHF 900.000")
    row = _text('<div class="listing"><a href="/y--xi', K, '.htm">', BRAND, " ", NAME, " ", _case(K, *ends), "</a> gepflegt, aus erster Hand, Nr. ", SIZE, "</div>")
    return listing_pages.index_cards(_pages(_parts(spark, folder), _text("https://www.a.example/l/", P, ".htm"), row), "a.example").select("source_id", "title")


@query(f"""WITH {LISTED}, o AS (SELECT *, CASE k % 5 WHEN 2 THEN 'no_images' WHEN 3 THEN 'no_year' WHEN 1 THEN 'no_clean_model' END AS gate, CASE k % 5 WHEN 0 THEN brand || ' Modell' || num || 'x' || printf('%02d', size) WHEN 1 THEN 'Rotax 912 ULS' ELSE brand || ' ' || name END AS headline FROM (SELECT *, substr(brand, 7) AS num FROM l))
SELECT 'https://h.example/' || p || '.html#' || i || '@2026-02-03' AS source_url, headline, 'h.example' AS source_name, CASE k % 5 WHEN 0 THEN 'Modell' || num || 'x' || printf('%02d', size) WHEN 1 THEN '' ELSE name END AS model, CASE WHEN k % 5 <> 1 THEN num::INT END AS manufacturer_id,
(CASE WHEN k % 2 = 0 THEN 10 WHEN k % 5 = 0 THEN 11 + size % 2 END)::INT AS category_id, CASE WHEN gate IS NOT NULL OR k % 9 = 0 THEN 'skipped' WHEN k % 3 = 0 THEN 'updated' ELSE 'inserted' END AS outcome, CASE WHEN gate IS NOT NULL THEN gate WHEN k % 9 = 0 THEN 'claimed' END AS reason FROM o""")
def listing_run_pages(spark, folder):
    """A run over pages of listings: parsed, matched with makers, reference entries and categories, gated, and held
    against a target that knows every third and whose every ninth is claimed."""
    from pyspark.sql import Window

    from aerolith.plans.runs import listing_run

    K, P, NAME, BRAND, SIZE, _ = _listed()
    parts = _parts(spark, folder)
    number = F.substring(BRAND, 7, 9)
    model = _text("Modell", number, "x", F.lpad(SIZE.cast("string"), 2, "0"))
    row = _text("<hr><b>", _case(K, _text(BRAND, " ", model), "Rotax 912 ULS", *[_text(BRAND, " ", NAME)] * 3), "</b> 03.02.2026 <br>", F.when(K % 5 != 3, _text("Baujahr: ", 1950 + SIZE)).otherwise("ohne Angabe"), " • sehr gepflegt, Platz in der Halle kann bleiben", F.when(K % 2 == 0, " • Kennzeichen: D-MABC").otherwise(""), F.when(K % 5 != 2, _text(' <img src="/b', K, '.jpg">')).otherwise(""))
    listings = listing_pages.prose_aircraft(_pages(parts, _text("https://h.example/", P, ".html"), row, "<body>", "</body>"), "h.example")
    makers = parts.select(BRAND.alias("name"), number.cast("int").alias("id")).distinct()
    entries = parts.select(BRAND.alias("maker"), model.alias("model"), F.lit(None).cast("string").alias("variant"), _case(SIZE, "Glider", "Jet").alias("category"), F.xxhash64(BRAND, SIZE).alias("ord")).distinct()
    key = F.col("r_regionkey")
    categories = table(spark, folder, "region").where(key < 3).select((key + 10).cast("int").alias("id"), _case(key, "Ultralight / light sport aircraft (LSA)", "GLIDER", "jet").alias("name"))
    at = F.row_number().over(Window.partitionBy("p").orderBy("k")) - 1
    target = parts.withColumn("i", at).where(K % 3 == 0).select(_text("https://h.example/", P, ".html#", F.col("i"), "@2026-02-03").alias("source_url"), (K % 9 != 0).alias("is_external"), F.lit(None).cast("timestamp_ntz").alias("claimed_at"))
    return listing_run(listings, makers, entries, categories, target, "none@example.org")
