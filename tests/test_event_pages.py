import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerolith.rules import tables as T
from aerolith.sources import event_pages as E

NOW = "2026-04-25 00:00:00"


def rows(spark, source, html, url="https://example.org/list"):
    landed = spark.createDataFrame([(source, url, html), (source, url, None), (source, url, "")], "source string, page_url string, payload string")
    now = F.lit(NOW).cast("timestamp_ntz")
    return E.parse(source, landed, now).collect()


def at(y, m, d):
    return dt.datetime(y, m, d)


def test_table_rows(spark):
    row = """<tr><td class="pubcal_title">Fluglager &amp; Kurs</td><td class="pubcal_daterange icon-clock">01.05.2026 - 03.05.2026</td><td class="pubcal_daterange icon-info">Info</td>
    <td class="pubcal_location">Tannheim (EDMT)</td><td class="pubcal_cidname">LSV</td></tr>"""
    r = rows(spark, "vereinsflieger.de", f"<table>{row}<tr><td class='pubcal_title'>Ohne Datum</td></tr></table>", "https://example.org/?category=3")
    assert [(x.title, x.start, x.end, x.icao, x.venue, x.category, x.organiser) for x in r] == [("Fluglager & Kurs", at(2026, 5, 1), at(2026, 5, 3), "EDMT", "Tannheim", "flying-camp", "LSV")]
    assert r[0].source_url.startswith("https://example.org/?category=3#") and len(r[0].source_url.split("#")[1]) == 16


def test_cms_blocks(spark):
    block = """<div data-history-node-id="77"><div class="field--name-field-bild"><img alt="plakat"></div><div class="field--name-field-startdatum"><div class="field__item">02.05.2026</div></div>
    <div class="field--name-field-ort"><div class="field__item">Flugplatz, Ulm</div></div><div class="field--name-field-beschreibung"><div class="field__item"><h3>Infotag UL</h3><p>Text. Mehr.</p></div></div></div>"""
    (r,) = rows(spark, "dulv.de", block)
    assert (r.title, r.category, r.source_url, r.city, r.start) == ("Infotag UL", "seminar", "https://www.dulv.de/node/77", "Ulm", at(2026, 5, 2))


def test_prose_below_headings(spark):
    html = """<h2>Museen</h2><p>01.01.2026 – Nichts</p><h2>Fly-Inns und Pilotentreffen</h2><p>20. – 26.07.2026 – <a href="https://t.example/">Tannkosh</a> – Tannheim (EDMT)</p><p><del>01.08.2026 – Weg – Ulm</del></p><p>kein Datum</p>"""
    (r,) = rows(spark, "pilotenausbildung.net", html)
    assert (r.title, r.start, r.end, r.icao, r.category, r.country, r.event_url) == ("Tannkosh", at(2026, 7, 20), at(2026, 7, 26), "EDMT", "meetup", "DE", "https://t.example/")


def test_cards_without_year(spark):
    html = """<a class="global-event-list-item" href="/e/1"><div class="global-event-list-title">World Symposium</div><div class="global-event-list-item-venue">Geneva, Switzerland</div><div class="global-event-list-item-date">12 - 14 May</div></a>"""
    (r,) = rows(spark, "iata.org", html)
    assert (r.source_url, r.start, r.end, r.country, r.city, r.category) == ("https://www.iata.org/e/1", at(2026, 5, 12), at(2026, 5, 14), "CH", "Geneva", "seminar")


def test_articles_with_map(spark):
    html = """<div data-data='{"1":{"lat":"48.1","long":"9.5","url":"https://f/termine/a"}}'></div><article><span class="article-headline">Flugtag</span><h3><a href="https://f/termine/a">Sommerfest</a></h3><time class="article-time">01.06.2026</time></article>
    <article><h3><a href="https://f/andere/b">X</a></h3><time class="article-time">01.06.2026</time></article>"""
    (r,) = rows(spark, "fliegermagazin.de", html)
    assert (r.title, r.category, r.latitude, r.longitude, r.start) == ("Sommerfest", "airfield-festival", 48.1, 9.5, at(2026, 6, 1))


def test_json_ld(spark):
    html = """<script type="application/ld+json">[{"@type":"Event","name":"Fly-In Ulm","startDate":"2026-06-01T10:00:00","location":{"name":"Ulm (EDUM)","address":{"streetAddress":"89077 Ulm"}},"offers":{"url":"https://u/1"}},
    {"@type":"Event","name":"Weg","startDate":"2026-06-01","eventStatus":"https://schema.org/EventCancelled"},{"@type":"Place","name":"P"}]</script><script type="application/ld+json">{broken</script>"""
    (r,) = rows(spark, "ulforum.de", html)
    assert (r.title, r.icao, r.city, r.source_url, r.category, r.end) == ("Fly-In Ulm", "EDUM", "Ulm", "https://u/1", "meetup", at(2026, 6, 1))


def test_us_dates(spark):
    html = """<div class="menu-event-single"><div class="menu-event-title"><a href="/x">Workshop A</a></div><div class="event-date">Oct. 18-19, 2026</div><div class="location">Denver, CO</div></div>"""
    (r,) = rows(spark, "nbaa.org", html)
    assert (r.source_url, r.city, r.start, r.end, r.category) == ("https://nbaa.org/x", "Denver", at(2026, 10, 18), at(2026, 10, 19), "seminar")


def test_machine_times(spark):
    html = """<div class="node--event"><div class="field--promo-title"><h3>Big Forum</h3></div><div class="field--date-range"><time datetime="2026-05-05T09:00:00Z">5</time> - <time datetime="2026-05-07T09:00:00Z">7</time></div><div class="field--ref-event-type">Webinar</div></div>"""
    (r,) = rows(spark, "eurocontrol.int", html)
    assert (r.title, r.start, r.end, r.category, r.description) == ("Big Forum", at(2026, 5, 5), at(2026, 5, 7), "webinar", "Webinar — Big Forum")


@pytest.mark.parametrize("html", ["<html lang='de'><head><title>April 22 - 25, 2026 | AERO Friedrichshafen</title></head><body></body></html>", "<html lang='de'><head><title>AERO</title></head><body><div class='date'>22. - 25. April 2026</div></body></html>", "<html lang='de'><body>Am April 22 - 25, 2026 ist es so weit</body></html>"])
def test_fair_home_page(spark, html):
    (r,) = rows(spark, "aero-expo.com", html, "https://a.example/")
    assert (r.title, r.start, r.end, r.source_locale, r.source_url) == ("AERO Friedrichshafen 2026", at(2026, 4, 22), at(2026, 4, 25), "de", "https://a.example/#2026")


def test_feed(spark):
    xml = """<?xml version="1.0"?><rss><channel><item><title>Hangar-Treffen (EDMT)</title><link>https://p/1</link><dc:creator><![CDATA[Frank]]></dc:creator><description><![CDATA[<img src="x">Schön. The post X appeared first on Y.]]></description>
    <mec:startDate>2026-08-01</mec:startDate><mec:location>Tannheim</mec:location></item><item><title>Ohne Datum</title></item></channel></rss>"""
    (r,) = rows(spark, "pilot-frank.de", xml)
    assert (r.title, r.icao, r.organiser, r.category, r.description, r.start) == ("Hangar-Treffen (EDMT)", "EDMT", "Frank", "meetup", "Schön.", at(2026, 8, 1))


def test_page_counts_and_urls(spark):
    df = spark.createDataFrame([("<a href='?page=3'>4</a><a href='/x?page=2'>3</a> Seite 1 von 7",)], "p string")
    count = lambda s: df.select(E.page_count(s, F.col("p"))).first()[0]
    assert [count(s) for s in ("fliegermagazin.de", "iata.org", "dulv.de", "eurocontrol.int", "nbaa.org")] == [7, 4, 4, 4, 1]
    urls = df.select(E.page_urls("dulv.de", F.lit("https://d/l"), F.lit(3)), E.page_urls("fliegermagazin.de", F.lit("https://f/t/"), F.lit(2))).first()
    assert urls[0] == ["https://d/l", "https://d/l?page=1", "https://d/l?page=2"] and urls[1] == ["https://f/t/", "https://f/t/seite/2/"]


def test_all_sources_together(spark):
    landed = spark.createDataFrame([("nbaa.org", "https://n/", None), ("unknown", "https://n/", "<p>x</p>")], "source string, page_url string, payload string")
    assert E.events(landed, F.lit(NOW).cast("timestamp_ntz"), ["nbaa.org", "ics-feed", "iata.org"]).count() == 0
    assert set(E.PARSERS) == {s for s, _, kind, _, _ in T.SOURCES if kind == "events"}


def test_dropped_rows_have_reasons(spark):
    row = "<tr><td class='pubcal_title'>{}</td><td class='pubcal_daterange icon-clock'>{}</td><td class='pubcal_cidname'>{}</td></tr>"
    html = "<table>" + "".join(row.format(*x) for x in [("", "01.05.2026", "L"), ("A", "bald", "L"), ("B", "01.05.2026", ""), ("C", "01.05.2026", "L"), ("D", "", "")]) + "</table>"
    calendar = "BEGIN:VCALENDAR\nBEGIN:VEVENT\nUID:1\nSUMMARY:x\nDTSTART:20260501\nSTATUS:CANCELLED\nEND:VEVENT\nBEGIN:VEVENT\nSUMMARY:x\nEND:VEVENT\nBEGIN:VEVENT\nUID:3\nSUMMARY:Da\nDTSTART:20260502T100000\nEND:VEVENT\nEND:VCALENDAR"
    landed = spark.createDataFrame([("vereinsflieger.de", "https://v/", html), ("ics-feed", "https://c/a.ics", calendar), ("ics-feed", "https://c/b.ics", "<html>")], "source string, page_url string, payload string")
    calendars = spark.createDataFrame([("Club", "webcal://c/a.ics", "AT", "seminar", "Europe/Vienna", "de", None)], "name string, url string, country string, default_category string, timezone string, source_locale string, organiser_name string")
    rows = E.all_rows(landed, F.lit(NOW).cast("timestamp_ntz"), ["vereinsflieger.de", "ics-feed"], calendars)
    assert {(r.source_name, r.drop_reason): r.n for r in E.drop_counts(rows).collect()} == {
        ("vereinsflieger.de", "no-title"): 1, ("vereinsflieger.de", "no-date"): 2, ("vereinsflieger.de", "no-organiser"): 1, ("ics-feed", "cancelled"): 1, ("ics-feed", "no-uid"): 1,
    }
    kept = {r.title: r for r in E.events(landed, F.lit(NOW).cast("timestamp_ntz"), ["vereinsflieger.de", "ics-feed"], calendars).collect()}
    assert set(kept) == {"C", "Da"} and (kept["Da"].organiser, kept["Da"].country, kept["Da"].category, kept["Da"].start) == ("Club", "AT", "seminar", dt.datetime(2026, 5, 2, 8))


def test_feeds_are_xml(spark):
    """Attributes, nested CDATA, entities known and unknown to XML; a feed that breaks off says so."""
    xml = """  <?xml version="1.0"?><rss version="2.0"><channel><title>Alle</title><item a="1"><title lang="de">Fest &amp; Markt&nbsp;(EDMT) <![CDATA[<b>am]]]]><![CDATA[> Platz</b>]]></title><link>https://p/1?a=1&amp;b=2</link>
    <mec:startDate>2026-08-01</mec:startDate><description>&lt;p&gt;Gut &amp;amp; sch&#246;n&lt;/p&gt;</description></item><item/></channel></rss>"""
    landed = spark.createDataFrame([("https://f/", xml), ("https://g/", "<?xml version='1.0'?><rss><channel><item><title>x"), ("https://h/", "<html>"), ("https://i/", "<?xml version='1.0'?><rss><channel/></rss>")], "page_url string, payload string")
    got = sorted(((r.page_url, r.title, r.drop_reason, r.source_url, r.description) for r in E.pilot_frank(landed).collect()), key=str)
    assert [g[:3] for g in got] == [("https://f/", "", "no-title"), ("https://f/", "Fest & Markt (EDMT) am]]> Platz", None), ("https://g/", "", "malformed-xml")]
    assert any(g[3] == "https://p/1?a=1&b=2" and g[4] == "Gut & schön" for g in got)


def test_pages_in_sql(spark):
    from aerolith.sources import sql

    sql.register(spark)
    menu = '<div class="menu-event-single"><div class="menu-event-title">A</div></div><div class="menu-event-single"><div class="location">B</div></div>'
    landed = spark.createDataFrame([("nbaa.org", menu), ("nbaa.org", None), (None, menu), ("else", menu), ("nbaa.org", "")], "source string, payload string")
    got = spark.sql("SELECT r.* FROM {landed} l, LATERAL page_rows(l.source, l.payload, 'title, location, none') r", landed=landed).collect()
    assert sorted(map(tuple, got)) == [(0, "A", None, None), (1, None, "B", None)]
    maps = spark.sql("SELECT r.fields FROM {landed} l, LATERAL page_rows(l.source, l.payload) r", landed=landed).collect()
    assert sorted(str(r.fields.get("title")) for r in maps) == ["A", "None"]
    for bad in ("page_rows(l.source, 7)", "page_rows(l.source, l.payload, 7)"):
        with pytest.raises(Exception, match="page_rows"):
            spark.sql(f"SELECT r.* FROM {{landed}} l, LATERAL {bad} r", landed=landed).collect()
