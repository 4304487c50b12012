import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerolith.functions import classify as C
from aerolith.functions import dates as D
from aerolith.functions import json as J
from aerolith.functions import keys as K
from aerolith.functions import numbers as N
from aerolith.functions import text as X
from aerolith.functions import urls as U


def each(spark, f, *values):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, c string")
    return [r[1] for r in df.select("k", f(F.col("c"))).orderBy("k").collect()]


def spans(rows):
    return [r and (str(r.start), str(r.end)) for r in rows]


def test_numbers(spark):
    assert each(spark, N.extract_number, "1.234,5", "450", "keine Angabe", "2500", None) == [1234.5, 450.0, None, 250.0, None]
    assert each(spark, N.parse_number, "2500", "1.234,5") == [2500.0, 1234.5]
    assert [tuple(r) for r in each(spark, N.parse_price, "€12.500 VB", "35.500,50", "abc", "VHB", "1500,-")] == [(12500.0, True), (35500.5, False), (None, False), (None, True), (1500.0, False)]
    assert [tuple(r) for r in each(spark, N.price_in_text, "Preis: €35.500 VB", "Preis auf Anfrage", "nichts", "€ 0")] == [(35500.0, True), (None, True), (None, False), (None, False)]
    assert [tuple(r) for r in each(spark, N.labelled_price, "Preis auf Anfrage", "9.500 €", "1.000,50 € Verhandlungssache", "")] == [(None, True), (9500.0, False), (1000.5, True), (None, False)]


def test_slugs(spark):
    assert each(spark, X.slug, "Flügel für Überlandflug", "Price: €12,500! (negotiable)", "Жуковский", "İstanbul ß", "", "Ωμέγα") == ["flugel-fur-uberlandflug", "price-12-500-negotiable", "zhukovskiy", "istanbul", "", "om-ga"]
    assert each(spark, lambda c: X.slug(c, F.lit(42)), "Cessna 172") == ["cessna-172-42"]
    assert each(spark, lambda c: X.slug(c, F.lit(0)), "Cessna 172") == ["cessna-172"]
    long = "wort " * 30
    (s,) = each(spark, X.slug, long)
    assert s == "-".join(["wort"] * 16) and len(s) <= 80
    assert each(spark, X.slug, "x" * 200) == ["x" * 80]


def test_german_dates(spark):
    assert each(spark, D.german_date, "am 01.02.2024", "3/2024", "März 2025", "99.99.2024", "nix") == ["2024-02-01", "2024-03-01", "2025-03-01", "2024-99-99", None]
    assert spans(each(spark, D.german_range, "1.2.2026", "1.2.2026 – 3.2.2026", "31.02.2026", "1.13.2026", "1.2.1800")) == [("2026-02-01", "2026-02-01"), ("2026-02-01", "2026-02-03"), ("2026-03-03", "2026-03-03"), None, None]
    assert spans(each(spark, D.loose_german_range, "20. – 26.07.2026 – Treffen", "28.2. - 1.3.2026", "5.6.2026 x", "x")) == [("2026-07-20", "2026-07-26"), ("2026-02-28", "2026-03-01"), ("2026-06-05", "2026-06-05"), None]


def test_named_dates(spark):
    now = F.lit("2026-04-25").cast("timestamp_ntz")
    assert spans(each(spark, lambda c: D.yearless_range(c, now), "12 - 14 May", "30 Dec - 2 Jan", "1 Jan", "26 March", "1 Foo")) == [("2026-05-12", "2026-05-14"), ("2026-12-30", "2027-01-02"), ("2027-01-01", "2027-01-01"), ("2026-03-26", "2026-03-26"), None]
    assert spans(each(spark, D.us_range, "Oct. 18-19, 2026", "Nov. 30 - Dec. 2, 2026", "May 5, 2026")) == [("2026-10-18", "2026-10-19"), ("2026-11-30", "2026-12-02"), ("2026-05-05", "2026-05-05")]
    assert spans(each(spark, D.fair_range, "April 22 - 25, 2026", "22. - 25. April 2026", "5. März 2026", "April 30 - May 2, 2026")) == [("2026-04-22", "2026-04-25"), ("2026-04-22", "2026-04-25"), ("2026-03-05", "2026-03-05"), ("2026-04-30", "2026-05-02")]


def test_calendar_times(spark):
    assert each(spark, lambda c: D.iso(D.ics_time(c, F.lit("America/New_York"))), "20260601T190000", "20260601", "20260601T190000Z", "nix") == ["2026-06-01T23:00:00.000Z", "2026-06-01T00:00:00.000Z", "2026-06-01T19:00:00.000Z", None]
    # one look at the offset, so the hours around a change of clocks differ from a full conversion
    assert each(spark, lambda c: D.iso(D.ics_time(c, "Europe/Berlin")), "20260329T023000", "20261025T023000") == ["2026-03-29T00:30:00.000Z", "2026-10-25T01:30:00.000Z"]
    assert each(spark, lambda c: D.iso(D.ics_time(c, F.lit("No/Where"))), "20260601T190000") == ["2026-06-01T19:00:00.000Z"]
    assert each(spark, D.ics_duration, "PT1H", "P1DT12H", "", "P", "-PT15M", "P2W") == [3600000, 129600000, None, None, -900000, 1209600000]


def test_places(spark):
    assert each(spark, X.clean_city, "86150 Augsburg", "München (EDDM)", "Deutschland, Grefrath", "Kapfenberg LOGK", "hamburg", "Germany", "Cessna Town", None, "") == ["Augsburg", "München", "Grefrath", "Kapfenberg", None, None, None, None, None]
    assert [tuple(r) for r in each(spark, X.venue_icao, "Tannheim (EDMT)", "Flugplatz EDMT Tannheim", "nix", "EDMT")] == [("Tannheim", "EDMT"), ("Flugplatz Tannheim", "EDMT"), ("nix", None), ("EDMT", "EDMT")]
    assert each(spark, X.venue_city, "89077 Ulm", "Halle, Ulm", "Ulm") == ["Ulm", "Ulm", None]
    assert each(spark, X.location, "Standort: Bad Aibling", "in 86150 Augsburg", "nix") == ["Bad Aibling", "86150 Augsburg", None]
    assert [tuple(r) for r in each(spark, C.venue_country, "Geneva, Switzerland", "Paris", "")] == [("Geneva", "CH"), (None, "XX"), (None, "XX")]
    assert each(spark, C.text_country, "Fly-In Salzburg Austria", "Ulm", "Austriaco") == ["AT", "DE", "DE"]


def test_contacts_and_cleaning(spark):
    assert each(spark, X.decode_email, "%69%6efo[at]x [dot] de", "a%40b.de", "100%", None) == ["info@x.de", "a@b.de", "100%", None]
    assert each(spark, X.clean_text, "<p>a &amp;lt; b</p>\n c ", None) == ["a < b c", None]
    assert each(spark, X.sanitize, '<b onclick="x">a</b> javascript:b onload = c') == ["a b  c"]
    assert each(spark, X.deduplicate_description, "This is a long sentence. This is a long sentence. short. short.", "same paragraph\n\nsame paragraph", "") == ["This is a long sentence. short. short.", "same paragraph", ""]
    assert [tuple(r) for r in each(spark, X.split_title_location, "Fest - Ulm", "Fest", "A – B – C")] == [("Fest", "Ulm"), ("Fest", None), ("A – B", "C")]
    assert each(spark, lambda c: X.elapsed(c.cast("long")), "999", "1500", "61000") == ["999ms", "2s", "1m 1s"]
    assert each(spark, X.redact_credentials, "http://u:p@h/x") == ["http://***@h/x"]
    assert each(spark, X.unescape_ics, r"a\,b\;c\nd") == ["a,b;c\nd"]


def test_language_blocks(spark):
    text = "Ein langer deutscher Text, der mehr als fünfzig Zeichen hat, sicher.\n-----\nThe same in English, which is long as well, surely."
    assert each(spark, X.strip_language_blocks, text, "kurz") == [text.split("\n-----")[0], "kurz"]
    half = "TTAF 1234h war gut. IFR geht. Noch ein Satz hier. "
    doubled = (half + half.replace("war", "was").replace("Satz", "sent")).strip()
    assert len(doubled) >= 100 or each(spark, X.strip_language_blocks, doubled) == [doubled]


@pytest.mark.parametrize("registration,category,country", [("D-EXYZ", "Single Engine Piston", "Germany"), ("d-1234", "Glider", "Germany"), ("HB-XAB", "Helicopter / Gyrocopter", "Switzerland"), ("N123", None, "United States"), ("9A-ABC", None, "Croatia"), ("??", None, None)])
def test_registrations(spark, registration, category, country):
    assert each(spark, C.registration_category, registration) == [category]
    assert each(spark, C.registration_country, registration) == [country]


def test_classifiers(spark):
    assert each(spark, lambda c: C.aircraft_category(F.lit(None), c), "Cessna 172", "Yak-52", "nichts", "Trike X", "Trikeshaw", "Super Jet Z", "Virus SW") == ["Single Engine Piston", "Single Engine Piston", None, "Microlight / Flex-Wing", None, "Jet", "Ultralight / Light Sport Aircraft (LSA)"]
    assert each(spark, C.is_clean_model, "C42B", "912 ULS", "D-MXXX", "Zum Verkauf", "x", "12.500 €", "O-320", "a b c d e f g") == [True] + [False] * 7
    none = F.lit(None).cast("string")
    assert each(spark, lambda c: C.model_of_title(c, F.lit("Cessna"), none), "Verkaufe Cessna 172 Baujahr 1980", "Cessna 172 N", "Cessna F150 L zum Verkauf aus privater Hand") == ["", "172 N", "F150 L zum"]
    assert each(spark, C.source_priority, "dulv.de", "unbekannt") == [100, 50]
    assert [each(spark, lambda c, o=o: C.compare_priority(F.lit(o), c), "ulforum.de")[0] for o in ("dulv.de", "iata.org", "ulforum.de")] == ["higher", "lower", "equal"]


def test_keys(spark):
    key = lambda t, city, icao=None, start="2026-06-01T10:00:00.000Z": spark.range(1).select(K.canonical_key(F.lit(t), F.lit(start), F.lit(icao).cast("string"), F.lit(city).cast("string"), F.lit("Halle"))).first()[0]
    assert key("Tannkosh 2026 Fly-In", "Ulm") != key("Fly-In Tannkosh 2026", "Ulm")
    assert key("Fest", "Mühlhausen") == key("Fest", "Muhlhausen") and key("Fest", "Ulm") == key("Fest", "Ulm", start="2026-06-01T20:00:00.000Z")
    assert key("x" * 41, "Ulm") == key("x" * 60, "Ulm") and key("", "Ulm") is None and key("Fest", "", None) is None and key("Fest", "Ulm", start="bad") is None
    same = spark.range(1).select(K.content_hash(F.lit("Annual Open"), F.lit("Day 2026")), K.content_hash(F.lit("Annual"), F.lit("Open Day 2026"))).first()
    assert same[0] == same[1]


def test_json_and_urls(spark):
    assert each(spark, J.repaired, '```json\n{"a": {"b": 1,\n```', '{"a":1,}', '{"a":"b', "kaputt") == ['{"a": {"b": 1}}', '{"a":1}', '{"a":"b"}', None]
    assert each(spark, J.date_or_null, "2026-01-02", "2026-13-02", "3/2026", "x") == ["2026-01-02", None, "2026-03-01", None]
    assert each(spark, J.number_or_null, "12.5", "0", "x") == [12.5, None, None]
    page = F.lit("https://h.example/a/b?x=1")
    assert each(spark, lambda c: U.absolute(c, page), "/c", "c", "?y", "#z", "//o/p", "mailto:x", "http://q/") == ["https://h.example/c", "https://h.example/a/c", "https://h.example/a/b?y", "https://h.example/a/b?x=1#z", "https://o/p", "mailto:x", "http://q/"]
    assert each(spark, U.https, "webcal://a/b", "WEBCALS://a", "http://a") == ["https://a/b", "https://a", "http://a"]


def test_image_rules(spark):
    assert each(spark, lambda c: C.image_format(F.unhex(c)), "FFD8FF" + "00" * 9, "89504E47" + "00" * 8, "5249464600000000" + "57454250", "FFD8FF", "00" * 12) == ["jpeg", "png", "webp", None, None]
    assert each(spark, C.is_advertisement, "https://a/Banner.png", "https://a/ad_1.gif", "https://a/road1.gif") == [True, True, False]
    assert each(spark, C.allowed_image_host, "https://www.aircraft24.de/x.jpg", "https://evil.example/x.jpg", "nix") == [True, False, False]


def test_midnight(spark):
    assert each(spark, D.midnight, "2026-06-01T10:00:00", "2026-02-31", "x") == [dt.date(2026, 6, 1), dt.date(2026, 3, 3), None]


def test_nested_found_names_its_text_once(spark):
    """An expression that names its text several times doubles with each level: a number in prose had 64 matches."""
    from aerolith.functions.core import found, led

    df = spark.createDataFrame([("Tank: 1.050,5 l",), ("TANK 7 l",), ("leer",), (None,)], "t string")
    out = df.select(N.extract_number(found(F.col("t"), r"(?iu)(?:Tankinhalt|Tank)[:\s]*([\d.,]+)\s*l")).alias("n"))
    assert [r.n for r in out.collect()] == [1050.5, 7.0, None, None]
    assert out._jdf.queryExecution().analyzed().toString().count("regexp_extract") == 3
    assert led(r"(?iu)(?:Kennz\.?|Zulassung)[:\s]*(\d)") != r"(?iu)(?:Kennz\.?|Zulassung)[:\s]*(\d)"
    signs = spark.createDataFrame([("Kennz: 1",), ("zulaſſung 2",), ("x",)], "t string")
    assert [r[0] for r in signs.select(found(F.col("t"), r"(?iu)(?:Kennz\.?|Zulassung)[:\s]*(\d)")).collect()] == ["1", "2", None]
    for same in ("x?a|b", r"\s+", "(?i)(?:a|b)?c", "a*b", "^a|b", ""):
        assert led(same) == same
