from pyspark.sql import functions as F

from aerolith.sources import listing_pages as L


def one(spark, f, html, *args, url="https://www.example.org/list/index.htm"):
    return f(spark.createDataFrame([(url, html)], "page_url string, payload string"), "site", *args).collect()


BLOCK = """<body><p>Startseite Impressum</p><hr><b>Comco Ikarus C42</b> 03.02.2026 <br>Baujahr: 2015 • Motor: Rotax 912 ULS • TT: 450 • MTOW: 472,5 kg • Standort: 86899 Landsberg am Lech, gepflegtes Flugzeug
Preis: €35.500 VB <a href="mailto:%69nfo@x.de">Mail</a> Kennzeichen: D-MABC <img src="/bild.jpg" width="300" height="200"><img src="icon.gif" width="10" height="10"><hr></body>"""


def test_prose_aircraft(spark):
    (r,) = one(spark, L.prose_aircraft, BLOCK)
    assert (r.title, r.posted_date, r.year, r.total_time, r.mtow, r.price, r.price_negotiable) == ("Comco Ikarus C42", "2026-02-03", 2015, 450.0, 472.5, 35500.0, True)
    assert (r.registration, r.contact_email, r.image_urls, r.engine) == ("D-MABC", "info@x.de", ["https://www.example.org/bild.jpg"], "Rotax 912 ULS")
    assert r.source_id == "https://www.example.org/list/index.htm#0@2026-02-03"


def test_prose_parts_take_the_category_above(spark):
    html = """<body><h2>Avionik und Funkgeräte</h2> und mehr davon hier<hr><b>Funkgerät Becker AR4201</b> 01.01.2026 Zustand: gut, Preis: 500 EUR MWSt ausweisbar, guter Zustand<hr>Propeller aller Art gibt es hier unten<hr>
    <b>Luftschraube 2-Blatt</b> 02.01.2026 Preis: 900 EUR VB, kaum gebraucht und gepflegt</body>"""
    a, b = sorted(one(spark, L.prose_parts, html), key=lambda r: r.source_id)
    assert (a.title, a.category, a.price, a.condition, a.vat_included) == ("Funkgerät Becker AR4201", "avionics", 500.0, "gut", True)
    assert (b.category, b.price, b.price_negotiable, b.vat_included) == ("propellers", 900.0, True, None)


def test_index_cards(spark):
    html = """<div class="listing"><a href="/singleprop/cessna/172--xi123.htm">Cessna 172 Bj.: 1980</a> Bj.: 1980; TTAF: 2.345; Standort: Strausberg/EDAY, Deutschland; € 45.000 D-EABC <img src="/logo.png"><img src="/a.jpg"></div><a href="p2.htm">Weiter</a><a href="/x--xm1.htm">m</a>"""
    (r,) = one(spark, L.index_cards, html)
    assert (r.title, r.year, r.total_time, r.price, r.city, r.icao, r.country, r.registration) == ("Cessna 172", 1980, 2345.0, 45000.0, "Strausberg", "EDAY", "Germany", "D-EABC")
    assert r.source_id == "site:/singleprop/cessna/172--xi123.htm" and r.image_urls == ["https://www.example.org/a.jpg"]
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(html, "https://www.example.org/list/index.htm")], "h string, u string")
    got = df.select(L.next_page(F.col("h"), F.col("u")), L.model_links(F.col("h"), F.col("u")), L.url_hints(F.lit("https://a/singleprop/de-havilland/x.htm"))).first()
    assert got[0] == "https://www.example.org/list/p2.htm" and got[1] == ["https://www.example.org/x--xm1.htm"] and tuple(got[2]) == ("Single Engine Piston", "de havilland")


GRID = """<div class="listview-item"><div class="new-lfz-description"><h2><a href="/d/1"><strong>Piper</strong></a></h2><h3><strong>PA-28</strong></h3></div><p class="price"><span>12.500,50 € Verhandlungssache</span></p>Baujahr: 1978 Standort: Ulm<img class="img-fluid" src="/p.jpg"></div>
<div class="listview-item"><div class="new-lfz-description"><h2><strong>Alt</strong></h2></div>Baujahr: 1800</div>"""


def test_grid(spark):
    (r,) = one(spark, L.grid_aircraft, GRID, "https://g.example", "Ende")
    assert (r.title, r.price, r.price_negotiable, r.year, r.city, r.source_id, r.image_urls) == ("Piper PA-28", 12500.5, True, 1978, "Ulm", "https://g.example/d/1", ["https://g.example/p.jpg"])
    assert r.description == "Piper PA-28. Baujahr 1978. Preis: 12.500,5 EUR. Ende."
    parts = one(spark, L.grid_parts, GRID, "https://g.example", url="https://g.example/triebwerke/")
    assert {p.category for p in parts} == {"engines"}


def test_details_win_over_cards(spark):
    cards = L.grid_aircraft(spark.createDataFrame([("https://g.example/l", GRID)], "page_url string, payload string"), "site", "https://g.example", "Ende")
    html = """<html><body><main>Betriebsstunden: 1.234 Leergewicht: 650 kg Kennzeichen: D-EFGH AVGAS Standort: Ulm (EDUM)</main></body></html>"""
    details = spark.createDataFrame([("https://g.example/d/1", html)], "page_url string, payload string")
    (r,) = L.with_details(cards, details).collect()
    assert (r.total_time, r.empty_weight, r.registration, r.fuel_type, r.icao, r.country, r.price) == (1234.0, 650.0, "D-EFGH", "AVGAS", "EDUM", "Germany", 12500.5)
    (same,) = L.with_details(cards, details.where("false")).collect()
    assert (same.total_time, same.title) == (None, "Piper PA-28")


def test_null_and_empty_pages(spark):
    pages = spark.createDataFrame([("u", None), ("u", "")], "page_url string, payload string")
    assert L.prose_aircraft(pages, "s").count() == L.index_cards(pages, "s").count() == L.grid_parts(pages, "s", "x").count() == 0


def test_index_pages_without_classes_take_the_parents_of_links(spark):
    html = """<div><a href="/x/y--xi1.htm">Cessna 172</a> Bj.: 1980; Standort: Ulm; € 45.000 <b>x</b></div><div><a href="/x/z--xi2.htm">Piper PA-28 Archer</a> Bj.: 1981; € 50.000</div><div><a href="/q--xi3.htm">k</a></div><a href="/p.htm">keine</a>"""
    got = one(spark, L.index_cards, html)
    assert [(r.title, r.year, r.source_id) for r in got] == [("Cessna 172", 1980, "site:/x/y--xi1.htm"), ("Piper PA-28 Archer", 1981, "site:/x/z--xi2.htm")]
    # a card of its class, however, is enough for the links outside to be left alone; too short a card is none
    card = '<div class="listing"><a href="/s--xi9.htm">Diamond DA 40</a> Baujahr unbekannt, sonst gut</div>'
    assert [r.title for r in one(spark, L.index_cards, html + card)] == ["Diamond DA 40"]
    assert len(one(spark, L.index_cards, html + '<p class="listing">x</p>')) == 2


def test_folded_sections_of_all_shapes():
    from aerolith.sources.cards import folded_sections

    text = lambda html: folded_sections(f"<body><main>{html}</main></body>", L.FOLDS)
    item = '<div class="accordion-item"><div class="accordion-header"><h3> Exterior </h3></div><div class="accordion-collapse"><div class="accordion-body">Garmin  430\n und mehr</div></div></div>'
    assert text(item) == {"exterior": "Garmin 430 und mehr"}
    assert text('<button data-bs-toggle="collapse" data-bs-target="#a">Innen</button><a data-toggle="collapse" href="#b">Avionik</a><a data-toggle="collapse" href="x">y</a><a data-toggle="collapse" href="#no">z</a><div id="b">Becker Funk</div><div id="a"><p>Leder, vier Sitze</p></div>') == {"innen": "Leder, vier Sitze", "avionik": "Becker Funk"}
    assert text("<details><summary>Sonstige</summary>Text <b>hier</b> </details><details><summary>Kurz</summary>abc</details>") == {"sonstige": "Text hier"}
    assert text('<div class="card-header">Interior</div>\n<div class="card-body">Sechs Sitze</div><div class="panel-heading">Ohne</div><p>nicht gefragt</p>') == {"interior": "Sechs Sitze"}
    # the first way that finds any is the only one; of equal names the last counts; nothing folded gives nothing
    assert text(item + "<details><summary>Innen</summary>nicht gelesen</details>" + item.replace("430", "530")) == {"exterior": "Garmin 530 und mehr"}
    assert text("<p>nichts</p>") == {} and folded_sections("", L.FOLDS) == {}
    assert folded_sections("<details><summary>Sonstige</summary>ohne Hauptteil</details>", L.FOLDS) == {"sonstige": "ohne Hauptteil"}


def test_an_interior_alone_is_added_to_the_description(spark):
    cards = L.grid_aircraft(spark.createDataFrame([("https://g.example/l", GRID)], "page_url string, payload string"), "site", "https://g.example", "Ende")
    page = "<body><main><details><summary>Innen</summary>Leder in gutem Zustand, vier Sitze</details></main></body>"
    (r,) = L.with_details(cards, spark.createDataFrame([("https://g.example/d/1", page)], "page_url string, payload string")).collect()
    assert r.description == "Piper PA-28. Baujahr 1978. Preis: 12.500,5 EUR. Ende. Leder in gutem Zustand, vier Sitze"


def test_siblings_and_ids_are_indexed():
    from aerolith.sources import dom

    page = dom.parse("<ul>" + "".join(f"<li id='i{k % 3}'>{k}</li>" for k in range(20_000)) + "</ul>")
    node, n = page.select("li")[0], 1
    while (node := node.next()) is not None:
        n += 1
    assert n == 20_000 and page.ids()["i2"].text() == "2"


def test_trees_of_pages_do_not_pile_up(spark):
    """A page's tree goes when its cards are taken, and pages go to Python in small batches, whatever their size."""
    import gc

    from aerolith.sources import cards, dom

    html = "<div class='listview-item'><h3><strong>A</strong></h3></div>" * 3
    gc.collect()
    gc.disable()
    try:
        assert [len(cards.extract(html, L.GRID)) for _ in range(5)] == [3] * 5
        assert cards.folded_sections("<main><details><summary>Kopf</summary>lange genug</details></main>", L.FOLDS) == {"kopf": "lange genug"}
        assert sum(isinstance(x, dom.Node) for x in gc.get_objects()) == 0
    finally:
        gc.enable()
    rows = spark.createDataFrame([(html,), (None,), ("",)], "html string").select(cards.cards(F.col("html"), L.GRID).alias("c"))
    assert "ArrowEvalPython" not in rows._jdf.queryExecution().executedPlan().toString()
    assert [len(r.c) for r in rows.collect()] == [3, 0, 0]


def test_a_detail_page_is_parsed_once(spark):
    """Cards and folded sections of a page come from one call, the same as from two."""
    from aerolith.sources.cards import cards, cards_and_folds, folds
    from aerolith.sources.listing_pages import DETAIL, FOLDS, with_details

    page = "<html><body><main>Leergewicht: 600 kg <details><summary>Avionik</summary>Garmin 430 und mehr</details></main></body></html>"
    pages = spark.createDataFrame([("u", page), ("v", "<p>x</p>"), ("w", page[:60])], "page_url string, payload string")
    p = F.col("payload")
    both = cards_and_folds(p, DETAIL, FOLDS)
    assert all(r.a == r.b and r.c == r.d for r in pages.select(both["cards"].alias("a"), cards(p, DETAIL).alias("b"), both["folds"].alias("c"), folds(p, FOLDS).alias("d")).collect())
    from aerolith import schemas

    out = with_details(spark.createDataFrame([], schemas.LISTING), pages)
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "card_rows(" not in plan and plan.count("both(") == 1
