"""Queries over listings-like tables: matching, merging, repairs, parsing of prices and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.functions import classify as C
from aerolith.functions import dates as D
from aerolith.functions import keys as K
from aerolith.functions import numbers as N
from aerolith.functions import text as X
from aerolith.operators import dedup, match, merge, metrics, repair, upsert
from aerolith.plans.catalog import query
from aerolith.rules import tables as T
from aerolith.session import table


def _part(spark, folder):
    return table(spark, folder, "part")


def _specs(spark, folder):
    """Reference entries: each brand, type and second word of names, in order."""
    p = _part(spark, folder)
    return p.groupBy(F.col("p_brand").alias("maker"), F.col("p_type").alias("model"), F.element_at(F.split("p_name", " "), 2).alias("variant")).agg(F.min("p_partkey").alias("ord"), F.min("p_size").alias("spec_size"))


SPECS = "s AS (SELECT p_brand AS maker, p_type AS model, split_part(p_name, ' ', 2) AS variant, min(p_partkey) AS ord, min(p_size) AS spec_size FROM part GROUP BY ALL)"


@query("""WITH m AS (SELECT DISTINCT p_brand AS b FROM part), j AS (SELECT p_partkey, b, row_number() OVER (PARTITION BY p_partkey ORDER BY length(b) DESC NULLS LAST, b) AS k
FROM part LEFT JOIN m ON contains(lower(p_name || ' ' || p_brand || 'x'), lower(b))) SELECT p_partkey, b AS manufacturer FROM j WHERE k = 1""")
def manufacturer_match(spark, folder):
    p = _part(spark, folder)
    titled = p.select("p_partkey", F.concat_ws(" ", "p_name", F.concat("p_brand", F.lit("x"))).alias("title"))
    return match.manufacturer(titled, "p_partkey", "title", p.select(F.col("p_brand").alias("name"))).select("p_partkey", "manufacturer")


@query(f"""WITH {SPECS}, t AS (SELECT p_partkey, lower(p_name || ' ' || p_brand || ' ' || p_type) AS t FROM part),
j AS (SELECT p_partkey, ord, CASE WHEN contains(t, lower(maker)) THEN 2 ELSE 0 END + CASE WHEN contains(t, lower(model)) THEN 3 ELSE 0 END + CASE WHEN variant <> '' AND contains(t, lower(variant)) THEN 1 ELSE 0 END AS score FROM t, s),
k AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, ord) AS n FROM j WHERE score >= 3) SELECT p_partkey, score, ord FROM k WHERE n = 1""")
def spec_score_match(spark, folder):
    titled = _part(spark, folder).select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("text"))
    return match.best_spec(titled, "p_partkey", "text", _specs(spark, folder), "maker", "model", "variant", "ord").select("p_partkey", "score", "ord")


@query(f"""WITH {SPECS}, j AS (SELECT p_partkey, spec_size, ord, 1 + CASE WHEN contains(lower(p_name || ' ' || p_type), lower(model)) THEN 3 ELSE 0 END + CASE WHEN contains(lower(p_name || ' ' || p_type), lower(variant)) THEN 1 ELSE 0 END AS score
FROM part JOIN s ON lower(maker) = lower(p_brand)), k AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, ord) AS n FROM j) SELECT p_partkey, 'size ' || spec_size AS category FROM k WHERE n = 1""")
def category_match(spark, folder):
    titled = _part(spark, folder).select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("title"), "p_brand")
    specs = _specs(spark, folder).withColumn("category", F.concat(F.lit("size "), F.col("spec_size").cast("string")))
    return match.category_of_maker(titled, "p_partkey", "title", "p_brand", specs, "maker", "model", "variant", "category", "ord")


@query(f"""WITH {SPECS}, f AS (SELECT maker, model || ' ' || variant AS full_name, min(ord) AS ord FROM s GROUP BY ALL), j AS (SELECT p_partkey, full_name, row_number() OVER (PARTITION BY p_partkey ORDER BY length(full_name) DESC, ord) AS n
FROM part JOIN f ON lower(maker) = lower(p_brand) AND contains(' ' || lower(p_type || ' ' || p_name) || ' ', ' ' || lower(full_name) || ' ')) SELECT p_partkey, full_name AS model FROM j WHERE n = 1""")
def headline_scan(spark, folder):
    """Types and names that stand side by side in a headline: here where the name's first word equals an entry's."""
    titled = _part(spark, folder).select("p_partkey", F.concat_ws(" ", "p_type", "p_name").alias("headline"), "p_brand")
    return match.headline_models(titled, "p_partkey", "headline", "p_brand", _specs(spark, folder), "maker", "model", "variant", "ord")


@query("""WITH g AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL), c AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS k FROM g) SELECT p_brand, p_type, n FROM c WHERE k = 1""")
def modal_category(spark, folder):
    return metrics.modal_value(_part(spark, folder), "p_brand", "p_type")


@query("""WITH g AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL), c AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS k FROM g)
SELECT p_partkey, CASE WHEN part.p_type IN ('SMALL', 'PROMO') THEN c.p_type ELSE part.p_type END AS p_type FROM part LEFT JOIN c ON part.p_brand = c.p_brand AND k = 1""")
def repair_update(spark, folder):
    p = _part(spark, folder)
    modal = metrics.modal_value(p, "p_brand", "p_type").select("p_brand", "p_type")
    return repair.recategorised(p.select("p_partkey", "p_brand", "p_type"), "p_partkey", "p_brand", "p_type", modal, ("SMALL", "PROMO")).select("p_partkey", "p_type")


@query("""SELECT p_partkey, CASE WHEN p_size > 40 AND p_type = 'PROMO' THEN 'Other' WHEN p_name LIKE '%widget' THEN 'Light Jet' WHEN p_name LIKE 'red%' OR p_name ILIKE '%BOLT%' THEN 'Turboprop' WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'Single Engine Piston' ELSE p_type END AS category FROM part""")
def bulk_classifier(spark, folder):
    rules = [
        (F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"), "Single Engine Piston"),
        (F.col("p_name").like("red%") | F.col("p_name").ilike("%BOLT%"), "Turboprop"),
        (F.col("p_name").like("%widget"), "Light Jet"),
        ((F.col("p_size") > 40) & (F.col("p_type") == "PROMO"), "Other"),
    ]
    return _part(spark, folder).select("p_partkey", repair.last_wins(rules, F.col("p_type")).alias("category"))


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def semi_category(spark, folder):
    urgent = table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey")
    return table(spark, folder, "customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("""SELECT c_custkey, c_name || '@example.org' AS email FROM customer WHERE c_mktsegment <> 'MACHINERY' AND lower(c_name || '@example.org') <> 'customer#000000005@example.org'
AND NOT EXISTS (SELECT 1 FROM supplier WHERE lower('Customer#' || lpad(s_suppkey::VARCHAR, 9, '0') || '@EXAMPLE.ORG') = lower(c_name || '@example.org'))""")
def anti_suppression(spark, folder):
    from aerolith.operators.validate import invite_eligible

    c = table(spark, folder, "customer").withColumn("email", F.concat("c_name", F.lit("@example.org")))
    off = table(spark, folder, "supplier").select(F.concat(F.lit("Customer#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"), F.lit("@EXAMPLE.ORG")).alias("email"))
    return invite_eligible(c, F.col("c_mktsegment") != "MACHINERY", "email", off, "email", "Customer#000000005@example.org").select("c_custkey", "email")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = (SELECT r_regionkey FROM region ORDER BY r_name DESC LIMIT 1)")
def scalar_subquery(spark, folder):
    for name in ("nation", "region"):
        table(spark, folder, name).createOrReplaceTempView(f"aerolith_{name}")
    return spark.sql("SELECT n_nationkey, n_name FROM aerolith_nation WHERE n_regionkey = (SELECT r_regionkey FROM aerolith_region ORDER BY r_name DESC LIMIT 1)")


@query("SELECT c_custkey, n_name AS nation, r_name AS state FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def state_lookup(spark, folder):
    """City and country to state, by lower-cased names, as two dimensions joined into one."""
    n, r = table(spark, folder, "nation"), table(spark, folder, "region")
    dim = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.upper("n_name").alias("city"), F.lit("x").alias("country"), "r_name")
    c = table(spark, folder, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").withColumn("country", F.lit("X"))
    return match.lookup(c, {"n_name": "city", "country": "country"}, dim, "r_name", "state").select("c_custkey", F.col("n_name").alias("nation"), "state")


@query("SELECT c_custkey, (c_nationkey * 3)::DOUBLE AS latitude FROM customer")
def geocode_memo(spark, folder):
    """Each distinct place is asked for once; the provider here is arithmetic."""
    c = table(spark, folder, "customer")
    key = K.geocode_key(F.col("c_mktsegment"), F.col("c_nationkey").cast("string"), F.lit(" edny "), F.lit("Germany"))
    ask = lambda keys: keys.select("key", (F.element_at(F.split("key", r"\|"), 2).cast("double") * 3).alias("answer"))
    return match.memoised(c, key, ask, "latitude").select("c_custkey", "latitude")


def _one_of(values, key):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.col(key), F.lit(len(values))) + 1).cast("int"))


def _values(values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _like(expression: str, rules) -> str:
    """A CASE over ordered rules (condition, value), in SQL."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    return "CASE " + " ".join(f"WHEN {condition} THEN {quoted(value)}" for condition, value in rules) + " END"


#: What titles have beside a part's name: every mark of every category, and forms that only patterns find.
TITLE_MARKS = (*[mark for _, _, in_title, _ in T.CATEGORY_RULES for mark in in_title], "Yak-52 TW", "cj6", "Zlin", "Z-142", "DR 400", "UL", "LSA", "lsa2", "xul", "Unbekannt")
_MARKED = [
    (" OR ".join([*[f"contains(t, '{m}')" for m in in_title], *[f"regexp_matches(t, '{p}')" for p in patterns]]) or "FALSE", name)
    for name, _, in_title, patterns in T.CATEGORY_RULES
]
#: Beginnings of registrations; letters and digits of the key follow.
REGISTRATION_STARTS = (*[start for start, _ in T.REGISTRATION_COUNTRIES], *[f"D-{x}" for x in "EMNKHGIFCB"], "D-", "OE-", "OE-X", "OE-W", "OE-I", "HB-R", "HB-W", "HB-Y", "HB-", "d-k", "XX-", "N")


CITIES = ("86150 Augsburg", "München (EDDM)", "Deutschland, Grefrath", "Kapfenberg LOGK", "hamburg", "Germany", "Cessna Town", "Flugplatz Tannheim", "Bad Wörishofen", "Strausberg/EDAY", "Ulm Hangar 3", "Köln, NRW", "Sehr langer Name einer Stadt in der Heide", "Nähe Ulm", "Bonn 7")


@query(f"WITH p AS (SELECT p_partkey, lower(p_name || ' ' || {_values(TITLE_MARKS)}[(p_partkey % {len(TITLE_MARKS)} + 1)::INT] || ' ' || p_size) AS t FROM part) SELECT p_partkey, {_like('t', _MARKED)} AS category FROM p")
def classify_title(spark, folder):
    """Names of parts, each with a mark of some category."""
    title = F.concat_ws(" ", "p_name", _one_of(TITLE_MARKS, "p_partkey"), F.col("p_size").cast("string"))
    return _part(spark, folder).select("p_partkey", C.aircraft_category(F.lit(None).cast("string"), title).alias("category"))


_REG_FORMS = [(f"regexp_full_match(r, '{form}')", name) for form, name in T.REGISTRATION_CATEGORIES]
_REG_STARTS = [(f"starts_with(r, '{start}')", name) for start, name in T.REGISTRATION_COUNTRIES]


@query(f"""WITH p AS (SELECT p_partkey, upper({_values(REGISTRATION_STARTS)}[(p_partkey % {len(REGISTRATION_STARTS)} + 1)::INT] || CASE WHEN p_partkey % 5 = 0 THEN p_partkey % 10000 || '' ELSE right(translate(p_partkey + 1000000 || '', '0123456789', 'ABCDEFGHIJ'), (p_partkey % 3 + 2)::INT) END) AS r FROM part)
SELECT p_partkey, {_like('r', _REG_FORMS)} AS category, {_like('r', _REG_STARTS)} AS country FROM p""")
def classify_registration(spark, folder):
    """Registrations of every country and form, with letters or digits made from the key."""
    k = F.col("p_partkey")
    letters = F.translate((k + 1_000_000).cast("string"), "0123456789", "ABCDEFGHIJ")
    reg = F.concat(_one_of(REGISTRATION_STARTS, "p_partkey"), F.when(k % 5 == 0, F.concat(F.lit(" "), (k % 10_000).cast("string"))).otherwise(F.right(letters, (k % 3 + 2).cast("int"))))
    return _part(spark, folder).select("p_partkey", C.registration_category(reg).alias("category"), C.registration_country(reg).alias("country"))


@query(f"""SELECT p_partkey, (['Augsburg','München','Grefrath','Kapfenberg',NULL,NULL,NULL,'Tannheim','Bad Wörishofen','Strausberg','Ulm','Köln',NULL,'Ulm',NULL])[(p_partkey % {len(CITIES)} + 1)::INT] AS city,
([NULL,'München',NULL,'Kapfenberg',NULL,NULL,NULL,NULL,'Bad Wörishofen','Strausberg/EDAY',NULL,'Köln',NULL,'Nähe Ulm',NULL])[(p_partkey % {len(CITIES)} + 1)::INT] AS repaired FROM part""")
def city_cleanup(spark, folder):
    city = _one_of(CITIES, "p_partkey")
    return _part(spark, folder).select("p_partkey", X.clean_city(city).alias("city"), repair.clean_city_column(city).alias("repaired"))


@query("""SELECT p_partkey, p_name NOT LIKE '%bolt%' AND p_size % 3 <> 0 AS clean, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name END AS model FROM part WHERE p_name NOT LIKE '%bolt%'
UNION ALL SELECT p_partkey, p_size % 3 <> 0 AS clean, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name END FROM part WHERE p_name LIKE '%bolt%'""")
def clean_model(spark, folder):
    """Names of parts as models; every third size has an engine's name in their place."""
    name = F.when(F.col("p_size") % 3 == 0, F.lit("Rotax 912")).otherwise(F.col("p_name"))
    title = F.concat(F.lit("Verkaufe "), F.col("p_brand"), F.lit(" "), name, F.lit(" Baujahr 1999"))
    none = F.lit(None).cast("string")
    model = C.model_of_title(title, F.col("p_brand"), none)
    return _part(spark, folder).select("p_partkey", C.is_clean_model(name).alias("clean"), model.alias("model"))


@query(f"""WITH {SPECS}, m AS (SELECT maker, model, min(spec_size) AS spec_size FROM s GROUP BY ALL) SELECT p_partkey, coalesce(CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN '' ELSE p_size::VARCHAR END, '') = '' AS was_missing,
CASE WHEN p_partkey % 3 = 2 THEN p_size::VARCHAR ELSE spec_size::VARCHAR END AS cruise_speed, CASE WHEN p_partkey % 3 = 2 THEN NULL ELSE 'kt' END AS cruise_speed_unit, p_name AS engine FROM part LEFT JOIN m ON maker = p_brand AND model = p_type""")
def fill_null_merge(spark, folder):
    p = _part(spark, folder)
    dim = _specs(spark, folder).groupBy("maker", "model").agg(F.min("spec_size").cast("string").alias("spec_cruise_speed"))
    k = F.col("p_partkey") % 3
    rows = p.join(dim, (F.col("maker") == F.col("p_brand")) & (F.col("model") == F.col("p_type")), "left").select(
        "p_partkey", "p_name", F.when(k == 0, None).when(k == 1, "").otherwise(F.col("p_size").cast("string")).alias("cruise_speed"), F.lit(None).cast("string").alias("cruise_speed_unit"),
        F.when(k == 1, "").alias("engine"), "spec_cruise_speed", F.lit("kt").alias("spec_cruise_speed_unit"))
    rows = rows.withColumn("was_missing", F.coalesce(F.col("cruise_speed"), F.lit("")) == "")
    filled = merge.apply_extracted(merge.apply_specs(rows), {"engine": F.col("p_name")})
    return filled.select("p_partkey", "was_missing", "cruise_speed", "cruise_speed_unit", "engine")


@query("SELECT o_orderkey, o_totalprice AS amount, o_orderkey % 2 = 0 AS negotiable, (split_part(printf('%.2f', o_totalprice), '.', 1))::DOUBLE AS whole FROM orders")
def parse_price(spark, folder):
    german = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    text = F.concat(F.lit("€"), german, F.when(F.col("o_orderkey") % 2 == 0, " VB").otherwise(""))
    price = N.parse_price(text)
    return table(spark, folder, "orders").select("o_orderkey", price["amount"].alias("amount"), price["negotiable"].alias("negotiable"), F.floor(N.price_in_text(F.concat(F.lit("Preis: "), german, F.lit(" EUR")))["amount"]).cast("double").alias("whole"))


@query("SELECT o_orderkey, o_totalprice AS with_groups, left(regexp_replace(split_part(printf('%.2f', o_totalprice), '.', 1), '\\D', '', 'g'), 3)::DOUBLE AS first_three, floor(o_totalprice)::DOUBLE AS whole FROM orders")
def extract_number(spark, folder):
    german = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    bare = F.floor("o_totalprice").cast("string")
    return table(spark, folder, "orders").select("o_orderkey", N.extract_number(F.concat(F.lit("ca. "), german)).alias("with_groups"), N.extract_number(bare).alias("first_three"), N.parse_number(bare).alias("whole"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS full_date, strftime(o_orderdate, '%Y-%m-01') AS month_date FROM orders")
def german_date(spark, folder):
    o = F.col("o_orderdate")
    return table(spark, folder, "orders").select("o_orderkey", D.german_date(F.concat(F.lit("am "), F.date_format(o, "dd.MM.yyyy"), F.lit(" Uhr"))).alias("full_date"), D.german_date(F.date_format(o, "M/yyyy")).alias("month_date"))


@query("""SELECT o_orderkey, o_orderdate::DATE AS range_start, (o_orderdate + to_days((o_orderkey % 20)::INT))::DATE AS range_end, o_orderdate::DATE AS loose_start, (date_trunc('month', o_orderdate) + INTERVAL 30 DAY)::DATE AS overflow FROM orders""")
def german_range(spark, folder):
    o = F.col("o_orderdate")
    later = o + F.make_dt_interval((F.col("o_orderkey") % 20).cast("int"))
    plain = D.german_range(F.concat(F.date_format(o, "d.M.yyyy"), F.lit(" – "), F.date_format(later, "dd.MM.yyyy")))
    loose = D.loose_german_range(F.concat(F.date_format(o, "dd.MM."), F.lit(" - 31."), F.date_format(o, "MM.yyyy"), F.lit(" Treffen")))
    return table(spark, folder, "orders").select("o_orderkey", plain["start"].alias("range_start"), plain["end"].alias("range_end"), loose["start"].alias("loose_start"), loose["end"].alias("overflow"))


@query("""WITH c AS (SELECT o_orderkey, make_date(2026, month(o_orderdate), CASE WHEN month(o_orderdate) = 2 AND day(o_orderdate) = 29 THEN 28 ELSE day(o_orderdate) END) + CASE WHEN month(o_orderdate) = 2 AND day(o_orderdate) = 29 THEN 1 ELSE 0 END AS d,
  o_orderdate FROM orders) SELECT o_orderkey, CASE WHEN d < DATE '2026-04-25' - 30 THEN (make_date(2027, month(o_orderdate), 1) + (day(o_orderdate) - 1)::INT)::DATE ELSE (make_date(2026, month(o_orderdate), 1) + (day(o_orderdate) - 1)::INT)::DATE END AS start FROM c""")
def iata_year_roll(spark, folder):
    o = F.col("o_orderdate")
    now = F.lit("2026-04-25").cast("timestamp_ntz")
    return table(spark, folder, "orders").select("o_orderkey", D.yearless_range(F.date_format(o, "d MMMM"), now)["start"].alias("start"))


@query("SELECT o_orderkey, o_orderdate::DATE AS us_start, (o_orderdate + INTERVAL 3 DAY)::DATE AS us_end, o_orderdate::DATE AS fair_start FROM orders")
def named_ranges(spark, folder):
    o = F.col("o_orderdate")
    later = o + F.expr("INTERVAL 3 DAYS")
    same = F.year(o) == F.year(later)
    us = D.us_range(F.when(same, F.concat(F.date_format(o, "MMM. d"), F.lit(" – "), F.date_format(later, "MMMM d, yyyy"))))
    fair = D.fair_range(F.date_format(o, "MMMM d, yyyy"))
    return table(spark, folder, "orders").select("o_orderkey", F.coalesce(us["start"], o.cast("date")).alias("us_start"), F.coalesce(us["end"], later.cast("date")).alias("us_end"), fair["start"].alias("fair_start"))


@query("""WITH t AS (SELECT o_orderkey AS k, o_orderkey % 7 <> 0 AS is_external, CASE WHEN o_orderkey % 11 = 0 THEN o_orderdate END AS claimed_at, o_totalprice AS price, o_orderstatus AS status FROM orders WHERE o_orderkey % 2 = 0)
SELECT coalesce(t.k, o.o_orderkey) AS o_orderkey, CASE WHEN t.k IS NULL THEN o.o_totalprice + 1 WHEN o.o_orderkey IS NOT NULL AND t.is_external AND t.claimed_at IS NULL THEN o.o_totalprice + 1 ELSE t.price END AS price,
CASE WHEN t.k IS NULL THEN 'new' ELSE t.status END AS status FROM t FULL JOIN (SELECT * FROM orders WHERE o_orderkey % 3 = 0) o ON t.k = o.o_orderkey""")
def claimed_guard(spark, folder):
    """A snapshot after an upsert: claimed rows stay, known ones change in price only, new ones are added."""
    o = table(spark, folder, "orders")
    target = o.where("o_orderkey % 2 = 0").select("o_orderkey", (F.col("o_orderkey") % 7 != 0).alias("is_external"), F.when(F.col("o_orderkey") % 11 == 0, F.col("o_orderdate")).alias("claimed_at"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    staged = o.where("o_orderkey % 3 = 0").select("o_orderkey", (F.col("o_totalprice") + 1).alias("price"), F.lit("new").alias("status"))
    return upsert.snapshot(staged, target, "o_orderkey", ["price"]).select("o_orderkey", "price", "status")


@query("SELECT o_custkey, o_orderpriority FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) x WHERE NOT EXISTS (SELECT 1 FROM orders y WHERE y.o_custkey = x.o_custkey AND y.o_orderpriority = x.o_orderpriority AND y.o_orderstatus = 'F')")
def insert_missing(spark, folder):
    o = table(spark, folder, "orders")
    return upsert.insert_missing(o.select("o_custkey", "o_orderpriority"), o.where("o_orderstatus = 'F'").select("o_custkey", "o_orderpriority"), ["o_custkey", "o_orderpriority"])


@query("SELECT o_orderkey, 1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS listing_number FROM orders")
def listing_numbers(spark, folder):
    return upsert.numbered(table(spark, folder, "orders").select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], 1000).select("o_orderkey", "listing_number")


@query("SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, c_nationkey LIMIT 30")
def top_cities(spark, folder):
    """A report: the 30 places with most rows."""
    return table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "c_nationkey").limit(30)


@query("""SELECT p_partkey, p_brand || ' ' || p_type || CASE WHEN p_size >= 19 THEN '. Baujahr ' || (1900 + p_size) ELSE '. Baujahr ' || (1900 + p_size) END || '. ' ||
CASE WHEN p_partkey % 3 = 0 THEN 'Preis: ' || replace(replace(replace(regexp_replace(regexp_replace(printf('%,.1f', round(p_retailprice, 1)), '0+$', ''), '\\.$', ''), ',', '#'), '.', ','), '#', '.') || ' EUR' WHEN p_partkey % 3 = 1 THEN 'Preis Verhandlungssache' ELSE 'Preis auf Anfrage' END || '. Aus dem Bestand.' AS description FROM part""")
def listing_descriptions(spark, folder):
    k = F.col("p_partkey") % 3
    text = merge.listing_description(F.col("p_brand"), F.col("p_type"), F.col("p_size") + 1900, F.when(k == 0, F.round("p_retailprice", 1)), k == 1, "Aus dem Bestand")
    return _part(spark, folder).select("p_partkey", text.alias("description"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'jpeg' WHEN 1 THEN 'png' WHEN 2 THEN 'webp' END AS format, substr(sha256(unhex(CASE p_partkey % 4 WHEN 0 THEN 'FFD8FF' WHEN 1 THEN '89504E47' WHEN 2 THEN '52494646000000005745425000' ELSE '4749' END || '000000000000000000')), 1, 24) || '.bin' AS name FROM part""")
def magic_bytes(spark, folder):
    head = F.element_at(F.array(*[F.lit(x) for x in ("FFD8FF", "89504E47", "52494646000000005745425000", "4749")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    data = F.unhex(F.concat(head, F.lit("000000000000000000")))
    return _part(spark, folder).select("p_partkey", C.image_format(data).alias("format"), K.image_name(data, F.lit("bin")).alias("name"))


@query("SELECT p_partkey, (['Rotax','Garmin','small'])[CASE WHEN p_partkey % 3 = 0 THEN 1 WHEN p_partkey % 3 = 1 THEN 2 ELSE 3 END] AS brand, ([1, 2, 5])[(p_partkey % 3 + 1)::INT] AS category_id FROM part WHERE TRUE".replace("'small'])[", "split_part(p_name, ' ', 1)])["))
def part_brands(spark, folder):
    k = F.col("p_partkey") % 3
    title = F.concat(F.col("p_name"), F.when(k == 0, " for ROTAX 912").when(k == 1, " garmin GTX").otherwise(""))
    category = F.element_at(F.array(F.lit("avionics"), F.lit("engines"), F.lit("rescue")), (k + 1).cast("int"))
    from aerolith.functions.core import looked_up

    return _part(spark, folder).select("p_partkey", C.part_brand(title).alias("brand"), looked_up(category, T.PARTS_CATEGORY_IDS).alias("category_id"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM (SELECT l_orderkey, l_linenumber FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey % 5 = 0) GROUP BY ALL HAVING count(*) > 1")
def duplicate_audit(spark, folder):
    li = table(spark, folder, "lineitem")
    return dedup.duplicates(li.select("l_orderkey", "l_linenumber").union(li.where("l_partkey % 5 = 0").select("l_orderkey", "l_linenumber")), "l_orderkey", "l_linenumber")


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
round(avg(l_discount), 6) AS avg_disc FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def pricing_summary(spark, folder):
    li = table(spark, folder, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"), F.round(F.sum(price), 2).alias("sum_disc_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"))
