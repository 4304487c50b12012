"""Queries over sources: card extraction, calendars, frontiers, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.operators.scratch import scratch_path, written
from aerolith.plans.catalog import query
from aerolith.plans.events import RUNS, arriving
from aerolith.session import table
from aerolith.sources import ics
from aerolith.sources.cards import Cards, cards
from aerolith.sources.landing import reachable
from aerolith.streaming import incremental

PAGE = Cards("html", {"lang": ("", "attr:lang"), "heading": ("h1", "text"), "first_link": ("nav a", "attr:href"), "last_link": ("nav a", "last:href"), "links": ("nav li a", "all:href")})


@query(r"""SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, nullif(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '') IS NOT NULL AS has_heading,
len(regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'), '<a\s[^>]*href="([^"]*)"', 1))::INT AS n_links, nullif(regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'), 'href="([^"]*)"', 1)[1], '') AS first_link FROM pages""")
def page_cards(spark, folder):
    """The same tree access that the sources' parsers use, over all pages."""
    c = cards(F.col("html"), PAGE)[0]
    p = table(spark, folder, "pages").select("page_id", c.alias("c"))
    get = lambda k: F.col("c").getItem(k)
    n = F.size(F.filter(F.split(F.coalesce(get("links"), F.lit("")), "\n"), lambda x: x != ""))
    return p.select("page_id", get("lang").alias("lang"), (F.trim(F.coalesce(get("heading"), F.lit(""))) != "").alias("has_heading"), n.alias("n_links"), get("first_link").alias("first_link"))


@query("""WITH e AS (SELECT event_id, user_id, ts FROM events)
SELECT event_id, 'Treffen ' || event_id || ', Ulm' AS title, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S.000Z') AS start_iso, strftime(date_trunc('second', ts) + INTERVAL 90 MINUTE, '%Y-%m-%dT%H:%M:%S.000Z') AS end_iso,
'Tannheim' AS venue, 'EDMT' AS icao, 'meetup' AS category FROM e WHERE event_id % 10 <> 3""")
def calendar_events(spark, folder):
    """A calendar of each user's events, written as iCalendar text with folded lines, then read back."""
    e = table(spark, folder, "events")
    stamp = F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'")
    status = F.when(F.col("event_id") % 10 == 3, "CANCELLED").otherwise("CONFIRMED")
    event = F.concat_ws("\r\n", F.lit("BEGIN:VEVENT"), F.concat(F.lit("UID:"), F.col("event_id").cast("string")), F.concat(F.lit("SUMMARY:Treffen\r\n  "), F.col("event_id").cast("string"), F.lit("\\, Ulm")), F.concat(F.lit("DTSTART:"), stamp),
                        F.lit("DURATION:PT1H30M"), F.lit("LOCATION:Tannheim (EDMT)"), F.lit("CATEGORIES:Nichts,Meetup"), F.concat(F.lit("STATUS:"), status), F.concat(F.lit("URL:https://example.org/"), F.col("event_id").cast("string")), F.lit("END:VEVENT"))
    feeds = e.groupBy("user_id").agg(F.array_join(F.collect_list(event), "\r\n").alias("body")).select(
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("name"), F.concat(F.lit("https://example.org/"), F.col("user_id").cast("string"), F.lit(".ics")).alias("url"), F.lit("DE").alias("country"), F.lit("general").alias("default_category"),
        F.lit("Europe/Berlin").alias("timezone"), F.lit("de").alias("source_locale"), F.lit("LSV").alias("organiser_name"), F.concat(F.lit("﻿BEGIN:VCALENDAR\r\nX-WR-TIMEZONE:Europe/Berlin\r\n"), F.col("body"), F.lit("\r\nEND:VCALENDAR\r\n")).alias("payload"))
    out = ics.calendar_events(feeds, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    from aerolith.functions.dates import iso

    return out.select(F.regexp_extract("event_url", r"(\d+)$", 1).cast("long").alias("event_id"), "title", iso(F.col("start")).alias("start_iso"), iso(F.col("end")).alias("end_iso"), "venue", "icao", "category")


@query("""WITH RECURSIVE l AS (SELECT c_custkey AS a, c_custkey * 2 + 1 AS b FROM customer UNION ALL SELECT c_custkey, c_custkey + 7 FROM customer WHERE c_custkey % 3 = 0),
r(page, step) AS (SELECT 0::BIGINT, 0 UNION SELECT l.b, r.step + 1 FROM r JOIN l ON l.a = r.page WHERE r.step < 5) SELECT page, min(step)::INT AS step FROM r GROUP BY page""")
def frontier(spark, folder):
    """Pages that five steps of links lead to, each with the first step that finds it."""
    c = F.col("c_custkey")
    k = table(spark, folder, "customer")
    links = k.select(c.cast("string").alias("page_url"), (c * 2 + 1).cast("string").alias("next_url")).union(k.where(c % 3 == 0).select(c.cast("string"), (c + 7).cast("string")))
    starts = spark.range(1).select(F.col("id").cast("string").alias("page_url"))
    return reachable(starts, links, 5).select(F.col("page_url").cast("long").alias("page"), "step")


#: Waves in which a table arrives as a stream, and files of each.
WAVES, FILES = 3, 4


def _stream(df: DataFrame, key: str) -> DataFrame:
    """A table as a stream: waves of files, one after the other, each written by several tasks; a micro-batch takes as
    many files as a wave has, whatever wave they are of."""
    where = scratch_path(df.sparkSession, "stream")
    rows = written(df.withColumn("wave", F.pmod(F.xxhash64(key), F.lit(WAVES))), "waves")
    for k in range(WAVES):
        rows.where(F.col("wave") == k).drop("wave").repartition(FILES).write.mode("append").parquet(where)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", FILES).parquet(where)


#: Lists of pages as linked by numbers: every 17th customer starts a list, whose next page is its number twice and five
#: more; pages divisible by 4 have none.
@query("""WITH RECURSIVE s AS (SELECT c_custkey AS list, c_custkey AS page_key FROM customer WHERE c_custkey % 17 = 3),
w(list, page_key, page) AS (SELECT list, page_key, 1 FROM s UNION ALL SELECT list, (page_key * 2 + 5) % 1000003, page + 1 FROM w WHERE page < 10 AND page_key % 4 <> 0),
n AS (SELECT *, row_number() OVER (ORDER BY list, page) AS place FROM w) SELECT list, page_key, page::INT AS page, place FROM n WHERE place <= 50""")
def bounded_frontier(spark, folder):
    """Lists of pages followed to their next pages: ten of a list, fifty in all, in the lists' order."""
    from aerolith.sources.landing import followed

    k = table(spark, folder, "customer").select(F.col("c_custkey").alias("list"))
    starts = k.where("list % 17 = 3").select("list", F.col("list").alias("ord"), F.col("list").cast("string").alias("page_url"))
    # the links of all pages that ten steps can reach
    reach = starts.select(F.col("list").alias("n"))
    every = reach
    for _ in range(10):
        reach = reach.where("n % 4 <> 0").select(((F.col("n") * 2 + 5) % 1000003).alias("n"))
        every = every.union(reach)
    links = every.distinct().where("n % 4 <> 0").select(F.col("n").cast("string").alias("page_url"), ((F.col("n") * 2 + 5) % 1000003).cast("string").alias("next_url"))
    return followed(starts, links, 10, 50).select("list", F.col("page_url").cast("long").alias("page_key"), "page", "place")


@query("""SELECT page_id, source, strlen(html)::BIGINT AS bytes, CASE WHEN strlen(html) BETWEEN 1 AND 3000 THEN sha1(html) END AS digest, CASE WHEN strlen(html) = 0 THEN 'empty' WHEN strlen(html) > 3000 THEN 'too-large' END AS drop_reason
FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'a.example' WHEN 1 THEN 'b.example' ELSE 'c.example' END AS source, CASE WHEN page_id % 50 = 0 THEN '' ELSE coalesce(html, '') END AS html FROM pages) WHERE source <> 'c.example'""")
def payload_files(spark, folder):
    """All pages landed as files below a folder for each of three sources, and those of two sources read back: empty files
    and files over 3,000 bytes have a reason instead of a payload."""
    from aerolith.sources.payload_source import payloads

    p = table(spark, folder, "pages")
    i = F.col("page_id")
    source = F.when(i % 3 == 0, "a.example").when(i % 3 == 1, "b.example").otherwise("c.example")
    below = scratch_path(spark, "landed")
    land(p.select(F.concat(F.lit("source="), source, F.lit("/"), i.cast("string"), F.lit(".html")).alias("name"), F.when(i % 50 == 0, "").otherwise(F.coalesce("html", F.lit(""))).cast("binary").alias("data")), below)
    found = payloads(spark, path=below, most_bytes=3000).where(F.col("source").isin("a.example", "b.example"))
    return found.select(F.regexp_extract("page_url", r"(\d+)\.html$", 1).cast("long").alias("page_id"), "source", "bytes", F.sha1("payload").alias("digest"), "drop_reason")


def land(df: DataFrame, below: str) -> None:
    """Write a file for each row (name, data) below a folder, in tasks."""

    def write(batches):
        from aerolith.sources.payload_source import opened

        system, inner, _ = opened(below)
        made = set()
        for batch in batches:
            for name, data in zip(batch.column("name").to_pylist(), batch.column("data").to_pylist(), strict=True):
                parent = f"{inner}/{name}".rpartition("/")[0]
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(f"{inner}/{name}") as f:
                    f.write(data)
            yield batch.slice(0, 0)

    df.mapInArrow(write, df.schema).write.format("noop").mode("overwrite").save()


@query("""SELECT user_id, arg_max(CASE event_type WHEN 'purchase' THEN 'dulv.de' WHEN 'signup' THEN 'ulforum.de' ELSE 'iata.org' END, (CASE event_type WHEN 'purchase' THEN 100 WHEN 'signup' THEN 60 ELSE 40 END, -epoch_us(ts))) AS winner, count(*) AS n FROM events GROUP BY user_id""")
def streaming_winners(spark, folder):
    """The best source of each key, kept by a stream."""
    source = F.when(F.col("event_type") == "purchase", "dulv.de").when(F.col("event_type") == "signup", "ulforum.de").otherwise("iata.org")
    stream = _stream(table(spark, folder, "events"), "event_id").withColumn("source", source)
    below = scratch_path(spark, "winners")
    incremental.to_completion(incremental.winners_writer(stream, below, "user_id", "source", "ts", "user_id long", parts=8))
    return incremental.winners(spark, below, "user_id long").select("user_id", "winner", "n")


@query("SELECT user_id, count(*) AS n, round(sum(value), 4) AS total, NULL::TIMESTAMP AS claimed_at FROM events WHERE user_id IS NOT NULL GROUP BY user_id")
def streaming_upsert(spark, folder):
    """Raw rows in micro-batches: each adds what it has of a user to the user's stored row, so that a batch that is lost
    or counted twice shows."""
    e = table(spark, folder, "events").where("user_id IS NOT NULL").select("event_id", "user_id", F.lit(1).cast("long").alias("n"), F.coalesce("value", F.lit(0.0)).alias("total"))
    below = scratch_path(spark, "upserts")
    schema = "user_id long, n long, total double, is_external boolean, claimed_at timestamp_ntz"
    incremental.to_completion(incremental.upsert_writer(_stream(e, "event_id").drop("event_id"), below, "user_id", None, ["n", "total"], [F.col("n")], schema, parts=8, adding=["n", "total"]))
    return incremental.current(spark, below, schema).select("user_id", "n", F.round("total", 4).alias("total"), "claimed_at")


def _in_waves(rows: DataFrame, wave: str, waves: int, start) -> DataFrame:
    """Rows that arrive wave by wave: each wave is landed in several files and a stream, made by start(stream, folder), run
    over it to its end before the next one comes. What the stream has written, with its batch's number."""
    spark = rows.sparkSession
    where, below = scratch_path(spark, "waves"), scratch_path(spark, "stream-out")
    rows = written(rows, "waves")
    plain = rows.drop(wave)
    for k in range(waves):
        rows.where(F.col(wave) == k).drop(wave).repartition(FILES).write.mode("append").parquet(where)
        out = start(spark.readStream.schema(plain.schema).parquet(where))
        incremental.to_completion(out.writeStream.format("parquet").option("path", f"{below}/out").option("checkpointLocation", f"{below}/checkpoint").outputMode("append"))
    return spark.read.schema(out.schema).parquet(f"{below}/out")


#: Thirds of the month, and every tenth row a third later than it should come: behind the watermark, if not by less than
#: a day. State goes six days after a key's newest row, by the watermark.
THIRDS = """WITH e AS (SELECT event_id, user_id * 7 + event_id % 7 AS k, event_type, date_trunc('milliseconds', ts) AS ts, (day(ts) - 1) // 11 AS third FROM events WHERE user_id IS NOT NULL),
a AS (SELECT *, least(third + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END, 2) AS wave FROM e),
w AS (SELECT wave, max(max(ts)) OVER (ORDER BY wave) - INTERVAL 1 DAY AS mark FROM a GROUP BY wave),
o AS (SELECT a.* FROM a LEFT JOIN w ON w.wave = a.wave - 1 WHERE w.mark IS NULL OR a.ts > w.mark),
g AS (SELECT wave, k, max(ts) AS "at", arg_max(event_type, (ts, event_id::VARCHAR)) AS content, count(*) AS n FROM o GROUP BY ALL)"""


@query(THIRDS + """, s0 AS (SELECT g.*, 'inserted' AS outcome FROM g WHERE wave = 0), x0 AS (SELECT s0.*, "at" + INTERVAL 6 DAY <= mark AS gone FROM s0 JOIN w USING (wave)),
s1 AS (SELECT 1 AS wave, coalesce(g.k, p.k) AS k, greatest(g."at", p."at") AS "at", CASE WHEN g."at" > p."at" OR p."at" IS NULL THEN g.content ELSE p.content END AS content, g.n, p.content AS old, p.k IS NOT NULL AS had
  FROM (SELECT * FROM g WHERE wave = 1) g FULL JOIN (SELECT * FROM x0 WHERE NOT gone) p ON g.k IS NOT DISTINCT FROM p.k),
x1 AS (SELECT s1.*, "at" + INTERVAL 6 DAY <= mark AS gone FROM s1 JOIN w USING (wave)),
s2 AS (SELECT 2 AS wave, coalesce(g.k, p.k) AS k, greatest(g."at", p."at") AS "at", CASE WHEN g."at" > p."at" OR p."at" IS NULL THEN g.content ELSE p.content END AS content, g.n, p.content AS old, p.k IS NOT NULL AS had
  FROM (SELECT * FROM g WHERE wave = 2) g FULL JOIN (SELECT * FROM x1 WHERE NOT gone) p ON g.k IS NOT DISTINCT FROM p.k),
x2 AS (SELECT s2.*, "at" + INTERVAL 6 DAY <= mark AS gone FROM s2 JOIN w USING (wave)),
told AS (SELECT k, "at", content, n, outcome FROM s0 UNION ALL SELECT k, "at", content, n, CASE WHEN NOT had THEN 'inserted' WHEN content = old THEN 'unchanged' ELSE 'updated' END FROM s1 WHERE n IS NOT NULL
  UNION ALL SELECT k, "at", content, n, CASE WHEN NOT had THEN 'inserted' WHEN content = old THEN 'unchanged' ELSE 'updated' END FROM s2 WHERE n IS NOT NULL
  UNION ALL SELECT k, "at", content, 0, 'expired' FROM x0 WHERE gone UNION ALL SELECT k, "at", content, 0, 'expired' FROM x1 WHERE gone UNION ALL SELECT k, "at", content, 0, 'expired' FROM x2 WHERE gone)
SELECT k AS key, "at", content, n::BIGINT AS n, outcome FROM told""")
def keyed_state(spark, folder):
    """The newest event of each of many keys, kept as state: new, changed and repeated contents, late rows, expired keys."""
    from datetime import timedelta

    from aerolith.streaming.keyed import latest_by_key

    i = F.col("event_id")
    third = F.floor((F.dayofmonth("ts") - 1) / 11)
    e = table(spark, folder, "events").where("user_id IS NOT NULL")
    rows = e.select((F.col("user_id") * 7 + i % 7).alias("k"), F.date_trunc("MILLISECOND", F.col("ts").cast("timestamp")).alias("ts"), i.cast("string").alias("tie"), "event_type", F.least(third + F.when(i % 10 == 0, 1).otherwise(0), F.lit(2)).alias("wave"))
    out = _in_waves(rows, "wave", 3, lambda stream: latest_by_key(stream, "k", "ts", "tie", "event_type", "1 day", timedelta(days=6)))
    return out.withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("SELECT event_id, user_id FROM events")
def streaming_distinct(spark, folder):
    """Events that come twice, the second time in the same or a later wave: each is passed on once."""
    from aerolith.streaming.keyed import first_seen

    third = F.floor((F.dayofmonth("ts") - 1) / 11)
    e = table(spark, folder, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), third.alias("wave"))
    twice = e.union(e.withColumn("wave", F.least(F.col("wave") + F.col("event_id") % 2, F.lit(2))))
    return _in_waves(twice, "wave", 3, lambda stream: first_seen(stream, "ts", "1 day", ["event_id", "user_id"])).select("event_id", "user_id")


@query(RUNS.replace("{0}", "1") + "SELECT event_id, source, canonical_key FROM f WHERE fate = 'stored'")
def streaming_supersede(spark, folder):
    """Events of all sources as a stream: what is stored in the end is, for each key, the rows of its best source,
    whichever batch they came with."""
    store = incremental.event_store(spark, scratch_path(spark, "store"), "event_id long", parts=8)
    incremental.to_completion(incremental.event_writer(_stream(arriving(spark, folder), "event_id"), store, [F.col("event_id")]))
    return store.current("events").select("event_id", F.col("external_source").alias("source"), "canonical_key")


@query("""SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def daily_counts(spark, folder):
    e = table(spark, folder, "events")
    return e.groupBy(F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
