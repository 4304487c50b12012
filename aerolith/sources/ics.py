"""iCalendar feeds, native: unfolded, cut at events, one expression for each property."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions import text as X
from aerolith.functions.classify import calendar_category
from aerolith.functions.core import found, given, once
from aerolith.functions.dates import ics_duration, ics_time
from aerolith.functions.keys import short_sha1
from aerolith.operators import recurrence

HORIZON_DAYS = 90


def looks_like_calendar(payload: Column) -> Column:
    return F.coalesce(payload.rlike(r"(?i)^\x{FEFF}?\s*BEGIN:VCALENDAR(?![A-Za-z0-9_])"), F.lit(False))


def _value(line: Column) -> Column:
    value = line.substr(F.instr(line, ":") + 1, F.length(line))
    return F.when(value.contains("\\"), X.unescape_ics(value)).otherwise(value)


def _zone(line: Column) -> Column:
    return found(line, '(?i)^[^:]*;TZID="?([^";:]+)"?')


SINGLE = ("UID", "SUMMARY", "DESCRIPTION", "DTSTART", "DTEND", "DURATION", "LOCATION", "URL", "CATEGORIES", "RRULE", "STATUS")


def _line(name: str) -> str:
    """A line of a property, with the end of the line before it: its name in any case, then parameters, then its value."""
    return rf"\n[ \t]*((?i:{name})(?:;[^:\n]*)?:[^\n]*)"


def _last_line(block: Column, name: str) -> Column:
    """The last line of a property: its parameters and value. A block begins with the end of a line. It is looked at from
    its end, in one pass: a list of lines for each event, searched once for each property, takes several times as long."""
    return found(block, rf"\A(?s:.*){_line(name)}")


def _times(block: Column, name: str, zone: Column) -> Column:
    """The times of all lines of a property, each a comma list."""
    each = lambda x: F.transform(F.split(_value(x), ","), lambda v: ics_time(v, F.coalesce(_zone(x), zone)))
    lines = F.regexp_extract_all(block, F.lit(_line(name)), F.lit(1))
    return F.when(block.rlike(_line(name)), F.array_compact(F.flatten(F.transform(lines, each)))).otherwise(F.array().cast("array<timestamp_ntz>"))


def blocks(df: DataFrame, payload: str = "payload") -> DataFrame:
    """df with a row for each event of a calendar, and columns zone (the calendar's) and block (the event's lines, each
    behind the end of the one before)."""
    text = X.unfold_ics(F.col(payload))
    events = lambda t: F.regexp_extract_all(t, F.lit(r"(?is)BEGIN:VEVENT\s*(\n.*?)\n\s*END:VEVENT"), F.lit(1))
    head = lambda t: F.concat(F.lit("\n"), F.element_at(F.split(t, "(?i)BEGIN:VEVENT", 2), 1))
    df = once(df, {"__t": text}).drop(payload)
    zone = given(F.trim(F.coalesce(_value(_last_line(head(F.col("__t")), "X-WR-TIMEZONE")), F.lit(""))))
    return df.withColumn("__zone", F.when(F.col("__t").rlike("(?i)BEGIN:VEVENT"), zone)).withColumn("__block", F.explode(events(F.col("__t")))).drop("__t")


def parsed(df: DataFrame, payload: str = "payload") -> DataFrame:
    """df with a row for each event, and columns uid, summary, description, start, end, tzid, location, url, categories,
    rrule, is_all_day, exdates, rdates, status and drop_reason: what an event lacks that it must have (a UID, a summary, a
    start), or null."""
    rows = once(blocks(df, payload), {f"__{name}": _last_line(F.col("__block"), name) for name in SINGLE})
    line = lambda name: F.col(f"__{name}")
    zone_of = lambda c: F.coalesce(_zone(c), F.col("__zone"))
    status = F.upper(F.trim(_value(line("STATUS"))))
    rows = once(rows, {
        "uid": given(_value(line("UID"))), "summary": given(_value(line("SUMMARY"))), "description": F.coalesce(_value(line("DESCRIPTION")), F.lit("")),
        "tzid": zone_of(line("DTSTART")), "__end_zone": zone_of(line("DTEND")), "location": F.coalesce(_value(line("LOCATION")), F.lit("")), "url": _value(line("URL")),
        "categories": F.filter(F.transform(F.split(F.lower(F.coalesce(_value(line("CATEGORIES")), F.lit(""))), ","), lambda x: F.trim(x)), lambda x: x != ""),
        "rrule": given(_value(line("RRULE"))), "is_all_day": F.coalesce(line("DTSTART").rlike("(?i)^[^:]*;VALUE=DATE[;:]") | F.trim(_value(line("DTSTART"))).rlike(r"^\d{8}$"), F.lit(False)),
        "exdates": _times(F.col("__block"), "EXDATE", F.col("__zone")), "rdates": _times(F.col("__block"), "RDATE", F.col("__zone")),
        "status": F.when(status.isin("CONFIRMED", "CANCELLED", "TENTATIVE"), status), "__ms": ics_duration(_value(line("DURATION"))),
        "__start_text": _value(line("DTSTART")), "__end_text": _value(line("DTEND")),
    })
    rows = once(rows, {"start": ics_time(F.col("__start_text"), F.col("tzid")), "end": ics_time(F.col("__end_text"), F.col("__end_zone"))})
    by_length = F.col("start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("__ms") / 1000).cast("decimal(18,6)"))
    lacks = F.when(F.col("uid").isNull(), "no-uid").when(F.col("summary").isNull(), "no-summary").when(F.col("start").isNull(), "no-start")
    rows = rows.withColumn("end", F.coalesce("end", by_length, "start")).withColumn("drop_reason", lacks)
    return rows.drop("__block", "__zone", "__end_zone", "__ms", "__start_text", "__end_text", *[f"__{name}" for name in SINGLE])


def parse(df: DataFrame, payload: str = "payload") -> DataFrame:
    """The rows of parsed() that have a UID, a summary and a start."""
    return parsed(df, payload).where("drop_reason IS NULL").drop("drop_reason")


def venue(c: Column) -> Column:
    """A struct of venue and city of a free-text location."""
    v = X.clean_text(c)
    postal = r"(?<![A-Za-z0-9_])\d{4,5}\s+([A-Za-zÄÖÜäöüßÉÈÊÀÂÇéèêàâç\s'-]+)"
    parts = F.filter(F.transform(F.split(v, ","), lambda x: F.trim(x)), lambda p: p != "")
    several = F.size(parts) >= 2
    return F.struct(
        F.when(v.rlike(postal), v).when(several, parts[0]).otherwise(v).alias("venue"),
        F.when(v.rlike(postal), F.trim(F.regexp_extract(v, postal, 1))).when(several, F.try_element_at(parts, F.lit(2))).alias("city"),
    )


def calendar_rows(feeds: DataFrame, now: Column, source_name: str = "ics-feed") -> DataFrame:
    """Events of feeds (the columns of a calendar: name, url, country, default_category, timezone, source_locale,
    organiser_name, and its payload) and drop_reason. Recurrences are expanded to 90 days after now. Payloads that are no
    calendars have no rows."""
    found_ = parsed(feeds.where(looks_like_calendar(F.col("payload"))).withColumnRenamed("url", "feed_url"))
    found_ = found_.withColumn("drop_reason", F.coalesce("drop_reason", F.when(F.col("status") == "CANCELLED", "cancelled")))
    # a row that is dropped counts once: it has no recurrences, and a day that its occurrence needs
    whole = F.col("drop_reason").isNull()
    only = lambda name: F.when(whole, F.col(name))
    found_ = once(found_, {"rrule": only("rrule"), "exdates": only("exdates"), "rdates": only("rdates"), "__told": F.col("start"), "start": F.coalesce("start", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")), "end": F.coalesce("end", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))})
    every = recurrence.expand(found_, now + F.expr(f"INTERVAL {HORIZON_DAYS} DAYS"))
    every = once(once(every, {"__v": venue(F.col("location"))}), {"__i": X.venue_icao(F.col("__v.venue"))})
    every = every.withColumns({c: F.when(F.col("__told").isNotNull(), F.col(c)) for c in ("start", "end")})
    organiser = F.coalesce(F.col("organiser_name"), F.col("name"))
    page = F.concat(F.col("feed_url"), F.lit("#"), short_sha1(F.concat_ws("|", "summary", F.date_format("start", "yyyy-MM-dd"), organiser)))
    return every.select(
        page.alias("source_id"), page.alias("source_url"), F.lit(source_name).alias("source_name"), F.col("feed_url").alias("page_url"), F.lit(0).alias("source_category_id"),
        calendar_category(F.col("categories"), F.col("default_category")).alias("category"), X.clean_text(F.col("summary")).alias("title"), F.lit(None).cast("string").alias("subtitle"),
        F.lit(None).cast("string").alias("date_range_text"), "start", "end", F.coalesce("tzid", "timezone", F.lit("Europe/Berlin")).alias("timezone"), "country", F.col("__v.city").alias("city"),
        F.coalesce(given(F.col("__i.name")), F.col("name")).alias("venue"), F.col("__i.icao").alias("icao"), organiser.alias("organiser"),
        given(X.clean_text(F.col("description"))).alias("description"), F.col("url").alias("event_url"), F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"),
        F.coalesce("source_locale", F.lit("en")).alias("source_locale"), "drop_reason",
    )


def calendar_events(feeds: DataFrame, now: Column, source_name: str = "ics-feed") -> DataFrame:
    """The events of feeds that have a UID, a summary and a start and are not cancelled."""
    return calendar_rows(feeds, now, source_name).where("drop_reason IS NULL").drop("drop_reason")


def discovery(pages: DataFrame) -> DataFrame:
    """A report on pages (name, url, html): the calendars that each links to, how many, and the row as JSON."""
    rows = pages.select("name", "url", F.coalesce(feed_links(F.col("html"), F.col("url")), F.array().cast("array<string>")).alias("feeds"))
    return rows.withColumn("n_feeds", F.size("feeds")).withColumn("json", F.to_json(F.struct("name", "url", "feeds")))


def feed_links(html: Column, page: Column) -> Column:
    """Distinct URLs of calendars that a page links to."""
    from aerolith.functions.urls import absolute

    anchors = F.regexp_extract_all(html, F.lit(r"""(?is)<a\s[^>]*href\s*=\s*["']([^"']+)["']"""), F.lit(1))
    anchors = F.filter(anchors, lambda h: h.rlike(r"(?i)^webcal://|\.(ics|ical)(\?|$)"))
    links = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<link\s[^>]*>"), F.lit(0)), lambda x: x.rlike(r"""(?i)rel\s*=\s*["']alternate""") & x.rlike("(?i)text/calendar"))
    links = F.transform(links, lambda x: F.regexp_extract(x, r"""(?i)href\s*=\s*["']([^"']+)""", 1))
    return F.array_distinct(F.transform(F.filter(F.concat(anchors, links), lambda h: h != ""), lambda h: absolute(h, page)))
