"""Dates, date ranges, iCalendar times and durations. Ranges are structs of start and end (dates); all text results are
ISO 8601 in UTC with milliseconds. Days beyond the end of a month run on into the next one, as the sources' own
calendar arithmetic has it."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.functions.core import SPACE, chain, found, given, let, looked_up
from aerolith.rules import tables as T

DASH = "[-–—]"


def iso(c: Column) -> Column:
    """A timestamp (in UTC, or without a zone) as text."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def running_date(year: Column, month: Column, day: Column) -> Column:
    """A date from integers; days of 1 to 31 run on past the end of the month, anything else gives null."""
    ok = month.between(1, 12) & day.between(1, 31)
    first = F.try_make_timestamp(year, F.when(ok, month), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).cast("date")
    return F.date_add(first, F.when(ok, day) - 1)


def _midnight(year: Column, month: Column, day: Column) -> Column:
    parts = F.array(year.try_cast("int"), month.try_cast("int"), day.try_cast("int"))
    return let(parts, lambda p: running_date(F.when(p[0].between(1900, 2100), p[0]), p[1], p[2]))


def _range(start: Column, end: Column) -> Column:
    return let(F.struct(start.alias("start"), end.alias("end")), lambda r: F.when(r["start"].isNotNull() & r["end"].isNotNull(), r))


def _given_to(make):
    return lambda groups: make(lambda k: given(groups[k - 1]))


def _cases(text: Column, *cases) -> Column:
    """The range of the first pattern that matches; each case is (pattern, function of groups)."""
    out = None
    for regex, make in cases:
        groups = F.array(*[F.regexp_extract(text, regex, k + 1) for k in range(re.compile(regex).groups)])
        made = let(groups, _given_to(make))
        out = F.when(text.rlike(regex), made) if out is None else out.when(text.rlike(regex), made)
    return out


def _once(text: Column, *cases) -> Column:
    return let(text, lambda t: _cases(t, *cases))


def german_date(c: Column) -> Column:
    """dd.mm.yyyy anywhere (the calendar isn't asked), m/yyyy, or a month's name and a year, as yyyy-mm-dd text."""
    return let(c, _german_date)


def _german_date(c: Column) -> Column:
    full, slash, named = r"(\d{2})\.(\d{2})\.(\d{4})", r"^(\d{1,2})/(\d{4})$", r"([A-Za-zäöü]+)\s+(\d{4})"
    month = looked_up(F.lower(F.regexp_extract(c, named, 1)), T.GERMAN_MONTHS)
    return (
        F.when(c.rlike(full), F.concat_ws("-", *[F.regexp_extract(c, full, k) for k in (3, 2, 1)]))
        .when(c.rlike(slash), F.concat(F.regexp_extract(c, slash, 2), F.lit("-"), F.lpad(F.regexp_extract(c, slash, 1), 2, "0"), F.lit("-01")))
        .when(c.rlike(named), F.concat(F.regexp_extract(c, named, 2), F.lit("-"), month, F.lit("-01")))
    )


def german_range(c: Column) -> Column:
    """d.m.yyyy, alone or with an end of the same form."""
    return _cases(
        c,
        (rf"^\s*(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}})\s*{DASH}\s*(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}})\s*$", lambda g: _range(_midnight(g(3), g(2), g(1)), _midnight(g(6), g(5), g(4)))),
        (r"^\s*(\d{1,2})\.(\d{1,2})\.(\d{4})\s*$", lambda g: _range(_midnight(g(3), g(2), g(1)), _midnight(g(3), g(2), g(1)))),
    )


def _spaced(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, rf"{SPACE}+", " "))


def loose_german_range(c: Column) -> Column:
    """Also d. - d.m.yyyy and d.m. - d.m.yyyy, with more text behind."""
    end = r"(?![A-Za-z0-9_])"
    return _once(
        _spaced(c),
        (rf"^(\d{{1,2}})\.?\s*{DASH}\s*(\d{{1,2}})\.\s*(\d{{1,2}})\.(\d{{4}}){end}", lambda g: _range(_midnight(g(4), g(3), g(1)), _midnight(g(4), g(3), g(2)))),
        (rf"^(\d{{1,2}})\.(\d{{1,2}})\.?(\d{{4}})?\s*{DASH}\s*(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}){end}", lambda g: _range(_midnight(F.coalesce(g(3), g(6)), g(2), g(1)), _midnight(g(6), g(5), g(4)))),
        (rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}){end}", lambda g: _range(_midnight(g(3), g(2), g(1)), _midnight(g(3), g(2), g(1)))),
    )


def _english(name: Column) -> Column:
    return looked_up(F.lower(name), T.ENGLISH_MONTHS)


def yearless_range(c: Column, now: Column) -> Column:
    """d month, d - d month, d month - d month: this year, or the next if the start is more than 30 days past."""
    now_year = F.year(now)

    def of(month1, day1, month2, day2):
        return let(F.array(month1, day1.try_cast("int"), month2, day2.try_cast("int")), lambda p: rolled(*[p[k] for k in range(4)]))

    def rolled(month1, d1, month2, d2):
        here = F.date_add(F.make_date(now_year, F.coalesce(month1, F.lit(1)), F.lit(1)), F.coalesce(d1, F.lit(1)) - 1)
        past = here.cast("timestamp_ntz") < now.cast("timestamp_ntz") - F.expr("INTERVAL 30 DAYS")
        year = now_year + F.when(past, 1).otherwise(0)
        return _range(running_date(year, month1, d1), running_date(year + F.when(month2 < month1, 1).otherwise(0), month2, d2))

    return _once(
        _spaced(c),
        (rf"^(\d{{1,2}})\s+([A-Za-z]+)\s*{DASH}\s*(\d{{1,2}})\s+([A-Za-z]+)$", lambda g: of(_english(g(2)), g(1), _english(g(4)), g(3))),
        (rf"^(\d{{1,2}})\s*{DASH}\s*(\d{{1,2}})\s+([A-Za-z]+)$", lambda g: of(_english(g(3)), g(1), _english(g(3)), g(2))),
        (r"^(\d{1,2})\s+([A-Za-z]+)$", lambda g: of(_english(g(2)), g(1), _english(g(2)), g(1))),
    )


def _named(month1, day1, month2, day2, year) -> Column:
    parts = F.array(year.try_cast("int"), month1, day1.try_cast("int"), month2, day2.try_cast("int"))
    return let(parts, lambda p: _range(running_date(p[0], p[1], p[2]), running_date(p[0], p[3], p[4])))


def us_range(c: Column) -> Column:
    """Oct. 18-19, 2026 and the like; a month's name may end with a full stop."""
    month = lambda name: _english(F.regexp_replace(name, r"\.", ""))
    return _once(
        _spaced(F.regexp_replace(c, "[–—]", "-")),
        (r"^([A-Za-z]+\.?)\s+(\d{1,2})\s*-\s*([A-Za-z]+\.?)\s+(\d{1,2}),\s*(\d{4})$", lambda g: _named(month(g(1)), g(2), month(g(3)), g(4), g(5))),
        (r"^([A-Za-z]+\.?)\s+(\d{1,2})\s*-\s*(\d{1,2}),\s*(\d{4})$", lambda g: _named(month(g(1)), g(2), month(g(1)), g(3), g(4))),
        (r"^([A-Za-z]+\.?)\s+(\d{1,2}),\s*(\d{4})$", lambda g: _named(month(g(1)), g(2), month(g(1)), g(2), g(3))),
    )


def fair_range(c: Column) -> Column:
    """A fair's dates in English (April 22 - 25, 2026) or German (22. - 25. April 2026)."""
    month = lambda name: looked_up(F.lower(name), T.FULL_GERMAN_MONTHS | T.ENGLISH_MONTHS)
    word = "([A-Za-zäöüÄÖÜ]+)"
    return _once(
        _spaced(F.regexp_replace(c, "[–—]", "-")),
        (rf"^{word}\s+(\d{{1,2}})\s*-\s*(\d{{1,2}}),\s*(\d{{4}})$", lambda g: _named(month(g(1)), g(2), month(g(1)), g(3), g(4))),
        (r"^([A-Za-z]+)\s+(\d{1,2})\s*-\s*([A-Za-z]+)\s+(\d{1,2}),\s*(\d{4})$", lambda g: _named(month(g(1)), g(2), month(g(3)), g(4), g(5))),
        (r"^([A-Za-z]+)\s+(\d{1,2}),\s*(\d{4})$", lambda g: _named(month(g(1)), g(2), month(g(1)), g(2), g(3))),
        (rf"^(\d{{1,2}})\.\s*-\s*(\d{{1,2}})\.\s*{word}\s+(\d{{4}})$", lambda g: _named(month(g(3)), g(1), month(g(3)), g(2), g(4))),
        (rf"^(\d{{1,2}})\.\s*{word}\s+(\d{{4}})$", lambda g: _named(month(g(2)), g(1), month(g(2)), g(1), g(3))),
    )


def midnight(c: Column) -> Column:
    """The day that an ISO date or time starts with."""
    day = r"^(\d{4})-(\d{2})-(\d{2})"
    return running_date(found(c, day, 1).try_cast("int"), found(c, day, 2).try_cast("int"), found(c, day, 3).try_cast("int"))


def zoned_to_utc(wall: Column, zone: Column | str) -> Column:
    """UTC of a wall clock's time (both timestamps without a zone). The offset is looked up once, for the wall clock's
    time taken as UTC; so hours around a change of clocks come out as the sources have them. An unknown zone is UTC."""
    if isinstance(zone, str):
        named = F.lit(zone if zone in list(ZONES) else "UTC")
    else:
        named = F.when(F.coalesce(zone.isin(*ZONES), F.lit(False)), zone).otherwise("UTC")
    there = F.from_utc_timestamp(wall.cast("timestamp"), named).cast("timestamp_ntz")
    return wall - (there - wall)


def _zones() -> list[str]:
    import zoneinfo

    return sorted(zoneinfo.available_timezones())


class _Zones(list):
    """Names of time zones, read when first asked for."""

    def __iter__(self):
        if not len(self):
            self.extend(_zones())
        return super().__iter__()


ZONES = _Zones()


def ics_time(c: Column, zone: Column | str) -> Column:
    """The UTC time (without a zone) of an iCalendar date, UTC time, or local time in a zone (Europe/Berlin if null)."""
    v = F.trim(c)
    day = r"^(\d{4})(\d{2})(\d{2})(?:T(\d{2})(\d{2})(\d{2})(Z?))?$"
    part = lambda at, n: F.substring(v, at, n).try_cast("int")
    timed = F.substring(v, 9, 1) == "T"
    date = F.try_make_timestamp(part(1, 4), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).cast("timestamp_ntz")
    date = date + F.make_ym_interval(F.lit(0), part(5, 2) - 1) + F.make_dt_interval(part(7, 2) - 1)
    clock = date + F.make_dt_interval(F.lit(0), part(10, 2), part(12, 2), part(14, 2).cast("decimal(18,6)"))
    zone = zone if isinstance(zone, str) else F.coalesce(zone, F.lit("Europe/Berlin"))
    local = F.when(timed, F.when(F.substring(v, 16, 1) == "Z", clock).otherwise(zoned_to_utc(clock, zone))).otherwise(date)
    return F.when(v.rlike(day), local)


_DURATION = r"^([+-]?)P(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?$"


def ics_duration(c: Column) -> Column:
    """An ISO 8601 duration of weeks, days, hours, minutes and seconds in milliseconds; null without any part."""
    v = F.trim(c)
    parts = [found(v, _DURATION, k).try_cast("long") for k in range(2, 7)]
    seconds = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0).cast("long")) * s for p, s in zip(parts, (604800, 86400, 3600, 60, 1), strict=True)])
    sign = F.when(F.regexp_extract(v, _DURATION, 1) == "-", -1).otherwise(1)
    return F.when(v.rlike(_DURATION) & F.coalesce(*parts).isNotNull(), sign * seconds * 1000)


def nth_weekdays(first_of_month: Column, weekday: Column, prefix: Column) -> Column:
    """The days of a month that are a weekday (0 is Sunday): all for prefix 0, the n-th, or the n-th from the end."""
    days = F.filter(F.sequence(first_of_month, F.last_day(first_of_month)), lambda d: F.dayofweek(d) - 1 == weekday)
    one = F.try_element_at(days, F.when(prefix != 0, prefix).otherwise(1))
    return F.when(prefix == 0, days).when(one.isNull(), F.array().cast("array<date>")).otherwise(F.array(one))


def strip_leading_date(c: Column) -> Column:
    """A struct of the date text that a line starts with and the rest."""
    lead = rf"^(\d{{1,2}}\.?\s*{DASH}?\s*\d{{0,2}}\.?\s*\d{{0,2}}\.?\d{{4}})\s*{DASH}?\s*"
    return F.struct(F.when(c.rlike(lead), F.trim(F.regexp_extract(c, lead, 0))).alias("date"), F.trim(chain(c, (lead, ""))).alias("rest"))
