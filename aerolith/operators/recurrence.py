"""Expansion of recurring events.

All occurrences of a rule come from one expression: candidate times by frequency, a budget of `COUNT` over all of them,
then exceptions taken out, then the limit, then extra dates. The arrays are bounded by the limit, the number of
exceptions and the horizon, so a rule without any possible occurrence ends as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.core import found
from aerolith.functions.dates import ics_time, nth_weekdays

MOST_OCCURRENCES = 26
WEEKDAYS = ("SU", "MO", "TU", "WE", "TH", "FR", "SA")
TIMES = "array<timestamp_ntz>"


def _value(rule: Column, key: str) -> Column:
    return found(rule, rf"(?i)(?:^|;){key}=([^;]*)")


def _positive(c: Column) -> Column:
    n = found(c, r"^\s*([+-]?\d+)").try_cast("int")
    return F.when(n > 0, n)


def parsed_rule(rule: Column) -> Column:
    """A struct of freq, interval, count, until, byday (prefix, weekday) and bymonthday."""
    freq = F.upper(_value(rule, "FREQ"))
    entry = r"^([+-]?\d{1,2})?(SU|MO|TU|WE|TH|FR|SA)$"
    days = F.filter(F.transform(F.split(F.upper(_value(rule, "BYDAY")), ","), lambda x: F.trim(x)), lambda x: x.rlike(entry))
    names = F.array(*[F.lit(x) for x in WEEKDAYS])
    byday = F.transform(days, lambda x: F.struct(F.coalesce(F.regexp_extract(x, entry, 1).try_cast("int"), F.lit(0)).alias("prefix"), (F.array_position(names, F.regexp_extract(x, entry, 2)) - 1).cast("int").alias("weekday")))
    numbers = F.transform(F.split(_value(rule, "BYMONTHDAY"), ","), lambda x: F.regexp_extract(x, r"^\s*([+-]?\d+)", 1).try_cast("int"))
    empty = F.array().cast("array<int>")
    return F.struct(
        F.when(freq.isin("DAILY", "WEEKLY", "MONTHLY"), freq).alias("freq"),
        F.coalesce(_positive(_value(rule, "INTERVAL")), F.lit(1)).alias("interval"),
        _positive(_value(rule, "COUNT")).alias("count"),
        ics_time(_value(rule, "UNTIL"), "Europe/Berlin").alias("until"),
        F.coalesce(byday, F.array().cast("array<struct<prefix:int,weekday:int>>")).alias("byday"),
        F.coalesce(F.array_sort(F.filter(numbers, lambda n: n.between(1, 31))), empty).alias("bymonthday"),
    )


def _days(n: Column) -> Column:
    return F.make_dt_interval(n)


def occurrences(start: Column, r: Column, exdates: Column, rdates: Column, horizon: Column, most: int = MOST_OCCURRENCES) -> Column:
    """An array of the start times of an event, in order: without a rule that is understood, its own. r is a column of
    parsed rules: a column, not an expression, so that it is parsed once."""
    none = F.array().cast(TIMES)
    exdates, rdates = F.coalesce(exdates, none), F.coalesce(rdates, none)
    stop = F.least(r["until"], horizon)
    need = F.size(exdates) + most + 1
    whole = F.date_trunc("SECOND", start).cast("timestamp_ntz")
    clock = whole - F.date_trunc("DAY", start).cast("timestamp_ntz")
    first = F.trunc(start.cast("date"), "MM")
    at = lambda day: day.cast("timestamp_ntz") + clock

    step = F.when(r["freq"] == "DAILY", r["interval"]).otherwise(r["interval"] * 7)
    even = F.transform(F.sequence(F.lit(1), need), lambda k: start + _days(k * step))
    # months one after the other, each from the day that the one before came out at
    later = lambda t: F.date_add(F.add_months(F.trunc(t.cast("date"), "MM"), r["interval"]), F.dayofmonth(t) - 1).cast("timestamp_ntz") + (t - F.date_trunc("DAY", t).cast("timestamp_ntz"))
    drift = F.aggregate(F.sequence(F.lit(1), need), F.array(start), lambda acc, k: F.concat(acc, F.array(later(F.element_at(acc, -1)))), lambda acc: F.slice(acc, F.lit(2), need))

    sunday = F.date_sub(start.cast("date"), F.dayofweek(start) - 1)
    weekdays = F.array_sort(F.transform(r["byday"], lambda d: d["weekday"]))
    weekly = F.flatten(F.transform(F.sequence(F.lit(0), need), lambda w: F.transform(weekdays, lambda d: at(F.date_add(sunday, w * 7 * r["interval"] + d)))))

    months = F.greatest(F.lit(0), F.floor(F.months_between(F.coalesce(stop, start), first) / r["interval"]).cast("int")) + 1
    cursor = F.transform(F.sequence(F.lit(0), months), lambda m: F.add_months(first, m * r["interval"]))
    by_weekday = F.flatten(F.transform(cursor, lambda c: F.transform(F.array_sort(F.flatten(F.transform(r["byday"], lambda d: nth_weekdays(c, d["weekday"], d["prefix"])))), at)))
    by_day = F.flatten(F.transform(cursor, lambda c: F.transform(F.filter(r["bymonthday"], lambda d: d <= F.dayofmonth(F.last_day(c))), lambda d: at(F.date_add(c, d - 1)))))

    has_days, has_numbers = F.size(r["byday"]) > 0, F.size(r["bymonthday"]) > 0
    monthly = F.when(has_days, by_weekday).when(has_numbers, by_day).otherwise(drift)
    raw = F.when(r["freq"] == "DAILY", even).when(r["freq"] == "WEEKLY", F.when(has_days, weekly).otherwise(even)).when(r["freq"] == "MONTHLY", monthly).otherwise(none)
    raw = F.filter(F.coalesce(raw, none), lambda t: (t > start) & (t <= stop))
    raw = F.when(r["count"].isNotNull(), F.slice(raw, F.lit(1), F.greatest(r["count"] - 1, F.lit(0)))).otherwise(raw)
    kept = F.filter(F.concat(F.array(start), raw), lambda t: ~F.array_contains(exdates, t))
    kept = F.slice(kept, 1, most)
    extra = F.filter(F.array_sort(F.array_distinct(rdates)), lambda t: ~F.array_contains(kept, t) & ~F.array_contains(exdates, t) & (t <= horizon))
    return F.array_sort(F.slice(F.concat(kept, extra), 1, most))


def expand(df: DataFrame, horizon: Column, start: str = "start", end: str = "end", rule: str = "rrule", exdates: str = "exdates", rdates: str = "rdates", most: int = MOST_OCCURRENCES) -> DataFrame:
    """df with a row for each occurrence: start and end moved, and occurrence, its number from 0."""
    length = F.greatest(F.col(end) - F.col(start), F.expr("INTERVAL '0' SECOND"))
    ready = df.withColumn("__length", length).withColumn("__rule", parsed_rule(F.col(rule)))
    times = occurrences(F.col(start), F.col("__rule"), F.col(exdates), F.col(rdates), horizon, most)
    single = F.col("__rule.freq").isNull() & (F.coalesce(F.size(exdates), F.lit(0)) <= 0) & (F.coalesce(F.size(rdates), F.lit(0)) <= 0) & F.col(start).isNotNull()
    times = F.when(single, F.array(start)).otherwise(times)  # most events
    out = ready.select("*", F.posexplode(times).alias("occurrence", "__start"))
    return out.withColumn(end, F.col("__start") + F.col("__length")).withColumn(start, F.col("__start")).drop("__start", "__length", "__rule")
