"""Queries over events: validation, keys, winners, outcomes, statistics, recurrences, calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.functions import dates as D
from aerolith.functions import keys as K
from aerolith.functions.classify import calendar_category, category_of_number
from aerolith.functions.core import once
from aerolith.operators import dedup, metrics, recurrence
from aerolith.operators.filldown import fill_down
from aerolith.operators.scratch import written
from aerolith.operators.upsert import outcomes
from aerolith.operators.validate import event_reason
from aerolith.plans.catalog import query
from aerolith.session import table

NOW = "2024-01-20 00:00:00"
#: The sources that the kinds of stream events stand for.
SOURCES = ("dulv.de", "ics-feed", "ulforum.de", "iata.org", "pilot-frank.de")

KINDS = ("view", "click", "purchase", "signup", "error")


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Event candidates made from the stream table: every rule of the validation has rows that break it."""
    e, n = table(spark, folder, "events"), table(spark, folder, "nation")
    i = F.col("event_id")
    days = lambda x: F.make_dt_interval(x.cast("int"))
    kind = F.greatest(F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("event_type")) - 1, F.lit(0)).cast("int")
    out = e.join(n, F.pmod(F.col("user_id"), F.lit(25)) == F.col("n_nationkey"), "left").select(
        i, "user_id", F.element_at(F.array(*[F.lit(s) for s in SOURCES]), kind + 1).alias("source"),
        F.when(i % 97 == 0, "  ").when(i % 89 == 0, "ab").otherwise(F.concat(F.lit("Fly-in "), F.coalesce("event_type", F.lit("")), F.lit(" "), (i % 40).cast("string"))).alias("title"),
        F.when(i % 83 == 0, "").otherwise(F.concat(F.lit("https://example.org/e/"), i.cast("string"))).alias("source_url"),
        F.when(i % 79 == 0, None).otherwise(F.lit("meetup")).alias("category"),
        F.when(i % 73 == 0, " ").otherwise(F.col("n_name")).alias("country"),
        F.when(i % 71 == 0, None).when(i % 67 == 0, F.col("ts") + days(F.lit(3000))).when(i % 61 == 0, F.col("ts") - days(F.lit(400))).otherwise(F.col("ts")).alias("start"),
        F.when(i % 59 == 0, None).when(i % 53 == 0, F.col("ts") - days(F.lit(1))).when(i % 47 == 0, F.col("ts") + days(F.lit(120))).when(i % 67 == 0, F.col("ts") + days(F.lit(3001)))
        .when(i % 61 == 0, F.col("ts") - days(F.lit(399))).otherwise(F.col("ts") + days(i % 5)).alias("end"),
        F.when(i % 43 == 0, "edxx").when(i % 41 == 0, "AB").when(i % 3 == 0, "EDNY").alias("icao"),
        F.when(i % 37 == 0, 91.5).when(i % 2 == 0, 47.5).alias("latitude"), F.when(i % 31 == 0, -200.0).when(i % 2 == 0, 9.5).alias("longitude"),
        F.when(i % 4 == 0, "Mühlhausen").when(i % 4 == 1, "").alias("city"), F.lit("Café du Ciel").alias("venue"), F.col("ts"), F.col("value"),
    )
    return out.withColumn("reason", event_reason(F.lit(NOW).cast("timestamp_ntz")))


CANDIDATES = f"""
WITH c AS (SELECT event_id, user_id, (['dulv.de','ics-feed','ulforum.de','iata.org','pilot-frank.de'])[(CASE event_type {{kinds}} END) + 1] AS source,
  CASE WHEN event_id % 97 = 0 THEN '  ' WHEN event_id % 89 = 0 THEN 'ab' ELSE 'Fly-in ' || coalesce(event_type, '') || ' ' || (event_id % 40) END AS title,
  CASE WHEN event_id % 83 = 0 THEN '' ELSE 'https://example.org/e/' || event_id END AS source_url, CASE WHEN event_id % 79 = 0 THEN NULL ELSE 'meetup' END AS category,
  CASE WHEN event_id % 73 = 0 THEN ' ' ELSE n_name END AS country,
  CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 67 = 0 THEN ts + INTERVAL 3000 DAY WHEN event_id % 61 = 0 THEN ts - INTERVAL 400 DAY ELSE ts END AS s,
  CASE WHEN event_id % 59 = 0 THEN NULL WHEN event_id % 53 = 0 THEN ts - INTERVAL 1 DAY WHEN event_id % 47 = 0 THEN ts + INTERVAL 120 DAY WHEN event_id % 67 = 0 THEN ts + INTERVAL 3001 DAY
    WHEN event_id % 61 = 0 THEN ts - INTERVAL 399 DAY ELSE ts + to_days((event_id % 5)::INT) END AS e,
  CASE WHEN event_id % 43 = 0 THEN 'edxx' WHEN event_id % 41 = 0 THEN 'AB' WHEN event_id % 3 = 0 THEN 'EDNY' END AS icao,
  CASE WHEN event_id % 37 = 0 THEN 91.5 WHEN event_id % 2 = 0 THEN 47.5 END AS latitude, CASE WHEN event_id % 31 = 0 THEN -200.0 WHEN event_id % 2 = 0 THEN 9.5 END AS longitude,
  CASE event_id % 4 WHEN 0 THEN 'Mühlhausen' WHEN 1 THEN '' END AS city, 'Café du Ciel' AS venue, ts, value FROM events LEFT JOIN nation ON user_id % 25 = n_nationkey),
v AS (SELECT *, CASE WHEN trim(coalesce(title, '')) = '' THEN 'missing_title' WHEN length(trim(title)) < 3 THEN 'title_too_short' WHEN trim(coalesce(source_url, '')) = '' THEN 'missing_source_url'
  WHEN trim(coalesce(category, '')) = '' THEN 'missing_category' WHEN trim(coalesce(country, '')) = '' THEN 'missing_country' WHEN s IS NULL THEN 'invalid_start_date' WHEN e IS NULL THEN 'invalid_end_date'
  WHEN e < s THEN 'end_before_start' WHEN e - s > INTERVAL 90 DAY THEN 'duration_exceeds_max' WHEN e < TIMESTAMP '{NOW}' - INTERVAL 90 DAY THEN 'ended_too_long_ago'
  WHEN s > TIMESTAMP '{NOW}' + INTERVAL 5 YEAR THEN 'starts_too_far_in_future' WHEN icao IS NOT NULL AND NOT regexp_full_match(trim(icao), '[A-Z]{{{{4}}}}') THEN 'invalid_icao'
  WHEN latitude NOT BETWEEN -90 AND 90 OR longitude NOT BETWEEN -180 AND 180 THEN 'invalid_coordinates' END AS reason FROM c),
k AS (SELECT *, strftime(s, '%Y%m%d') AS day, trim(both '-' from regexp_replace(lower(strip_accents(title)), '[^a-z0-9]+', '-', 'g'))[:40] AS name,
  CASE WHEN coalesce(trim(icao), '') <> '' THEN trim(icao) ELSE trim(both '-' from regexp_replace(lower(strip_accents(coalesce(city, venue, ''))), '[^a-z0-9]+', '-', 'g')) END AS place FROM v),
y AS (SELECT *, CASE WHEN name <> '' AND day IS NOT NULL AND place <> '' THEN sha1(day || '|' || place || '|' || name) END AS canonical_key,
  CASE source WHEN 'dulv.de' THEN 100 WHEN 'ics-feed' THEN 90 WHEN 'ulforum.de' THEN 60 WHEN 'iata.org' THEN 40 WHEN 'pilot-frank.de' THEN 20 ELSE 50 END AS priority FROM k),
b AS (SELECT canonical_key AS bk, arg_max(source, (priority, -epoch_us(ts), source)) AS winner FROM y WHERE reason IS NULL AND canonical_key IS NOT NULL GROUP BY 1),
w AS (SELECT y.*, CASE WHEN b.bk IS NOT NULL AND source <> winner THEN 'lower_priority_duplicate' ELSE 'kept' END AS outcome FROM y LEFT JOIN b ON canonical_key = bk WHERE reason IS NULL)
"""  # noqa: E501


CANDIDATES = CANDIDATES.replace("{kinds}", " ".join(f"WHEN '{k}' THEN {n}" for n, k in enumerate(KINDS)) + " ELSE 0").replace("{{4}}", "{4}")


def keyed(df: DataFrame) -> DataFrame:
    """df with its key, made once for each row: filters and joins by it come after."""
    return once(df, {"canonical_key": K.canonical_key(F.col("title"), D.iso(F.col("start")), F.col("icao"), F.col("city"), F.col("venue"))})


def winners(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.priority_winners(keyed(candidates(spark, folder).where("reason IS NULL")).withColumn("arrival", F.unix_micros(F.col("ts").cast("timestamp"))), "canonical_key", "source", "arrival")


@query(CANDIDATES + "SELECT event_id, source, reason FROM v")
def validate_events(spark, folder):
    return candidates(spark, folder).select("event_id", "source", "reason")


@query(CANDIDATES + ", r AS (SELECT source, reason, count(*) AS n FROM v WHERE reason IS NOT NULL GROUP BY ALL) SELECT source, 'validation drops: ' || sum(n)::BIGINT || ' (' || string_agg(reason || ': ' || n, ', ' ORDER BY n DESC, reason) || ')' AS summary FROM r GROUP BY source")
def validation_drop_summary(spark, folder):
    return metrics.drop_summary(metrics.skip_reasons(candidates(spark, folder)))


@query(CANDIDATES + "SELECT event_id, canonical_key, substr(sha1(title || '|' || strftime(s, '%Y-%m-%dT%H:%M:%S.%gZ') || '|' || country), 1, 16) AS content_id FROM y WHERE reason IS NULL")
def canonical_key(spark, folder):
    e = keyed(candidates(spark, folder).where("reason IS NULL"))
    return e.select("event_id", "canonical_key", K.short_sha1(F.concat_ws("|", "title", D.iso(F.col("start")), "country")).alias("content_id"))


@query(CANDIDATES + "SELECT source, outcome, count(*) AS n, round(sum(value), 4) AS total_value FROM w GROUP BY ALL")
def cross_source_winner(spark, folder):
    return winners(spark, folder).groupBy("source", "outcome").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total_value"))


@query(CANDIDATES + """, o AS (SELECT canonical_key AS ok, arg_max(source, (priority, -epoch_us(ts), source)) AS stored FROM y WHERE reason IS NULL AND event_id % 2 = 0 AND canonical_key IS NOT NULL GROUP BY 1)
SELECT event_id, CASE WHEN ok IS NULL OR stored = source THEN 'kept' WHEN priority > CASE stored WHEN 'dulv.de' THEN 100 WHEN 'ics-feed' THEN 90 WHEN 'ulforum.de' THEN 60 WHEN 'iata.org' THEN 40 ELSE 20 END THEN 'superseding'
  ELSE 'lower_priority_duplicate' END AS outcome FROM y LEFT JOIN o ON canonical_key = ok LEFT JOIN (SELECT canonical_key AS nk, arg_max(source, (priority, -epoch_us(ts), source)) AS new FROM y WHERE reason IS NULL AND event_id % 2 = 1 AND canonical_key IS NOT NULL GROUP BY 1) ON canonical_key = nk
  WHERE reason IS NULL AND event_id % 2 = 1 AND (nk IS NULL OR new = source)""")
def supersede_outcomes(spark, folder):
    """Odd events arrive after even ones: the best source of each key against the stored winner of that key."""
    e = written(keyed(candidates(spark, folder).where("reason IS NULL")).withColumn("arrival", F.unix_micros(F.col("ts").cast("timestamp"))), "arrivals")
    best = lambda rows: dedup.priority_winners(rows, "canonical_key", "source", "arrival").where("outcome = 'kept'").drop("outcome")
    stored = best(e.where("event_id % 2 = 0")).select("canonical_key", "source", F.lit(True).alias("is_external"), F.lit(None).cast("timestamp_ntz").alias("claimed_at"))
    met, _ = dedup.against_stored(best(e.where("event_id % 2 = 1")), stored, "canonical_key", "source", "outcome")
    return met.select("event_id", "outcome")


#: What becomes of events in runs, one for each remainder of their number: a row is let in if its source is the best that
#: its key has had so far, and goes when a better one comes.
RUNS = CANDIDATES + """, g AS (SELECT event_id, source, source_url, canonical_key, priority, event_id % {0} AS run FROM y WHERE reason IS NULL),
h AS (SELECT *, max(priority) OVER (PARTITION BY canonical_key ORDER BY run RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far, max(priority) OVER (PARTITION BY canonical_key) AS at_last FROM g),
f AS (SELECT *, CASE WHEN canonical_key IS NULL OR priority = at_last THEN 'stored' WHEN priority = so_far THEN 'deleted' ELSE 'refused' END AS fate FROM h)
"""


def arriving(spark, folder) -> DataFrame:
    """Valid events as rows of a store of events."""
    e = keyed(candidates(spark, folder).where("reason IS NULL"))
    return e.select("event_id", F.col("source").alias("external_source"), "source_url", "canonical_key", K.content_hash(F.col("title"), F.col("country")).alias("digest"), F.unix_micros(F.col("ts").cast("timestamp")).alias("arrival"))


@query(RUNS.replace("{0}", "2") + "SELECT event_id, fate, fate <> 'deleted' AND run = 1 AND event_id % 3 = 0 AND fate = 'stored' AS again FROM f")
def superseding_runs(spark, folder):
    """Two runs over a store, the second one twice and with rows of the first one again: the stored rows in the end, those
    that a better source has removed, and those that were refused. `again` marks rows of the second run that a third one
    brings again, unchanged."""
    from aerolith.operators.scratch import scratch_path
    from aerolith.streaming.incremental import event_batch, event_store

    rows = written(arriving(spark, folder), "arrivals")
    store = event_store(spark, scratch_path(spark, "store"), "event_id long", parts=8)
    run = lambda condition, number: event_batch(rows.where(condition), store, number, [F.col("event_id")])
    first = run("event_id % 2 = 0", 0)
    second = [run("event_id % 2 = 1", 1) for _ in range(2)][1]
    third = run("event_id % 6 = 3", 2)
    ids = rows.select("external_source", "source_url", "event_id")
    stored = store.current("events").select("event_id", F.lit("stored").alias("fate"))
    named = lambda told, fate, reason: told.where(F.col("reason") == reason).join(ids, ["external_source", "source_url"]).select("event_id", F.lit(fate).alias("fate"))
    every = stored.union(named(second, "deleted", "superseded"))
    for told in (first, second):
        every = every.union(named(told, "refused", "lower_priority_duplicate"))
    unchanged = named(third, "stored", "unchanged").select(F.col("event_id").alias("e"))
    return every.join(unchanged, F.col("event_id") == F.col("e"), "left").select("event_id", "fate", F.col("e").isNotNull().alias("again"))


STAGED = CANDIDATES + """, t AS (SELECT event_id, event_id % 7 <> 0 AS is_external, CASE WHEN event_id % 11 = 0 THEN ts END AS claimed_at, sha1(title || ' ' || CASE WHEN event_id % 3 = 0 THEN 'old' ELSE country END) AS digest FROM v WHERE reason IS NULL AND event_id % 2 = 0),
u AS (SELECT v.event_id, v.source, CASE WHEN t.event_id IS NULL THEN NULL WHEN NOT t.is_external OR t.claimed_at IS NOT NULL THEN 'claimed' WHEN t.digest = sha1(title || ' ' || country) THEN 'unchanged' END AS reason, t.event_id IS NOT NULL AS known
  FROM v LEFT JOIN t USING (event_id) WHERE v.reason IS NULL), x AS (SELECT event_id, source, reason, CASE WHEN reason IS NOT NULL THEN 'skipped' WHEN known THEN 'updated' ELSE 'inserted' END AS outcome FROM u)
"""  # noqa: E501


def staged_outcomes(spark, folder) -> DataFrame:
    e = candidates(spark, folder).where("reason IS NULL").drop("reason").withColumn("digest", K.content_hash(F.col("title"), F.col("country")))
    target = e.where("event_id % 2 = 0").select(
        "event_id", (F.col("event_id") % 7 != 0).alias("is_external"), F.when(F.col("event_id") % 11 == 0, F.col("ts")).alias("claimed_at"),
        K.content_hash(F.col("title"), F.when(F.col("event_id") % 3 == 0, "old").otherwise(F.col("country"))).alias("digest"))
    return outcomes(e, target, "event_id", "digest")


@query(STAGED + "SELECT event_id, outcome, reason FROM x")
def upsert_outcome(spark, folder):
    return staged_outcomes(spark, folder).select("event_id", "outcome", "reason")


@query(STAGED + "SELECT source, count(*) AS found, count(*) FILTER (outcome = 'inserted') AS inserted, count(*) FILTER (outcome = 'updated') AS updated, count(*) FILTER (outcome = 'skipped') AS skipped, 0::BIGINT AS errors FROM x GROUP BY source")
def run_stats(spark, folder):
    return metrics.run_stats(staged_outcomes(spark, folder))


@query(STAGED + ", r AS (SELECT source, count(*) AS found, count(*) FILTER (outcome = 'inserted') AS inserted, count(*) FILTER (outcome = 'updated') AS updated, count(*) FILTER (outcome = 'skipped') AS skipped, 0::BIGINT AS errors FROM x GROUP BY source) SELECT *, (SELECT count(*) FROM x) AS rows_in_all, (SELECT sum(event_id) FROM x)::BIGINT AS amount FROM r")
def observed_stats(spark, folder):
    """The statistics of a run, counted while its outcomes are written."""
    from aerolith.operators.scratch import scratch_path

    out, watched = metrics.observed_run(staged_outcomes(spark, folder), SOURCES, amounts={"ids": F.col("event_id")})
    out.select("event_id", "outcome").write.parquet(scratch_path(spark, "outcomes"))
    stats, amounts = metrics.observed_stats(spark, watched)
    return stats.withColumns({"rows_in_all": F.lit(amounts["rows"]).cast("long"), "amount": F.lit(amounts["ids"]).cast("long")})


@query("SELECT s.n_name AS source FROM nation s LEFT JOIN (SELECT user_id % 40 AS k, count(*) AS n FROM events GROUP BY 1) e ON e.k = s.n_nationkey + 20 WHERE e.n IS NULL")
def zero_row_warning(spark, folder):
    expected = table(spark, folder, "nation").select(F.col("n_name").alias("source"), (F.col("n_nationkey") + 20).alias("k"))
    found = table(spark, folder, "events").groupBy((F.col("user_id") % 40).alias("k")).agg(F.count("*").alias("found"), F.lit(0).alias("errors"))
    stats = expected.join(found, "k").select("source", "found", "errors")
    return metrics.zero_row_sources(expected.select("source"), stats)


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events""")
def section_fill_down(spark, folder):
    e = table(spark, folder, "events").withColumn("head", F.when(F.col("event_type") == "signup", F.col("value")))
    return fill_down(e, ["user_id"], [F.col("ts"), F.col("event_id")], "head", "filled").select("event_id", "filled")


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, folder):
    return table(spark, folder, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_repair(spark, folder):
    """The properties cut short and fenced, then repaired."""
    from aerolith.functions.json import repaired

    broken = F.concat(F.lit("```json\n"), F.regexp_replace("props", r"\}\s*$", ""), F.lit(",\n```"))
    return table(spark, folder, "events").select("event_id", F.get_json_object(repaired(F.regexp_replace(broken, ",\n```$", "\n```")), "$.k").alias("k"))


@query("SELECT event_id, strftime(ts - (timezone('Europe/Berlin', timezone('UTC', ts)) - ts), '%Y-%m-%dT%H:%M:%S.000Z') AS utc FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)")
def zoned_to_utc(spark, folder):
    e = table(spark, folder, "events")
    return e.select("event_id", D.iso(D.zoned_to_utc(F.date_trunc("SECOND", F.col("ts")).cast("timestamp_ntz"), "Europe/Berlin")).alias("utc"))


@query("SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S.000Z') AS utc, strftime(ts, '%Y-%m-%dT00:00:00.000Z') AS day FROM events")
def ics_date(spark, folder):
    e = table(spark, folder, "events")
    return e.select("event_id", D.iso(D.ics_time(F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"), "Europe/Berlin")).alias("utc"), D.iso(D.ics_time(F.date_format("ts", "yyyyMMdd"), "Europe/Berlin")).alias("day"))


@query("SELECT event_id, CASE WHEN event_id % 6 = 5 THEN NULL ELSE (CASE event_id % 6 WHEN 0 THEN 604800 * (event_id % 9) WHEN 1 THEN 86400 * (event_id % 7) + 3600 * (event_id % 24) WHEN 2 THEN 60 * (event_id % 60) WHEN 3 THEN 3600 * (event_id % 24) + event_id % 60 ELSE -900 END) * 1000 END::BIGINT AS ms FROM events")
def ics_duration(spark, folder):
    i = F.col("event_id")
    s = lambda x: x.cast("string")
    text = (
        F.when(i % 6 == 0, F.concat(F.lit("P"), s(i % 9), F.lit("W"))).when(i % 6 == 1, F.concat(F.lit("P"), s(i % 7), F.lit("DT"), s(i % 24), F.lit("H")))
        .when(i % 6 == 2, F.concat(F.lit("PT"), s(i % 60), F.lit("M"))).when(i % 6 == 3, F.concat(F.lit("PT"), s(i % 24), F.lit("H"), s(i % 60), F.lit("S"))).when(i % 6 == 4, "-PT15M").otherwise("P")
    )
    return table(spark, folder, "events").select("event_id", D.ics_duration(text).alias("ms"))


@query("SELECT event_id, coalesce(list_filter([lower(event_type), CASE WHEN event_id % 3 = 0 THEN 'trade-fair' END], lambda x: x IN ('seminar','trade-fair'))[1], CASE event_id % 2 WHEN 0 THEN 'airshow' ELSE 'general' END) AS category, (['general','seminar','competition','flying-camp','airfield-festival','trade-fair','general','general'])[(event_id % 8 + 1)::INT] AS numbered FROM events")
def event_categories(spark, folder):
    i = F.col("event_id")
    own = F.array_compact(F.array(F.col("event_type"), F.when(i % 3 == 0, "Trade  Fair")))
    return table(spark, folder, "events").select("event_id", calendar_category(own, F.when(i % 2 == 0, "airshow").otherwise("nothing")).alias("category"), category_of_number((i % 8).cast("int")).alias("numbered"))


@query("SELECT user_id, ts, event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 25")
def latest_n(spark, folder):
    """A report: the 25 latest events."""
    return table(spark, folder, "events").select("user_id", "ts", "event_id").orderBy(F.desc("ts"), F.desc("event_id")).limit(25)


# recurrences: one rule for each supplier, from a start that depends on its key
START = "(TIMESTAMP '2026-01-01 09:30:00' + to_days((s_suppkey % 31)::INT))"
HORIZON = "2026-12-31 00:00:00"


def _rules(spark, folder, rule, exdates=None, rdates=None) -> DataFrame:
    start = F.lit("2026-01-01 09:30:00").cast("timestamp_ntz") + F.make_dt_interval((F.col("s_suppkey") % 31).cast("int"))
    none = F.array().cast("array<timestamp_ntz>")
    s = table(spark, folder, "supplier").select("s_suppkey", start.alias("start"))
    s = s.select("s_suppkey", "start", (F.col("start") + F.expr("INTERVAL 2 HOURS")).alias("end"), F.lit(rule).alias("rrule") if isinstance(rule, str) else rule.alias("rrule"), (none if exdates is None else exdates).alias("exdates"), (none if rdates is None else rdates).alias("rdates"))
    out = recurrence.expand(s, F.lit(HORIZON).cast("timestamp_ntz"))
    return out.select("s_suppkey", "occurrence", D.iso(F.col("start")).alias("start_iso"), D.iso(F.col("end")).alias("end_iso"))


def _sql(days: str, count: int | None, filters: str = "TRUE", extra: str = "", most: int = 26) -> str:
    """Occurrences from a series of days: those that fit, in order, up to the count, with the start first."""
    budget = f"AND n <= {count - 1}" if count else ""
    return f"""WITH s AS (SELECT s_suppkey, {START} AS st FROM supplier), d AS (SELECT s_suppkey, st, unnest(generate_series(st + INTERVAL 1 DAY, TIMESTAMP '{HORIZON}', INTERVAL 1 DAY)) AS t FROM s),
f AS (SELECT s_suppkey, t, row_number() OVER (PARTITION BY s_suppkey ORDER BY t) AS n FROM d WHERE {days}), r AS (SELECT s_suppkey, st AS t FROM s UNION ALL SELECT s_suppkey, t FROM f WHERE TRUE {budget}),
k AS (SELECT s_suppkey, t, row_number() OVER (PARTITION BY s_suppkey ORDER BY t) AS m FROM r WHERE {filters} {extra}), o AS (SELECT s_suppkey, t, m - 1 AS n FROM k WHERE m <= {most})
SELECT s_suppkey, n::INT AS occurrence, strftime(t, '%Y-%m-%dT%H:%M:%S.000Z') AS start_iso, strftime(t + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.000Z') AS end_iso FROM o"""  # noqa: E501


@query(_sql("date_diff('day', st, t) % 3 = 0", 12))
def rrule_daily(spark, folder):
    return _rules(spark, folder, "FREQ=DAILY;INTERVAL=3;COUNT=12")


@query(_sql("date_diff('day', date_trunc('day', st) - to_days(dayofweek(st)::INT), date_trunc('day', t) - to_days(dayofweek(t)::INT)) % 14 = 0 AND dayofweek(t) IN (1, 5)", None))
def rrule_weekly_byday(spark, folder):
    return _rules(spark, folder, "FREQ=WEEKLY;INTERVAL=2;BYDAY=FR,MO")


@query(_sql("(dayofweek(t) = 2 AND (day(t) - 1) // 7 = 1) OR (dayofweek(t) = 5 AND month(t + INTERVAL 7 DAY) <> month(t))", 9))
def rrule_monthly_byday(spark, folder):
    return _rules(spark, folder, "FREQ=MONTHLY;BYDAY=2TU,-1FR;COUNT=9")


@query(_sql("day(t) IN (1, 15, 31)", None))
def rrule_monthly_bymonthday(spark, folder):
    return _rules(spark, folder, "FREQ=MONTHLY;BYMONTHDAY=31,1,15")


@query(_sql("date_diff('day', st, t) % 7 = 0", 8, "t NOT IN (st_of(s_suppkey) + INTERVAL 7 DAY, st_of(s_suppkey) + INTERVAL 21 DAY)").replace("st_of(s_suppkey)", START))
def rrule_exdate(spark, folder):
    start = F.lit("2026-01-01 09:30:00").cast("timestamp_ntz") + F.make_dt_interval((F.col("s_suppkey") % 31).cast("int"))
    return _rules(spark, folder, "FREQ=WEEKLY;COUNT=8", F.array(start + F.expr("INTERVAL 7 DAYS"), start + F.expr("INTERVAL 21 DAYS")))


@query(_sql("date_diff('day', st, t) % 14 = 0", 4).replace("k AS (", f"z AS (SELECT s_suppkey, t FROM r UNION SELECT s_suppkey, {START} + INTERVAL 20 DAY FROM supplier UNION SELECT s_suppkey, {START} + INTERVAL 14 DAY FROM supplier), k AS (").replace("FROM r WHERE TRUE ", "FROM z WHERE TRUE "))
def rrule_rdate(spark, folder):
    start = F.lit("2026-01-01 09:30:00").cast("timestamp_ntz") + F.make_dt_interval((F.col("s_suppkey") % 31).cast("int"))
    extra = F.array(start + F.expr("INTERVAL 20 DAYS"), start + F.expr("INTERVAL 14 DAYS"), F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
    return _rules(spark, folder, "FREQ=WEEKLY;INTERVAL=2;COUNT=4", None, extra)


@query("""WITH e AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
n AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS visit FROM e)
SELECT user_id, visit::BIGINT AS visit, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM n GROUP BY user_id, visit""")
def user_visits(spark, folder):
    """Runs of a user's events that are six hours apart at most."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    fresh = F.when(F.col("ts") - F.lag("ts").over(w) <= F.expr("INTERVAL 6 HOURS"), 0).otherwise(1)
    e = table(spark, folder, "events").withColumn("fresh", fresh)
    e = e.withColumn("visit", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return e.groupBy("user_id", "visit").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
