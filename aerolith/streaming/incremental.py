"""Incremental runs: landed batches against a keyed target, and winners per key as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from aerolith.functions.classify import source_priority
from aerolith.operators import dedup
from aerolith.operators.match import first_row
from aerolith.operators.scratch import freed, written
from aerolith.operators.upsert import outcomes, snapshot
from aerolith.operators.validate import is_claimed
from aerolith.streaming.store import CODEC, PARTS, Kept, Store


def table_store(spark, folder: str, schema: str, key: str = "", parts: int = PARTS) -> Store:
    return Store(spark, folder, {"target": Kept(schema, (key,))}, parts)


def current(spark, folder: str, schema: str) -> DataFrame:
    """The newest state of a table that upsert() keeps below folder, or an empty one."""
    return table_store(spark, folder, schema).current("target")


def upsert(rows: DataFrame, folder: str, schema: str, key: str, number: int, merge: Callable[[DataFrame, DataFrame], DataFrame], parts: int = PARTS) -> None:
    """Merge batch `number` into a table that is kept in parts by a hash of the key: merge(rows, target) gives the new
    rows of the parts that the batch has keys of; the other parts are neither read nor written."""
    batch = table_store(rows.sparkSession, folder, schema, key, parts).begin(number)
    batch.put("target", merge(rows, batch.meet("target", rows)))
    batch.commit()


def upsert_writer(stream: DataFrame, folder: str, key: str, digest: str | None, changing: list[str], order: list[Column], schema: str, parts: int = PARTS, adding: Iterable[str] = ()) -> DataStreamWriter:
    """A writer that upserts each micro-batch into a table in parts below folder. Outcomes are appended to
    folder/outcomes, a folder for each batch. Of columns in `adding`, what a key's rows bring is summed up and added to
    what is stored; of all others the first row of a key counts."""
    adding = list(adding)

    def each(batch: DataFrame, number: int) -> None:
        def merge(rows: DataFrame, target: DataFrame) -> DataFrame:
            if adding:
                sums = rows.groupBy(F.col(key).alias("__of")).agg(*[F.sum(c).alias(f"__{c}") for c in adding])
                sums = sums.join(target.select(F.col(key).alias("__at"), *[F.col(c).alias(f"__old_{c}") for c in adding]), F.col("__of") == F.col("__at"), "left")
                one = first_row(rows, [key], order).drop(*adding)
                rows = one.join(sums, F.col(key) == F.col("__of")).select(*one.columns, *[(F.col(f"__{c}") + F.coalesce(f"__old_{c}", F.lit(0))).alias(c) for c in adding])
            found = written(outcomes(rows, target, key, digest, order), "outcomes")
            found.select(key, "outcome", "reason").write.mode("overwrite").parquet(f"{folder}/outcomes/batch={number}")
            fresh = found.where("outcome <> 'skipped'").drop("outcome", "reason").withColumns({"is_external": F.lit(True), "claimed_at": F.lit(None).cast("timestamp_ntz")})
            return snapshot(fresh.select(*target.columns), target, key, changing)

        with freed(batch.sparkSession):
            upsert(written(batch, "batch"), folder, schema, key, number, merge, parts)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{folder}/checkpoint")


#: What a store of events keeps of each besides its own columns, and the index by the key that sources share.
EVENT = "uid string, external_source string, source_url string, canonical_key string, digest string, is_external boolean, claimed_at timestamp_ntz"
BY_KEY = "canonical_key string, uid string, external_source string, is_external boolean, claimed_at timestamp_ntz"


def event_store(spark, folder: str, columns: str = "", parts: int = PARTS) -> Store:
    """Stored events (EVENT and columns of their own) by source and URL, and an index of them by canonical key."""
    return Store(spark, folder, {"events": Kept(f"{EVENT}{columns and ', '}{columns}", ("uid",)), "by_key": Kept(BY_KEY, ("canonical_key",))}, parts)


def event_batch(rows: DataFrame, store: Store, number: int, order: list[Column], arrival: str = "arrival") -> DataFrame:
    """Apply a batch of valid events (external_source, source_url, canonical_key, digest, arrival and the store's own
    columns) and return what became of each: uid, external_source, source_url, canonical_key, outcome, reason.

    Of the sources in the batch that share a key one goes on; the stored rows of its key, found by the index, let it in,
    go for it (a row with outcome deleted) or refuse it. What goes on is upserted by source and URL. Events, index and
    the list of outcomes change with the batch's manifest, so a batch that is run again gives the same."""
    uid = F.sha1(F.concat_ws("\x1f", F.col("external_source"), F.col("source_url")))
    batch = store.begin(number)
    best = written(dedup.best_sources(rows, "canonical_key", "external_source", arrival), "winners", CODEC)
    refs = batch.meet("by_key", best.select(F.col("__k").alias("canonical_key")))
    decided, doomed = dedup.decided(rows.withColumn("uid", uid).drop(arrival), best, refs, "canonical_key", "external_source")
    decided, doomed = written(decided, "decided-events", CODEC), written(doomed, "doomed-events", CODEC)
    goes_on = decided.where("decision <> 'lower_priority_duplicate'").drop("decision")
    target = there = batch.meet("events", goes_on.select("uid").union(doomed.select("uid")))
    lost = not doomed.isEmpty()
    if lost:
        target = there.join(doomed.select("uid"), "uid", "left_anti")
    after = written(_met(first_row(goes_on, ["uid"], order), target), "events-after", CODEC)
    # the index: entries of rows that went or changed go, whatever key they had; those of changed and new rows come
    fresh = after.where("__outcome <> 'skipped'")
    keys = fresh.select(F.explode(F.array_compact(F.array("canonical_key", "__old_key"))).alias("canonical_key"))
    refs = batch.meet("by_key", keys)
    entries = fresh.where("canonical_key IS NOT NULL").select(*refs.columns)
    columns = ["uid", "external_source", "source_url", "canonical_key"]
    told = decided.where("decision = 'lower_priority_duplicate'").select(*columns, F.lit("skipped").alias("outcome"), F.col("decision").alias("reason"))
    own = [F.when(F.col("__outcome") == "skipped", F.col(f"__own.{c}")).otherwise(F.col(c)).alias(c) for c in columns[1:]]
    told = told.unionByName(after.where("__outcome IS NOT NULL").select("uid", *own, F.col("__outcome").alias("outcome"), F.col("__reason").alias("reason")))
    if lost:
        gone = there.join(doomed.select("uid"), "uid", "left_semi").select(*columns, F.lit("deleted").alias("outcome"), F.lit("superseded").alias("reason"))
        told = told.unionByName(gone)
    told.write.mode("overwrite").option("compression", CODEC).parquet(f"{store.folder}/outcomes/batch={number}")
    batch.put("by_key", refs.join(fresh.select("uid").union(doomed.select("uid")), "uid", "left_anti").unionByName(entries))
    batch.put("events", after.select(*there.columns))
    batch.commit()
    return rows.sparkSession.read.parquet(f"{store.folder}/outcomes/batch={number}")


def _met(staged: DataFrame, target: DataFrame) -> DataFrame:
    """outcomes() and snapshot() in one, by uid and digest: the target after staged rows (one for each uid) have met it,
    and __outcome and __reason of rows that are staged, __own with what a skipped one says, __old_key where a row has
    left a key."""
    s, t = (lambda c: F.col(f"s.{c}")), (lambda c: F.col(f"t.{c}"))
    both = target.alias("t").join(staged.alias("s"), t("uid") == s("uid"), "full_outer")
    known, asked = t("uid").isNotNull(), s("uid").isNotNull()
    reason = F.when(asked & known & is_claimed("t.is_external", "t.claimed_at"), "claimed").when(asked & known & F.coalesce(t("digest") == s("digest"), F.lit(False)), "unchanged")
    fresh = asked & reason.isNull()
    outcome = F.when(reason.isNotNull(), "skipped").when(asked & known, "updated").when(asked, "inserted")
    kept = {"uid": F.coalesce(t("uid"), s("uid")), "is_external": F.when(known, t("is_external")).otherwise(True), "claimed_at": t("claimed_at")}
    columns = [kept.get(c, F.when(fresh, s(c)).otherwise(t(c)) if c not in kept else None).alias(c) for c in target.columns]
    own = F.struct(*[s(c) for c in ("external_source", "source_url", "canonical_key")])
    left = F.when(fresh & ~t("canonical_key").eqNullSafe(s("canonical_key")), t("canonical_key"))
    return both.select(*columns, outcome.alias("__outcome"), reason.alias("__reason"), F.when(reason.isNotNull(), own).alias("__own"), left.alias("__old_key"))


def event_writer(stream: DataFrame, store: Store, order: list[Column], arrival: str = "arrival") -> DataStreamWriter:
    """A writer that applies each micro-batch of events to a store of events."""

    def each(batch: DataFrame, number: int) -> None:
        with freed(batch.sparkSession):
            event_batch(written(batch, "batch", CODEC), store, number, order, arrival)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{store.folder}/checkpoint")


def winners_writer(stream: DataFrame, folder: str, key: str, source: str, ts: str, schema: str, parts: int = PARTS) -> DataStreamWriter:
    """A writer that keeps, for each key, the best source so far (highest priority, then earliest time) and how many
    rows it has had, in a table in parts below folder: key, priority, earliness, winner and n. What a batch has of a key
    is one row before it meets the table. schema names the key's type: `key type`."""
    better = F.struct("priority", "earliness", "winner")
    whole = f"{schema}, priority int, earliness long, winner string, n long"

    def each(batch: DataFrame, number: int) -> None:
        rows = batch.select(F.col(key), source_priority(F.col(source)).cast("int").alias("priority"), (-F.unix_micros(F.col(ts).cast("timestamp"))).alias("earliness"), F.col(source).alias("winner"))
        best = lambda df, n: df.groupBy(key).agg(F.max(better).alias("b"), n.alias("n")).select(key, "b.*", "n")
        with freed(batch.sparkSession):
            fresh = written(best(rows, F.count("*")), "batch")
            upsert(fresh, folder, whole, key, number, lambda own, target: best(target.unionByName(own), F.sum("n")), parts)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{folder}/checkpoint")


def winners(spark, folder: str, schema: str) -> DataFrame:
    """The table of winners_writer()."""
    return current(spark, folder, f"{schema}, priority int, earliness long, winner string, n long")


def to_completion(writer: DataStreamWriter) -> None:
    """Run a stream over what is there."""
    writer.trigger(availableNow=True).start().awaitTermination()
