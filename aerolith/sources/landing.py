"""Landed payloads: text files, page tables, and frontiers of links between them."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators.scratch import written
from aerolith.operators.upsert import numbered
from aerolith.rules import tables as T
from aerolith.sources.payload_source import MOST_BYTES, payloads

def files(spark: SparkSession, path: str, charset: str | None = None, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(page_url, payload, drop_reason) of files, one payload each; the path stands for the URL. Bytes are decoded once,
    by the charset that is known or as UTF-8. A file that is not read has no payload and a reason: too-large (more than
    most_bytes), empty or what went wrong. Folders are listed by the tasks that read them."""
    return payloads(spark, path=path, most_bytes=most_bytes).select("page_url", decoded(F.col("payload"), charset).alias("payload"), "drop_reason")


def texts(spark: SparkSession, path: str, charset: str | None = None, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(page_url, payload) of the files that are read."""
    return files(spark, path, charset, most_bytes).where("drop_reason IS NULL").drop("drop_reason")


def decoded(data: Column, charset: str | None = None) -> Column:
    """Text of bytes: Latin-1 for its names, else UTF-8 with bad bytes replaced."""
    name = (charset or "").lower()
    if name in ("windows-1252", "cp1252", "latin-1", "latin1", "iso-8859-1"):
        return F.decode(data, "windows-1252" if name in ("windows-1252", "cp1252") else "ISO-8859-1")
    return F.make_valid_utf8(data.cast("string"))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """(page_url, payload) of a table of pages."""
    return spark.read.parquet(f"{folder}/pages.parquet").select(F.col("url").alias("page_url"), F.col("html").alias("payload"))


def reachable(starts: DataFrame, links: DataFrame, most_steps: int = 20) -> DataFrame:
    """(page_url, step) of the pages that links (page_url, next_url) lead to from the starts (page_url), in at most so
    many steps, each page once: an iterative join that ends when a step finds nothing new. A step writes what it finds
    and nothing else again."""
    found = [written(starts.select("page_url").distinct().withColumn("step", F.lit(0)), "frontier")]
    for step in range(1, most_steps + 1):
        fresh = found[-1].join(links, "page_url").select(F.col("next_url").alias("page_url")).where("page_url IS NOT NULL").distinct()
        for known in found:
            fresh = fresh.join(known, "page_url", "left_anti")
        fresh = written(fresh.withColumn("step", F.lit(step)), "frontier")
        if fresh.isEmpty():
            break
        found.append(fresh)
    return reduce(DataFrame.union, found)


def followed(starts: DataFrame, links: DataFrame, most: int, most_in_total: int | None = None) -> DataFrame:
    """(list, page_url, page, place) of the pages that are read when lists of pages are followed one after the other.

    starts (list, page_url, ord) are the first pages; a page leads to the next_url that links (page_url, next_url) has for
    it, to none without one. Of a list at most `most` pages are read, of all lists in their order at most
    `most_in_total`; page counts within a list from 1, place within all from 1. A list that comes back to a page of its
    own reads it again, as a reader without a memory does; the bounds end it.

    Lists are walked side by side, a step for all of them, so the steps are `most` at most, whatever their number; which
    pages the bound in total leaves is decided by sums over lists, taken by ranges of their order."""
    at = written(starts.select("list", "ord", "page_url", F.lit(1).alias("page")), "followed")
    walked = [at]
    for page in range(2, most + 1):
        at = at.join(links.select("page_url", "next_url"), "page_url").where("next_url IS NOT NULL").select("list", "ord", F.col("next_url").alias("page_url"), F.lit(page).alias("page"))
        at = written(at, "followed")
        if at.isEmpty():
            break
        walked.append(at)
    placed = numbered(reduce(DataFrame.union, walked), ["ord", "list", "page"], column="place")
    placed = placed if most_in_total is None else placed.where(F.col("place") <= most_in_total)
    return placed.select("list", "page_url", "page", "place")


def source_table(spark: SparkSession) -> DataFrame:
    """(source, kind, base_url, invites, priority) of the sources and what they list."""
    rows = {(name, kind): (name, kind, base, invites, T.SOURCE_PRIORITY.get(name, T.DEFAULT_PRIORITY)) for name, base, kind, invites, _ in reversed(T.SOURCES)}
    return spark.createDataFrame(sorted(rows.values()), "source string, kind string, base_url string, invites boolean, priority int")


def page_table(spark: SparkSession, disabled: Iterable[str] = ()) -> DataFrame:
    """(source, kind, page_url, enabled) of the sources' first pages; pages in `disabled` (URLs) are not to be read."""
    off = set(disabled)
    rows = [(name, kind, base + path, base + path not in off) for name, base, kind, _, paths in T.SOURCES for path in paths]
    return spark.createDataFrame(rows, "source string, kind string, page_url string, enabled boolean")


def enabled(landed: DataFrame, pages: DataFrame) -> DataFrame:
    """Landed payloads without those of disabled pages; pages that the table does not name (later ones of a list) stay."""
    off = pages.where("NOT enabled").select("page_url")
    return landed.join(off, "page_url", "left_anti")
