"""Parsers in SQL: a table function of a source and a payload, for LATERAL joins with landed pages.

    sql.register(spark)
    SELECT l.page_url, r.* FROM landed l, LATERAL page_rows(l.source, l.payload, 'title, date') r

gives a row for each card of a page, by the card specification of its source, so that one statement reads pages of all
sources once. The third argument, a constant, names the fields that become columns; without it there is one column of
all fields, a map. Sources without cards, and null payloads, have no rows; fields that a source's cards don't have are null.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, MapType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from aerolith.sources import event_pages, listing_pages
from aerolith.sources.cards import Cards, extract

#: The cards of sources whose pages are lists of them.
SPECS: dict[str, Cards] = {
    "vereinsflieger.de": event_pages.TABLE_ROWS, "dulv.de": event_pages.CMS_BLOCKS, "iata.org": event_pages.LIST_ITEMS, "fliegermagazin.de": event_pages.ARTICLES, "nbaa.org": event_pages.MENU,
    "eurocontrol.int": event_pages.NODES, "aircraft24.de": listing_pages.INDEX_CARDS, "aeromarkt.net": listing_pages.GRID,
}


def _names(wanted: str | None) -> list[str]:
    return [x.strip() for x in (wanted or "").split(",") if x.strip()]


class PageRows:
    @staticmethod
    def analyze(source: AnalyzeArgument, payload: AnalyzeArgument, fields: AnalyzeArgument | None = None) -> AnalyzeResult:
        for name, argument in (("source", source), ("payload", payload)):
            if argument.isTable or not isinstance(argument.dataType, StringType):
                raise ValueError(f"page_rows: {name} must be a string")
        if fields is not None and (fields.value is None or not isinstance(fields.value, str)):
            raise ValueError("page_rows: the fields must be a constant string")
        names = _names(fields.value if fields is not None else None)
        schema = StructType().add("index", IntegerType())
        for name in names:
            schema = schema.add(name, StringType())
        return AnalyzeResult(schema if names else schema.add("fields", MapType(StringType(), StringType())))

    def eval(self, source: str, payload: str, fields: str | None = None) -> Iterator[tuple]:
        spec = SPECS.get(source)
        names = _names(fields)
        for k, card in enumerate(extract(payload, spec)) if spec and payload else ():
            yield (k, *(card.get(n) for n in names)) if names else (k, card)


def register(spark: SparkSession) -> None:
    """page_rows(source, payload[, fields]) in the session's SQL."""
    spark.udtf.register("page_rows", udtf(PageRows))
