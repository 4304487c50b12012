"""URL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def https(c: Column) -> Column:
    """webcal and webcals as https."""
    return F.regexp_replace(c, "(?i)^webcals?://", "https://")


def origin(c: Column) -> Column:
    return F.regexp_extract(c, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def host(c: Column) -> Column:
    return F.try_parse_url(c, F.lit("HOST"))


def absolute(href: Column, page: Column) -> Column:
    """A reference made absolute: whole URLs stay, roots join the origin, queries the page, others its folder."""
    folder = F.regexp_extract(page, "^([^?#]*/)", 1)
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(page, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1), href))
        .when(href.startswith("/"), F.concat(origin(page), href))
        .when(href.startswith("?"), F.concat(F.regexp_extract(page, "^([^?#]*)", 1), href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(page, "^([^#]*)", 1), href))
        .otherwise(F.concat(folder, href))
    )


def on_site(href: Column, site: str) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(site), href))


def segments(c: Column) -> Column:
    path = F.regexp_extract(c, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda x: x != "")
