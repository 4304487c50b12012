from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan

from aerolith.sources.landing import followed
from aerolith.sources.payload_source import PayloadReader, payloads


@pytest.fixture
def landed(tmp_path):
    for source, name, data in (("a", "1.html", b"one"), ("a", "sub/2.html", b""), ("b", "3.html", b"x" * 50), ("b", "_hidden", b"y"), ("c", "4.html", b"four")):
        there = tmp_path / f"source={source}" / name
        there.parent.mkdir(parents=True, exist_ok=True)
        there.write_bytes(data)
    return tmp_path


def rows(reader):
    return sorted((r["source"], r["page_url"].rsplit("/", 1)[1], r["payload"], r["drop_reason"]) for s in reader.partitions() for b in reader.read(s) for r in b.to_pylist())


def test_files_by_source(spark, landed):
    got = payloads(spark, path=str(landed), most_bytes=20, shards=3).collect()
    assert sorted((r.source, r.page_url.rsplit("/", 1)[1], r.bytes, r.payload and bytes(r.payload), r.drop_reason) for r in got) == [
        ("a", "1.html", 3, b"one", None), ("a", "2.html", 0, None, "empty"), ("b", "3.html", 50, None, "too-large"), ("c", "4.html", 4, b"four", None),
    ]
    assert all(r.page_url.startswith("file:/") and r.landed_at for r in got)
    assert payloads(spark, path=str(landed), most_bytes=-1).where("source = 'b'").first().bytes == 50


def test_conditions_keep_folders_and_files_closed(landed):
    def reader(*filters):
        made = PayloadReader({"path": str(landed), "shards": "2"})
        assert len(list(made.pushFilters(list(filters)))) == len(filters)
        return made

    one = reader(In(("source",), ("a", "c")))
    assert {s.source for s in one.partitions()} == {"a", "c"} and len(one.partitions()) == 4
    assert {s.source for s in reader(EqualTo(("source",), "a"), In(("source",), ("a", "b"))).partitions()} == {"a"}
    soon, ago = datetime.now(timezone.utc) + timedelta(hours=1), datetime.now(timezone.utc) - timedelta(hours=1)
    assert rows(reader(GreaterThanOrEqual(("landed_at",), soon))) == [] and len(rows(reader(GreaterThanOrEqual(("landed_at",), ago), LessThan(("landed_at",), soon)))) == 4
    assert rows(reader(EqualTo(("source",), "none"))) == []


def test_a_fetcher_gets_what_a_list_names(spark, tmp_path):
    (tmp_path / "urls").mkdir()
    (tmp_path / "urls/1.txt").write_text("a\thttps://x/1\na\thttps://x/fail\nb\thttps://x/none\n\nhttps://x/bare\r\n")
    (tmp_path / "urls/2.txt").write_text("b\thttps://x/long")
    found = payloads(spark, url_list=f"{tmp_path}/urls", fetcher="tests.tests_helpers:fetch", most_bytes=40, shards=2)
    got = {r.page_url[10:]: (r.source, r.payload and bytes(r.payload), r.drop_reason) for r in found.collect()}
    assert got == {"1": ("a", b"body of https://x/1", None), "fail": ("a", None, "failed: TimeoutError: no answer"), "none": ("b", None, "empty"), "bare": (None, b"body of https://x/bare", None), "long": ("b", None, "too-large")}
    assert [r.page_url for r in found.where("source = 'b' AND payload IS NULL").orderBy("page_url").collect()] == ["https://x/long", "https://x/none"]


def test_options_are_checked(tmp_path):
    for options in ({}, {"path": "a", "url_list": "b"}, {"url_list": "b"}):
        with pytest.raises(ValueError):
            PayloadReader(options)
    (tmp_path / "one.html").write_bytes(b"x")
    assert rows(PayloadReader({"path": str(tmp_path / "one.html")})) == [(None, "one.html", b"x", None)]


def test_followed_lists_are_bounded(spark):
    starts = spark.createDataFrame([("b", "b1", 2), ("a", "a1", 1), ("loop", "l", 3)], "list string, page_url string, ord int")
    links = spark.createDataFrame([("b1", "b2"), ("a1", "a2"), ("a2", "a3"), ("a3", "a4"), ("l", "l"), ("b2", None)], "page_url string, next_url string")
    got = lambda *bounds: [(r.list, r.page_url, r.page, r.place) for r in followed(starts, links, *bounds).orderBy("place").collect()]
    assert got(3) == [("a", "a1", 1, 1), ("a", "a2", 2, 2), ("a", "a3", 3, 3), ("b", "b1", 1, 4), ("b", "b2", 2, 5), ("loop", "l", 1, 6), ("loop", "l", 2, 7), ("loop", "l", 3, 8)]
    assert got(2, 4) == [("a", "a1", 1, 1), ("a", "a2", 2, 2), ("b", "b1", 1, 3), ("b", "b2", 2, 4)]
    assert followed(starts.where(F.lit(False)), links, 5).count() == 0
