import io
import random

from pyspark.sql import Row

from aerolith.llm import warc
from aerolith.llm.warc import member_parts, record_parts, salvage


def _record(k, payload, revisit=False, refers_to=None):
    import hashlib

    return b"".join(record_parts(k, f"http://h/{k} ä", payload, hashlib.sha1(payload).digest(), len(payload), refers_to, revisit))


def member(record):
    return b"".join(member_parts([record]))


def _read(data):
    return list(salvage(io.BytesIO(data), len(data)))


def test_round_trip_gzip_and_plain():
    for wrap in (member, bytes):
        parts = [wrap(_record(k, b"x" * k * 1000)) for k in range(5)]
        found = _read(b"".join(parts))
        assert [x["id"] for *_, x in found] == list(range(5))
        assert [x["payload"] for *_, x in found] == [b"x" * k * 1000 for k in range(5)]
        assert [n for _, n, _ in found] == [len(p) for p in parts]
        assert found[3][2]["url"] == "http://h/3 ä"


def test_damage_costs_only_the_damaged_records():
    rng = random.Random(7)
    for wrap in (member, bytes):
        parts = [wrap(_record(k, rng.randbytes(3000))) for k in range(12)]
        for trial in range(40):
            bad = rng.randrange(12)
            data = bytearray(parts[bad])
            kind = trial % 3
            if kind == 0:
                data[rng.randrange(len(data))] ^= 1 << rng.randrange(8)
            elif kind == 1:
                data = data[: rng.randrange(1, len(data))]
            else:
                at = rng.randrange(len(data))
                data[at:at] = rng.randbytes(50)
            whole = b"".join(bytes(data) if k == bad else p for k, p in enumerate(parts))
            found = _read(whole)
            ids = [x["id"] for *_, x in found if isinstance(x, dict)]
            # a changed byte may fall where no check looks (a gzip header's time); then the record is sound
            assert ids in ([k for k in range(12) if k != bad], list(range(12)))
            spans = [(at, n) for at, n, _ in found]
            assert sum(n for _, n in spans) == len(whole)
            assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))


def test_empty_and_garbage_archives():
    assert _read(b"") == []
    assert [x[:2] for x in _read(b"garbage" * 10)] == [(0, 70)]
    assert [x[:2] for x in _read(b"\x1f\x8b\x08" * 10)] == [(0, 30)]


def test_write_and_read_with_nulls_ties_and_clashing_columns(spark):
    big, other = "ä" * 600, "b" * 1000
    rows = [(1, "http://a/", big), (5, None, big), (3, "u", big), (3, "u", big), (7, "x", "short"), (8, "x", "short"), (9, "e", ""), (10, "n", None), (None, "q", other), (2, "q", other)]
    df = spark.createDataFrame([Row(page_id=a, url=b, html=c, i=1, p="clash", __bytes=3) for a, b, c in rows], "page_id long, url string, html string, i int, p string, __bytes int")
    manifest = warc.write(df)
    found = {(r.id, r.record_type, r.refers_to, r.payload_bytes): r for r in warc.read(manifest).collect()}
    assert set(found) == {
        (1, "revisit", 5, 1200), (5, "response", None, 1200), (3, "revisit", 5, 1200), (7, "response", None, 5), (8, "response", None, 5),
        (9, "response", None, 0), (10, "response", None, 0), (None, "revisit", 2, 1000), (2, "response", None, 1000),
    }
    assert warc.read(manifest).count() == 10
    assert bytes(found[5, "response", None, 1200].payload) == big.encode()
    assert found[5, "response", None, 1200].url is None
    assert warc.gaps(manifest).count() == 0


def test_empty_table(spark):
    manifest = warc.write(spark.createDataFrame([], "page_id long, url string, html string"))
    assert manifest.count() == 0 and warc.read(manifest).count() == 0


def test_gaps_are_logged(spark, tmp_path):
    parts = [member(_record(k, b"y" * 2000)) for k in range(3)]
    (tmp_path / "a.warc.gz").write_bytes(parts[0] + b"junk" * 9 + parts[1] + parts[2][:-20])
    archives = warc.archives_in(spark, str(tmp_path))
    assert sorted(r.id for r in warc.read(archives, payloads=False).collect()) == [0, 1]
    log = sorted((r.offset, r.length) for r in warc.gaps(archives).collect())
    assert log == [(len(parts[0]), 36), (len(parts[0]) + 36 + len(parts[1]), len(parts[2]) - 20)]


def test_long_urls_and_payloads_come_back(spark):
    long = "http://h/" + "ä%\n" * (1 << 20)
    rows = [(1, long, "p" * 30_000_000), (2, "http://h/2", "x" * 10), (3, "u" * ((1 << 21) + 1), None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write(df)
    found = {r.id: r for r in warc.read(manifest, strict=True).collect()}
    assert {k: (r.url, r.payload_bytes) for k, r in found.items()} == {i: (u, len(h or "")) for i, u, h in rows}
    assert bytes(found[1].payload) == b"p" * 30_000_000


def test_a_long_plain_record_and_a_wrong_length():
    parts = [_record(k, b"z" * 3_000_000) for k in range(3)]
    assert [x["payload_bytes"] for *_, x in _read(b"".join(parts))] == [3_000_000] * 3
    wrong = parts[1].replace(b"Content-Length: 3000", b"Content-Length: 9999", 2)
    assert [x["id"] for *_, x in _read(parts[0] + wrong + parts[2]) if isinstance(x, dict)] == [0, 2]


def test_strict_reading_misses_no_record(spark):
    from pyspark.errors import PySparkException

    manifest = warc.write(spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string"))
    more = manifest.selectExpr("archive", "n_records + 1 AS n_records")
    try:
        warc.read(more, strict=True).collect()
    except PySparkException as error:
        assert "sound records" in str(error)
    else:
        raise AssertionError
