"""Operator 4: WARC archives, a writer that marks revisits and a reader that salvages damaged files.

Writer. Each row becomes a WARC/1.1 record in a gzip member of its own: a response, an HTTP message whose body is the
payload, or a revisit, the same HTTP head without a body, that refers to the record with the equal payload. Rows are
written to rolling archives in the shared folder; an archive's name holds the attempt's id, and only archives in the
manifest, which Spark commits, count. So an attempt that is lost leaves nothing that is read later.

Reader. Archives are read, decompressed and checked in steps of bounded size, whatever the length of a record, its
headers or its URL; only payloads that are asked for are held whole. A record counts if its member decompresses with a
good checksum, its version line, headers and length are right, and its block and payload digests fit. Where a check
fails, the reader looks for the next place where a valid member or a version line begins, goes on there, and logs the
bytes between as a quarantined gap (archive, offset, length, reason). Both gzipped and plain archives are read. An
archive of one's own can be read strictly: then fewer records than its manifest counts are an error.

Defined results: a null payload is empty. Of equal payloads of at least `revisit_bytes` bytes the row with the largest
id is the response (rows that are equal to it in id as well are responses too); smaller ones are always responses. A
null id is written as such; it is the smallest. A null URL is left out of the record. An empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import scratch_path, small_pieces, written

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
STEP = 1 << 20
PART = 1 << 16
MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
MANIFEST = "archive string, n_records long, n_bytes long"
RECORD = "id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, archive string, offset long, length long"
GAP = "archive string, offset long, length long, reason string"


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _urn(x: int | None) -> str:
    return f"<urn:x-row:{'' if x is None else x}>"


def record_parts(row_id: int | None, url: str | None, payload: bytes, digest: bytes, payload_bytes: int, refers_to: int | None, revisit: bool) -> list[bytes]:
    """One uncompressed record, in parts."""
    block = [f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode(), b"" if revisit else payload]
    whole = hashlib.sha1(block[0])
    whole.update(block[1])
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(row_id)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f-\x9f%]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url))
    head += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: {_base32(digest)}", f"WARC-Block-Digest: {_base32(whole.digest())}"]
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {sum(map(len, block))}"]
    return ["\r\n".join(head).encode() + b"\r\n\r\n", *block, b"\r\n\r\n"]


def member_parts(parts: Iterable[bytes], level: int = 1) -> Iterator[bytes]:
    """A gzip member without name or time, so that equal records give equal bytes."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    for part in parts:
        yield squeeze.compress(part)
    yield squeeze.flush()


def _files(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}" if not uri.startswith("file:") else "file://" + uri.removeprefix("file:"))


def decide(df: DataFrame, row_id: str, payload: str, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """df with __digest (binary), __bytes, __revisit and __refers_to.

    Groups are found from (digest, length, id) alone: sums of groups meet, not their rows. Only groups of two or more
    are written and joined back, so that adaptive execution can split the partitions of a very large one."""
    data = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    df = df.withColumn("__digest", F.unhex(F.sha1(data))).withColumn("__bytes", F.octet_length(data).cast("long"))
    long = F.col("__bytes") >= revisit_bytes
    groups = df.where(long).groupBy("__digest", "__bytes").agg(F.count("*").alias("__n"), F.max(F.col(f"`{row_id}`").cast("long")).alias("__first")).where("__n > 1")
    groups = written(groups.select(F.col("__digest").alias("__d"), F.col("__bytes").alias("__b"), "__first"), "warc-groups")
    joined = df.join(groups, (F.col("__digest") == F.col("__d")) & (F.col("__bytes") == F.col("__b")) & long, "left")
    other = F.col("__first").isNotNull() & ~F.col(f"`{row_id}`").cast("long").eqNullSafe(F.col("__first"))
    return joined.withColumn("__revisit", other).withColumn("__refers_to", F.when(other, F.col("__first"))).drop("__d", "__b", "__first")


def write(df: DataFrame, row_id: str = "page_id", url: str = "url", payload: str = "html", path: str | None = None,
          revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows' records below path (a new folder in the shared one) and return the manifest of archives."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "warc")
    files, below = _files(path)
    files.create_dir(below, recursive=True)
    rows = df.select(F.col(f"`{row_id}`").cast("long").alias("i"), F.col(f"`{url}`").cast("string").alias("u"), F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("p"))
    rows = decide(rows, "i", "p", revisit_bytes)

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, below = _files(path)
        attempt, n_archives, out = uuid.uuid4().hex, 0, None
        name, n, size = "", 0, 0
        for batch in small_pieces(batches, column="p"):
            for r in zip(*(batch.column(c).to_pylist() for c in ("i", "u", "p", "__digest", "__bytes", "__refers_to", "__revisit")), strict=True):
                if out is None:
                    name, n, size = f"{path}/{attempt}-{n_archives:05d}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{below}/{attempt}-{n_archives:05d}.warc.gz", compression=None)
                    n_archives += 1
                for part in member_parts(record_parts(*r)):
                    out.write(part)
                    size += len(part)
                n += 1
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"archive": [name], "n_records": [n], "n_bytes": [size]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [name], "n_records": [n], "n_bytes": [size]})

    manifest = f"{path}/manifest"
    rows.mapInArrow(archives, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


class Bytes:
    """A file that can be sought; one step of it is held."""

    def __init__(self, stream, size: int):
        self.stream, self.size, self.start, self.held = stream, size, 0, b""

    def need(self, at: int, n: int) -> bytes:
        """Up to n bytes from place `at`; fewer only at the end."""
        n = min(n, self.size - at)
        if at < self.start or at + n > self.start + len(self.held):
            self.stream.seek(at)
            self.start, self.held = at, self.stream.read(max(STEP, n))
        return self.held[at - self.start : at - self.start + n]

    def find(self, pattern: re.Pattern, at: int) -> int:
        """The next place of a pattern of at most 16 bytes, or the end."""
        while at < self.size:
            part = self.need(at, STEP)
            if m := pattern.search(part):
                return at + m.start()
            if len(part) < STEP:
                break
            at += STEP - 16
        return self.size


class Damaged(Exception):
    pass


class Parts:
    """The bytes of a record as they come, a part at a time."""

    def __init__(self, parts: Iterator[bytes]):
        self.parts, self.held, self.taken = parts, bytearray(), 0

    def more(self) -> bool:
        part = next(self.parts, None)
        self.held += part or b""
        return part is not None

    def until(self, mark: bytes, reason: str) -> bytes:
        """What comes before a mark, which is passed over."""
        at = 0
        while (end := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                raise Damaged(reason)
        out = bytes(self.held[:end])
        del self.held[: end + len(mark)]
        self.taken += end + len(mark)
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise Damaged("record ends early")
            part = bytes(self.held[:n])
            del self.held[: len(part)]
            self.taken += len(part)
            n -= len(part)
            if part:
                yield part


def _head(data: bytes) -> dict[str, str]:
    """Headers of a record by lower-case name."""
    version, _, lines = data.partition(b"\r\n")
    if not VERSION.fullmatch(version + b"\r\n"):
        raise Damaged("no version line")
    try:
        pairs = dict(line.split(":", 1) for line in lines.decode().split("\r\n"))
    except ValueError as bad:
        raise Damaged("bad header") from bad
    return {k.strip().lower(): v.strip() for k, v in pairs.items()}


def _length(head: dict[str, str]) -> int:
    text = head.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", text):
        raise Damaged("no length")
    return int(text)


def _row(text: str | None) -> int | None:
    m = re.fullmatch(r"<urn:x-row:(-?\d*)>", text or "")
    if not m:
        raise Damaged("bad record id")
    return int(m[1]) if m[1] else None


def parse(parts: Parts, most: int | None = None, keep: bool = True) -> dict:
    """An uncompressed record, checked; at most `most` bytes can come. The payload is null unless it is to be kept."""
    head = _head(parts.until(b"\r\n\r\n", "headers do not end"))
    n = _length(head)
    if most is not None and parts.taken + n + 4 > most:
        raise Damaged("record ends early")
    block, body, pending, http, kept, size = hashlib.sha1(), hashlib.sha1(), bytearray(), None, [], 0
    for part in parts.take(n):
        block.update(part)
        if http is None:
            before = max(0, len(pending) - 3)
            pending += part
            if (cut := pending.find(b"\r\n\r\n", before)) < 0:
                continue
            http, part = bytes(pending[: cut + 2]), bytes(pending[cut + 4 :])
            pending.clear()
        body.update(part)
        size += len(part)
        if keep:
            kept.append(part)
    if b"".join(parts.take(4)) != b"\r\n\r\n":
        raise Damaged("length and end do not fit")
    if _base32(block.digest()) != head.get("warc-block-digest"):
        raise Damaged("block digest")
    m = re.search(rb"\r\nContent-Length: (\d{1,18})\r\n", http or b"")
    kind = head.get("warc-type")
    if not m or kind not in ("response", "revisit"):
        raise Damaged("bad block")
    stated = head.get("warc-payload-digest", "")
    if kind == "response" and (_base32(body.digest()) != stated or size != int(m[1])):
        raise Damaged("payload digest")
    try:
        digest = base64.b32decode(stated.removeprefix("sha1:")).hex()
    except ValueError as bad:
        raise Damaged("payload digest") from bad
    uri = head.get("warc-target-uri")
    url = None if uri is None else re.sub(rb"%([0-9A-F]{2})", lambda x: bytes([int(x[1], 16)]), uri.encode()).decode("utf-8", "replace")
    return {"id": _row(head.get("warc-record-id")), "url": url, "record_type": kind, "refers_to": _row(head.get("warc-refers-to")) if kind == "revisit" else None, "payload_bytes": int(m[1]), "payload_digest": digest, "payload": b"".join(kept) if keep else None}


class Inflated:
    """The content of the gzip member at a place, part by part; length is the member's, once all has come."""

    def __init__(self, data: Bytes, at: int):
        self.data, self.at, self.length = data, at, 0

    def __iter__(self) -> Iterator[bytes]:
        inflate, here = zlib.decompressobj(31), self.at
        while not inflate.eof:
            rest = inflate.unconsumed_tail
            if not rest:
                rest = self.data.need(here, PART)
                here += len(rest)
            try:
                got = inflate.decompress(rest, STEP)
            except zlib.error as bad:
                raise Damaged("member does not decompress") from bad
            if got:
                yield got
            elif not rest:
                raise Damaged("member ends early")
        self.length = here - len(inflate.unused_data) - self.at


def _plain(data: Bytes, at: int) -> Iterator[bytes]:
    while part := data.need(at, PART):
        yield part
        at += len(part)


START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")


def salvage(stream, size: int, keep: bool = True) -> Iterator[tuple[int, int, dict | str]]:
    """(offset, length, record) of each record and (offset, length, reason) of each gap, in order."""
    data, at = Bytes(stream, size), 0
    gap, reason = -1, ""
    while at < size:
        try:
            begin = data.need(at, 12)
            if begin.startswith(MEMBER):
                inflated = Inflated(data, at)
                parts = Parts(iter(inflated))
                found = parse(parts, keep=keep)
                if parts.held or parts.more():
                    raise Damaged("length and end do not fit")
                length = inflated.length
            elif VERSION.match(begin):
                parts = Parts(_plain(data, at))
                found = parse(parts, size - at, keep)
                length = parts.taken
            else:
                raise Damaged("neither a member nor a version line")
        except Damaged as bad:
            if gap < 0:
                gap, reason = at, str(bad)
            at = data.find(START, at + 1)
            continue
        if gap >= 0:
            yield gap, at - gap, reason
            gap = -1
        yield at, length, found
        at += length
    if gap >= 0:
        yield gap, size - gap, reason


def _each(archives: DataFrame, schema: str, pick, keep: bool = False, strict: bool = False) -> DataFrame:
    """Archives are dealt out one by one: their names are few bytes, so adaptive execution would put all in one task."""
    stated = F.col("n_records").cast("long") if strict else F.lit(None).cast("long")
    spread = archives.select("archive", stated.alias("n_records")).repartition(max(1, archives.count()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        kind = pa.schema([(name, types[of]) for name, of in (x.split() for x in schema.split(", "))])
        for batch in batches:
            for archive, n_records in zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True):
                files, path = _files(archive)
                size = files.get_file_info(path).size
                with files.open_input_file(path) as stream:
                    rows, held, n = [], 0, 0
                    for at, length, found in salvage(stream, size, keep):
                        n += isinstance(found, dict)
                        row = pick(archive, at, length, found)
                        if row is not None:
                            rows.append(row)
                            held += len(row.get("payload") or b"") + len(row.get("url") or "") + 100
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, kind)
                            rows, held = [], 0
                    if n_records is not None and n != n_records:
                        raise ValueError(f"{archive} has {n} sound records, its manifest says {n_records}")
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, kind)

    return spread.mapInArrow(read, schema)


def read(archives: DataFrame, payloads: bool = True, strict: bool = False) -> DataFrame:
    """All sound records of the archives (a table with a column archive); payload is null where not asked for. If strict,
    archives is a manifest, and an archive with another number of sound records than that says is an error."""

    def pick(archive, at, length, found):
        return None if isinstance(found, str) else found | {"archive": archive, "offset": at, "length": length}

    return _each(archives, RECORD, pick, payloads, strict)


def gaps(archives: DataFrame) -> DataFrame:
    """The quarantine log: the byte ranges of the archives that belong to no sound record."""
    return _each(archives, GAP, lambda archive, at, length, found: {"archive": archive, "offset": at, "length": length, "reason": found} if isinstance(found, str) else None)


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """A table of the archives in a folder that no manifest describes."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder).select(F.col("path").alias("archive"))
