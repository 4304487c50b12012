"""Operator 5: URL filters by a sorted digest array.

A rule list is kept as one file: the 64-bit xxhash digests of all rules in sorted order, their full strings, and a
verdict for each. The file is distributed once (SparkContext.addFile) and memory-mapped by every Python worker, so its
pages are shared and its size isn't bound by a worker's memory. A few megabytes of URLs at a time are turned into the
digests of all rules that could fit (of a host's parents only those with as many dots as some rule's host, of a path's
starts those as long as some rule's path), which are probed together by a vectorised binary search; a digest that is
found counts only if the stored string is equal, so collisions do no harm.

A rule is (host, path, verdict), written host + path. It fits its host and all subdomains, for URLs whose path starts
with the rule's; of several the longest string wins, of equally long ones that with the longer host.

Host: what follows the first :// up to /, ?, # or the end, A-Z lower-cased. Path: then up to ?, # or the end.

Defined results: a null URL, or one without ://, has an empty host and path and gets the default verdict, as does any
URL that no rule fits. A rule given twice counts once; if its verdicts differ, block wins. Rules with an empty host fit
nothing. An empty list is allowed. Extra columns are kept.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAGIC = b"AERURLS2"
MOST_BYTES = 4 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _key(host: bytes, path: bytes) -> int:
    return xxhash.xxh64_intdigest(b"%s\0%s" % (host, path))


def pack(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """The file of a list of (host, path, allow or block)."""
    held: dict[tuple[bytes, bytes], bool] = {}
    for host, path, verdict in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"no verdict: {verdict}")
        if host:
            pair = host.encode(), path.encode()
            held[pair] = held.get(pair, False) or verdict == "block"
    rows = sorted((_key(*pair), *pair, block) for pair, block in held.items())
    texts = [host + b"\0" + path for _, host, path, _ in rows]
    lengths = np.unique(np.array([len(path) for _, _, path, _ in rows], "<u4"))
    dots = np.unique(np.array([host.count(b".") for _, host, _, _ in rows], "<u4"))
    ends = np.cumsum([0, *map(len, texts)]).astype("<u8")
    parts = [np.array([r[0] for r in rows], "<u8").tobytes(), ends.tobytes(), np.array([r[3] for r in rows], "u1").tobytes(), lengths.tobytes(), dots.tobytes(), b"".join(texts)]
    return MAGIC + np.array([len(rows), len(lengths), len(dots)], "<u8").tobytes() + b"".join(parts)


class Rules:
    """A packed list, memory-mapped."""

    def __init__(self, path: str):
        raw = np.memmap(path, "u1", "r")
        if bytes(raw[:8]) != MAGIC:
            raise ValueError(f"{path} is not a list of URL rules")
        n, n_lengths, n_dots = (int(x) for x in raw[8:32].view("<u8"))
        at = 32
        parts = []
        for size, kind in ((8 * n, "<u8"), (8 * (n + 1), "<u8"), (n, "u1"), (4 * n_lengths, "<u4"), (4 * n_dots, "<u4")):
            part = raw[at : at + size]
            parts.append(np.frombuffer(part.tobytes(), kind) if kind == "<u4" else part if kind == "u1" else _view(raw, at, size, kind))
            at += size
        self.keys, self.ends, self.blocks, lengths, dots = parts
        self.lengths = [int(x) for x in lengths]  # of rules' paths; few
        self.dots = [int(x) for x in dots]  # of rules' hosts
        self.texts = raw[at:]

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """The first place of each key, or -1."""
        at = np.searchsorted(self.keys, keys)
        found = at < len(self.keys)
        found[found] = self.keys[at[found]] == keys[found]
        return np.where(found, at, -1)

    def confirmed(self, at: int, key: int, text: bytes) -> int:
        """The place of the rule with this key and string, from the first with the key, or -1."""
        while at < len(self.keys) and int(self.keys[at]) == key:
            if self.texts[int(self.ends[at]) : int(self.ends[at + 1])].tobytes() == text:
                return at
            at += 1
        return -1

    def parents(self, host: bytes) -> Iterator[bytes]:
        """The host and its parents, as far as rules have as many dots."""
        labels = host.rsplit(b".", self.dots[-1] + 1) if self.dots and host else []
        for n in self.dots:
            if n < len(labels):
                yield b".".join(labels[-1 - n :])

    def judge(self, hosts: list[bytes], paths: list[bytes]) -> list[tuple[str | None, bool | None]]:
        """(rule, block) of each URL, or (None, None)."""
        owner, keys, texts = [], [], []
        for row, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            starts = [path[:n] for n in self.lengths if n <= len(path)]
            for parent in self.parents(host) if starts else ():
                for start in starts:
                    texts.append(parent + b"\0" + start)
                    keys.append(_key(parent, start))
                    owner.append(row)
        best: list[tuple[int, int, int] | None] = [None] * len(hosts)
        if keys:
            numbers = np.array(keys, "<u8")
            for k in np.flatnonzero((at := self.probe(numbers)) >= 0):
                if (place := self.confirmed(int(at[k]), keys[k], texts[k])) >= 0:
                    rank = len(texts[k]), texts[k].index(b"\0"), place
                    if best[owner[k]] is None or rank > best[owner[k]]:
                        best[owner[k]] = rank
        out = []
        for found in best:
            if found is None:
                out.append((None, None))
            else:
                text = self.texts[int(self.ends[found[2]]) : int(self.ends[found[2] + 1])].tobytes()
                out.append((text.replace(b"\0", b"", 1).decode(), bool(self.blocks[found[2]])))
        return out


def _view(raw: np.memmap, at: int, size: int, kind: str) -> np.ndarray:
    return np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at)


_open: dict[str, Rules] = {}


def _rules(name: str) -> Rules:
    if name not in _open:
        _open[name] = Rules(SparkFiles.get(name))
    return _open[name]


def distribute(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> str:
    """Give a rule list to all executors; returns its file name, which depends on the content alone."""
    data = pack(rules)
    name = f"url-rules-{hashlib.sha256(data).hexdigest()[:24]}.bin"
    if not any(str(x).endswith(f"/{name}") for x in spark.sparkContext.listFiles):
        path = os.path.join(tempfile.mkdtemp(prefix="aerolith-"), name)
        with open(path, "wb") as f:
            f.write(data)
        spark.sparkContext.addFile(path)
    return name


def judge(df: DataFrame, rules: Iterable[tuple[str, str, str]], url: str = "url", default: str = "allow", column: str = "url_verdict") -> DataFrame:
    """df with a struct of host, path, rule (null if none fits) and verdict (the rule's, else default)."""
    name = distribute(df.sparkSession, rules)

    @F.arrow_udf("rule string, verdict string")
    def url_rule(host: pa.Array, path: pa.Array) -> pa.Array:
        found, step = [], max(1, len(host) * MOST_BYTES // max(host.nbytes + path.nbytes, 1))
        for at in range(0, len(host), step):
            found += _rules(name).judge(*([x.encode() for x in column.slice(at, step).to_pylist()] for column in (host, path)))
        verdicts = [default if block is None else "block" if block else "allow" for _, block in found]
        return pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array(verdicts, pa.string())], ["rule", "verdict"])

    source = F.col(f"`{url}`").cast("string")
    inner = df.withColumn(column, F.struct(host_of(source).alias("host"), path_of(source).alias("path")))
    host, path = F.col(f"`{column}`.host"), F.col(f"`{column}`.path")
    inner = inner.withColumn(column, F.struct(host.alias("host"), path.alias("path"), url_rule(host, path).alias("r")))
    return inner.withColumn(column, F.struct(host.alias("host"), path.alias("path"), F.col(f"`{column}`.r.rule").alias("rule"), F.col(f"`{column}`.r.verdict").alias("verdict")))
