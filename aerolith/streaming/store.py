"""Tables that runs change batch by batch: kept in parts by a hash of their key, changed together or not at all.

A batch reads and writes the parts that its keys fall in. What it writes is a new version of these parts; a manifest,
written last, says which version of each part of each table counts. So a batch that is run again after a failure starts
from the manifest before it and gives the same state, and several tables (rows, and an index of them by another key)
never disagree. Versions that only older manifests name are deleted.

The number of parts grows with the table: where parts hold more than `MOST_ROWS` rows on the average, the next batch
deals all rows to as many parts as bring that down to half. Each row is dealt anew a bounded number of times over the
life of a table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators.scratch import delete_path

PARTS = 64
MOST_ROWS = 2_000_000
#: Keys and digests as text take about half the room that Spark's usual codec leaves them.
CODEC = "zstd"
MANIFEST = "name string, parts int, part int, version long, rows long"


def path_exists(spark: SparkSession, path: str) -> bool:
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there)


@dataclass(frozen=True)
class Kept:
    """A table of a store: its columns and those of its key."""

    schema: str
    key: tuple[str, ...]


@dataclass(frozen=True)
class Part:
    parts: int
    version: int
    rows: int


@dataclass
class Store:
    spark: SparkSession
    folder: str
    tables: dict[str, Kept]
    parts: int = PARTS
    most_rows: int = MOST_ROWS

    def batches(self, before: int | None = None) -> list[int]:
        """The batches (before one) whose manifest is whole, in order: a few, as older ones are deleted."""
        if not path_exists(self.spark, f"{self.folder}/manifest"):
            return []
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/manifest")
        names = [x.getPath().getName() for x in path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]
        found = [int(x.removeprefix("batch=")) for x in names if path_exists(self.spark, f"{self.folder}/manifest/{x}/_SUCCESS")]
        return sorted(n for n in found if before is None or n < before)

    def state(self, batch: int | None) -> dict[str, dict[int, Part]]:
        """The parts of each table after a batch: as many rows as there are parts."""
        out: dict[str, dict[int, Part]] = {name: {} for name in self.tables}
        if batch is not None:
            for r in self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest/batch={batch}").collect():
                out[r.name][r.part] = Part(r.parts, r.version, r.rows)
        return out

    def place(self, name: str, part: int, p: Part) -> str:
        return f"{self.folder}/{name}/parts={p.parts}/part={part}/version={p.version}"

    def read(self, name: str, parts: dict[int, Part]) -> DataFrame:
        paths = [self.place(name, k, p) for k, p in sorted(parts.items()) if p.rows]
        schema = self.tables[name].schema
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema).where(F.lit(False))

    def current(self, name: str) -> DataFrame:
        """The newest state of a table."""
        return self.read(name, self.state(max(self.batches(), default=None))[name])

    def begin(self, number: int) -> Batch:
        return Batch(self, number)


class Batch:
    """One batch's view of a store: meet the rows that its keys may concern, put what is to be there instead, commit."""

    def __init__(self, store: Store, number: int):
        self.store, self.number = store, number
        self.older = store.batches(before=number)
        self.before = store.state(self.older[-1] if self.older else None)
        self.now = {name: dict(parts) for name, parts in self.before.items()}
        self.met: dict[str, set[int]] = {name: set() for name in store.tables}
        self.parts: dict[str, int] = {}
        for name, parts in self.before.items():
            count, rows = next((p.parts for p in parts.values()), store.parts), sum(p.rows for p in parts.values())
            grown = count
            while rows > grown * store.most_rows:
                grown *= 2
            self.parts[name] = 2 * grown if grown > count else count
            if self.parts[name] != count:  # dealt anew: every row is met
                self.met[name] = set(range(self.parts[name]))

    def _part(self, name: str) -> Column:
        return F.pmod(F.xxhash64(*self.store.tables[name].key), F.lit(self.parts[name])).cast("int")

    def meet(self, name: str, keys: DataFrame) -> DataFrame:
        """All rows of the parts that these keys, or keys met before, fall in."""
        self.met[name] |= {r[0] for r in keys.select(self._part(name)).distinct().collect()}  # as many as there are parts
        there = self.before[name]
        anew = any(p.parts != self.parts[name] for p in there.values())
        return self.store.read(name, there if anew else {k: p for k, p in there.items() if k in self.met[name]})

    def put(self, name: str, rows: DataFrame) -> None:
        """rows instead of all that was met of a table."""
        count, store = self.parts[name], self.store
        if not self.met[name]:
            return
        dealt = rows.select(*[F.col(f"`{c}`") for c in store.spark.createDataFrame([], store.tables[name].schema).columns])
        dealt = dealt.withColumns({"parts": F.lit(count), "part": self._part(name), "version": F.lit(self.number)})
        dealt.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("parts", "part", "version").option("compression", CODEC).parquet(f"{store.folder}/{name}")
        fresh = [store.place(name, k, Part(count, self.number, 1)) for k in sorted(self.met[name])]
        fresh = [x for x in fresh if path_exists(store.spark, x)]
        sizes = {}
        if fresh:
            names = F.regexp_extract(F.col("_metadata.file_path"), r"/part=(\d+)/version=", 1).cast("int")
            sizes = dict(store.spark.read.schema(store.tables[name].schema).parquet(*fresh).groupBy(names.alias("part")).agg(F.count("*")).collect())
        kept = {k: p for k, p in self.now[name].items() if p.parts == count}
        self.now[name] = kept | {k: Part(count, self.number, sizes.get(k, 0)) for k in self.met[name]}

    def commit(self) -> None:
        store = self.store
        rows = [(name, p.parts, k, p.version, p.rows) for name, parts in self.now.items() for k, p in parts.items()]
        store.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{store.folder}/manifest/batch={self.number}")
        for batch in self.older[:-1]:
            for name, parts in store.state(batch).items():
                for k, p in parts.items():
                    still = self.before[name].get(k)
                    if still is None or (still.parts, still.version) != (p.parts, p.version):
                        delete_path(store.spark, store.place(name, k, p))
            delete_path(store.spark, f"{store.folder}/manifest/batch={batch}")
