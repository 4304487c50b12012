"""Constraints of tables, declared, and the rows that break them, found before a write.

Required columns, checks and keys of a table are data. `violations` marks each row with the names of the constraints that
it breaks, in one pass over the rows for all conditions, and for each key one aggregate: of rows that share a key the
first in an order is good and the others break it, and all of them do if a stored row has the key. Keys can be partial
(rows outside their condition neither break nor hold them); a key with a null part is never broken. `refused` gives the
message that a store would refuse the row with, which `upsert.refusal` understands.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.core import first_case
from aerolith.operators.scratch import written


@dataclass(frozen=True)
class Required:
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Check:
    """A condition that no row may make false; unknown is good."""

    name: str
    condition: str


@dataclass(frozen=True)
class Unique:
    name: str
    columns: tuple[str, ...]
    where: str = "true"


LIVE = "source_url IS NOT NULL AND status IN ('active', 'paused')"
#: The constraints of the target tables: fixed names and conditions.
CONSTRAINTS: dict[str, tuple[Required | Check | Unique, ...]] = {
    "aircraft_listings": (Unique("aircraft_listings_source_url_unique", ("source_url",), LIVE), Check("description_check", "length(trim(description)) >= 10")),
    "parts_listings": (Unique("parts_listings_source_url_unique", ("source_url",), LIVE), Check("description_check", "length(trim(description)) >= 10")),
    "aircraft_reference_specs": (Required(("manufacturer", "model")), Unique("aircraft_reference_specs_manufacturer_model_variant_key", ("manufacturer", "model", "variant"))),
    "crawler_runs": (Required(("run_id", "source_name", "target", "status", "started_at")),),
}


def violations(df: DataFrame, constraints: Iterable[Required | Check | Unique], order: list[Column], stored: DataFrame | None = None, column: str = "violations") -> DataFrame:
    """df with an array of the names of the constraints that a row breaks, in the order of their declaration. Constraints
    on columns that df has not are not looked at. order says which of the rows with equal keys comes first; stored are
    rows that hold keys already."""
    have = {c.lower() for c in df.columns}
    rows = written(df.withColumn("__row", F.monotonically_increasing_id()), "constrained")
    broken: list[Column] = []
    for c in constraints:
        if isinstance(c, Required):
            broken += [F.when(F.col(f"`{x}`").isNull(), f"{x}_not_null") for x in c.columns if x.lower() in have]
        elif isinstance(c, Check):
            broken.append(F.when(~F.expr(c.condition), c.name))
        elif {x.lower() for x in c.columns} <= have:
            mark = f"__broken_{len(broken)}"
            keys = [F.col(f"`{x}`") for x in c.columns]
            named = [k.alias(f"__k{n}") for n, k in enumerate(keys)]
            counts = F.expr(c.where)
            for k in keys:
                counts = counts & k.isNotNull()
            best = F.min(F.struct(*[o.alias(f"o{n}") for n, o in enumerate(order)], F.col("__row").alias("r"))).getField("r")
            held = rows.where(counts).groupBy(*named).agg(best.alias("__first"), F.count("*").alias("__n"))
            if stored is not None:
                taken = stored.where(F.expr(c.where)).select(*named).distinct().withColumn("__taken", F.lit(True))
                held = held.join(taken, [f"__k{n}" for n in range(len(keys))], "left").where("__n > 1 OR __taken")
            else:
                held = held.where("__n > 1").withColumn("__taken", F.lit(None).cast("boolean"))
            # written, so that a key of very many rows can be split
            held = written(held.drop("__n"), "held-keys")
            same = counts
            for n, k in enumerate(keys):
                same = same & (k == F.col(f"__k{n}"))
            rows = rows.join(held, same, "left").withColumn(mark, F.coalesce("__taken", F.lit(False)) | (F.col("__first") != F.col("__row")))
            rows = rows.drop("__first", "__taken", *[f"__k{n}" for n in range(len(keys))])
            broken.append(F.when(F.col(mark), c.name))
    return rows.withColumn(column, F.array_compact(F.array(*broken)).cast("array<string>")).select(*df.columns, column)


def refused(violated: Column, constraints: Iterable[Required | Check | Unique]) -> Column:
    """The message of the first constraint that a row breaks, null for none."""
    unique = [c.name for c in constraints if isinstance(c, Unique)]
    first = F.try_element_at(violated, F.lit(1))
    quoted = F.concat(F.lit('"'), first, F.lit('"'))
    return first_case(
        (first.isNull(), F.lit(None).cast("string")),
        (first.isin(*unique) if unique else F.lit(False), F.concat(F.lit("duplicate key value violates unique constraint "), quoted)),
        (first.endswith("_not_null"), F.concat(F.lit("null value violates not-null constraint "), quoted)),
        otherwise=F.concat(F.lit("new row violates check constraint "), quoted),
    )
