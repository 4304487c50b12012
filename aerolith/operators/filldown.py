"""Fill-down and first/last within ordered groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fill_down(df: DataFrame, by: list[str], order: list[Column], value: str, column: str, default=None) -> DataFrame:
    """df with the last value that is not null up to each row of its group."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(column, F.coalesce(F.last(value, ignorenulls=True).over(w), F.lit(default)))
