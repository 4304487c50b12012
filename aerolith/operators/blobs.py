"""A store of binary payloads by content: a payload's name is its digest, so that storing it again changes nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.functions.classify import image_format
from aerolith.functions.keys import image_name

SCHEMA = "name string, format string, data binary, shelf string"


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """(name, format, data, shelf) of a store; an empty folder has none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(SCHEMA).parquet(folder) if there else spark.createDataFrame([], SCHEMA)


def store(df: DataFrame, data: str, folder: str, column: str = "blob_name", format_: Column | None = None) -> DataFrame:
    """Write the payloads that a store does not have, each once, and return df with their names. Payloads of unknown
    formats are not stored and have no name. The store is laid out by the first two digits of names, so that a run
    reads the names of the shelves alone, and an append that is tried again adds nothing."""
    kind = image_format(F.col(data)) if format_ is None else format_
    named = df.withColumn("__format", kind)
    named = named.withColumn(column, F.when(F.col("__format").isNotNull(), image_name(F.col(data), F.col("__format"))))
    spark = df.sparkSession
    rows = named.where(F.col(column).isNotNull()).select(F.col(column).alias("name"), F.col("__format").alias("format"), F.col(data).alias("data")).withColumn("shelf", F.substring("name", 1, 2))
    known = stored(spark, folder).select("name", "shelf")
    fresh = rows.join(known, ["shelf", "name"], "left_anti").dropDuplicates(["name"]).select("name", "format", "data", "shelf")
    fresh.repartition("shelf").write.mode("append").partitionBy("shelf").parquet(folder)
    return named.drop("__format")
