"""Sessions and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations", "benchmark", "labels", "embeddings")


def session(app: str = "aerolith", **conf: str) -> SparkSession:
    """A session with the settings that the library counts on; master and resources come from the environment."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    }
    builder = SparkSession.builder.appName(app)
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def views(spark: SparkSession, folder: str) -> None:
    """Temporary views of all tables of a folder."""
    for name in TABLES:
        table(spark, folder, name).createOrReplaceTempView(name)
