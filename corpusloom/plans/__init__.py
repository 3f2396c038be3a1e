"""Named queries and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A whole table of the folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
