"""Incremental ingest: new files of a folder are normalised and deduplicated as they arrive.

An extension: the batch operators, applied to a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.text import text_hash


def arriving(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet", files_at_once: int = 100) -> DataFrame:
    """Rows of files as they appear in the folder, with ingested_at, the time of the file."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).format(fmt).load(folder)
    return stream.select("*", F.col("_metadata.file_modification_time").alias("ingested_at"))


def first_of_each_text(rows: DataFrame, late: str = "1 day", text: str = "text") -> DataFrame:
    """Adds text_hash; each text once within the time that state is kept for."""
    hashed = rows.withColumn("text_hash", text_hash(F.col(text))).withWatermark("ingested_at", late)
    return hashed.dropDuplicatesWithinWatermark(["text_hash"])


def ingest(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Everything that is there now, appended to a Parquet table, then stop; call again for what came since."""
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
