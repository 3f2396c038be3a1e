"""Format detection, scans, counts and ordinal access."""

from __future__ import annotations

import os
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import scrub_line

#: Extensions and the formats they stand for.
EXTENSIONS = {
    ".jsonl": "jsonl", ".ndjson": "jsonl", ".json": "json", ".parquet": "parquet", ".pq": "parquet", ".csv": "csv", ".txt": "text", ".text": "text", ".md": "text", ".log": "text",
}


def detect_format(path: str) -> str:
    """By extension, whatever its case and whatever query follows; else by the first bytes of a local file."""
    clean = urlsplit(path).path or path
    extension = os.path.splitext(clean)[1].lower()
    if extension in EXTENSIONS:
        return EXTENSIONS[extension]
    if not extension:
        raise ValueError(f"no extension to tell the format by: {path}")
    with open(path.removeprefix("file://"), "rb") as f:
        head = f.read(4096)
    if head[:4] == b"PAR1":
        return "parquet"
    first = head.lstrip()[:1]
    if first in (b"[", b"{"):
        return "json" if first == b"[" else "jsonl"
    raise ValueError(f"unknown format: {path}")


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None, strict: bool = False) -> DataFrame:
    """One row for each line that is JSON; control characters are dropped first and other lines skipped.

    strict: raise at a line that isn't JSON.  The schema is inferred from the lines unless given.  A line is parsed once
    with the schema; only one whose every field came out null is looked at again, to tell an empty record from no JSON."""
    lines = spark.read.text(path).select(scrub_line(F.col("value")).alias("value")).where("value <> ''")
    if schema is None:
        inferred = spark.read.option("mode", "FAILFAST" if strict else "DROPMALFORMED").option("allowUnquotedControlChars", True).json(path).schema
        schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in inferred.fields) or "value string"
    if strict:
        return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    parsed = lines.select(F.from_json("value", f"{schema}, `__broken` string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__broken"}).alias("r"), "value")
    whole = F.col("r.__broken").isNull() | F.try_parse_json("value").isNotNull()  # a value of another type isn't a broken line
    return parsed.where(whole).select("r.*").drop("__broken")


def read_variant(spark: SparkSession, path: str) -> DataFrame:
    """Ragged JSON lines as one VARIANT column `v`; lines that aren't JSON are skipped."""
    lines = spark.read.text(path).select(scrub_line(F.col("value")).alias("value")).where("value <> ''")
    return lines.select(F.try_parse_json("value").alias("v")).where("v is not null")


def load(spark: SparkSession, path: str | list[str], fmt: str | None = None) -> DataFrame:
    """The records of a file or folder, or of several, in any supported format."""
    fmt = fmt or detect_format(path if isinstance(path, str) else path[0])
    if fmt == "parquet":
        return spark.read.parquet(*([path] if isinstance(path, str) else path))
    if fmt == "jsonl":
        return read_jsonl(spark, path)
    if fmt == "json":
        return spark.read.option("multiLine", True).json(path)
    if fmt == "csv":
        return spark.read.options(header=True, multiLine=True, quote='"', escape='"', maxCharsPerColumn=-1).csv(path)
    if fmt == "text":
        return with_ordinal(spark.read.text(path), "line_number", 1).select("line_number", F.col("value").alias("text"))
    raise ValueError(f"unsupported format: {fmt}")


def with_ordinal(df: DataFrame, name: str = "ordinal", first: int = 0) -> DataFrame:
    """Rows numbered in the order of the files' splits: one count of each partition, then offsets; rows aren't shuffled.

    The offsets are a table with one row for each partition, which is joined."""
    numbered = df.withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id() % (1 << 33))
    sizes = {r["__p"]: r["n"] for r in numbered.groupBy("__p").agg(F.count("*").alias("n")).collect()}  # one row a partition
    starts, at = [], first
    for p in sorted(sizes):
        starts.append((p, at))
        at += sizes[p]
    offsets = df.sparkSession.createDataFrame(starts, "__p int, __at long")
    return numbered.join(F.broadcast(offsets), "__p").withColumn(name, F.col("__at") + F.col("__i")).drop("__p", "__i", "__at")


def with_provenance(df: DataFrame) -> DataFrame:
    """Adds file_path and file_row, the row's place among those read from its file: a key that survives another cluster and another order.

    df must come straight from files."""
    held = df.select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__i"))
    part = held.groupBy("file_path", "__start").agg(F.count("*").alias("__n"), F.min("__i").alias("__first"))
    before = Window.partitionBy("file_path").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)  # splits of one file
    offsets = part.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return held.join(offsets, ["file_path", "__start"]).withColumn("file_row", F.col("__i") - F.col("__first") + F.col("__before")).drop("__start", "__i", "__first", "__before")


def count_records(spark: SparkSession, path: str, fmt: str | None = None) -> int:
    """Records of a file: from the footers for Parquet, else by one scan that infers no schema."""
    fmt = fmt or detect_format(path)
    if fmt == "jsonl":
        return read_variant(spark, path).count()
    if fmt == "text":
        return spark.read.text(path).count()
    return load(spark, path, fmt).count()


def malformed_lines(spark: SparkSession, path: str) -> int:
    """Lines of a JSONL file that say something and aren't JSON."""
    lines = spark.read.text(path).select(scrub_line(F.col("value")).alias("value")).where("value <> ''")
    return lines.where(F.try_parse_json("value").isNull()).count()


def record_at(df: DataFrame, index: int, ordinal: str = "ordinal") -> DataFrame:
    """The record at a position; an IndexError if there is none."""
    if index < 0:
        raise IndexError(index)
    found = df.where(F.col(ordinal) == index)
    if not found.take(1):
        raise IndexError(index)
    return found


def records_range(df: DataFrame, start: int, count: int, ordinal: str = "ordinal") -> DataFrame:
    """Records at start, start + 1, ...; none past the end."""
    if start < 0 or count < 0:
        raise IndexError(start)
    return df.where((F.col(ordinal) >= start) & (F.col(ordinal) < start + count))


def usable_first_record(df: DataFrame, text: str = "text") -> bool:
    """Whether the first record has a text that is neither null nor the word null."""
    if text not in df.columns:
        return False
    first = df.select(text).take(1)
    return bool(first) and first[0][0] is not None and str(first[0][0]).strip().lower() != "null"
