"""Writers: fixed schemas, partitions by domain or length bin, splits, tar shards, reports."""

from __future__ import annotations

import io
import json
import os
import tarfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schema import conform, validate

#: Bytes a tar member takes besides its data, and records in an archive file.
TAR_OVERHEAD, ARCHIVE_RECORDS = 2048, 50_000


def write_conformed(df: DataFrame, path: str, schema: StructType, mode: str = "error") -> None:
    """Parquet under exactly the schema."""
    validate(conform(df, schema), schema).write.mode(mode).option("compression", "zstd").parquet(path)


def write_jsonl(df: DataFrame, path: str, records_per_file: int = ARCHIVE_RECORDS, mode: str = "error") -> None:
    """JSON lines with null fields kept, at most so many records in a file."""
    df.write.mode(mode).option("ignoreNullFields", False).option("maxRecordsPerFile", records_per_file).json(path)


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "error") -> None:
    """One folder for each value; null goes to 'unknown'.  A value with many rows is written by many tasks."""
    df.withColumn(by, F.coalesce(F.col(by).cast("string"), F.lit("unknown"))).write.mode(mode).partitionBy(by).parquet(path)


def write_marker(path: str, counts: dict[str, object]) -> None:
    """A JSON sidecar with what a finished run declares, written last."""
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "_DECLARED.json"), "w") as f:
        json.dump(counts, f, sort_keys=True)


def read_marker(path: str) -> dict[str, object]:
    """The sidecar; a missing one means the run didn't finish."""
    with open(os.path.join(path, "_DECLARED.json")) as f:
        return json.load(f)


def sidecar_json(df: DataFrame, without: tuple[str, ...] = ("text", "input_ids")) -> Column:
    """A row's other columns as JSON, without nulls; an earlier uuid is kept as source_uuid."""
    names = [c for c in df.columns if c not in without]
    return F.to_json(F.struct(*(F.col(c).alias("source_uuid" if c == "uuid" else c) for c in names)))


def write_tar_shards(df: DataFrame, folder: str, source: str, ids: str = "input_ids", key: str = "uuid", sidecar: str = "sidecar", shard_bytes: int = 268_435_456) -> DataFrame:
    """One or more tar shards for each task and length bin, rolled when full: `.npy` of int32 ids and `.json` for each sample.

    df has len_bin besides.  The folder must be shared.  Returns what was written: path, len_bin,
    samples, tokens, bytes.  Names hold the task, so a task that is run again overwrites its own."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rank = TaskContext.get().partitionId()
        open_: dict[str, list] = {}  # bin -> [tar, path, samples, tokens, bytes, sequence]
        done: list[tuple] = []

        def close(b: str) -> int:
            tar, path, *sums, seq = open_.pop(b)
            tar.close()
            done.append((path, b, *sums))
            return seq + 1

        for batch in batches:
            for row in batch.select([ids, key, sidecar, "len_bin"]).to_pylist():
                b = row["len_bin"] or "unbinned"
                array = np.asarray(row[ids], np.int32)
                if b not in open_ or open_[b][4] >= shard_bytes:
                    seq = close(b) if b in open_ else 0
                    os.makedirs(f"{folder}/{b}", exist_ok=True)
                    path = f"{folder}/{b}/shard-{source}-{rank:05d}-{seq:04d}.tar"
                    open_[b] = [tarfile.open(path, "w"), path, 0, 0, 0, seq]
                at = open_[b]
                buffer = io.BytesIO()
                np.save(buffer, array)
                for name, data in ((f"{row[key]}.npy", buffer.getvalue()), (f"{row[key]}.json", row[sidecar].encode())):
                    info = tarfile.TarInfo(name)
                    info.size = len(data)
                    at[0].addfile(info, io.BytesIO(data))
                at[2] += 1
                at[3] += len(array)
                at[4] += array.nbytes + TAR_OVERHEAD
        for b in list(open_):
            close(b)
        columns = list(zip(*done, strict=True)) if done else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["path", "len_bin", "samples", "tokens", "bytes"])

    return df.where(F.col(ids).isNotNull()).mapInArrow(write, "path string, len_bin string, samples long, tokens long, bytes long")


def as_markdown(messages: Column, title: Column, metadata: dict[str, Column] | None = None, tools: Column | None = None) -> Column:
    """A conversation as Markdown: title, metadata, roles in capitals with (empty) where nothing is said, and the tools with their descriptions.

    Metadata that is null is left out; tools are structs with name and function, as in the full record."""
    turn = lambda m: F.concat(F.lit("### "), F.upper(F.coalesce(m["role"], F.lit("unknown"))), F.lit("\n\n"), F.when(F.coalesce(m["content"], F.lit("")) == "", "(empty)").otherwise(m["content"]))
    parts = [F.lit("# "), F.coalesce(title, F.lit("N/A")), F.lit("\n\n")]
    parts += [F.when(c.isNotNull(), F.concat(F.lit(f"- **{name}**: "), c.cast("string"), F.lit("\n"))).otherwise("") for name, c in (metadata or {}).items()]
    parts += [F.lit("\n")] if metadata else []
    parts.append(F.array_join(F.transform(F.coalesce(messages, F.array()), turn), "\n\n"))
    if tools is not None:
        named = lambda t: F.concat(F.lit("- `"), F.coalesce(t["name"], t["function"]["name"], F.lit("unknown")), F.lit("`: "), F.coalesce(t["description"], t["function"]["description"], F.lit("")))
        parts.append(F.when(F.size(tools) > 0, F.concat(F.lit("\n\n## Tools\n\n"), F.array_join(F.transform(tools, named), "\n"))).otherwise(""))
    return F.concat(*parts)


def as_text(messages: Column, preview: int = 100) -> Column:
    """A conversation as lines `ROLE: start of the content`."""
    said = lambda m: F.when(F.coalesce(m["content"], F.lit("")) == "", "(empty)").when(F.length(m["content"]) > preview, F.concat(F.substring(m["content"], 1, preview), F.lit("..."))).otherwise(m["content"])
    return F.array_join(F.transform(messages, lambda m: F.concat(F.upper(F.coalesce(m["role"], F.lit("unknown"))), F.lit(": "), said(m))), "\n")
