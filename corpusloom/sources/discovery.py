"""Files of a folder, their sources, and counts by file."""

from __future__ import annotations

import os
from collections.abc import Sequence
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import EXTENSIONS

#: Fixed value: files whose name has this in it are left out.
SKIPPED_NAME = "interactive_agent"


def files_below(root: str, spark: SparkSession | None = None) -> list[tuple[str, int]]:
    """(path, bytes) of all files below a folder, or of one file: through Hadoop's file systems where a session is given or the root has a scheme."""
    spark = spark or (SparkSession.getActiveSession() if "://" in root or root.startswith("file:") else None)
    if spark is None:
        if os.path.isfile(root):
            return [(root, os.path.getsize(root))]
        return [(os.path.join(folder, n), os.path.getsize(os.path.join(folder, n))) for folder, _, names in os.walk(root) for n in names]
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    out = []
    while found.hasNext():
        status = found.next()
        out.append((status.getPath().toString(), int(status.getLen())))
    return out


def discover(root: str, spark: SparkSession | None = None) -> list[dict[str, str]]:
    """Supported files under a root, sorted: path and source_dataset, the first folder below the root, else the root's name (of a single file, its stem).

    Local without a session; with one, on any file system that Spark reads.  Files whose name begins with a dot or an underscore are left out."""
    files = files_below(root, spark)
    plain = urlsplit(root).path.rstrip("/") or root
    if len(files) == 1 and urlsplit(files[0][0]).path == plain:
        return [{"path": files[0][0], "source_dataset": os.path.splitext(os.path.basename(plain))[0]}]
    found = []
    for path, _ in files:
        folder, name = os.path.split(path)
        if os.path.splitext(name)[1].lower() in EXTENSIONS and SKIPPED_NAME not in name and name[0] not in "._":
            inside = os.path.relpath(urlsplit(folder).path, os.path.abspath(plain))
            found.append({"path": path, "source_dataset": os.path.basename(os.path.abspath(plain)) if inside == "." else inside.split(os.sep)[0]})
    return sorted(found, key=lambda x: x["path"])


def choose(files: Sequence[dict[str, str]], include: Sequence[str] = (), exclude: Sequence[str] = ()) -> list[dict[str, str]]:
    """Files whose source has one of include in it, without those whose source or path has one of exclude; files left out are never opened."""
    kept = [f for f in files if not include or any(x in f["source_dataset"] for x in include)]
    return [f for f in kept if not any(x in f["source_dataset"] or x in f["path"] for x in exclude)]


def listing(folder: str) -> list[dict[str, object]]:
    """Folders first, then files, each by name, with format and size."""
    entries = sorted(os.scandir(folder), key=lambda e: (not e.is_dir(), e.name))
    return [
        {"name": e.name, "is_dir": e.is_dir(), "format": None if e.is_dir() else EXTENSIONS.get(os.path.splitext(e.name)[1].lower()), "size": None if e.is_dir() else e.stat().st_size}
        for e in entries
    ]


def rows_by_file(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """(file_path, rows) of Parquet files: what is read against what was declared."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.parquet(*paths).groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("rows"))


def reconcile(rows: DataFrame, declared: dict[str, int]) -> DataFrame:
    """Files whose rows aren't what was declared, missing and unexpected ones among them: file_path, declared, rows."""
    spark = rows.sparkSession
    said = spark.createDataFrame(list(declared.items()) or [("", 0)], "file_path string, declared long").where("file_path <> ''")
    return said.join(rows, "file_path", "full").where(~F.col("declared").eqNullSafe(F.col("rows")))


def component(path: str, rules: Sequence[tuple[str, str]] = ()) -> str:
    """The part of a corpus that a file belongs to: the first rule (piece of the path, name) that fits, else the folder it is in, else 'root'."""
    plain = urlsplit(path).path.lstrip("/")
    return next((name for piece, name in rules if piece in plain), None) or os.path.basename(os.path.dirname(plain)) or "root"


def rows_by_component(rows: DataFrame, rules: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """(component, files, rows) from (file_path, rows), under the rules of component()."""
    name = F.when(F.lit(False), F.lit(None).cast("string"))
    plain = F.regexp_replace(F.regexp_replace("file_path", "^[a-z0-9]+:/+", ""), "^/+", "")
    for piece, called in rules:
        name = name.when(F.contains(plain, F.lit(piece)), F.lit(called))
    folder = F.element_at(F.split(plain, "/"), F.lit(-2))
    named = rows.select(name.otherwise(F.coalesce(F.when(F.size(F.split(plain, "/")) > 1, folder), F.lit("root"))).alias("component"), "rows")
    return named.groupBy("component").agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))


def in_scope(files: Sequence[dict[str, str]], prefix: str) -> list[dict[str, str]]:
    """Files whose path, below the root of the file system or the bucket, has a folder that begins with prefix; '' is all."""
    return [f for f in files if not prefix or f"/{prefix}" in urlsplit(f["path"]).path]
