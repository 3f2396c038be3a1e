"""Files of several sources and shapes as one conversation table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import SFT_SCHEMA, conform, validate
from ..sources.discovery import choose, discover
from ..sources.readers import detect_format, load
from .adapters import choose_adapter
from .sampling import exact_share


def union_sources(frames: Sequence[DataFrame], schema=SFT_SCHEMA) -> DataFrame:  # noqa: ANN001
    """One table under the schema; columns a source lacks are null."""
    out = conform(frames[0], schema)
    for f in frames[1:]:
        out = out.unionByName(conform(f, schema))
    return validate(out, schema)


def mix(spark: SparkSession, root: str, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """All supported files under root, each through the adapter its columns ask for; files left out by name are never opened."""
    files = choose(discover(root, spark if "://" in root or root.startswith("file:") else None), include, exclude)
    if not files:
        raise ValueError(f"no files to mix under {root}")
    return union_sources([_adapted(spark, paths, fmt, source) for (source, fmt), paths in _grouped(files).items()])


def _grouped(files: Sequence[dict[str, str]]) -> dict[tuple[str, str], list[str]]:
    """Paths by source and format: the files of a source in one format are one scan, however many they are."""
    groups: dict[tuple[str, str], list[str]] = {}
    for f in files:
        groups.setdefault((f["source_dataset"], detect_format(f["path"])), []).append(f["path"])
    return groups


def _adapted(spark: SparkSession, paths: list[str], fmt: str, source: str) -> DataFrame:
    """One scan of a source's files; where they don't fit together (no adapter for their columns as one), file by file."""
    try:
        df = load(spark, paths, fmt)
        return choose_adapter(df, fmt, source)(df, source)
    except ValueError:
        if len(paths) == 1:
            raise
        return union_sources([_adapted(spark, [p], fmt, source) for p in paths])


def sample_source(df: DataFrame, source: str, share: float, row: str, seed: int = 0) -> DataFrame:
    """A share of the rows of sources with `source` in their name, all rows of the others."""
    mine = F.contains(F.coalesce("source_dataset", F.lit("")), F.lit(source))
    return df.where(~mine).unionByName(exact_share(df.where(mine), "source_dataset", row, share, seed))


def dry_run(df: DataFrame) -> DataFrame:
    """(kind, name, n): rows by source, rows by task, and the total."""
    sets = df.groupingSets([["source_dataset"], ["task"], []], "source_dataset", "task").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    kind = F.when(F.col("g") == 1, "source").when(F.col("g") == 2, "task").otherwise("total")
    return sets.where("g <> 2 or task is not null").select(kind.alias("kind"), F.coalesce("source_dataset", "task").alias("name"), "n")
