"""Deep comparison of JSON values, and positional comparison of datasets."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Levels that are compared; below, values are compared whole.
DEPTH = 100


def compare(a: object, b: object, path: str = "", depth: int = 0) -> Iterator[tuple[str, str]]:
    """(path, state) of every value: unchanged, changed, removed or added; what is inside an added or removed value is marked too."""
    if depth < DEPTH and isinstance(a, dict) and isinstance(b, dict):
        for key in list(dict.fromkeys([*a, *b])):
            at = f"{path}.{key}" if path else key
            if key not in b:
                yield from _all(a[key], at, "removed", depth + 1)
            elif key not in a:
                yield from _all(b[key], at, "added", depth + 1)
            else:
                yield from compare(a[key], b[key], at, depth + 1)
    elif depth < DEPTH and isinstance(a, list) and isinstance(b, list):
        for i in range(max(len(a), len(b))):
            at = f"{path}[{i}]"
            if i >= len(b):
                yield from _all(a[i], at, "removed", depth + 1)
            elif i >= len(a):
                yield from _all(b[i], at, "added", depth + 1)
            else:
                yield from compare(a[i], b[i], at, depth + 1)
    else:
        yield path, "unchanged" if type(a) is type(b) and a == b else "changed"


def _all(value: object, path: str, state: str, depth: int) -> Iterator[tuple[str, str]]:
    yield path, state
    if depth < DEPTH:
        inner = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ()
        for key, v in inner:
            yield from _all(v, f"{path}.{key}" if isinstance(value, dict) else f"{path}[{key}]", state, depth + 1)


def record_diff(df: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """(key, path, state) for two JSON columns; text that isn't JSON is compared as text, null as JSON null."""
    kept = df.select(key, F.col(left).cast("string").alias("left"), F.col(right).cast("string").alias("right"))

    def parse(s: str | None) -> object:
        try:
            return None if s is None else json.loads(s)
        except ValueError:
            return s

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, paths, states = [], [], []
            for k, a, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                for path, state in compare(parse(a), parse(c)):
                    keys.append(k)
                    paths.append(path)
                    states.append(state)
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(0).type), pa.array(paths, pa.string()), pa.array(states, pa.string())], [key, "path", "state"])

    return kept.mapInArrow(run, kept.select(key).schema.add("path", "string").add("state", "string"))


def diff_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("state").agg(F.count("*").alias("n"))


def side_by_side(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Rows of two datasets at the same position, or with the same id: on, left and right as JSON; one side is null where the other has no such row."""
    a = left.select(F.col(on), F.to_json(F.struct(*(c for c in left.columns if c != on)), {"ignoreNullFields": "false"}).alias("left"))
    b = right.select(F.col(on), F.to_json(F.struct(*(c for c in right.columns if c != on)), {"ignoreNullFields": "false"}).alias("right"))
    return a.join(b, on, "full")
