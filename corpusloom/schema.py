"""The two fixed schemas, and helpers that bring a DataFrame into one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, MapType, StringType, StructField, StructType

_KINDS = {"string": StringType(), "double": DoubleType(), "long": LongType(), "boolean": BooleanType()}


def _struct(spec: str) -> StructType:
    return StructType([StructField(name, _KINDS[kind]) for name, kind in (x.split(":") for x in spec.split())])


#: The canonical columns of a pretraining document, in order.
PRETRAINING_SCHEMA = _struct(
    "text:string id:string dump:string url:string date:string file_path:string language:string language_score:double token_count:long"
    " source_dataset:string subset:string license:string upstream_source:string synthetic:boolean synthetic_parent_id:string"
    " quality_score:double domain:string subdomain:string dedup_cluster_id:string dedup_keep:boolean"
)
TURN = _struct("content:string role:string")
#: The unified conversation, in order.
SFT_SCHEMA = StructType(
    [StructField("conversations", ArrayType(TURN))]
    + [StructField(n, BooleanType() if n == "enable_thinking" else StringType()) for n in "agent model model_provider date task episode run_id enable_thinking tools source_dataset".split()]
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the schema's columns, cast; columns df lacks are null, others are dropped.

    Where a string is wanted, arrays, structs and maps become JSON."""
    have = {f.name.lower(): f for f in df.schema}

    def column(f: StructField) -> Column:
        given = have.get(f.name.lower())
        if given is None:
            return F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, StringType) and isinstance(given.dataType, (ArrayType, StructType, MapType)):
            return F.to_json(df[given.name], {"ignoreNullFields": "false"})
        return df[given.name].cast(f.dataType)

    return df.select(*(column(f).alias(f.name) for f in schema.fields))


@dataclass(frozen=True)
class Conformance:
    """How a DataFrame's columns differ from a schema's."""

    missing: tuple[str, ...]
    extra: tuple[str, ...]
    mistyped: tuple[str, ...]

    @property
    def ok(self) -> bool:
        return not (self.missing or self.extra or self.mistyped)


def conformance(df: DataFrame, schema: StructType) -> Conformance:
    have, want = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in schema}
    return Conformance(
        tuple(n for n in want if n not in have), tuple(n for n in have if n not in want),
        tuple(n for n in want if n in have and have[n].simpleString() != want[n].simpleString()),
    )


def validate(df: DataFrame, schema: StructType) -> DataFrame:
    """df itself; raises if its columns aren't the schema's."""
    found = conformance(df, schema)
    if not found.ok:
        raise ValueError(f"schema mismatch: {found}")
    return df
