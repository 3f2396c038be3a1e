"""Prompts from conversations: what the assistant said is blanked, its structure kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..schema import PRETRAINING_SCHEMA, SFT_SCHEMA
from .normalize import Source, to_pretraining


def blank_answers(messages: Column, turn: StructType) -> Column:
    """Assistant messages with empty content: tool_calls stay, reasoning_content becomes empty where it was there, other fields become null.  Other roles are untouched."""
    def blanked(m: Column) -> Column:
        parts = []
        for f in turn.fields:
            value = F.lit(None).cast(f.dataType)
            if f.name in ("role", "tool_calls"):
                value = m[f.name]
            elif f.name == "content":
                value = F.lit("").cast(f.dataType)
            elif f.name == "reasoning_content":
                value = F.when(m[f.name].isNotNull(), "")
            parts.append(value.alias(f.name))
        return F.when(m["role"] == "assistant", F.struct(*parts)).otherwise(m)

    return F.transform(messages, blanked)


def prompts(df: DataFrame) -> DataFrame:
    """uuid, messages (or conversations), tools, license, used_in and, where there is one, reasoning, with blanked answers."""
    key = "conversations" if "conversations" in df.columns else "messages"
    kind = df.schema[key].dataType
    if not isinstance(kind, ArrayType) or not isinstance(kind.elementType, StructType):
        raise ValueError(f"{key} must be an array of structs")
    made = blank_answers(F.col(key), kind.elementType).alias(key)
    kept = [c for c in ("uuid", "tools", "license", "used_in", "reasoning") if c in df.columns]
    return df.select(*([kept[0]] if "uuid" in kept else []), made, *(c for c in kept if c != "uuid"))


def select_records(df: DataFrame, ordinal: str, index: int | None = None, start: int | None = None, end: int | None = None, has_tools: bool = False) -> DataFrame:
    """By position: one, or start to before end; then only those with tools."""
    at = F.col(ordinal)
    out = df if index is None else df.where(at == index)
    out = out if start is None else out.where(at >= start)
    out = out if end is None else out.where(at < end)
    return out.where(F.coalesce(F.size("tools"), F.lit(0)) > 0) if has_tools else out


def parse_as(df: DataFrame, schema: StructType, source: str = "parse") -> DataFrame:
    """Conversations are parsed to prompts, pretraining documents are normalised."""
    if schema == SFT_SCHEMA:
        return prompts(df)
    if schema == PRETRAINING_SCHEMA:
        return to_pretraining(df, Source(source))
    raise ValueError("neither of the two schemas")
