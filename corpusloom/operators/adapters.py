"""Conversation sources of several shapes to the unified schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from ..functions.text import model_provider
from ..schema import SFT_SCHEMA, conform

_TURNS = "array<struct<content:string,role:string>>"


def turns(df: DataFrame, column: str) -> Column:
    """Turns of a column: an array's content and role, or a JSON string's; an empty or broken string has none."""
    if isinstance(df.schema[column].dataType, StringType):
        return F.coalesce(F.from_json(F.col(column), _TURNS), F.array().cast(_TURNS))
    return F.transform(F.col(column), lambda t: F.struct(t["content"].cast("string").alias("content"), t["role"].cast("string").alias("role")))


def as_json(df: DataFrame, column: str) -> Column:
    """A string as it is, anything else as JSON text; null where the column is absent."""
    if column not in df.columns:
        return F.lit(None).cast("string")
    return F.col(column) if isinstance(df.schema[column].dataType, StringType) else F.to_json(column)


def _field(df: DataFrame, path: str) -> Column:
    """The value at a dotted path as a string; null where the schema has no such path."""
    kind = df.schema
    for part in path.split("."):
        if not isinstance(kind, StructType) or part not in kind.names:
            return F.lit(None).cast("string")
        kind = kind[part].dataType
    return F.col(path).cast("string")


def _unified(df: DataFrame, source: str, **columns: Column) -> DataFrame:
    made = {"enable_thinking": F.lit(True), **columns, "source_dataset": F.lit(source)}
    return conform(df.select(*(c.alias(n) for n, c in made.items())), SFT_SCHEMA)


def _pair(prompt: Column, answer: Column) -> Column:
    return F.array(F.struct(prompt.cast("string").alias("content"), F.lit("user").alias("role")), F.struct(answer.cast("string").alias("content"), F.lit("assistant").alias("role")))


def passthrough(df: DataFrame, source: str) -> DataFrame:
    """Already unified: the columns that are there, the rest null."""
    kept = {f.name: F.col(f.name) for f in SFT_SCHEMA if f.name in df.columns and f.name not in ("conversations", "tools", "source_dataset")}
    return _unified(df, source, conversations=turns(df, "conversations"), tools=as_json(df, "tools"), **kept)


def trajectories(df: DataFrame, source: str) -> DataFrame:
    return _unified(df, source, conversations=turns(df, "messages"), task=_field(df, "instance_id"), episode=_field(df, "turns"), run_id=_field(df, "trial_id"), tools=as_json(df, "tools"))


def messages(df: DataFrame, source: str) -> DataFrame:
    model = _field(df, "metadata.model")
    return _unified(df, source, conversations=turns(df, "messages"), model=model, model_provider=model_provider(model), date=_field(df, "metadata.created_at"), run_id=F.coalesce(_field(df, "metadata.run_id"), _field(df, "metadata.prompt_id")), tools=as_json(df, "tools"))


def prompt_completion(df: DataFrame, source: str) -> DataFrame:
    return _unified(df, source, conversations=_pair(F.col("prompt"), F.col("completion")))


def code_answers(df: DataFrame, source: str) -> DataFrame:
    model = _field(df, "provenance.model")
    return _unified(df, source, conversations=_pair(F.col("provenance.prompt"), F.col("content.text")), model=model, model_provider=model_provider(model, False), date=_field(df, "provenance.generated_at"), task=_field(df, "language"), run_id=_field(df, "sample_id"))


def reasoning_turns(df: DataFrame, source: str) -> DataFrame:
    model = _field(df, "provenance.model")
    return _unified(df, source, conversations=turns(df, "conversation"), model=model, model_provider=model_provider(model, False), date=_field(df, "provenance.generated_at"), task=_field(df, "language"), episode=_field(df, "transform_type"), run_id=_field(df, "sample_id"))


def agentic(df: DataFrame, source: str) -> DataFrame:
    """The source's name ends in search or tool_calling; the task is the domain or the first use."""
    if not source.endswith(("search", "tool_calling")):
        raise ValueError(f"not a subset with search or tool calls: {source}")
    first_use = F.try_element_at("used_in", F.lit(1)).cast("string") if "used_in" in df.columns and isinstance(df.schema["used_in"].dataType, ArrayType) else F.lit(None).cast("string")
    thinking = F.coalesce(F.col("parallel_tool_calls").cast("boolean"), F.lit(True)) if "parallel_tool_calls" in df.columns else F.lit(True)
    return _unified(df, source, conversations=turns(df, "messages"), model=_field(df, "model"), model_provider=model_provider(_field(df, "model")), task=F.coalesce(_field(df, "domain"), first_use), run_id=_field(df, "uuid"), enable_thinking=thinking, tools=as_json(df, "tools"))


def choose_adapter(df: DataFrame, fmt: str, source: str) -> Callable[[DataFrame, str], DataFrame]:
    """By format and columns; the order of the tests matters."""
    have = set(df.columns)
    if fmt == "csv" and {"prompt", "completion"} <= have:
        return prompt_completion
    if fmt == "parquet":
        if "conversations" in have:
            return passthrough
        if {"instance_id", "trial_id", "messages", "reward", "model_patch", "turns"} <= have:
            return trajectories
    if fmt in ("json", "jsonl"):
        if "messages" in have:
            return agentic if source.endswith(("search", "tool_calling")) else messages
        if "conversation" in have:
            return reasoning_turns
        if {"provenance", "content"} <= have:
            return code_answers
        if "conversations" in have:
            return passthrough
    raise ValueError(f"no adapter for {fmt} with columns {sorted(have)}")


def with_messages(df: DataFrame) -> DataFrame:
    """`conversations` under the name `messages`, unless there are messages already."""
    return df.withColumnRenamed("conversations", "messages") if "conversations" in df.columns and "messages" not in df.columns else df


def with_conversations(df: DataFrame) -> DataFrame:
    """The other way round: what with_messages renamed has its name again, for sources kept as unified Parquet."""
    return df.withColumnRenamed("messages", "conversations") if "messages" in df.columns and "conversations" not in df.columns else df
