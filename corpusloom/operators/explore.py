"""Looking at conversations: summaries, filters, search, paths, statistics."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from ..functions.text import first_user_message, truncated


def with_defaults(df: DataFrame) -> DataFrame:
    """uuid, messages, tools, license, used_in, filled with empty values; conversations count as messages where those are absent, trial_name as uuid."""
    have = set(df.columns)
    messages = F.col("messages") if "messages" in have else F.col("conversations") if "conversations" in have else F.array()
    uuid = F.coalesce(*(F.col(c).cast("string") for c in ("uuid", "trial_name") if c in have), F.lit(None).cast("string"))
    kinds = {f.name: f.dataType for f in df.schema}
    made = {"uuid": uuid, "messages": messages}
    for name in ("tools", "used_in"):
        made[name] = F.coalesce(F.col(name), F.array().cast(kinds[name])) if isinstance(kinds.get(name), ArrayType) else F.col(name) if name in have else F.array()
    made["license"] = F.col("license") if "license" in have else F.lit(None).cast("string")
    return df.select(*(c.alias(n) for n, c in made.items()), *(c for c in df.columns if c not in made and c not in ("conversations", "trial_name")))


def count_of(array: Column) -> Column:
    return F.when(array.isNull(), 0).otherwise(F.size(array))


def summary(df: DataFrame, ordinal: str) -> DataFrame:
    """One line for each record: position, start of the uuid, counts, first question, licence and where it is used."""
    return df.select(
        F.col(ordinal).alias("index"), F.when(F.length("uuid") > 12, F.concat(F.substring("uuid", 1, 12), F.lit("..."))).otherwise(F.col("uuid")).alias("uuid"),
        count_of(F.col("messages")).alias("n_messages"), count_of(F.col("tools")).alias("n_tools"), first_user_message(F.col("messages")).alias("preview"),
        F.col("license"), F.array_join("used_in", ", ").alias("used_in"), *([F.col("reasoning")] if "reasoning" in df.columns else []),
    )


def reasons(df: DataFrame) -> Column:
    """Whether a record has reasoning; false where the messages have no such field."""
    kind = df.schema["messages"].dataType
    known = isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType) and "reasoning_content" in kind.elementType.names
    return has_reasoning(F.col("messages")) if known else F.lit(False)


def has_reasoning(messages: Column) -> Column:
    return F.coalesce(F.exists(messages, lambda m: F.coalesce(m["reasoning_content"], F.lit("")) != ""), F.lit(False))


def list_records(df: DataFrame, has_tools: bool = False, reasoning: bool = False, min_messages: int | None = None, limit: int | None = None) -> DataFrame:
    """Records with tools, with reasoning and with so many messages; the limit comes after the filters."""
    out = df.where(count_of(F.col("tools")) > 0) if has_tools else df
    out = out.where(reasons(df)) if reasoning else out
    out = out.where(count_of(F.col("messages")) >= min_messages) if min_messages is not None else out
    return out.limit(limit) if limit is not None else out


def search(df: DataFrame, query: str, columns: list[str] | None = None, context: int = 30, case_sensitive: bool = False) -> DataFrame:
    """Rows in which a column contains the query, with `found_in` and `around`: the first hit and `context` characters on both sides.

    All columns unless some are named; arrays, structs and maps are searched whole, as JSON."""
    fold = (lambda c: c) if case_sensitive else F.lower
    wanted = query if case_sensitive else query.lower()
    nested = {f.name for f in df.schema if isinstance(f.dataType, (ArrayType, StructType, MapType))}
    said = lambda n: F.to_json(n) if n in nested else F.col(n).cast("string")
    hits = F.array(*(F.struct(F.lit(n).alias("column"), said(n).alias("text"), F.instr(fold(said(n)), wanted).alias("at")) for n in columns or df.columns))
    first = df.withColumn("__hit", F.get(F.filter(hits, lambda h: h["at"] > 0), F.lit(0))).where("__hit is not null")
    at, text = F.col("__hit.at"), F.col("__hit.text")
    start, end = F.greatest(F.lit(1), at - context), at + len(query) - 1 + context
    around = F.concat(F.when(start > 1, "...").otherwise(""), F.substring(text, start, end - start + 1), F.when(end < F.length(text), "...").otherwise(""))
    return first.select("*", F.col("__hit.column").alias("found_in"), around.alias("around")).drop("__hit")


def path(v: Column, dotted: str, kind: str = "string") -> Column:
    """The value at a path like messages[0].content of a VARIANT; null where there is none."""
    return F.try_variant_get(v, "$." + dotted, kind)


def role_counts(df: DataFrame) -> DataFrame:
    """(role, n), the most common first; messages without a role count as unknown."""
    roles = df.select(F.explode("messages").alias("m")).select(F.coalesce("m.role", F.lit("unknown")).alias("role"))
    return roles.groupBy("role").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "role")


def record_roles(messages: Column) -> Column:
    """How often each role speaks in one record, as a map in the order of the roles; messages without a role count as unknown."""
    roles = F.transform(messages, lambda m: F.coalesce(m["role"], F.lit("unknown")))
    return F.map_from_entries(F.transform(F.array_sort(F.array_distinct(roles)), lambda r: F.struct(r, F.size(F.filter(roles, lambda x: x == r)))))


def tool_name(t: Column) -> Column:
    return F.coalesce(t["name"], t["function"]["name"])


def tool_counts(df: DataFrame, top: int | None = 10) -> DataFrame:
    """(tool, n), the most common first, names breaking ties."""
    named = df.select(F.explode("tools").alias("t")).select(tool_name(F.col("t")).alias("tool")).where("tool is not null")
    counted = named.groupBy("tool").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tool")
    return counted.limit(top) if top else counted


def distinct_tools(df: DataFrame) -> DataFrame:
    """(distinct_tools): the number of different tool names, from partial sets."""
    named = df.select(F.explode("tools").alias("t")).select(tool_name(F.col("t")).alias("tool"))
    return named.agg(F.count_distinct("tool").alias("distinct_tools"))


def statistics(df: DataFrame) -> DataFrame:
    """records, messages, tools, messages a record, and records with tools and with reasoning, as numbers and in percent, in one pass."""
    m, t = count_of(F.col("messages")), count_of(F.col("tools"))
    sums = df.agg(
        F.count("*").alias("records"), F.sum(m).alias("messages"), F.sum(t).alias("tools"), F.round(F.avg(m), 6).alias("messages_a_record"),
        F.count_if(t > 0).alias("with_tools"), F.count_if(reasons(df)).alias("with_reasoning"),
    )
    percent = lambda c: F.when(F.col("records") > 0, F.round(100 * F.col(c) / F.col("records"), 4)).otherwise(0.0)
    return sums.select("*", percent("with_tools").alias("tools_percent"), percent("with_reasoning").alias("reasoning_percent"))


def page(df: DataFrame, ordinal: str, number: int, size: int = 50) -> DataFrame:
    """A page of rows, numbered from 1; numbers past the ends mean the first and the last page."""
    last = df.agg(F.greatest(F.ceil((F.max(ordinal) + 1) / size), F.lit(1)).alias("n")).first()["n"] or 1
    at = min(max(number, 1), int(last)) - 1
    return df.where((F.col(ordinal) >= at * size) & (F.col(ordinal) < (at + 1) * size))


_UUID = re.compile(r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$", re.I)


def detect_fields(df: DataFrame) -> dict[str, str | None]:
    """Which columns hold messages, tools and the id: by shape, then by name, then by the look of the first value."""
    arrays = {f.name: set(f.dataType.elementType.names) for f in df.schema if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StructType)}
    messages = next((n for n, inner in arrays.items() if {"role"} & inner or {"content"} & inner), None)
    tools = next((n for n, inner in arrays.items() if n != messages and {"function", "name"} & inner), None)
    names = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    ids = next((n for n in ("uuid", "id", "trial_name", "conversation_id", "record_id") if n in df.columns), None)
    if ids is None and names and (row := df.select(*names).first()):
        ids = next((n for n in names if row[n] and _UUID.match(row[n])), None)
    return {"messages": messages, "tools": tools, "id": ids}


def preview(c: Column, n: int = 100) -> Column:
    return truncated(c, n)
