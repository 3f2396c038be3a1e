"""Nested records as flat tables that keep their parent-child links.

Records that are JSON get one schema first, merged from all of them.  Every array level, and every map,
becomes a table of its own; structs are folded into the columns of the level they are in.  A child
row carries its record's key, its own or one that is given to it, and the ordinal of every array
element above it (from 0), so a link is an equi-join on those columns.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructField, StructType, _parse_datatype_string

from ..session import stored


@dataclass
class Level:
    """One table: how to reach its rows, and its columns."""

    name: str
    path: list[tuple[str, str]]  # (array expression relative to the element above, ordinal column)
    columns: list[tuple[str, str]] = field(default_factory=list)  # (expression, column)


def _unique(name: str, taken: set[str]) -> str:
    """A column name not taken yet, apart from case; clashing names get _2, _3 and so on."""
    out, n = name, 1
    while out.lower() in taken:
        n += 1
        out = f"{name}_{n}"
    taken.add(out.lower())
    return out


def _quote(*parts: str) -> str:
    return ".".join(f"`{p.replace('`', '``')}`" for p in parts if p)


def _entries(kind: MapType) -> ArrayType:
    return ArrayType(StructType([StructField("key", kind.keyType), StructField("value", kind.valueType)]))


def _table_schema(merged: str) -> str:
    """A schema as the aggregate over VARIANT values writes it, as one for from_json."""
    out = re.sub(r"\bOBJECT<", "STRUCT<", merged)
    out = re.sub(r"\bDECIMAL\(\d+,\s*\d+\)(?=[,>]|$)", "DOUBLE", out)
    return re.sub(r"(?<=[ <])(VOID|VARIANT)(?=[,>]|$)", "STRING", out).replace("STRUCT<>", "STRING")


def merged_schema(lines: DataFrame, column: str) -> StructType:
    """The schema that all JSON objects of a column have together, in one aggregation: fields of any record, whole and fractional numbers
    as fractional, what differs in kind as text.  Lines that aren't JSON objects don't count."""
    v = F.try_parse_json(column)
    found = lines.select(v.alias("v")).where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT"))).agg(F.schema_of_variant_agg("v").alias("s")).first()["s"]
    if found is None or not found.startswith("OBJECT<") or found == "OBJECT<>":
        return StructType([])
    return _parse_datatype_string(_table_schema(found))


def records_of(lines: DataFrame, column: str, keep: Sequence[str] = (), schema: StructType | None = None) -> DataFrame:
    """The records in a column of JSON as typed, nested columns under their merged schema, after the columns in keep (which a field of the same name gives way to, with _2 at its end).

    Lines that aren't JSON objects are left out.  An empty column gives the columns in keep alone."""
    schema = schema or merged_schema(lines, column)
    valid = lines.where(F.startswith(F.schema_of_variant(F.try_parse_json(column)), F.lit("OBJECT")))
    if not schema.fields:
        return valid.select(*keep)
    taken = {k.lower() for k in keep}
    parsed = valid.select(*keep, F.from_json(column, schema).alias("__r"))
    return parsed.select(*keep, *(F.col(f"__r.{_quote(f.name)}").alias(_unique(f.name, taken)) for f in schema.fields))


def with_row_key(df: DataFrame, name: str = "row_key") -> DataFrame:
    """A surrogate key for records whose own keys repeat or are absent: the rows are stored with it, so it is the same in every table made from them."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()), "keyed")


def levels_of(schema: StructType, keys: list[str], root: str) -> list[Level]:
    """The tables of a schema, parents before children."""
    out: list[Level] = []

    def visit(level: Level, struct: StructType, prefix: tuple[str, ...], label: str, taken: set[str], names: set[str]) -> None:
        for f in struct.fields:
            where = (*prefix, f.name)
            short = f"{label}_{f.name}" if label else f.name
            if isinstance(f.dataType, StructType):
                visit(level, f.dataType, where, short, taken, names)
            elif isinstance(f.dataType, ArrayType):
                add(level, f.dataType, _quote(*where), short, names)
            elif isinstance(f.dataType, MapType):
                add(level, _entries(f.dataType), f"map_entries({_quote(*where)})", short, names)
            elif not (level.path == [] and f.name in keys):
                level.columns.append((_quote(*where), _unique(short, taken)))

    def add(parent: Level, kind: ArrayType, where: str, short: str, names: set[str]) -> None:
        name = _unique(short if not parent.path else f"{parent.name}_{short}", names)
        ordinal = _unique(f"{name}_pos", {k.lower() for k in keys} | {o for _, o in parent.path})
        level = Level(name, [*parent.path, (where, ordinal)])
        out.append(level)
        taken = {k.lower() for k in keys} | {o.lower() for _, o in level.path}
        if isinstance(kind.elementType, StructType):
            visit(level, kind.elementType, ("_it",), "", taken, names)
        elif isinstance(kind.elementType, ArrayType):
            add(level, kind.elementType, "`_it`", "items", names)
        elif isinstance(kind.elementType, MapType):
            add(level, _entries(kind.elementType), "map_entries(`_it`)", "entries", names)
        else:
            level.columns.append(("_it", _unique("value", taken)))

    top = Level(root, [])
    out.append(top)
    visit(top, schema, (), "", {k.lower() for k in keys}, {root.lower()})
    return out


def flat_tables(df: DataFrame, keys: list[str], root: str = "records") -> dict[str, DataFrame]:
    """table name -> DataFrame, for the records and for each array in them.

    The table of records has the keys and every column outside arrays; a child table has the keys,
    one ordinal column for each array above it, and its elements' columns.  Null and empty arrays
    give no rows; null elements give a row of nulls, so that ordinals stay true.  Names that clash,
    also in case, get a number.  keys must identify a row; rows that share them are each flattened
    for itself but can't be told apart: with_row_key gives them a key.  A map is an array of keys and values.  Nothing is shuffled: each table is one pass over the columns
    it needs.
    """
    out = {}
    for level in levels_of(df.schema, keys, root):
        if not level.path:
            out[level.name] = df.select(*keys, *(F.expr(e).alias(c) for e, c in level.columns))
            continue
        rows, above = df, [*keys]
        for array, ordinal in level.path:
            rows = rows.select(*(F.col(_quote(c)) for c in above), F.posexplode(F.expr(array)).alias(ordinal, "_it"))
            above.append(ordinal)
        out[level.name] = rows.select(*(F.col(_quote(c)) for c in above), *(F.expr(e).alias(c) for e, c in level.columns))
    return out


def tidy_id(c: Column) -> Column:
    """An id apart from case and outer white space; null if nothing is left."""
    tidy = F.lower(F.regexp_replace(c, r"(?U)^[\s\x00-\x1f]+|[\s\x00-\x1f]+$", ""))
    return F.when(tidy != "", tidy)


def call_links(df: DataFrame, key: str = "record_no") -> DataFrame:
    """Links between calls, tools and replies: key, link, msg_pos, call_pos, target_pos.

    df has `messages` and `tools` as in the `full` record; other columns are ignored.

    tool / orphan_call: a call and the first tool of exactly its name, or -1; a tool's name is the
    one at its top, else the one in `function`; a call without a name has no tool.
    reply / orphan_reply: a message of role tool and the latest call before it with the same id,
    apart from case and outer white space; a reply without an id, or with a blank one, is an orphan.
    When an id is called twice in a message, the later call counts.  Records without messages have
    no links; an empty table gives none.  Repeated records are linked each for itself.
    """
    tables = flat_tables(df.select(key, "messages", "tools"), [key])
    messages, calls, tools = tables["messages"], tables["messages_tool_calls"], tables["tools"]
    named = tools.select(key, F.coalesce("name", "function_name").alias("tool"), "tools_pos").where("tool is not null")
    first = named.groupBy(key, "tool").agg(F.min("tools_pos").alias("at"))
    asked = calls.select(key, F.col("messages_pos").alias("msg_pos"), F.col("messages_tool_calls_pos").alias("call_pos"), F.col("function_name").alias("tool"), tidy_id(F.col("id")).alias("id"))
    to_tools = asked.join(first, [key, "tool"], "left").select(
        key, F.when(F.col("at").isNull(), "orphan_call").otherwise("tool").alias("link"), "msg_pos", "call_pos", F.coalesce("at", F.lit(-1)).alias("target_pos")
    )
    answers = messages.where(F.lower(F.trim("role")) == "tool").select(key, F.col("messages_pos").alias("msg_pos"), tidy_id(F.col("tool_call_id")).alias("id"))
    nothing = F.lit(None).cast("struct<msg_pos:int,call_pos:int>")
    steps = asked.where("id is not null").select(key, "id", "msg_pos", "call_pos", F.struct("msg_pos", "call_pos").alias("call")).unionByName(
        answers.where("id is not null").select(key, "id", "msg_pos", F.lit(-1).alias("call_pos"), nothing.alias("call"))
    )
    # within a message, call_pos -1 puts the reply before the calls, so only earlier messages count
    so_far = Window.partitionBy(key, "id").orderBy("msg_pos", "call_pos").rowsBetween(Window.unboundedPreceding, 0)
    linked = steps.withColumn("last", F.last("call", ignorenulls=True).over(so_far)).where("call is null")
    replies = linked.select(
        key,
        F.when(F.col("last").isNull(), "orphan_reply").otherwise("reply").alias("link"),
        F.coalesce("last.msg_pos", "msg_pos").alias("msg_pos"),
        F.coalesce("last.call_pos", F.lit(-1)).alias("call_pos"),
        F.when(F.col("last").isNull(), -1).otherwise(F.col("msg_pos")).alias("target_pos"),
    )
    lost = answers.where("id is null").select(key, F.lit("orphan_reply").alias("link"), "msg_pos", F.lit(-1).alias("call_pos"), F.lit(-1).alias("target_pos"))
    return to_tools.unionByName(replies).unionByName(lost)
