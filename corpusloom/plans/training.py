"""Queries of problems 1 and 2, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift, flatten
from . import read


def _feeds(spark: SparkSession, folder: str) -> DataFrame:
    names = ("tool_structure_variations", "dict_content")
    a, b = (read(spark, folder, n).withColumn("table_name", F.lit(n)) for n in names)
    return a.unionByName(b)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return drift.schema_changes(_feeds(spark, folder)).select("table_name", "file_path", "field_path", "change")


def p1_records(spark: SparkSession, folder: str) -> DataFrame:
    return drift.unified_records(_feeds(spark, folder))


def p1_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The fields of each file, as the profiles have them that changes are told from."""
    return drift.profiles(_feeds(spark, folder)).where("field_path is not null").select("table_name", "file_path", "field_path").distinct()


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return flatten.call_links(read(spark, folder, "full_records"))


def _flat(name: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return flatten.flat_tables(read(spark, folder, "full_records"), ["record_no"])[name]

    return query


QUERIES = {"p1_found": p1_found, "p1_records": p1_records, "p1_fields": p1_fields, "p2_found": p2_found} | {
    f"p2_{short}": _flat(name) for short, name in (("records", "records"), ("messages", "messages"), ("calls", "messages_tool_calls"), ("tools", "tools"), ("used_in", "used_in"))
}

_MESSAGES = "select record_no, i - 1 as messages_pos, messages[i] as m from (select record_no, messages, unnest(range(1, len(messages) + 1)) as i from full_records)"
_CALLS = f"select record_no, messages_pos, j - 1 as messages_tool_calls_pos, m.tool_calls[j] as c from (select *, unnest(range(1, len(m.tool_calls) + 1)) as j from ({_MESSAGES}))"
_TOOLS = "select record_no, i - 1 as tools_pos, tools[i] as t from (select record_no, tools, unnest(range(1, len(tools) + 1)) as i from full_records)"


def _tidy(column: str) -> str:
    return f"nullif(lower(regexp_replace({column}, '^[\\s\\p{{Z}}\\x00-\\x1f\\x85]+|[\\s\\p{{Z}}\\x00-\\x1f\\x85]+$', '', 'g')), '')"


_LINES = " union all ".join(f"select '{n}' as table_name, file_path, body from {n} where json_valid(body) and json_type(body) = 'OBJECT'" for n in ("tool_structure_variations", "dict_content"))


def _members(name: str) -> str:
    """The objects in a field of the lines, one or several."""
    listed = f"case json_type(body, '$.{name}') when 'ARRAY' then json_extract(body, '$.{name}[*]') else [json_extract(body, '$.{name}')] end"
    return f"(select table_name, file_path, x from (select table_name, file_path, unnest({listed}) as x from l) where json_type(x) = 'OBJECT')"


ORACLES = {
    "p1_fields": f"""with l as ({_LINES}) select distinct table_name, file_path, field_path from (
select table_name, file_path, unnest(json_keys(body)) as field_path from l union all select table_name, file_path, 'messages.' || unnest(json_keys(x)) from {_members('messages')}
union all select table_name, file_path, 'tools.' || unnest(json_keys(x)) from {_members('tools')}
union all select table_name, file_path, 'tools.function.' || unnest(json_keys(json_extract(x, '$.function'))) from {_members('tools')} where json_type(x, '$.function') = 'OBJECT'
) where field_path not in ('messages', 'tools', 'tools.function')""",
    "p2_records": "select record_no, uuid, license, reasoning, received_at from full_records",
    "p2_messages": f'select record_no, messages_pos::int as messages_pos, m.role as "role", m.content as content, m.reasoning_content as reasoning_content, m.tool_call_id as tool_call_id from ({_MESSAGES})',
    "p2_calls": f'select record_no, messages_pos::int as messages_pos, messages_tool_calls_pos::int as messages_tool_calls_pos, c.id as id, c."type" as "type", c."function"."name" as function_name, c."function".arguments as function_arguments from ({_CALLS})',
    "p2_tools": f'select record_no, tools_pos::int as tools_pos, t."type" as "type", t."name" as "name", t.description as description, t.parameters as parameters, t."function"."name" as function_name, t."function".description as function_description, t."function".parameters as function_parameters from ({_TOOLS})',
    "p2_used_in": "select record_no, (i - 1)::int as used_in_pos, used_in[i] as value from (select record_no, used_in, unnest(range(1, len(used_in) + 1)) as i from full_records)",
    "p2_found": f"""
with calls as (select record_no, messages_pos as msg_pos, messages_tool_calls_pos as call_pos, c."function"."name" as tool, {_tidy('c.id')} as id from ({_CALLS})),
tools as (select record_no, coalesce(t."name", t."function"."name") as tool, min(tools_pos) as spot from ({_TOOLS}) group by all),
answers as (select record_no, messages_pos as msg_pos, {_tidy('m.tool_call_id')} as id from ({_MESSAGES}) where lower(trim(m.role)) = 'tool'),
best as (select a.record_no, a.msg_pos, max(c.msg_pos * 1000000 + c.call_pos) as spot from answers a left join calls c on c.record_no = a.record_no and c.id = a.id and c.msg_pos < a.msg_pos group by all)
select record_no, case when spot is null then 'orphan_call' else 'tool' end as link, msg_pos::int as msg_pos, call_pos::int as call_pos, coalesce(spot, -1)::int as target_pos from calls left join tools using (record_no, tool)
union all
select record_no, case when spot is null then 'orphan_reply' else 'reply' end, coalesce(spot // 1000000, msg_pos)::int, coalesce(spot % 1000000, -1)::int, case when spot is null then -1 else msg_pos end::int from best
""",
}
