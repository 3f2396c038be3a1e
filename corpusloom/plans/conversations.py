"""Queries of the operators for conversations: looking at them, parsing, mixing, comparing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.running import ordinal_by_key
from ..operators import adapters, diff, explore, mix, parse
from . import read

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def records(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "full_records")


TURNS = "[case when m.role is not null and m.content is not null then m.role || ': ' || m.content else m.content end for m in messages if m.content is not null]"
TOLD = f"array_to_string({TURNS}, chr(10))"


@query(f"select record_no, sha256(coalesce({TOLD}, '')) as h from full_records")
def conversation_hashes(spark, folder):
    return records(spark, folder).select("record_no", T.text_hash(T.conversation_text(F.col("messages"))).alias("h"))


_SUMMARY = """select row_number() over (order by record_no) - 1 as index, case when length(uuid) > 12 then substr(uuid, 1, 12) || '...' else uuid end as uuid, coalesce(len(messages), 0) as n_messages, coalesce(len(tools), 0) as n_tools,
coalesce((case when length(said[1]) <= 0 then '' when length(trim(said[1])) <= 40 then trim(said[1]) else substr(trim(said[1]), 1, 37) || '...' end), '') as preview, license, array_to_string(used_in, ', ') as used_in, reasoning
from (select *, [m.content for m in messages if m.role = 'user' and m.content <> ''] as said from full_records)"""


@query(_SUMMARY)
def record_summary(spark, folder):
    return explore.summary(ordinal_by_key(records(spark, folder), "record_no"), "ordinal")


@query("select record_no from full_records where coalesce(len(tools), 0) > 0")
def list_with_tools(spark, folder):
    return explore.list_records(records(spark, folder), has_tools=True).select("record_no")


@query("select record_no from full_records where len([1 for m in messages if coalesce(m.reasoning_content, '') <> '']) > 0")
def list_with_reasoning(spark, folder):
    return explore.list_records(records(spark, folder), reasoning=True).select("record_no")


@query("select record_no, len(messages) as n from full_records where coalesce(len(messages), 0) >= 10")
def list_min_messages(spark, folder):
    return explore.list_records(records(spark, folder), min_messages=10).select("record_no", F.size("messages").alias("n"))


@query("select coalesce(m.role, 'unknown') as role, count(*) as n from (select unnest(messages) as m from full_records) group by 1")
def role_counts(spark, folder):
    return explore.role_counts(records(spark, folder))


@query("""select coalesce(t."name", t."function"."name") as tool, count(*) as n from (select unnest(tools) as t from full_records) where coalesce(t."name", t."function"."name") is not null group by 1 order by n desc, tool limit 10""")
def tool_counts(spark, folder):
    return explore.tool_counts(records(spark, folder))


@query("""select count(*) as records, sum(coalesce(len(messages), 0))::bigint as messages, sum(coalesce(len(tools), 0))::bigint as tools, round(avg(coalesce(len(messages), 0)), 6) as messages_a_record,
count(*) filter (coalesce(len(tools), 0) > 0) as with_tools, count(*) filter (len([1 for m in messages if coalesce(m.reasoning_content, '') <> '']) > 0) as with_reasoning, round(100.0 * count(*) filter (coalesce(len(tools), 0) > 0) / count(*), 4) as tools_percent,
round(100.0 * count(*) filter (len([1 for m in messages if coalesce(m.reasoning_content, '') <> '']) > 0) / count(*), 4) as reasoning_percent from full_records""")
def dataset_statistics(spark, folder):
    return explore.statistics(records(spark, folder))


@query("""select doc_id, 'text' as found_in, (case when p - 30 > 1 then '...' else '' end) || substr(text, greatest(1, p - 30), p + 35 - greatest(1, p - 30) + 1) || (case when p + 35 < length(text) then '...' else '' end) as around
from (select doc_id, text, instr(lower(text), 'valley') as p from documents) where p > 0""".replace("'valley'", "'tribun'"))
def search_documents(spark, folder):
    return explore.search(read(spark, folder, "documents").select("doc_id", "text"), "Tribun", ["text"]).drop("text")


@query("""select record_no, json_extract_string(try_cast(body as json), '$.tools[0].function.name') as tool from tool_structure_variations where json_valid(body) and json_type(body) = 'OBJECT'""")
def json_path(spark, folder):
    lines = read(spark, folder, "tool_structure_variations").select("record_no", F.try_parse_json("body").alias("v")).where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))
    return lines.select("record_no", explore.path(F.col("v"), "tools[0].function.name").alias("tool"))


@query("""with r as (select record_no, row_number() over (order by record_no) - 1 as ordinal, least(2, greatest(1, ceil(count(*) over () / 50.0))) - 1 as page from full_records)
select record_no, ordinal from r where ordinal >= page * 50 and ordinal < (page + 1) * 50""")
def page_two(spark, folder):
    return explore.page(ordinal_by_key(records(spark, folder).select("record_no"), "record_no"), "ordinal", 2)


@query("select record_no from full_records order by record_no limit 1 offset 42")
def record_at(spark, folder):
    return parse.select_records(ordinal_by_key(records(spark, folder), "record_no"), "ordinal", index=42).select("record_no")


@query("""select record_no, (i - 1)::int as pos, m.role as "role", case when m.role = 'assistant' then '' else m.content end as content, case when m.role = 'assistant' and m.reasoning_content is not null then '' else m.reasoning_content end as reasoning_content,
case when m.role = 'assistant' then null else m.tool_call_id end as tool_call_id, coalesce(len(m.tool_calls), -1) as n_calls from (select record_no, messages[i] as m, i from (select record_no, messages, unnest(range(1, len(messages) + 1)) as i from full_records))""")
def parse_blanked(spark, folder):
    df = records(spark, folder)
    blanked = df.select("record_no", F.posexplode(parse.blank_answers(F.col("messages"), df.schema["messages"].dataType.elementType)).alias("pos", "m"))
    return blanked.select("record_no", "pos", "m.role", "m.content", "m.reasoning_content", "m.tool_call_id", F.when(F.col("m.tool_calls").isNull(), -1).otherwise(F.size("m.tool_calls")).alias("n_calls"))


_MIXED = [("empty_content", "messages"), ("no_role", "messages"), ("full_records", "agentic")]


def _mixed(spark: SparkSession, folder: str) -> DataFrame:
    return mix.union_sources([getattr(adapters, how)(read(spark, folder, n), n if how == "messages" else f"{n}_tool_calling") for n, how in _MIXED])


def _mixed_sql(columns: str) -> str:
    parts = [f"select messages, '{n}{'' if how == 'messages' else '_tool_calling'}' as source_dataset, {'null' if how == 'messages' else 'used_in[1]'} as task, {'null' if how == 'messages' else 'uuid'} as run_id from {n}" for n, how in _MIXED]
    plain = [p.replace("select messages,", "select [{'role': m.role, 'content': m.content} for m in messages] as messages,") for p in parts]
    return f"select {columns} from ({' union all '.join(plain)})"


@query(_mixed_sql(f"sha256(coalesce({TOLD}, '')) as h, source_dataset, task, run_id, true as enable_thinking"))
def mix_union(spark, folder):
    return _mixed(spark, folder).select(T.text_hash(T.conversation_text(F.col("conversations"))).alias("h"), "source_dataset", "task", "run_id", "enable_thinking")


@query(f"""with m as ({_mixed_sql('source_dataset, task')}) select 'source' as kind, source_dataset as name, count(*) as n from m group by 2 union all select 'task', task, count(*) from m where task is not null group by 2 union all select 'total', null, count(*) from m""")
def mix_dry_run(spark, folder):
    return mix.dry_run(_mixed(spark, folder))


_AT = "'[' || i || ']"
_EACH = "select record_no, i - 1 as i, messages[i] as m from (select record_no, messages, unnest(range(1, len(messages) + 1)) as i from full_records)"
_CALL = "select record_no, i, j - 1 as j, m.tool_calls[j] as c from (select *, unnest(range(1, len(m.tool_calls) + 1)) as j from m)"


@query(f"""with m as ({_EACH}), c as ({_CALL}) select record_no, '' as path, 'unchanged' as state from full_records where messages is null
union all select record_no, {_AT}', 'unchanged' from m where m is null union all select record_no, {_AT}.role', 'unchanged' from m where m.role is not null
union all select record_no, {_AT}.content', case when coalesce(m.role, '') <> 'assistant' or m.content = '' then 'unchanged' when m.content is null then 'added' else 'changed' end from m where m.content is not null or m.role = 'assistant'
union all select record_no, {_AT}.reasoning_content', case when m.role = 'assistant' and m.reasoning_content <> '' then 'changed' else 'unchanged' end from m where m.reasoning_content is not null
union all select record_no, {_AT}.tool_call_id', case when m.role = 'assistant' then 'removed' else 'unchanged' end from m where m.tool_call_id is not null
union all select record_no, {_AT}.tool_calls[' || j || ']', 'unchanged' from c where c is null
union all select record_no, {_AT}.tool_calls[' || j || '].' || f.name, 'unchanged' from (select record_no, i, j, unnest([{{'name': 'id', 'v': c.id}}, {{'name': 'type', 'v': c."type"}}, {{'name': 'function.name', 'v': c."function"."name"}}, {{'name': 'function.arguments', 'v': c."function".arguments}}]) as f from c) where f.v is not null""")
def record_diff(spark, folder):
    """What blanking the answers changes in each record, by path."""
    df = records(spark, folder)
    blanked = parse.blank_answers(F.col("messages"), df.schema["messages"].dataType.elementType)
    return diff.record_diff(df.select("record_no", F.to_json("messages").alias("a"), F.to_json(blanked).alias("b")), "record_no", "a", "b")
