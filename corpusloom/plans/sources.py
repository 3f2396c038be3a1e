"""Queries of readers, writers, adapters and comparisons: tables go out in another form, come back through the operator, and must be the same."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.running import ordinal_by_key
from ..operators import adapters, dedup, diff, explore, filters, flatten, manifest, mix, pack, parse, sampling, topics
from ..schema import PRETRAINING_SCHEMA, conform, conformance
from ..session import shared_dir, stored
from ..sources import discovery, readers, sinks
from . import read
from .corpus import _CELLS, BIN, BINS, NORMAL, _kept, documents
from .conversations import records

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/corpusloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def _feed(spark: SparkSession, folder: str) -> str:
    """The raw lines of a feed as a text file."""
    path = _path(spark, "lines") + ".jsonl"
    read(spark, folder, "tool_structure_variations").select(F.col("body").alias("value")).where("value is not null").write.text(path)
    return path


# ---- readers ----------------------------------------------------------------------------------
@query("select doc_id, text, lang, n_chars from documents")
def jsonl_round_trip(spark, folder):
    """Documents written as JSON lines and read again, schema inferred."""
    path = _path(spark, "documents") + ".jsonl"
    sinks.write_jsonl(documents(spark, folder).select("doc_id", "text", "lang", "n_chars"), path)
    return readers.load(spark, path).select("doc_id", "text", "lang", "n_chars")


@query("select count(*) filter (json_valid(body)) as records, count(*) filter (not json_valid(body) and trim(body) <> '') as malformed from tool_structure_variations where body is not null")
def feed_line_counts(spark, folder):
    path = _feed(spark, folder)
    return spark.createDataFrame([(readers.count_records(spark, path), readers.malformed_lines(spark, path))], "records long, malformed long")


@query("select json_type(body) as kind, count(*) as n from tool_structure_variations where json_valid(body) and json_type(body) = 'OBJECT' group by 1")
def variant_objects(spark, folder):
    kind = F.when(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")), "OBJECT")
    return readers.read_variant(spark, _feed(spark, folder)).select(kind.alias("kind")).where("kind is not null").groupBy("kind").agg(F.count("*").alias("n"))


@query("select o_orderkey::varchar as o_orderkey, o_orderstatus, o_orderpriority from orders")
def csv_round_trip(spark, folder):
    path = _path(spark, "orders") + ".csv"
    read(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").write.option("header", True).csv(path)
    return readers.load(spark, path)


@query("select row_number() over (order by s_name, s_suppkey) as line_number, s_name as text from supplier")
def text_lines(spark, folder):
    path = _path(spark, "names") + ".txt"
    read(spark, folder, "supplier").orderBy("s_name", "s_suppkey").select("s_name").coalesce(1).write.text(path)
    return readers.load(spark, path).select(F.col("line_number").cast("long").alias("line_number"), "text")


@query("select r_regionkey, r_name from region")
def json_array(spark, folder):
    """One JSON array in a file."""
    path = _path(spark, "region") + ".json"
    rows = read(spark, folder, "region").agg(F.to_json(F.collect_list(F.struct("r_regionkey", "r_name"))).alias("value"))  # five rows
    rows.coalesce(1).write.text(path)
    return readers.load(spark, path).select(F.col("r_regionkey").cast("int").alias("r_regionkey"), "r_name")


@query("select count(*) as records from documents")
def parquet_count(spark, folder):
    return spark.createDataFrame([(readers.count_records(spark, f"{folder}/documents.parquet"),)], "records long")


@query("select doc_id, row_number() over (order by doc_id) - 1 as ordinal from documents qualify ordinal >= 100 and ordinal < 150")
def records_range(spark, folder):
    return readers.records_range(ordinal_by_key(documents(spark, folder).select("doc_id"), "doc_id"), 100, 50)


@query("select doc_id from documents order by doc_id limit 1 offset 7")
def document_at(spark, folder):
    return readers.record_at(ordinal_by_key(documents(spark, folder).select("doc_id"), "doc_id"), 7).select("doc_id")


@query("select count(*) as records, count(*) as distinct_keys, 0::bigint as first_row from documents")
def row_provenance(spark, folder):
    """(file, row) names every row once."""
    keyed = readers.with_provenance(documents(spark, folder).select("doc_id", "_metadata"))
    return keyed.agg(F.count("*").alias("records"), F.count_distinct("file_path", "file_row").alias("distinct_keys"), F.min("file_row").alias("first_row"))


@query("select count(*) as files, sum(n)::bigint as records from (select count(*) as n from documents)")
def files_reconciled(spark, folder):
    """Rows by file of what was just written, against what was declared; nothing differs."""
    path = _path(spark, "declared")
    docs = documents(spark, folder).select("doc_id")
    docs.coalesce(1).write.parquet(path)
    rows = discovery.rows_by_file(spark, path)
    declared = {r["file_path"]: r["rows"] for r in rows.collect()}  # one file
    off = discovery.reconcile(rows, declared)
    return rows.agg(F.count("*").alias("files"), F.sum("rows").alias("records")).join(off.agg(F.count("*").alias("off")), F.lit(True)).where("off = 0").drop("off")


@query("select true as usable")
def usable_record(spark, folder):
    return spark.createDataFrame([(readers.usable_first_record(documents(spark, folder)),)], "usable boolean")


# ---- writers ----------------------------------------------------------------------------------
@query("select coalesce(lang, 'unknown') as lang, count(*) as n, sum(doc_id)::bigint as ids from documents group by 1")
def partitioned_round_trip(spark, folder):
    path = _path(spark, "by-lang")
    sinks.write_partitioned(documents(spark, folder).select("doc_id", "lang"), path, "lang")
    return readers.load(spark, path, "parquet").groupBy(F.col("lang").cast("string").alias("lang")).agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query("select part, count(*) as n, min(doc_id) as first, max(doc_id) as last from (select doc_id, ntile(4) over (order by doc_id)::int as part from documents) group by 1")
def split_files(spark, folder):
    """A split written as one folder a part."""
    path = _path(spark, "split")
    sampling.with_part(ordinal_by_key(documents(spark, folder).select("doc_id"), "doc_id"), 4, "ordinal").drop("ordinal").write.partitionBy("part").parquet(path)
    return spark.read.parquet(path).groupBy("part").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


@query("select id, token_count, quality_score, dedup_keep from pretraining_normalized")
def conformed_round_trip(spark, folder):
    """Written under exactly the canonical columns, whatever columns come."""
    path = _path(spark, "conformed")
    sinks.write_conformed(read(spark, folder, "pretraining_normalized").withColumn("extra", F.lit(1)), path, PRETRAINING_SCHEMA)
    back = spark.read.parquet(path)
    if not conformance(back, PRETRAINING_SCHEMA).ok:
        raise ValueError(conformance(back, PRETRAINING_SCHEMA))
    return back.select("id", "token_count", "quality_score", "dedup_keep")


@query("""select doc_id, json_object('lang', lang, 'source', source)::varchar as text, null::varchar as id from documents where lang is not null and source is not null""")
def nested_to_json(spark, folder):
    """A struct where the schema wants a string is JSON."""
    docs = documents(spark, folder).where("lang is not null and source is not null")
    made = conform(docs.select(F.struct("lang", "source").alias("text"), F.col("doc_id").alias("token_count")), PRETRAINING_SCHEMA)
    return made.select(F.col("token_count").alias("doc_id"), "text", "id")


_TURN = "'### ' || upper(coalesce(m.role, 'unknown')) || chr(10) || chr(10) || case when coalesce(m.content, '') = '' then '(empty)' else m.content end"


@query(f"select record_no, '# ' || coalesce(uuid, 'N/A') || chr(10) || chr(10) || coalesce(array_to_string([{_TURN} for m in messages], chr(10) || chr(10)), '') as markdown from full_records")
def as_markdown(spark, folder):
    return records(spark, folder).select("record_no", sinks.as_markdown(F.col("messages"), F.col("uuid")).alias("markdown"))


@query("""select record_no, array_to_string([upper(coalesce(m.role, 'unknown')) || ': ' || case when coalesce(m.content, '') = '' then '(empty)' when length(m.content) > 100 then substr(m.content, 1, 100) || '...' else m.content end for m in messages], chr(10)) as said from full_records""")
def as_text(spark, folder):
    return records(spark, folder).select("record_no", sinks.as_text(F.col("messages")).alias("said"))


@query("select doc_id, json_object('doc_id', doc_id, 'lang', lang, 'n_chars', n_chars)::varchar as sidecar from documents where lang is not null and n_chars is not null")
def sidecars(spark, folder):
    docs = documents(spark, folder).where("lang is not null and n_chars is not null").select("doc_id", "lang", "n_chars", "text")
    return docs.select("doc_id", sinks.sidecar_json(docs).alias("sidecar"))


@query(_CELLS)
def manifest_json(spark, folder):
    """A manifest through JSON and back."""
    return manifest.from_json(spark, manifest.to_json(manifest.cells(_kept(spark, folder), edges=BINS)))


# ---- adapters ---------------------------------------------------------------------------------
def _said(df: DataFrame, *columns: str) -> DataFrame:
    turn = lambda t: F.concat(F.coalesce(t["role"], F.lit("?")), F.lit("="), F.coalesce(t["content"], F.lit("?")))
    return df.select(F.array_join(F.transform("conversations", turn), "|").alias("turns"), *columns, "source_dataset")


@query("select 'user=' || coalesce(lang, '?') || '|assistant=' || coalesce(source, '?') as turns, null::varchar as model, true as enable_thinking, 'pairs' as source_dataset from documents")
def adapt_prompt_completion(spark, folder):
    df = documents(spark, folder).select(F.col("lang").alias("prompt"), F.col("source").alias("completion"))
    return _said(adapters.choose_adapter(df, "csv", "pairs")(df, "pairs"), "model", "enable_thinking")


@query("select 'user=' || coalesce(lang, '?') || '|assistant=' || coalesce(source, '?') as turns, 'lab/m1' as model, 'lab' as model_provider, site as task, doc_id::varchar as run_id, 'code' as source_dataset from documents")
def adapt_code_answers(spark, folder):
    df = documents(spark, folder).select(F.struct(F.lit("lab/m1").alias("model"), F.col("lang").alias("prompt")).alias("provenance"), F.struct(F.col("source").alias("text")).alias("content"), F.col("site").alias("language"), F.col("doc_id").alias("sample_id"))
    return _said(adapters.choose_adapter(df, "jsonl", "code")(df, "code"), "model", "model_provider", "task", "run_id")


_TOLD = "array_to_string([coalesce(m.role, '?') || '=' || coalesce(m.content, '?') for m in messages], '|')"


@query(f"select {_TOLD} as turns, license as task, 'rewrite' as episode, uuid as run_id, 'thoughts' as source_dataset from empty_content")
def adapt_reasoning_turns(spark, folder):
    df = read(spark, folder, "empty_content").select(F.col("messages").alias("conversation"), F.col("license").alias("language"), F.lit("rewrite").alias("transform_type"), F.col("uuid").alias("sample_id"), F.struct(F.lit("m").alias("model")).alias("provenance"))
    return _said(adapters.choose_adapter(df, "jsonl", "thoughts")(df, "thoughts"), "task", "episode", "run_id")


@query(f"select {_TOLD} as turns, uuid as task, record_no::varchar as episode, license as run_id, 'runs' as source_dataset from no_role")
def adapt_trajectories(spark, folder):
    df = read(spark, folder, "no_role").select("messages", F.col("uuid").alias("instance_id"), F.col("license").alias("trial_id"), F.lit(1.0).alias("reward"), F.lit("").alias("model_patch"), F.col("record_no").alias("turns"))
    return _said(adapters.choose_adapter(df, "parquet", "runs")(df, "runs"), "task", "episode", "run_id")


@query(f"select {_TOLD} as turns, license as agent, uuid as run_id, 'same' as source_dataset from empty_messages")
def adapt_unified(spark, folder):
    df = read(spark, folder, "empty_messages").select(F.col("messages").alias("conversations"), F.col("license").alias("agent"), F.col("uuid").alias("run_id"))
    return _said(adapters.choose_adapter(df, "parquet", "same")(df, "same"), "agent", "run_id")


@query(f"select coalesce({_TOLD}, '') as turns, 'lab' as model_provider, uuid as run_id, 'chats' as source_dataset from empty_content")
def adapt_messages(spark, folder):
    """Turns given as a JSON string."""
    df = read(spark, folder, "empty_content").select(F.to_json("messages").alias("messages"), F.struct(F.lit("lab/m2").alias("model"), F.col("uuid").alias("prompt_id")).alias("metadata"))
    return _said(adapters.choose_adapter(df, "jsonl", "chats")(df, "chats"), "model_provider", "run_id")


@query("select case when contains(m, '/') then split_part(m, '/', 1) end as strict, case when contains(m, '/') then split_part(m, '/', 1) else m end as loose, count(*) as n from (select coalesce(lang || '/', '') || coalesce(source, 'x') as m from documents) group by 1, 2")
def model_providers(spark, folder):
    m = documents(spark, folder).select(F.concat(F.coalesce(F.concat("lang", F.lit("/")), F.lit("")), F.coalesce("source", F.lit("x"))).alias("m"))
    return m.groupBy(T.model_provider(F.col("m")).alias("strict"), T.model_provider(F.col("m"), False).alias("loose")).agg(F.count("*").alias("n"))


# ---- looking at records -----------------------------------------------------------------------
@query("select record_no, coalesce(m.role, 'unknown') as role, count(*) as n from (select record_no, unnest(messages) as m from full_records) group by 1, 2")
def record_roles(spark, folder):
    return records(spark, folder).select("record_no", F.explode(explore.record_roles(F.col("messages"))).alias("role", "n")).withColumn("n", F.col("n").cast("long"))


@query("""select count(distinct coalesce(t."name", t."function"."name")) as distinct_tools from (select unnest(tools) as t from full_records)""")
def distinct_tools(spark, folder):
    return explore.distinct_tools(records(spark, folder))


@query("select record_no, 'messages' as found_in from full_records where contains(lower(to_json(messages)::varchar), 'harbour')")
def search_records(spark, folder):
    """A word anywhere in the records' messages, calls and their arguments too."""
    return explore.search(records(spark, folder).select("record_no", "messages"), "Harbour", case_sensitive=False).select("record_no", "found_in")


@query("select trial_name as uuid, len(messages) as n_messages, 0 as n_tools, null::varchar as license from (select uuid as trial_name, messages from no_role)")
def defaults_filled(spark, folder):
    df = explore.with_defaults(read(spark, folder, "no_role").select(F.col("uuid").alias("trial_name"), F.col("messages").alias("conversations")))
    return df.select("uuid", F.when(F.col("messages").isNull(), None).otherwise(F.size("messages")).cast("long").alias("n_messages"), F.size("tools").alias("n_tools"), "license")


@query("select 'messages' as messages, 'tools' as tools, 'uuid' as id")
def fields_detected(spark, folder):
    found = explore.detect_fields(records(spark, folder))
    return spark.createDataFrame([(found["messages"], found["tools"], found["id"])], "messages string, tools string, id string")


@query("select record_no, case when messages is null then 'null' else '[' || len(messages) || ' items]' end as messages, case when reasoning is null then 'null' when length(reasoning) <= 20 then reasoning else substr(reasoning, 1, 17) || '...' end as reasoning from full_records")
def cell_previews(spark, folder):
    df = records(spark, folder)
    return df.select("record_no", T.cell_preview(F.col("messages"), "array").alias("messages"), T.cell_preview(F.col("reasoning"), "string").alias("reasoning"))


@query("select record_no from (select record_no, tools, row_number() over (order by record_no) - 1 as o from full_records) where o >= 20 and o < 60 and coalesce(len(tools), 0) > 0")
def records_with_tools_in_range(spark, folder):
    return parse.select_records(ordinal_by_key(records(spark, folder), "record_no"), "ordinal", start=20, end=60, has_tools=True).select("record_no")


@query("select uuid, len(messages) as n, len([1 for m in messages if m.role = 'assistant' and m.content <> '']) as told from full_records where messages is not null")
def prompts_only(spark, folder):
    """Prompts: no assistant says anything (told counts the records' own)."""
    df = records(spark, folder).where("messages is not null")
    made = parse.prompts(df.select("uuid", "messages", "tools"))
    silent = made.where(F.exists("messages", lambda m: (m["role"] == "assistant") & (m["content"] != "")))
    if silent.limit(1).count():
        raise ValueError("an answer was kept")
    return df.select("uuid", F.size("messages").cast("long").alias("n"), F.size(F.filter("messages", lambda m: (m["role"] == "assistant") & (m["content"] != ""))).cast("long").alias("told"))


# ---- comparing --------------------------------------------------------------------------------
@query("select doc_id, 'missing' as state from documents where doc_id % 50 = 0 union all select -doc_id, 'unexpected' from documents where doc_id % 70 = 0")
def expected_against_actual(spark, folder):
    ids = documents(spark, folder).select("doc_id")
    actual = ids.where("doc_id % 50 <> 0").unionByName(ids.where("doc_id % 70 = 0").select((-F.col("doc_id")).alias("doc_id")))
    return filters.expected_against_actual(ids, actual)


@query("select coalesce(l.n_nationkey, r.n_nationkey) as n_nationkey, case when l.n_nationkey is not null then json_object('n_name', l.n_name, 'n_regionkey', l.n_regionkey)::varchar end as \"left\", case when r.n_nationkey is not null then json_object('n_name', r.n_name, 'n_regionkey', r.n_regionkey)::varchar end as \"right\" from (select * from nation where n_regionkey < 3) l full join (select * from nation where n_regionkey > 1) r using (n_nationkey)")
def side_by_side(spark, folder):
    nation = read(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return diff.side_by_side(nation.where("n_regionkey < 3"), nation.where("n_regionkey > 1"), "n_nationkey")


@query("""select state, sum(n)::bigint as n from (
select case when lang = lower(lang) then 'unchanged' else 'changed' end as state, count(*) as n from documents where lang is not null group by 1
union all select 'removed', count(*) from documents where source is not null union all select 'added', count(*) from documents where site is not null) where n > 0 group by 1""")
def diff_summary(spark, folder):
    """Changes of three fields, told from JSON: one is folded, one goes, one comes."""
    docs = documents(spark, folder)
    a, b = F.to_json(F.struct("lang", "source")), F.to_json(F.struct(F.lower("lang").alias("lang"), "site"))
    return diff.diff_summary(diff.record_diff(docs.select("doc_id", a.alias("a"), b.alias("b")), "doc_id", "a", "b"))


@query("select doc_id, n_chars, 'lost' as \"where\" from documents where doc_id % 50 = 0 or (doc_id % 51 = 0 and n_chars is not null) union all select doc_id, n_chars + 1, 'added' from documents where doc_id % 51 = 0 and doc_id % 50 <> 0 and n_chars is not null")
def split_verified(spark, folder):
    """A split of which some rows were dropped and others altered on the way."""
    docs = documents(spark, folder).select("doc_id", "n_chars")
    parts = sampling.with_part(ordinal_by_key(docs, "doc_id"), 5, "ordinal").drop("ordinal").where("doc_id % 50 <> 0")
    tampered = parts.withColumn("n_chars", F.when(F.col("doc_id") % 51 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")))
    return sampling.verify_split(docs, tampered, "doc_id")


@query("select part, count(*) as n, true as mixed from (select ntile(7) over (order by doc_id)::int as part from documents) group by 1")
def split_shuffled(spark, folder):
    """Parts of a shuffled split: their sizes, and that each holds ids from both ends of the table."""
    docs = documents(spark, folder).select("doc_id")
    middle = docs.agg(F.percentile("doc_id", 0.5).alias("m"))
    parts = sampling.shuffled_parts(docs, "doc_id", 7, 11).join(F.broadcast(middle), F.lit(True))
    low = F.count_if(F.col("doc_id") < F.col("m")) / F.count("*")
    return parts.groupBy("part").agg(F.count("*").alias("n"), ((low > 0.2) & (low < 0.8)).alias("mixed"))


@query("select doc_id, (('0x' || substr(sha256('9' || chr(0) || doc_id), 1, 16))::ubigint % 16)::bigint as physical_partition, row_number() over (partition by ('0x' || substr(sha256('9' || chr(0) || doc_id), 1, 16))::ubigint % 16 order by substr(sha256((('0x' || substr(sha256('9' || chr(0) || doc_id), 1, 16))::ubigint % 16)::bigint::varchar || chr(0) || doc_id), 1, 16), doc_id) - 1 as at from documents")
def shuffle_order(spark, folder):
    """The place of each document in the order in which its partition comes out."""
    docs = documents(spark, folder).select("doc_id", sampling.sub_partition(F.col("doc_id"), F.lit(16), 9).alias("physical_partition"))
    out = topics.shuffle_order(docs, "doc_id").withColumn("i", F.monotonically_increasing_id())
    first = out.groupBy("physical_partition").agg(F.min("i").alias("first"))
    return out.join(first, "physical_partition").select("doc_id", "physical_partition", (F.col("i") - F.col("first")).alias("at"))


_CLASSES = f"select count(*) as examined, count(distinct sha256(coalesce({NORMAL.format('text')}, ''))) as kept, count(*) - count(distinct sha256(coalesce({NORMAL.format('text')}, ''))) as removed"


@query(f"{_CLASSES}, count(*) as declared, true as reconciled from documents")
def dedup_reconcile(spark, folder):
    docs = documents(spark, folder)
    return dedup.reconciled(dedup.exact_classes(docs, "doc_id", T.normal_text(F.col("text"))), "doc_id", "keep", declared=readers.count_records(spark, f"{folder}/documents.parquet"))


_SCALARS = {"bins": {50: {"share": 0.25, "domains": {"en": {"share": 0.75, "subdomains": {"web_crawl": 0.5, "books": 0.5}}, "de": 0.25}}, 150: 0.25, 400: {"share": 0.5, "domains": {"en": 1}}}}


@query()
def mixture_scalar_check(spark, folder):
    """The same mixture as mixture_check, with bare numbers for shares."""
    tree = manifest.token_tree(_kept(spark, folder).withColumn("shard", F.lit("all")), "shard", edges=BINS)
    capacity = tree.select(F.col("bin").cast("long").alias("len_bucket"), "domain", "subdomain", "n_tokens")
    return manifest.check_mixture(capacity, manifest.parse_mixture(_SCALARS))


_WORDS_OF = f"len([w for w in string_split(coalesce({NORMAL.format('text')}, ''), ' ') if w <> ''])"
_CONTEXT = "case when ('0x' || substr(sha256('0' || chr(0) || doc_id), 1, 16))::ubigint::double / 18446744073709551616.0 < 0.5 then 32 else 128 end"


@query(f"select sum(greatest(1, ceil(n / (c - 1.0))))::bigint as segments, sum(n)::bigint as source_tokens, true as complete from (select {_WORDS_OF} as n, {_CONTEXT} as c from documents)")
def pack_accounts_words(spark, folder):
    """Words instead of tokens, packed: every chunk in one sample and every word there."""
    docs = documents(spark, folder)
    words = F.filter(F.split(F.coalesce(T.normal_text(F.col("text")), F.lit("")), " "), lambda w: w != "")
    ids = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("site").alias("host"), F.transform(words, F.length).alias("input_ids"))
    placed = ids.withColumn("context", sampling.choose_context(F.col("doc_id"), {32: 0.5, 128: 0.5})).withColumn("cluster", F.lit(0)).withColumn("partition", sampling.sub_partition(F.col("doc_id"), F.lit(16), 2))
    parts = stored(pack.segments(placed, (32, 128)), "segments")
    return pack.accounts(pack.pack_all(parts), parts).select("segments", "source_tokens", "complete")


@query("select doc_id, greatest(1, ceil(n / 31.0))::bigint as chunks, least(n, 31)::bigint as longest from (select doc_id, " + _WORDS_OF + " as n from documents)")
def document_chunks(spark, folder):
    words = F.filter(F.split(F.coalesce(T.normal_text(F.col("text")), F.lit("")), " "), lambda w: w != "")
    sized = documents(spark, folder).select("doc_id", F.transform(words, F.length).alias("ids"))
    docs = sized.select("doc_id", pack.split_document(F.col("ids"), 32).alias("c"))
    return docs.select("doc_id", F.size("c").cast("long").alias("chunks"), F.array_max(F.transform("c", F.size)).cast("long").alias("longest"))


@query(f"select coalesce(nullif(domain, ''), 'unknown') as domain, 1::bigint as n_files from (select distinct domain from pretraining_normalized)")
def files_per_domain(spark, folder):
    """Each domain's files; of a table in one file, one."""
    path = _path(spark, "one-file")
    read(spark, folder, "pretraining_normalized").select("domain").coalesce(1).write.parquet(path)
    return manifest.files_per_domain(spark.read.parquet(path))


@query(f"select {BIN} as len_bucket, count(*) as records, sum(t)::bigint as tokens, round(avg(t), 6) as tokens_a_record from (select {_WORDS_OF}::bigint as t from documents) group by 1")
def token_counts(spark, folder):
    """Counts of a tokenise run by length bin."""
    from ..functions.tokens import counts, whitespace_tokens

    words = documents(spark, folder).select(whitespace_tokens(F.col("text")).alias("token_count")).withColumn("len_bucket", T.length_bin(F.col("token_count"), BINS))
    return counts(words, "len_bucket")


def _mixable(spark: SparkSession, folder: str) -> str:
    """A folder with two sources: a CSV one and a Parquet one."""
    path = _path(spark, "mix")
    documents(spark, folder).select(F.col("lang").alias("prompt"), F.col("source").alias("completion")).coalesce(1).write.option("header", True).csv(f"{path}/pairs/a.csv")
    read(spark, folder, "empty_content").select(F.col("messages").alias("conversations"), F.col("uuid").alias("run_id")).coalesce(1).write.parquet(f"{path}/chats/b")
    return path


@query("select 'pairs' as source_dataset, count(*) as n from documents union all select 'chats', count(*) from empty_content")
def mixed_files(spark, folder):
    """Files of two shapes found below a folder, each through its adapter."""
    return mix.mix(spark, _mixable(spark, folder)).groupBy("source_dataset").agg(F.count("*").alias("n"))


@query("""select record_no, i::int as messages_pos, json_extract_string(body, '$.messages[' || i || '].role') as "role" from (select record_no, body, unnest(range(json_array_length(body, '$.messages')::bigint)) as i from dict_content where json_valid(body) and json_type(body) = 'OBJECT' and json_type(body, '$.messages') = 'ARRAY')""")
def json_messages(spark, folder):
    """The messages of raw JSON records as a table, under the schema merged from all of them."""
    lines = read(spark, folder, "dict_content").select("record_no", "body")
    return flatten.flat_tables(flatten.records_of(lines, "body", ["record_no"]), ["record_no"])["messages"].select("record_no", "messages_pos", "role")
