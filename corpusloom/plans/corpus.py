"""Queries of the operators for documents: normalising, duplicates, manifests, samples, clusters, packs.

Each query is followed by SQL that gives the same rows, where SQL can.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.running import ordinal_by_key
from ..functions.tokens import file_encoder, tokenize, whitespace_tokens
from ..operators import dedup, filters, manifest, mix, normalize, pack, sampling, topics
from ..session import stored
from . import read

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: A tokenizer file on every machine, and its end-of-text id.
TOKENIZER, EOS = "/opt/tokenizers/byte_bpe_50k.json", 50256
#: Length bins small enough that the test texts fall into all of them, counted in words.
BINS = (50, 150, 400)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "documents")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "pretraining_normalized")


NORMAL = "trim(regexp_replace(nfc_normalize({0}), '[\\s\\p{{Z}}\\x{{85}}\\x0b\\x1c-\\x1f]+', ' ', 'g'))"
SPACED = NORMAL.format("text")
WORDS = f"len([w for w in string_split(coalesce({SPACED}, ''), ' ') if w <> ''])::bigint"
BIN = "case when t <= 50 then 50 when t <= 150 then 150 else 400 end::bigint"


@query(f"""select {SPACED} as text, nullif(id, '') as id, dump, nullif(url, '') as url, date, file_path, language, language_score, token_count, 'pages' as source_dataset,
subset, license, upstream_source, false as synthetic, synthetic_parent_id, quality_score, 'web' as domain, subdomain, dedup_cluster_id, null::boolean as dedup_keep from pretraining_normalized""")
def normalize_pretraining(spark, folder):
    return normalize.to_pretraining(pages(spark, folder), normalize.Source("pages", domain="web"))


@query(f"""select {SPACED} as text, doc_id::varchar as id, 'documents' as source_dataset, 'mixed' as domain from documents""")
def normalize_documents(spark, folder):
    return normalize.to_pretraining(documents(spark, folder), normalize.Source("documents", domain="mixed")).select("text", "id", "source_dataset", "domain")


@query(f"""select count(*) as total, count(distinct sha256(coalesce({SPACED}, ''))) as distinct_texts, count(*) - count(distinct sha256(coalesce({SPACED}, ''))) as duplicates, count(*) filter (text is null) as null_texts from documents""")
def exact_dedup_report(spark, folder):
    return dedup.exact_report(documents(spark, folder), T.normal_text(F.col("text")))


@query(f"select min(doc_id) as doc_id from documents group by sha256(coalesce({SPACED}, ''))")
def exact_dedup_survivors(spark, folder):
    return dedup.survivors(documents(spark, folder), "doc_id", T.normal_text(F.col("text")))


@query(f"select doc_id, min(doc_id) over (partition by sha256(coalesce({SPACED}, ''))) as keep from documents")
def exact_dedup_classes(spark, folder):
    return dedup.exact_classes(documents(spark, folder), "doc_id", T.normal_text(F.col("text")))


@query(f"""with recursive w as (select doc_id, [x for x in string_split(lower(coalesce({SPACED}, '')), ' ') if x <> ''] as ws from documents),
s as (select distinct doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') as sh from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as i from w)), c as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as x, b.doc_id as y, count(*) as k from s a join s b using (sh) where a.doc_id <> b.doc_id group by 1, 2), e as (select x, y from p join c cx on cx.doc_id = x join c cy on cy.doc_id = y where k >= 0.8 * (cx.n + cy.n - k)),
r as (select doc_id as a, doc_id as b from c union select r.a, e.y from r join e on e.x = r.b) select a as doc_id, min(b) as class_id, a = min(b) as keep from r group by a""")
def near_duplicates(spark, folder):
    """Class of each document: five words to a shingle, similarity 0.8.  The SQL compares all pairs."""
    return dedup.near_duplicates(documents(spark, folder), "doc_id", "text")


@query(f"select doc_id from documents where doc_id not in (select min(doc_id) from documents group by sha256(coalesce({SPACED}, '')))")
def removed_documents(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return filters.without(docs, dedup.survivors(docs, "doc_id", T.normal_text(F.col("text"))), "doc_id").select("doc_id")


def _kept(spark, folder) -> DataFrame:
    """The flagship's rows: documents of distinct texts with domain, source and words."""
    docs = documents(spark, folder).select("doc_id", T.normal_text(F.col("text")).alias("text"), F.lower("source").alias("source_dataset"), F.col("lang").alias("domain"))
    columns = ["domain", "source_dataset", F.col("source_dataset").alias("subdomain"), whitespace_tokens(F.col("text")).alias("token_count")]
    return dedup.first_rows(docs, "doc_id", F.col("text"), columns)


_KEPT = f"(select doc_id, coalesce(nullif(lang, ''), 'unknown') as domain, coalesce(nullif(lower(source), ''), 'unknown') as source_dataset, {WORDS} as t from documents where doc_id in (select min(doc_id) from documents group by sha256(coalesce({SPACED}, ''))))"
_CELLS = f"select domain, {BIN} as len_bucket, source_dataset, count(*) as n_docs, sum(t)::bigint as n_tokens from {_KEPT} group by all"


@query(_CELLS)
def manifest_cells(spark, folder):
    return manifest.cells(_kept(spark, folder), edges=BINS)


@query(f"select case when grouping(domain) = 0 then 'domain' when grouping(len_bucket) = 0 then 'len_bucket' else 'all' end as level, domain, len_bucket, sum(n_docs)::bigint as n_docs, sum(n_tokens)::bigint as n_tokens from ({_CELLS}) group by grouping sets ((domain), (len_bucket), ())")
def manifest_rollups(spark, folder):
    return manifest.rollups(manifest.cells(_kept(spark, folder), edges=BINS))


@query(_CELLS)
def manifest_merged(spark, folder):
    """Manifests of two halves of the corpus, merged: the same as of the whole."""
    kept = _kept(spark, folder)
    return manifest.merged([manifest.cells(kept.where(F.col("doc_id") % 2 == r), edges=BINS) for r in (0, 1)])


@query(f"select case when t <= 50 then '50' when t <= 150 then '150' else '400' end as bin, domain, source_dataset as subdomain, count(*) as n_docs, sum(t)::bigint as n_tokens, array_to_string(list_sort(list(distinct (doc_id % 4)::varchar)), ',') as shards from {_KEPT} group by all")
def token_tree(spark, folder):
    kept = _kept(spark, folder).withColumn("shard", (F.col("doc_id") % 4).cast("string"))
    return manifest.token_tree(kept, "shard", edges=BINS).withColumn("shards", F.array_join("shards", ","))


@query(f"select doc_id, t as words, {BIN} as len_bucket from (select doc_id, {WORDS} as t from documents)")
def length_bins(spark, folder):
    words = documents(spark, folder).select("doc_id", whitespace_tokens(F.col("text")).alias("words"))
    return words.select("doc_id", "words", T.length_bin(F.col("words"), BINS).alias("len_bucket"))


_TARGETS = {"50": {"share": 0.25, "domains": {"en": {"share": 0.75, "subdomains": {"web_crawl": 0.5, "books": 0.5}}, "de": {"share": 0.25}}}, "150": {"share": 0.25}, "400": {"share": 0.5, "domains": {"en": {"share": 1.0}}}}


@query(f"""with c as (select {BIN} as b, domain as d, source_dataset as s, sum(t)::bigint as n from {_KEPT} group by all), total as (select sum(n) as n from c),
t(len_bucket, bin_share, domain, cell_share, subdomain) as (values (50, 0.25, 'en', 0.375, 'web_crawl'), (50, 0.25, 'en', 0.375, 'books'), (50, 0.25, 'de', 0.25, null), (150, 0.25, null, 1.0, null), (400, 0.5, 'en', 1.0, null)),
m as (select t.*, round_even(total.n * bin_share::double, 0)::bigint as bin_need, coalesce((select sum(n) from c where b = len_bucket), 0)::bigint as bin_have,
coalesce((select sum(n) from c where b = len_bucket and (domain is null or d = domain) and (subdomain is null or s = subdomain)), 0)::bigint as have from t, total),
k as (select *, round_even(bin_need * cell_share::double, 0)::bigint as need from m), q as (select *, greatest(0, need - have)::bigint as shortfall from k)
select len_bucket::bigint as len_bucket, domain, subdomain, need, have, shortfall, shortfall = 0 as ok, bin_need, bin_have, bool_and(shortfall = 0) over (partition by len_bucket) and bin_have >= bin_need as bin_ok from q""")
def mixture_check(spark, folder):
    tree = manifest.token_tree(_kept(spark, folder).withColumn("shard", F.lit("all")), "shard", edges=BINS)
    capacity = tree.select(F.col("bin").cast("long").alias("len_bucket"), "domain", "subdomain", "n_tokens")
    return manifest.check_mixture(capacity, manifest.parse_mixture(_TARGETS))


@query("select id, coalesce(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') as host from pretraining_normalized")
def url_hosts(spark, folder):
    return pages(spark, folder).select("id", T.url_host(F.col("url")).alias("host"))


_FLAGS = """(contains(lower(coalesce(text, '')), '<html') or contains(lower(coalesce(text, '')), '</div>'))::int as html_like,
(contains(coalesce(text, ''), 'def ') or contains(coalesce(text, ''), 'function ') or contains(coalesce(text, ''), '#include'))::int as code_like,
regexp_matches(substr(coalesce(text, ''), 1, 4096), '[^\\x00-\\x7F]')::int as non_ascii, strlen(coalesce(text, ''))::bigint as bytes"""


@query(f"select doc_id, {_FLAGS} from documents")
def shape_flags(spark, folder):
    return documents(spark, folder).select("doc_id", *T.shape_flags(F.col("text")))


@query(f"select count(*) as documents, sum(bytes)::bigint as bytes, sum(html_like)::bigint as html_like, sum(code_like)::bigint as code_like, sum(non_ascii)::bigint as non_ascii, count(*) filter ({NORMAL.format('coalesce(text, chr(32))')} = '') as excluded from (select text, {_FLAGS} from documents)")
def corpus_skew(spark, folder):
    return topics.skew(documents(spark, folder))


_H = "substr(sha256('{0}' || chr(0) || {1}), 1, 16)"
_U = "('0x' || " + _H + ")::ubigint"


@query(f"select doc_id, {_H.format(7, 'doc_id')} as h from documents")
def stable_hashes(spark, folder):
    return documents(spark, folder).select("doc_id", T.stable_hash(7, F.col("doc_id")).alias("h"))


@query("select id, lower(substr(s, 1, 8) || '-' || substr(s, 9, 4) || '-5' || substr(s, 14, 3) || '-' || substr('89ab', ((('0x' || substr(s, 17, 1))::int) % 4) + 1, 1) || substr(s, 18, 3) || '-' || substr(s, 21, 12)) as uuid from (select id, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode('urn:corpusloom:page:' || id)) as s from pretraining_normalized)")
def record_uuids(spark, folder):
    return pages(spark, folder).select("id", T.uuid5(F.concat(F.lit("urn:corpusloom:page:"), F.col("id"))).alias("uuid"))


@query(f"select doc_id, source from documents order by {_H.format(0, 'doc_id')}, doc_id limit 100")
def reservoir_sample(spark, folder):
    return sampling.top_by_hash(documents(spark, folder).select("doc_id", "source"), "doc_id", 100)


@query(f"select doc_id from documents where {_H.format(3, 'doc_id')} < '4000000000000000'")
def hash_threshold_sample(spark, folder):
    docs = documents(spark, folder).select("doc_id")
    return docs.where(sampling.below_share(F.col("doc_id"), 0.25, 3))


@query(f"select doc_id, source from (select doc_id, source, row_number() over (partition by source order by {_H.format(5, 'doc_id')}, doc_id) as r, count(*) over (partition by source) as n from documents) where r <= floor(n * 0.3)")
def sample_each_source(spark, folder):
    return sampling.exact_share(documents(spark, folder).select("doc_id", "source"), "source", "doc_id", 0.3, 5)


@query(f"select doc_id, source as source_dataset from (select doc_id, source, row_number() over (partition by source order by {_H.format(0, 'doc_id')}, doc_id) as r, count(*) over (partition by source) as n from documents) where not contains(coalesce(source, ''), 'crawl') or r <= floor(n * 0.5)")
def mix_sample_rate(spark, folder):
    docs = documents(spark, folder).select("doc_id", F.col("source").alias("source_dataset"))
    return mix.sample_source(docs, "crawl", 0.5, "doc_id")


@query("select doc_id, source, ntile(7) over (order by doc_id)::int as part from documents")
def split_parts(spark, folder):
    docs = ordinal_by_key(documents(spark, folder).select("doc_id", "source"), "doc_id")
    return sampling.with_part(docs, 7, "ordinal").drop("ordinal")


@query(f"select doc_id, ({_U.format(9, 'doc_id')} % 16)::bigint as part from documents")
def stable_partition(spark, folder):
    return documents(spark, folder).select("doc_id", sampling.sub_partition(F.col("doc_id"), F.lit(16), 9).alias("part"))


@query("""with w as (select source, sum(coalesce(strlen(text), 0))::bigint as bytes, count(*) as n_docs from documents where source is not null group by 1),
q as (select *, 40 * bytes / sum(bytes) over () as quota from w), f as (select *, floor(quota) as fl from q),
g as (select *, row_number() over (order by quota - fl desc, source) as r, 40 - sum(fl) over () as rest from f),
s as (select source, bytes, (1 + fl + case when r <= rest then 1 else 0 end)::bigint as share from g)
select source as cluster, bytes, share, coalesce(sum(share) over (order by source rows between unbounded preceding and 1 preceding), 0)::bigint as first from s""")
def partition_plan(spark, folder):
    by = documents(spark, folder).where("source is not null").groupBy(F.col("source").alias("cluster")).agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).cast("long").alias("bytes"), F.count("*").alias("n_docs"))
    return topics.partition_plan(by, by.count() + 40).drop("n_docs")


@query(f"select doc_id, case when {_U.format(2, 'doc_id')}::double / 18446744073709551616.0 < 0.25 then 8192 else 65536 end as context from documents")
def choose_context(spark, folder):
    return documents(spark, folder).select("doc_id", sampling.choose_context(F.col("doc_id"), {8192: 0.25, 65536: 0.75}, 2).alias("context"))


@query("""with e as (select case when event_type = 'purchase' or value >= 20 then 1.0 else 0.0 end as reward, case when user_id % 7 = 0 then 1.0 else 0.0 end as has_error, floor(value)::int as num_turns, event_type as model from events)
select case when reward <> 1.0 then 'failed' when has_error = 1.0 then 'excluded_by_error' when coalesce(num_turns, 0) < 10 then 'excluded_by_min_turns' when coalesce(num_turns, 0) > 80 then 'excluded_by_max_turns' else 'passed' end as reason, count(*) as n from e group by 1""")
def eval_filter(spark, folder):
    rollouts = read(spark, folder, "events").select(
        F.when((F.col("event_type") == "purchase") | (F.col("value") >= 20), 1.0).otherwise(0.0).alias("reward"),
        F.when(F.col("user_id") % 7 == 0, 1.0).otherwise(0.0).alias("has_error"), F.floor("value").cast("int").alias("num_turns"), F.col("event_type").alias("model"),
    )
    return filters.reason_counts(rollouts, filters.trajectory_reason(rollouts, exclude_errors=True, min_turns=10, max_turns=80))


def _assigned(spark, folder) -> tuple[DataFrame, int]:
    """Documents with their clusters, under the operator's own settings, and the number of clusters.

    Only a table with fewer than twice as many different texts as clusters has fewer, half as many as texts: k-means || finds no more starts."""
    docs = topics.prepared(documents(spark, folder), "doc_id")
    vectors = stored(topics.features(docs).select("doc_id", "bytes", "features"), "vectors")
    k = max(2, min(topics.CLUSTERS, docs.select("text").distinct().count() // 2))
    return topics.assign(vectors, topics.fit(vectors, "doc_id", k=k)).select("doc_id", "bytes", "cluster", F.round("distance", 6).alias("distance")), k


@query()
def topic_clusters(spark, folder):
    """Cluster and distance of each document."""
    return _assigned(spark, folder)[0].drop("bytes")


@query()
def topic_quality(spark, folder):
    """Sizes, shares and distance percentiles of the clusters, and whether they pass the gate."""
    assigned, k = _assigned(spark, folder)
    return topics.quality(stored(assigned, "assigned"), "doc_id", k)


@query()
def tokenized(spark, folder):
    """Token ids of each document."""
    return tokenize(documents(spark, folder).select("doc_id", "text"), file_encoder(TOKENIZER)).drop("text")


def _segments(spark, folder) -> DataFrame:
    docs = documents(spark, folder).select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.lower("site").alias("host"))
    ids = tokenize(docs, file_encoder(TOKENIZER))
    placed = ids.withColumn("context", sampling.choose_context(F.col("doc_id"), {512: 0.5, 2048: 0.5})).withColumn("cluster", sampling.sub_partition(F.col("doc_id"), F.lit(4), 1).cast("int"))
    return stored(pack.segments(placed.withColumn("partition", F.col("cluster").cast("long") * 16 + sampling.sub_partition(F.col("doc_id"), F.lit(16), 2)), (512, 2048)), "segments")


@query()
def packed_samples(spark, folder):
    """Packed training samples: ids, labels and mask of exactly the context's length."""
    parts = _segments(spark, folder)
    return pack.materialise(pack.pack_all(parts), parts, EOS, EOS)


@query()
def pack_accounts(spark, folder):
    """Every chunk in one sample, every token there."""
    parts = _segments(spark, folder)
    return pack.accounts(pack.pack_all(parts), parts)
