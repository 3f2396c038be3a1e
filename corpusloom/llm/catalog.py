"""Queries of problems 3 to 8, over whole tables, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from . import budget, defects, mixing, packing, similar, subjects
from .bpe import with_tokens

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _conversations(spark: SparkSession, folder: str) -> DataFrame:
    tables = [_table(spark, folder, n).select("record_no", "messages", F.lit(n).alias("table_name")) for n in ("empty_content", "no_role", "empty_messages")]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return defects.defective_pairs(_conversations(spark, folder))


def _counted(spark: SparkSession, folder: str) -> DataFrame:
    return budget.counted(_table(spark, folder, "pretraining_normalized"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return budget.wrong_counts(_counted(spark, folder))


def p4_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return budget.once(_counted(spark, folder)).select("id", "recorded", "tokens")


def p4_totals(spark: SparkSession, folder: str) -> DataFrame:
    return budget.totals(_counted(spark, folder))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return similar.similar_pairs(similar.similar_groups(_table(spark, folder, "pretraining_normalized")))


def p5_groups(spark: SparkSession, folder: str) -> DataFrame:
    return similar.group_report(similar.similar_groups(_table(spark, folder, "pretraining_normalized")))


def _sized(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their tokens, counted once for the passes that follow."""
    return stored(with_tokens(_table(spark, folder, "documents"), keep=["doc_id", "source"]), "sizes")


def _capacities(spark: SparkSession, folder: str) -> dict[str, int]:
    return {r["container"]: int(r["capacity_tokens"]) for r in _table(spark, folder, "container_sizes").collect()}


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of which the packing for ctx_4k has more than one piece."""
    packed = packing.pack(_sized(spark, folder), _capacities(spark, folder)["ctx_4k"])
    return packed.where("part = 1").select("doc_id")


def p6_packed(spark: SparkSession, folder: str) -> DataFrame:
    docs = _sized(spark, folder)
    return _union([packing.pack(docs, n).select(F.lit(c).alias("container"), "*") for c, n in _capacities(spark, folder).items()])


def p6_fill(spark: SparkSession, folder: str) -> DataFrame:
    docs = _sized(spark, folder)
    return _union([packing.fill_report(packing.pack(docs, n), n).select(F.lit(c).alias("container"), "*") for c, n in _capacities(spark, folder).items()])


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sources whose actual share of the mixture is limited by max_repeats."""
    docs = _sized(spark, folder).withColumn("source", mixing.source_name(F.col("source")))
    targets = _table(spark, folder, "mixture_targets")
    return mixing.shares(mixing.mix(docs, targets), mixing.sizes(docs, targets)).where("falls_short").select("source")


def p7_mixed(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_sized(spark, folder), _table(spark, folder, "mixture_targets"))


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    docs = _sized(spark, folder).withColumn("source", mixing.source_name(F.col("source")))
    targets = _table(spark, folder, "mixture_targets")
    return mixing.shares(mixing.mix(docs, targets), mixing.sizes(docs, targets))


def _subjects(spark: SparkSession, folder: str) -> DataFrame:
    return subjects.subjects_of(*(_table(spark, folder, n) for n in ("documents", "doc_subject_labels", "subject_areas")))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return _subjects(spark, folder).select("doc_id", "subject")


def p8_makeup(spark: SparkSession, folder: str) -> DataFrame:
    return subjects.makeup(_subjects(spark, folder), _table(spark, folder, "documents"))


def p4_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by source, from the same rows as the totals."""
    return p4_totals(spark, folder).where("source_dataset <> '*' and language = '*' and domain = '*'").select("source_dataset", "documents")


def p6_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """For each container: the documents packed, and whether every piece is there once, none overlaps and none leaves its container."""
    docs, frames = _sized(spark, folder), []
    for name, capacity in _capacities(spark, folder).items():
        packed = packing.pack(docs, capacity)
        held = packed.groupBy("pack_no").agg(F.sum("length").alias("used"), F.max(F.col("start") + F.col("length")).alias("end"), F.count_distinct("start").alias("starts"), F.count("*").alias("pieces"))
        fits = held.agg(F.coalesce(F.bool_and((F.col("used") == F.col("end")) & (F.col("end") <= capacity) & (F.col("starts") == F.col("pieces"))), F.lit(True)).alias("fits"))
        by = packed.groupBy("doc_id").agg(F.sum("length").alias("length"), F.count("*").alias("parts"), F.max("part").alias("last"), F.count_distinct("part").alias("distinct"))
        whole = docs.where("tokens > 0").join(by, "doc_id", "left").agg(F.count("*").alias("documents"), F.coalesce(F.bool_and((F.coalesce("length", F.lit(-1)) == F.col("tokens")) & (F.col("parts") == F.col("distinct")) & (F.col("last") == F.col("parts") - 1)), F.lit(True)).alias("once"))
        frames.append(whole.join(F.broadcast(fits), F.lit(True)).select(F.lit(name).alias("container"), "documents", "once", "fits"))  # one row each
    return _union(frames)


def p7_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """For each source: its documents, whether its copies are within one of the expected number, and whether none is used too often."""
    docs = _sized(spark, folder).withColumn("source", mixing.source_name(F.col("source")))
    targets = _table(spark, folder, "mixture_targets")
    mixed, sized = mixing.mix(docs, targets), mixing.sizes(docs, targets)
    got = mixed.groupBy(F.col("source").alias("name")).agg(F.sum("copies").alias("copies"), F.max("copies").alias("most"))
    rate = F.least(F.col("max_repeats").cast("double"), F.when(F.col("has_tokens") > 0, F.col("target_share") * F.col("total") / F.col("has_tokens")).otherwise(F.col("max_repeats")))
    near = F.abs(F.coalesce("copies", F.lit(0)) - F.col("has") * rate) <= 1
    return sized.join(got, "name", "left").select(F.col("spelt").alias("source"), F.col("has").alias("documents"), near.alias("near"), (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("allowed"))


QUERIES: dict[str, Query] = {
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_tokens": p4_tokens,
    "p4_totals": p4_totals,
    "p4_documents": p4_documents,
    "p5_found": p5_found,
    "p5_groups": p5_groups,
    "p6_found": p6_found,
    "p6_packed": p6_packed,
    "p6_fill": p6_fill,
    "p6_invariants": p6_invariants,
    "p7_found": p7_found,
    "p7_mixed": p7_mixed,
    "p7_shares": p7_shares,
    "p7_invariants": p7_invariants,
    "p8_found": p8_found,
    "p8_makeup": p8_makeup,
}

_SOURCE = "nullif(regexp_replace(lower(trim(source)), '[\\s\\-]+', '_', 'g'), '')"
_TAG = "regexp_replace(lower(trim(source_dataset)), '[\\s\\-_/]+', '_', 'g')"

#: Tokens can't be counted in SQL; what must hold of the results whatever the counts are can be said.
ORACLES: dict[str, str] = {
    "p4_documents": f"select case when source_dataset is null or {_TAG} in ('', 'und', 'unk', 'unknown', 'none', 'null', 'n_a', 'na', 'xx') then 'unknown' else {_TAG} end as source_dataset, count(*) as documents from (select id, min(source_dataset) as source_dataset from pretraining_normalized group by id) group by 1",
    "p6_invariants": "select container, (select count(*) from documents where coalesce(text, '') <> '') as documents, true as once, true as fits from container_sizes",
    "p7_invariants": f"select t.source, (select count(*) from documents where {_SOURCE} = regexp_replace(lower(trim(t.source)), '[\\s\\-]+', '_', 'g')) as documents, true as near, true as allowed from mixture_targets t",
}
