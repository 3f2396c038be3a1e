"""Mixing sources to target shares of the total size, by systematic sampling.

Every document of a source has the same expected number of copies, its rate: what the target asks for,
divided by what the source has, and no more than the source's cap.  In a fixed order within the
source, the expected copies before a document are its rank times the rate; one random offset is added,
and a copy is emitted at each whole number the sum passes.  So a source's number of copies is exact to
within one, however the documents are spread and however small the rate."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.running import buckets_for, rank_in_group

def source_name(c: Column) -> Column:
    """A source in the targets' spelling: lower case, underscores for blanks and hyphens; null where nothing is named."""
    name = F.regexp_replace(F.lower(F.trim(c)), r"[\s\-]+", "_")
    return F.when(name != "", name)


def sizes(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, max_repeats, has (documents), has_tokens and total (tokens of the whole table); a source without documents has 0.

    The total counts documents of every source, named in targets or not."""
    by = documents.groupBy("source").agg(F.count("*").alias("has"), F.sum("tokens").alias("has_tokens"))
    total = documents.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"))
    wanted = targets.select(source_name(F.col("source")).alias("name"), F.col("source").alias("spelt"), F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("int").alias("max_repeats"))
    joined = wanted.join(by, F.col("name") == F.col("source"), "left").select("name", "spelt", "target_share", "max_repeats", F.coalesce("has", F.lit(0)).alias("has"), F.coalesce("has_tokens", F.lit(0)).alias("has_tokens"))
    return joined.join(F.broadcast(total), F.lit(True))  # one row


def mix(documents: DataFrame, targets: DataFrame, seed: int = 0, budget: int | None = None, rows: bool = False) -> DataFrame:
    """doc_id, source, tokens and copies (1 or more) of each chosen document; with rows, a row (and its `copy`, from 1) for each copy.

    documents: doc_id, source, tokens; sources are matched in the targets' spelling.  The budget is
    the size of the mixture in tokens, by default that of the whole table.  A source that falls short
    gives max_repeats copies of everything.  Documents of sources that aren't named, or null, aren't
    chosen; documents without tokens count like others; ties and repeated texts don't matter, since
    the order is that of a hash of doc_id.  Empty tables give an empty mixture."""
    docs = documents.select("doc_id", source_name(F.col("source")).alias("source"), F.coalesce("tokens", F.lit(0)).alias("tokens"))
    size = sizes(docs, targets)
    asked = F.col("target_share") * (F.lit(budget) if budget is not None else F.col("total"))
    cap = F.greatest(F.col("max_repeats").cast("double"), F.lit(0.0))
    rate = F.when(F.col("has_tokens") > 0, F.least(cap, asked / F.col("has_tokens"))).otherwise(cap)
    rates = size.select(F.col("name").alias("source"), F.greatest(rate, F.lit(0.0)).alias("rate"))
    draw = F.pmod(F.xxhash64(F.lit(zlib.crc32(f"mix {seed}".encode())), F.col("source")), F.lit(1 << 30)) / (1 << 30)
    rated = docs.join(F.broadcast(rates), "source")  # one row for each named source
    ranked = rank_in_group(rated, ["source"], "doc_id", "rank", buckets_for(documents))
    upto = lambda r: F.floor(r * F.col("rate") + F.col("offset"))
    passed = upto(F.col("rank") + 1) - upto(F.col("rank"))
    chosen = ranked.withColumn("offset", draw).select("doc_id", "source", "tokens", passed.cast("int").alias("copies")).where("copies > 0")
    if not rows:
        return chosen
    return chosen.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")


def shares(mixed: DataFrame, sized: DataFrame) -> DataFrame:
    """Each source's target and actual share, tokens, copies and whether it falls short.

    A source falls short if the mixture has all its documents max_repeats times and these are less than its share of the
    whole table's tokens."""
    got = mixed.groupBy(F.col("source").alias("name")).agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.sum("copies").alias("copies"))
    every = mixed.agg(F.sum(F.col("tokens") * F.col("copies")).alias("all"))
    joined = sized.join(got, "name", "left").join(F.broadcast(every), F.lit(True))  # one row
    used_up = F.coalesce("copies", F.lit(0)) == F.col("has") * F.greatest("max_repeats", F.lit(0))
    return joined.select(
        F.col("spelt").alias("source"), "target_share", F.round(F.coalesce(F.col("tokens") / F.col("all"), F.lit(0.0)), 6).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("copies", F.lit(0)).alias("copies"), (used_up & (F.coalesce("tokens", F.lit(0)) < F.col("target_share") * F.col("total"))).alias("falls_short"),
    )
