"""Capacity: cells of domain, length bin and source, their rollups, and the check against a target mixture."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import length_bin

#: The upper edges of the length bins.
LENGTH_BINS = (8192, 65536, 262144)


def unknown(c: Column) -> Column:
    return F.coalesce(F.when(c != "", c), F.lit("unknown"))


def cells(df: DataFrame, tokens: str = "token_count", edges: Sequence[int] = LENGTH_BINS) -> DataFrame:
    """domain, len_bucket, source_dataset, n_docs, n_tokens; missing names are 'unknown', missing counts 0 tokens in no bin."""
    t = F.col(tokens)
    named = df.select(unknown(F.col("domain")).alias("domain"), length_bin(t, edges).alias("len_bucket"), unknown(F.col("source_dataset")).alias("source_dataset"), F.coalesce(t, F.lit(0)).alias("t"))
    return named.groupBy("domain", "len_bucket", "source_dataset").agg(F.count("*").alias("n_docs"), F.sum("t").alias("n_tokens"))


def ordered(manifest: DataFrame) -> DataFrame:
    return manifest.orderBy("domain", F.coalesce("len_bucket", F.lit(0)), "source_dataset")


def merged(parts: Sequence[DataFrame]) -> DataFrame:
    """Manifests of parts of a corpus as one."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("domain", "len_bucket", "source_dataset").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


def rollups(manifest: DataFrame) -> DataFrame:
    """Documents and tokens by domain, by length bin and over all: level, domain, len_bucket, n_docs, n_tokens."""
    sets = manifest.groupingSets([["domain"], ["len_bucket"], []], "domain", "len_bucket").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.grouping_id().alias("g"))
    level = F.when(F.col("g") == 1, "domain").when(F.col("g") == 2, "len_bucket").otherwise("all")
    return sets.select(level.alias("level"), "domain", "len_bucket", "n_docs", "n_tokens")


def files_per_domain(df: DataFrame) -> DataFrame:
    """(domain, n_files): files that hold rows of a domain."""
    return df.groupBy(unknown(F.col("domain")).alias("domain")).agg(F.count_distinct(F.col("_metadata.file_path")).alias("n_files"))


def token_tree(df: DataFrame, shard: str, tokens: str = "token_count", edges: Sequence[int] = LENGTH_BINS) -> DataFrame:
    """bin, domain, subdomain, n_docs, n_tokens and the shards that hold the cell's documents; no bin is 'unbinned'."""
    b = F.coalesce(length_bin(F.col(tokens), edges).cast("string"), F.lit("unbinned"))
    return df.groupBy(b.alias("bin"), unknown(F.col("domain")).alias("domain"), unknown(F.col("subdomain")).alias("subdomain")).agg(
        F.count("*").alias("n_docs"), F.sum(F.coalesce(tokens, F.lit(0))).alias("n_tokens"), F.sort_array(F.collect_set(shard)).alias("shards")
    )


def to_json(manifest: DataFrame) -> str:
    """A manifest as JSON; its rows are cells, not documents."""
    return json.dumps([r.asDict() for r in ordered(manifest).collect()])


def from_json(spark: SparkSession, text: str) -> DataFrame:
    return spark.createDataFrame(json.loads(text), "domain string, len_bucket long, source_dataset string, n_docs long, n_tokens long")


@dataclass(frozen=True)
class Target:
    """The share of a bin, and within it of a domain and a subdomain."""

    len_bucket: int
    bin_share: float
    domain: str | None
    domain_share: float
    subdomain: str | None
    subdomain_share: float


def _number(share: object, where: str) -> float:
    if isinstance(share, bool) or not isinstance(share, (int, float, str)):
        raise ValueError(f"{where} must be a number, not {share!r}")
    try:
        return float(share)
    except ValueError:
        raise ValueError(f"{where} must be a number, not {share!r}") from None


def _level(entries: dict, where: str) -> list[tuple[str, float, dict]]:
    """(name, share, what is below) of each entry of a level; an entry is a share or a mapping with one.  The shares add up to 1."""
    if not isinstance(entries, dict):
        raise ValueError(f"{where} must be a mapping")
    out = [(str(k), _number(v.get("share") if isinstance(v, dict) else v, f"{where}.{k}"), v if isinstance(v, dict) else {}) for k, v in entries.items()]
    shares = [s for _, s, _ in out]
    if any(not 0 <= s <= 1 for s in shares) or (shares and abs(sum(shares) - 1) > 1e-6):
        raise ValueError(f"shares of {where} don't add up to 1: {shares}")
    return out


def parse_mixture(tree: dict) -> list[Target]:
    """{bin: {share, domains: {name: share, or {share, subdomains: {name: share}}}}} as rows, with or without `bins` around it.

    Bins are whole numbers, shares from 0 to 1, and each level adds up to 1; a bin may have no domains, and a domain no subdomains."""
    out = []
    for name, bin_share, below in _level(tree.get("bins", tree), "bins"):
        if not name.isdigit():
            raise ValueError(f"a bin is a whole number, not {name!r}")
        edge, domains = int(name), _level(below.get("domains") or {}, f"bin {name}")
        if not domains:
            out.append(Target(edge, bin_share, None, 1.0, None, 1.0))
        for domain, share, inside in domains:
            subs = _level(inside.get("subdomains") or {}, f"bin {name}, domain {domain}")
            out += [Target(edge, bin_share, domain, share, sub, part) for sub, part, _ in subs] or [Target(edge, bin_share, domain, share, None, 1.0)]
    return out


def check_mixture(capacity: DataFrame, targets: list[Target], budget: int | None = None) -> DataFrame:
    """What each cell of a mixture needs and has: len_bucket, domain, subdomain, need, have, shortfall, ok, bin_need, bin_have, bin_ok.

    capacity: len_bucket, domain, subdomain, n_tokens.  A bin needs budget x share, rounded half to even;
    a cell its share of that.  budget None is the corpus total; 0 is 0.  Cells that aren't there have 0."""
    spark = capacity.sparkSession
    rows = [(t.len_bucket, t.bin_share, t.domain, t.domain_share * t.subdomain_share, t.subdomain) for t in targets]
    wanted = spark.createDataFrame(rows, "len_bucket long, bin_share double, domain string, cell_share double, subdomain string")
    total = capacity.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("total")) if budget is None else spark.createDataFrame([(budget,)], "total long")
    bins = capacity.groupBy("len_bucket").agg(F.sum("n_tokens").alias("bin_have"))
    by_domain = capacity.groupBy("len_bucket", "domain").agg(F.sum("n_tokens").alias("domain_have"))
    by_cell = capacity.groupBy("len_bucket", "domain", "subdomain").agg(F.sum("n_tokens").alias("cell_have"))
    joined = wanted.join(F.broadcast(total), F.lit(True)).join(bins, "len_bucket", "left").join(by_domain, ["len_bucket", "domain"], "left").join(by_cell, ["len_bucket", "domain", "subdomain"], "left")
    bin_need = F.bround(F.col("total") * F.col("bin_share"), 0).cast("long")
    need = F.bround(bin_need * F.col("cell_share"), 0).cast("long")
    have = F.coalesce(F.when(F.col("domain").isNull(), F.col("bin_have")).when(F.col("subdomain").isNull(), F.col("domain_have")).otherwise(F.col("cell_have")), F.lit(0))
    cell = joined.select("len_bucket", "domain", "subdomain", need.alias("need"), have.alias("have"), bin_need.alias("bin_need"), F.coalesce("bin_have", F.lit(0)).alias("bin_have"))
    short = F.greatest(F.lit(0).cast("long"), F.col("need") - F.col("have"))
    checked = cell.select("*", short.alias("shortfall"), (short == 0).alias("ok"))
    whole = checked.groupBy("len_bucket").agg(F.bool_and("ok").alias("__all"))
    return checked.join(whole, "len_bucket").select("len_bucket", "domain", "subdomain", "need", "have", "shortfall", "ok", "bin_need", "bin_have", (F.col("__all") & (F.col("bin_have") >= F.col("bin_need"))).alias("bin_ok"))


def satisfiable(checked: DataFrame) -> bool:
    return bool(checked.agg(F.coalesce(F.bool_and("bin_ok"), F.lit(True)).alias("ok")).first()["ok"])
