"""Samples, shuffles, splits and apportionment, all in the order of a hash: the same on every cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.running import rank_in_group
from ..functions.text import as_unsigned, stable_hash


def top_by_hash(df: DataFrame, row: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly min(n, rows) rows: those with the smallest hashes, ids breaking ties; a distributed top-n."""
    return df.withColumn("__h", stable_hash(seed, F.col(row))).orderBy("__h", row).limit(n).drop("__h")


def below_share(row: Column, share: float, seed: int = 0) -> Column:
    """Whether a row's hash is in the first `share` of the 64-bit range: about that share of the rows, without a shuffle."""
    if share >= 1:
        return F.lit(True)
    return stable_hash(seed, row) < F.lit(format(int(max(share, 0.0) * (1 << 64)), "016x"))


def exact_share(df: DataFrame, group: str, row: str, share: float, seed: int = 0) -> DataFrame:
    """floor(n * share) rows of each group: the largest groups are found by a cut that all but a few rows settle alone.

    The hash of a group's k-th row is found among its rows near the expected cut, counted in 1024 ranges of the hash."""
    hashed = df.withColumn("__h", stable_hash(seed, F.col(row))).withColumn("__r", F.conv(F.substring("__h", 1, 3), 16, 10).cast("int"))
    counts = hashed.groupBy(group, "__r").agg(F.count("*").alias("__n"))
    by_range = Window.partitionBy(group).orderBy("__r")
    every = Window.partitionBy(group)
    plan = counts.select(F.col(group).alias("__g"), F.col("__r").alias("__pr"), (F.sum("__n").over(by_range) - F.col("__n")).alias("__before"), F.floor(F.sum("__n").over(every) * F.lit(share)).alias("__k"))
    joined = hashed.join(plan, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__r") == F.col("__pr")))
    place = F.col("__before") + F.row_number().over(Window.partitionBy(group, "__r").orderBy("__h", row))
    return joined.where("__before < __k").withColumn("__at", place).where("__at <= __k").drop("__h", "__r", "__g", "__pr", "__before", "__k", "__at")


def shuffled(df: DataFrame, row: str, seed: int = 0) -> DataFrame:
    """All rows in the order of a hash of seed and id: a range-partitioned sort."""
    return df.orderBy(stable_hash(seed, F.col(row)), row)


def split_bounds(total: int, parts: int) -> list[tuple[int, int]]:
    """(start, end) of parts of equal size; the first total % parts get one more."""
    if parts < 1:
        raise ValueError(parts)
    each, more = divmod(total, parts)
    out, at = [], 0
    for i in range(parts):
        end = at + each + (i < more)
        out.append((at, end))
        at = end
    return out


def with_part(df: DataFrame, parts: int, ordinal: str, total: int | None = None) -> DataFrame:
    """Adds `part`, from 1: what split_bounds says for the row's position, without a window over all rows."""
    n = df.count() if total is None else total
    each, more = divmod(n, parts)
    at = F.col(ordinal)
    first = more * (each + 1)
    part = F.when(at < first, F.floor(at / (each + 1)))
    part = part.otherwise(F.lit(more) + F.floor((at - first) / each)) if each else part
    return df.withColumn("part", (part + 1).cast("int"))


def shuffled_parts(df: DataFrame, row: str, parts: int, seed: int = 0) -> DataFrame:
    """Adds `part` of a shuffled split: sizes differ by one at most."""
    ranked = rank_in_group(df.withColumn("__all", F.lit(0)), ["__all"], row, "__rank", buckets=4096)
    n = df.count()
    mixed = F.pmod(F.col("__rank") + F.lit(seed), F.lit(max(n, 1)))
    return with_part(ranked.withColumn("__rank", mixed), parts, "__rank", n).drop("__all", "__rank")


def verify_split(original: DataFrame, parts: DataFrame, ordinal: str) -> DataFrame:
    """Rows in one and not in the other, counting repeats: none if the parts hold exactly the original. The ordinal makes order count."""
    columns = original.columns
    lost = original.exceptAll(parts.select(*columns)).withColumn("where", F.lit("lost"))
    return lost.unionByName(parts.select(*columns).exceptAll(original).withColumn("where", F.lit("added")))


def apportion(df: DataFrame, key: str, weight: str, extra: int) -> DataFrame:
    """Adds `share`: one for each row and `extra` more by largest remainder, ties by key; and `first`, the shares before it in the order of key.

    For short lists (clusters, files): they meet in one task."""
    every = Window.partitionBy()
    quota = F.lit(extra) * F.col(weight) / F.sum(weight).over(every)
    first = df.withColumn("__floor", F.floor(quota)).withColumn("__rest", quota - F.floor(quota))
    left = F.lit(extra) - F.sum("__floor").over(every)
    place = F.row_number().over(Window.orderBy(F.desc("__rest"), key))
    given = first.withColumn("share", (F.lit(1) + F.col("__floor") + F.when(place <= left, 1).otherwise(0)).cast("long"))
    return given.withColumn("first", F.coalesce(F.sum("share").over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__floor", "__rest")


def sub_partition(row: Column, parts: Column, seed: int = 0) -> Column:
    """A row's partition among so many, by its hash."""
    return F.pmod(as_unsigned(stable_hash(seed, row)), parts.cast("decimal(20,0)")).cast("long")


def choose_context(row: Column, shares: dict[int, float], seed: int = 0) -> Column:
    """A context length by share: the first whose cumulative share exceeds the row's hash as a fraction; the last takes the rest."""
    u = as_unsigned(stable_hash(seed, row)).cast("double") / F.lit(float(1 << 64))
    out, total = None, 0.0
    lengths = sorted(shares)
    for length in lengths[:-1]:
        total += shares[length]
        out = F.when(u < total, length) if out is None else out.when(u < total, length)
    return F.lit(lengths[0]) if out is None else out.otherwise(lengths[-1])
