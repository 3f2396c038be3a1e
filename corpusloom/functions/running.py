"""Ranks and running sums within groups of any size.

A window over a group puts the group in one task.  Here each group is dealt over BUCKETS by a
hash of the row's id; the window runs within a bucket, and the sums of the buckets before it are
added.  The order within a group is (bucket, id): fixed, and as good as any for sampling and
matching by rank."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets a group is dealt over at least.
BUCKETS = 256


#: Rows of a bucket, were all rows in one group.
BUCKET_ROWS = 100_000


def buckets_for(df: DataFrame) -> int:
    """Buckets that hold BUCKET_ROWS rows at most, but for chance.  Counts df: give it a stored table."""
    return max(BUCKETS, -(-df.count() // BUCKET_ROWS))


def running_sum(df: DataFrame, groups: list[str], row: str, value: Column, into: str, buckets: int = BUCKETS) -> DataFrame:
    """Adds `into`: the sum of value over the rows of the group before this one (0 for the first).

    row must tell rows of a group apart, or their order is arbitrary.  Null groups are groups;
    null values count as 0."""
    held = df.withColumn("__v", F.coalesce(value, F.lit(0))).withColumn("__b", F.pmod(F.xxhash64(F.col(row)), F.lit(buckets)).cast("int"))
    sums = held.groupBy(*groups, "__b").agg(F.sum("__v").alias("__s"))
    before = Window.partitionBy(*groups).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*(F.col(g).alias(f"__{g}") for g in groups), F.col("__b").alias("__ob"), F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__o"))
    same = F.col("__b") == F.col("__ob")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
    within = Window.partitionBy(*groups, "__b").orderBy(row).rowsBetween(Window.unboundedPreceding, -1)
    part = held.withColumn("__p", F.coalesce(F.sum("__v").over(within), F.lit(0)))
    return part.join(offsets, same).withColumn(into, F.col("__p") + F.col("__o")).drop("__v", "__b", "__p", "__o", "__ob", *(f"__{g}" for g in groups))


def rank_in_group(df: DataFrame, groups: list[str], row: str, into: str, buckets: int = BUCKETS) -> DataFrame:
    """Adds `into`: 0, 1, 2 ... within each group."""
    return running_sum(df, groups, row, F.lit(1), into, buckets)


def ordinal_by_key(df: DataFrame, key: str, into: str = "ordinal", parts: int = 1024) -> DataFrame:
    """Adds `into`: the position, from 0, in the order of a whole-number key that is unique.

    Rows are ranked within ranges that hold about the same number of rows, whatever the keys are: dense, sparse or
    hashed; the ranges' counts, one row each, give the offsets.  Null keys come first."""
    found = df.select(F.percentile_approx(key, [i / parts for i in range(1, parts)], 10 * parts).alias("e")).first()["e"] or []
    edges = [-math.inf, *sorted({float(e) for e in found}), math.inf]
    binned = Bucketizer(splits=edges, inputCol="__k", outputCol="__k2").transform(df.withColumn("__k", F.coalesce(F.col(key).cast("double"), F.lit(0.0)))) if len(edges) > 2 else df.withColumn("__k", F.lit(0.0)).withColumn("__k2", F.lit(0.0))
    held = binned.withColumn("__b", F.when(F.col(key).isNull(), -1).otherwise(F.col("__k2").cast("int"))).drop("__k", "__k2")
    counts = held.groupBy("__b").agg(F.count("*").alias("__n"))
    order = Window.partitionBy(F.lit(0)).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("__b").alias("__ob"), F.coalesce(F.sum("__n").over(order), F.lit(0)).alias("__o"))
    within = Window.partitionBy("__b").orderBy(key)
    return held.withColumn("__r", F.row_number().over(within) - 1).join(offsets, F.col("__b") == F.col("__ob")).withColumn(into, F.col("__r") + F.col("__o")).drop("__b", "__r", "__ob", "__o")
