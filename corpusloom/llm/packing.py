"""Documents into containers of fixed capacity: shortest-pack-first over the histogram of lengths.

Only the histogram, with at most `capacity` entries, is planned on the driver.  The plan says how
many containers hold which lengths; documents of a length are then told apart by their rank, which
is computed across the cluster, and take their places by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.running import buckets_for, rank_in_group


#: Bytes of a plan that is sent to every task.  It has at most `capacity` lengths, whatever the number of documents: 32,768 tokens need
#: 14 MB for 200,000,000 documents.
PLAN_BYTES = 256 << 20


def plan_packs(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(number of containers, lengths in each): all lengths, longest first, each into the open pattern with most room.

    Patterns with the same room are used in the order they came up.  Room for nothing closes a pattern."""
    room: dict[int, list[list]] = {}
    closed: list[tuple[int, tuple]] = []
    widest = 0  # no open pattern has more room than this

    def put(space: int, count: int, lengths: tuple) -> None:
        nonlocal widest
        if space <= 0:
            closed.append((count, lengths))
            return
        room.setdefault(space, []).append([count, lengths])
        widest = max(widest, space)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while widest and not room.get(widest):
                room.pop(widest, None)
                widest -= 1
            if widest < length:  # open no more containers than this length can fill
                opened = -(-left // (capacity // length))
                left -= opened
                put(capacity - length, opened, (length, None))
                continue
            group = room[widest][0]
            used = min(left, group[0])
            group[0] -= used
            if not group[0]:
                room[widest].pop(0)
            left -= used
            put(widest - length, used, (length, group[1]))
    plan = closed + [(count, lengths) for groups in room.values() for count, lengths in groups if count]
    return [(count, _unlinked(lengths)) for count, lengths in plan]


def _unlinked(lengths: tuple | None) -> tuple[int, ...]:
    """The lengths of a pattern, which is kept as (last length, what came before) so that adding one copies nothing."""
    out = []
    while lengths is not None:
        out.append(lengths[0])
        lengths = lengths[1]
    return tuple(reversed(out))


def places(plan: list[tuple[int, tuple[int, ...]]], first: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(length, first rank, first container, start in the container) of each run of ranks, ordered by length and rank."""
    next_rank: dict[int, int] = {}
    rows, container = [], first
    for count, lengths in plan:
        start = 0
        seen: dict[int, int] = {}
        for length in lengths:
            rows.append((length, next_rank.get(length, 0) + seen.get(length, 0) * count, container, start))
            seen[length] = seen.get(length, 0) + 1
            start += length
        for length, times in seen.items():
            next_rank[length] = next_rank.get(length, 0) + times * count
        container += count
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    return columns[0], columns[1], columns[2], columns[3]


def pieces_of(documents: DataFrame, capacity: int) -> DataFrame:
    """doc_id, part, first_token and length of each piece: one for a document that fits, else full pieces and what remains."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(capacity))).cast("int")
    cut = documents.select("doc_id", "tokens", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    start = F.col("part").cast("long") * capacity
    return cut.select("doc_id", "part", start.alias("first_token"), F.least(F.lit(capacity).cast("long"), F.col("tokens") - start).alias("length"))


_PACKED = "doc_id long, part int, first_token long, length long, pack_no long, start long"


def pack(documents: DataFrame, capacity: int) -> DataFrame:
    """Which container each document, or each piece of a document larger than the container, goes into.

    documents: doc_id (unique), tokens.  Returns doc_id, part, first_token, length, pack_no (from 0) and
    start (in the container).  A document without tokens, or with a null count, takes no room and goes
    into no container.  Documents of one length are exchangeable; they take their places in the order
    of a hash of doc_id.  An empty table gives no containers."""
    if capacity < 1:
        raise ValueError("a container must hold at least one token")
    items = pieces_of(documents.where("tokens > 0"), capacity)
    whole = items.where(F.col("length") == capacity)
    loose = items.where(F.col("length") < capacity)
    counts = {int(r["length"]): int(r["n"]) for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    full = counts.pop(capacity, 0)
    runs = places(plan_packs(counts, capacity), full)
    if sum(x.nbytes for x in runs) > PLAN_BYTES:
        raise ValueError(f"a plan for {capacity} tokens needs more than {PLAN_BYTES} bytes in every task")
    table = documents.sparkSession.sparkContext.broadcast(runs)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, ranks, containers, starts = table.value
        key = lengths * (1 << 40) + ranks if len(lengths) else lengths
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(key, length * (1 << 40) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(containers[at] + rank - ranks[at]), pa.array(starts[at])], [*b.schema.names[:4], "pack_no", "start"])

    buckets = buckets_for(documents)
    named = F.concat_ws("/", "doc_id", "part")
    ranked = rank_in_group(loose.withColumn("piece", named), ["length"], "piece", "rank", buckets).select("doc_id", "part", "first_token", "length", F.col("rank").cast("long"))
    alone = rank_in_group(whole.withColumn("piece", named), ["length"], "piece", "rank", buckets).select("doc_id", "part", "first_token", "length", F.col("rank").cast("long").alias("pack_no"), F.lit(0).cast("long").alias("start"))
    return alone.unionByName(ranked.mapInArrow(place, _PACKED))


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """packs, least (the fewest that could hold all tokens), tokens, unused tokens and the share of room used."""
    sums = packed.agg(F.coalesce(F.max("pack_no") + 1, F.lit(0)).alias("packs"), F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"))
    space = F.col("packs") * capacity
    return sums.select("packs", F.ceil(F.col("tokens") / capacity).alias("least"), "tokens", (space - F.col("tokens")).alias("unused"), F.when(space > 0, F.round(F.col("tokens") / space, 6)).alias("used_share"))
