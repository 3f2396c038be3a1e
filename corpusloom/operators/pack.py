"""Token sequences into training samples of fixed context length, best fit first."""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import stable_hash
from ..session import stored
from .sampling import sub_partition

#: Open groups of a task, documents of a sample, and of these from one host.
MAX_OPEN, MAX_DOCUMENTS, MAX_SAME_HOST = 4096, 32, 2
#: Label of positions that don't count in the loss.
IGNORED = -100
#: Chunks of a bucket, were none packed in the first round.
BUCKET_CHUNKS = 200_000

SEGMENT = "doc_id string, chunk int, host string, cluster int, n int"
GROUP = f"context int, partition long, full boolean, segments array<struct<{SEGMENT.replace(' ', ':').replace(',:', ',')}>>"


def split_document(ids: Column, context: int) -> Column:
    """Chunks of at most context - 1 ids, so that each has room for EOS; a document without ids is one empty chunk."""
    size = context - 1
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(ids) - 1, F.lit(0)), F.lit(size)), lambda i: F.slice(ids, i + 1, size))


def segments(df: DataFrame, contexts: Sequence[int], ids: str = "input_ids") -> DataFrame:
    """One row for each chunk of a document: doc_id, host, cluster, context, partition, chunk, ids. df has all but the last two and `input_ids`.

    contexts: the lengths that `context` can have, a setting of the run."""
    chunks = F.array().cast("array<array<int>>")
    for c in contexts:
        chunks = F.when(F.col("context") == c, split_document(F.col(ids), c)).otherwise(chunks)
    return df.select("doc_id", "host", "cluster", "context", "partition", F.posexplode(chunks).alias("chunk", "ids"))


@dataclass
class Group:
    """Segments that go together: (doc_id, chunk, host, cluster, n)."""

    parts: list[tuple]
    hosts: Counter = field(default_factory=Counter)
    used: int = 0

    @classmethod
    def of(cls, parts: list[tuple]) -> Group:
        """A missing host counts as one of its own."""
        return cls(parts, Counter(p[2] or f"{p[0]}/{p[1]}" for p in parts), sum(p[4] + 1 for p in parts))


def best_fit(groups: Iterator[Group], context: int, max_open: int = MAX_OPEN, max_documents: int = MAX_DOCUMENTS, max_same_host: int = MAX_SAME_HOST) -> tuple[list[Group], list[Group]]:
    """(full groups, what is left over): each group joins the open one it leaves least room in, the oldest on ties.

    Open groups are kept by room, so only those with just enough are looked at."""
    rooms: list[int] = []  # rooms of open groups, ascending
    at: dict[int, list[int]] = {}  # room -> ages, ascending
    open_: dict[int, Group] = {}
    full: list[Group] = []
    spilled: list[Group] = []
    age = 0

    def put(n: int, g: Group) -> None:
        room = context - g.used
        if room not in at:
            bisect.insort(rooms, room)
            at[room] = []
        bisect.insort(at[room], n)
        open_[n] = g

    def take(n: int) -> Group:
        g = open_.pop(n)
        room = context - g.used
        at[room].remove(n)
        if not at[room]:
            del at[room]
            rooms.remove(room)
        return g

    for g in groups:
        if g.used > context:
            raise ValueError("a group larger than its context")
        found = None
        for room in rooms[bisect.bisect_left(rooms, g.used) :]:
            found = next((n for n in at[room] if len(open_[n].parts) + len(g.parts) <= max_documents and all(open_[n].hosts[h] + c <= max_same_host for h, c in g.hosts.items())), None)
            if found is not None:
                break
        if found is not None:
            old = take(found)
            g = Group(old.parts + g.parts, old.hosts + g.hosts, old.used + g.used)
            if g.used == context:
                full.append(g)
            else:
                put(found, g)
        elif g.used == context:
            full.append(g)
        elif len(open_) < max_open:
            put(age, g)
            age += 1
        else:
            spilled.append(g)
    left = sorted([*open_.values(), *spilled], key=lambda g: (-g.used, g.parts[0][0], g.parts[0][1]))
    return full, left


def _packer(limits: dict, last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        context, partition = int(pdf["context"].iloc[0]), int(pdf["partition"].iloc[0])
        rows = sorted(zip(pdf["order"], pdf["segments"], strict=True), key=lambda x: x[0])
        groups = (Group.of([(s["doc_id"], s["chunk"], s["host"], s["cluster"], s["n"]) for s in parts]) for _, parts in rows)
        full, left = best_fit(groups, context, **limits)
        made = [(context, partition, True, g.parts) for g in full] + [(context, partition, last, g.parts) for g in left]
        names = [x.split()[0] for x in SEGMENT.split(", ")]
        return pd.DataFrame([(c, p, f, [dict(zip(names, s, strict=True)) for s in parts]) for c, p, f, parts in made], columns=["context", "partition", "full", "segments"])

    return run


def pack_round(groups: DataFrame, partition: Column, limits: dict | None = None, last: bool = False) -> DataFrame:
    """Pack the groups of each (context, partition) in one task; `full` groups are done.  last: what is left counts as done, to be padded.

    partition must bound what meets in a task: the plan of partitions and the hash buckets do."""
    placed = groups.select("context", partition.cast("long").alias("partition"), "segments", "order")
    return placed.groupBy("context", "partition").applyInPandas(_packer(limits or {}, last), GROUP)


def _order(first: bool) -> Column:
    s = F.get("segments", F.lit(0))
    if first:
        return F.concat(stable_hash("pack", F.col("partition"), s["doc_id"]), F.lit("/"), s["doc_id"], F.format_string("/%09d", s["chunk"]))
    used = F.aggregate("segments", F.lit(0), lambda a, x: a + x["n"] + 1)
    return F.concat(F.format_string("%012d", F.lit(10**11) - used), F.lit("/"), s["doc_id"], F.format_string("/%09d", s["chunk"]))


def pack_all(parts: DataFrame, buckets: int | None = None, limits: dict | None = None) -> DataFrame:
    """All rounds: within a physical partition, then within a cluster, then across clusters by hash; the rest is padded.

    parts: what segments() gives, stored.  Returns context and segments of each sample.  Unless told, a bucket is meant to get
    BUCKET_CHUNKS chunks, so what meets in a task doesn't grow with the corpus."""
    if buckets is None:
        buckets = max(64, -(-parts.count() // BUCKET_CHUNKS))
    one = F.array(F.struct(F.col("doc_id").cast("string").alias("doc_id"), F.col("chunk").cast("int").alias("chunk"), F.col("host").alias("host"), F.col("cluster").cast("int").alias("cluster"), F.size("ids").alias("n")))
    start = parts.select("context", "partition", one.alias("segments"))
    done: DataFrame | None = None
    for r in range(3):
        lead = F.get("segments", F.lit(0))
        # a cluster's leftovers are dealt over buckets too, so that a cluster of a third of all documents isn't one task
        dealt = sub_partition(F.concat_ws("/", lead["doc_id"], lead["chunk"].cast("string")), F.lit(buckets), r)
        where = F.col("partition") if r == 0 else lead["cluster"].cast("long") * buckets + dealt if r == 1 else dealt
        packed = pack_round(start.withColumn("order", _order(r == 0)), where, limits, last=r == 2)
        packed = stored(packed, "packs")
        finished = packed.where("full").select("context", "segments")
        done = finished if done is None else done.unionByName(finished)
        start = packed.where("not full").select("context", "partition", "segments")
    return done


def materialise(samples: DataFrame, parts: DataFrame, eos: int, pad: int, eos_in_loss: bool = True) -> DataFrame:
    """pack_id, context, input_ids, labels, attention_mask, cluster_id (-1 when mixed), n_segments and n_source of each sample.

    A sample's chunks are joined to their ids by document and chunk and put in order again."""
    lead = F.get("segments", F.lit(0))
    named = samples.withColumn("pack_id", stable_hash("pack", F.col("context"), F.array_join(F.transform("segments", lambda s: F.concat_ws("/", s["doc_id"], s["chunk"].cast("string"))), ",")))
    places = named.select("pack_id", "context", F.posexplode("segments").alias("at", "s")).select("pack_id", "context", "at", "s.doc_id", "s.chunk", "s.cluster")
    with_ids = places.join(parts.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("chunk").cast("int").alias("chunk"), "ids"), ["doc_id", "chunk"])
    joined = with_ids.groupBy("pack_id", "context").agg(F.sort_array(F.collect_list(F.struct("at", "ids", "cluster"))).alias("p"))  # at most MAX_DOCUMENTS
    end = F.array(F.lit(eos))
    ids = F.flatten(F.transform("p", lambda x: F.concat(x["ids"], end)))
    loss = F.flatten(F.transform("p", lambda x: F.concat(x["ids"], end if eos_in_loss else F.array(F.lit(IGNORED)))))
    gap = F.col("context") - F.size(ids)
    clusters = F.array_distinct(F.transform("p", lambda x: x["cluster"]))
    return joined.select(
        "pack_id", "context", F.concat(ids, F.array_repeat(F.lit(pad), gap)).alias("input_ids"), F.concat(loss, F.array_repeat(F.lit(IGNORED), gap)).alias("labels"),
        F.concat(F.array_repeat(F.lit(1).cast("byte"), F.size(ids)), F.array_repeat(F.lit(0).cast("byte"), gap)).alias("attention_mask"),
        F.when(F.size(clusters) == 1, F.get(clusters, F.lit(0))).otherwise(-1).alias("cluster_id"), F.size("p").alias("n_segments"), F.aggregate("p", F.lit(0), lambda a, x: a + F.size(x["ids"])).alias("n_source"),
    )


def accounts(samples: DataFrame, parts: DataFrame) -> DataFrame:
    """Whether every chunk is in exactly one sample and every token is there: packs, segments, source_tokens, capacity, pad_tokens, complete."""
    placed = samples.select("context", "segments", F.size("segments").alias("k"), F.aggregate("segments", F.lit(0), lambda a, s: a + s["n"]).alias("n"))
    got = placed.agg(F.count("*").alias("packs"), F.sum("k").alias("segments"), F.sum("n").alias("source_tokens"), F.sum("context").alias("capacity"))
    distinct = samples.select(F.explode("segments").alias("s")).agg(F.count_distinct("s.doc_id", "s.chunk").alias("distinct_segments"))
    want = parts.agg(F.count("*").alias("want_segments"), F.sum(F.size("ids")).alias("want_tokens"))
    one = got.join(F.broadcast(distinct), F.lit(True)).join(F.broadcast(want), F.lit(True))  # one row each
    complete = (F.col("segments") == F.col("want_segments")) & (F.col("distinct_segments") == F.col("want_segments")) & (F.col("source_tokens") == F.col("want_tokens"))
    return one.select("packs", "segments", "source_tokens", "capacity", (F.col("capacity") - F.col("source_tokens") - F.col("segments")).alias("pad_tokens"), complete.alias("complete"))
