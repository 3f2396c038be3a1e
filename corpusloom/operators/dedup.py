"""Exact and near duplicates."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normal_text, text_hash
from ..session import drop, stored

#: Words of a shingle, and the similarity that near duplicates have at least.
WORDS, SIMILAR = 5, 0.8
#: Entries of the frequency table, as a power of two: 4 MB; it only moves cost, not results.
TABLE_BITS = 20
#: Ranges its counts are added up by, and bits of the bitmap of rows whose sets are compared, as a power of two: 2 MB.
SPANS, BITMAP_BITS = 16, 24
#: Odd factors of the words of a run.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
#: Rows of a bucket up to which its pairs are listed, and rows of a block of a larger one.
LISTED, BLOCK_ROWS = 256, 3_000


def exact_report(df: DataFrame, text: Column) -> DataFrame:
    """total, distinct_texts, duplicates and null_texts; null texts count as one empty text."""
    counted = df.agg(F.count("*").alias("total"), F.count_distinct(text_hash(text)).alias("distinct_texts"), F.count_if(text.isNull()).alias("null_texts"))
    return counted.select("total", "distinct_texts", (F.col("total") - F.col("distinct_texts")).alias("duplicates"), "null_texts")


def exact_classes(df: DataFrame, row: str, text: Column) -> DataFrame:
    """(row, keep): the smallest row id with the same text.  Partial minima come before the shuffle, so a text that a third of the rows repeat is cheap."""
    hashed = df.select(row, text_hash(text).alias("h"))
    lead = hashed.groupBy("h").agg(F.min(row).alias("keep"))
    return hashed.join(lead, "h").select(row, "keep")


def reconciled(classes: DataFrame, row: str, keep: str, declared: int | None = None) -> DataFrame:
    """examined, kept, removed, declared and whether they add up: what was examined was kept or removed, and is what was declared."""
    sums = classes.agg(F.count("*").alias("examined"), F.count_if(F.col(row) == F.col(keep)).alias("kept"), F.count_if(F.col(row) != F.col(keep)).alias("removed"))
    said = sums.withColumn("declared", F.lit(declared).cast("long"))
    return said.withColumn("reconciled", (F.col("examined") == F.col("kept") + F.col("removed")) & F.coalesce(F.col("declared") == F.col("examined"), F.lit(True)))


def survivors(df: DataFrame, row: str, text: Column) -> DataFrame:
    """(row): the smallest row id of each text."""
    return df.select(row, text_hash(text).alias("h")).groupBy("h").agg(F.min(row).alias(row)).select(row)


def first_rows(df: DataFrame, row: str, text: Column, keep: list[Column]) -> DataFrame:
    """The row with the smallest id of each text, with the columns in keep: one pass, and only the ids, hashes and kept columns are shuffled."""
    kept = df.select(text_hash(text).alias("h"), F.struct(F.col(row), *keep).alias("r"))
    return kept.groupBy("h").agg(F.min("r").alias("r")).select("r.*")


def _runs(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash): 64-bit hashes of the runs of five words of each text, words parted by one space; a shorter text is one run."""
    split = pc.split_pattern(texts, " ")
    count = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = split.flatten().dictionary_encode()
    names = b"".join(blake2b(w.encode(), digest_size=8).digest() for w in flat.dictionary.to_pylist())
    code = np.append(np.frombuffer(names, np.uint64)[flat.indices.to_numpy(zero_copy_only=False)], np.zeros(words, np.uint64))
    runs, ends = np.maximum(count - words + 1, 1), np.cumsum(count)
    doc = np.repeat(np.arange(len(count)), runs)
    at = np.arange(len(doc)) + ((ends - count) - (np.cumsum(runs) - runs))[doc]
    out = np.zeros(len(doc), np.uint64)
    for i in range(words):
        out += np.where(at + i < ends[doc], code[at + i], np.uint64(0)) * np.uint64(FACTORS[i])
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        out = (out ^ (out >> np.uint64(33))) * np.uint64(factor)
    return doc, out ^ (out >> np.uint64(33))


def _places(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << TABLE_BITS, np.uint32)
    for b in batches:
        counts += np.bincount(_places(_runs(b.column("text"))[1]), minlength=len(counts)).astype(np.uint32)
    spans = np.split(counts, SPANS)
    yield pa.RecordBatch.from_arrays([pa.array(range(SPANS), pa.int32()), pa.array([x.tobytes() for x in spans], pa.binary())], ["span", "n"])


def _added(table: pa.Table) -> pa.Table:
    total = np.zeros((1 << TABLE_BITS) // SPANS, np.uint64)
    for n in table.column("n"):
        total += np.frombuffer(n.as_py(), np.uint32)
    return pa.table({"span": table.column("span")[:1], "n": pa.array([np.minimum(total, (1 << 32) - 1).astype(np.uint32).tobytes()], pa.binary())})


def _frequencies(texts: DataFrame) -> bytes:
    """How often shingles occur, over all rows, in a table of fixed size."""
    got = texts.select("text").mapInArrow(_counted, "span int, n binary").groupBy("span").applyInArrow(_added, "span int, n binary").collect()
    found = {r["span"]: bytes(r["n"]) for r in got}
    return b"".join(found.get(i, bytes((4 << TABLE_BITS) // SPANS)) for i in range(SPANS))


def _prefixes(table, similar: float):
    """Row, number of shingles, and each shingle of the prefix with its place in the set's order: two sets as similar as that share one of their rarest
    n - ceil(similar * n) + 1 shingles, in any order that is the same for all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.frombuffer(table.value, np.uint32)
        for b in batches:
            doc, flat = _runs(b.column("text"))
            order = np.lexsort((flat, doc << 32 | often[_places(flat)]))
            doc, flat = doc[order], flat[order]
            first = np.append(True, (flat[1:] != flat[:-1]) | (doc[1:] != doc[:-1]))[: len(doc)]
            doc, flat = doc[first], flat[first]
            n = np.bincount(doc, minlength=b.num_rows)
            prefix = n - np.ceil(similar * n - 1e-9).astype(np.int64) + 1
            at = np.arange(len(doc)) - (np.cumsum(n) - n)[doc]
            kept = at < prefix[doc]
            of = doc[kept]
            yield pa.RecordBatch.from_arrays([b.column("row").take(pa.array(of)), pa.array(n[of].astype(np.int32)), pa.array(at[kept].astype(np.int32)), pa.array(flat[kept].view(np.int64))], ["row", "size", "at", "key"])

    return run


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, sorted by key, whose key the row before or after has too; only one row is held back."""
    held, hit = None, False
    for b in batches:
        if not b.num_rows:
            continue
        b = b if held is None else pa.concat_batches([held, b])
        key = b.column("key").to_numpy()
        same = np.append(key[1:] == key[:-1], False)
        both = same | np.append(hit, same[:-1])
        yield b.slice(0, b.num_rows - 1).filter(pa.array(both[:-1]))
        held, hit = b.slice(b.num_rows - 1), bool(both[-1])
    if hit:
        yield held


def _sets_of(wanted: DataFrame, texts: DataFrame, kind: str) -> DataFrame:
    """(row, shingles) of the wanted rows, and of a few others: a bitmap of fixed size picks them, so texts are never shuffled."""
    place = F.pmod(F.xxhash64("row"), F.lit(1 << BITMAP_BITS))
    bits = wanted.select(place.alias("p")).groupBy(F.shiftright("p", 5).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 32 as int)))").alias("bits")).toArrow()
    words = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    words[bits.column("word").to_numpy()] = bits.column("bits").to_numpy().astype(np.uint32)
    sent = texts.sparkSession.sparkContext.broadcast(words.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.frombuffer(sent.value, np.uint32)
        for b in batches:
            p = b.column("p").to_numpy()
            b = b.filter(pa.array((marked[p >> 5] >> (p & 31).astype(np.uint32)) & 1 == 1))
            if b.num_rows:
                doc, flat = _runs(b.column("text"))
                order = np.lexsort((flat, doc))
                doc, flat = doc[order], flat[order]
                first = np.append(True, (flat[1:] != flat[:-1]) | (doc[1:] != doc[:-1]))
                ends = np.append(0, np.cumsum(np.bincount(doc[first], minlength=b.num_rows))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[first].view(np.int64)))], ["row", "shingles"])

    return texts.select("row", place.alias("p"), "text").mapInArrow(run, f"row {kind}, shingles array<bigint>")


def _linker(similar: float):
    """Links (a, b) that connect all rows of a bucket, or of two of its blocks, that chains of similar pairs connect."""

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf["row"].to_numpy()
        size = np.array([len(x) for x in pdf["shingles"]])
        _, flat = np.unique(np.concatenate(pdf["shingles"].to_list()), return_inverse=True)
        starts = np.cumsum(size) - size
        sets = np.split(flat, starts[1:])
        left, has = np.ones(len(rows), bool), np.zeros(int(flat.max()) + 1, np.int64)
        a, b = [], []
        for first in range(len(rows)):
            todo = [first] if left[first] else []
            left[first] = False
            while todo and left.any():  # each row meets all that nothing is linked to yet
                x = todo.pop()
                rest = np.flatnonzero(left)
                has[sets[x]] = 1
                shared = np.add.reduceat(has[np.concatenate([sets[i] for i in rest])], np.cumsum(size[rest]) - size[rest])
                has[sets[x]] = 0
                hit = rest[shared >= similar * (size[x] + size[rest] - shared)]
                left[hit] = False
                todo += hit.tolist()
                a += [rows[x]] * len(hit)
                b += rows[hit].tolist()
        return pd.DataFrame({"a": a, "b": b})

    return link


def near_duplicates(df: DataFrame, row: str, text: str, similar: float = SIMILAR) -> DataFrame:
    """(row, class_id, keep): near duplicates share the smallest row id of their class; keep is true for that row.

    Exact copies are one row from the start.  Rows whose sets of five-word shingles have a Jaccard similarity
    of `similar` or more share a shingle of their prefixes, so comparing all rows of each such bucket misses
    no link.  Pairs of small buckets are listed, each once, and those that share too few shingles of their prefixes to be
    that similar are left out; only the rest have their sets compared.  Large buckets are connected block by block.  Classes are the
    connected components.  Null and empty texts are one class.  row must be unique and castable to string order."""
    kind = dict(df.select(F.col(row)).dtypes)[row]
    normal = df.select(F.col(row).alias("row"), normal_text(F.col(text)).alias("text"))
    texts = stored(normal.select("row", text_hash(F.col("text")).alias("h"), F.lower(F.coalesce("text", F.lit(""))).alias("text")), "texts")
    copies = stored(exact_classes(texts, "row", F.col("h")), "copies")
    table = texts.sparkSession.sparkContext.broadcast(_frequencies(texts))
    entry = f"row {kind}, size int, at int, key bigint"
    prefixes = texts.select("row", "text").mapInArrow(_prefixes(table, similar), entry)
    shared = stored(prefixes.repartition("key").sortWithinPartitions("key").mapInArrow(_several, entry), "shared")
    led = stored(shared.join(copies.where("row = keep").select("row"), "row", "left_semi"), "led")
    drop(shared)
    members = stored(led.join(led.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key"), "buckets")
    drop(led)
    listed = members.where(F.col("n") <= LISTED).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("row", "size", "at"))).alias("m"))
    each = listed.select("m", F.explode("m").alias("x")).select("x", F.explode("m").alias("y")).where("x.row < y.row")
    sized = each.where(F.least("x.size", "y.size") >= similar * F.greatest("x.size", "y.size") - 1e-9)
    placed = sized.where(F.least("x.at", "y.at") + F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at")) >= similar / (1 + similar) * (F.col("x.size") + F.col("y.size")) - 1e-9)
    counted = placed.groupBy(F.col("x.row").alias("lead"), F.col("y.row").alias("row"), F.col("x.size").alias("u"), F.col("y.size").alias("v")).agg(F.count("*").alias("c"), F.max("x.at").alias("i"), F.max("y.at").alias("j"))
    # what else a pair shares comes, in both sets, after the last shingle that their prefixes share, and after one of the prefixes; a pair that shares a large bucket too is connected there
    least = F.ceil(similar / (1 + similar) * (F.col("u") + F.col("v")) - 1e-9)
    stars = stored(counted.where(F.col("c") + F.least(F.col("u") - F.col("i"), F.col("v") - F.col("j"), F.ceil(similar * F.greatest("u", "v") - 1e-9)) - 1 >= least).select("lead", "row"), "pairs")
    large = members.where(F.col("n") > LISTED)
    sets = stored(_sets_of(stars.select("row").unionByName(stars.select(F.col("lead").alias("row"))).unionByName(large.select("row")), texts, kind), "shingles")
    drop(texts)
    left = stars.join(sets, "row").select("row", "lead", F.col("shingles").alias("s"))
    both = left.join(sets.select(F.col("row").alias("lead"), F.col("shingles").alias("t")), "lead")
    large = large.withColumn("parts", F.ceil(F.col("n") / BLOCK_ROWS).cast("int")).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    meeting = large.withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("key", "row", F.least("part", "meets").alias("i"), F.greatest("part", "meets").alias("j")).join(sets, "row")
    chained = meeting.groupBy("key", "i", "j").applyInPandas(_linker(similar), f"a {kind}, b {kind}")
    shared = F.size(F.array_intersect("s", "t"))
    direct = both.where(shared >= similar * (F.size("s") + F.size("t") - shared)).select(F.col("row").alias("a"), F.col("lead").alias("b"))
    links = stored(direct.unionByName(chained), "links")
    classes = components(links)
    for done in (members, stars, sets):
        drop(done)
    named = copies.join(classes.select(F.col("node").alias("keep"), "component"), "keep", "left").select("row", F.coalesce("component", "keep").alias("class_id"))
    return named.select(F.col("row").alias(row), "class_id", (F.col("row") == F.col("class_id")).alias("keep"))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node is connected to, by alternating large and small stars.

    links: a, b.  Each round sends a node's neighbours to its smallest one; the number of rounds grows
    with the logarithm of the longest chain.  Partial minima keep hubs from gathering in one task; what
    each round yields is written to the shared folder."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.where("a <> b").distinct()
        floor = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(floor, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(floor.select("a", F.col("m").alias("b")))
        new = stored(small.distinct(), "edges")
        drop(edges)
        state = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        edges = new
        if state == before:
            break
        before = state
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").unionByName(own)
