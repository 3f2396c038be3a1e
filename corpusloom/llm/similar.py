"""Groups of records that deal with the same matter, by bisecting k-means.

1. Each text becomes the set of its words and numbers (pairs of characters for Han script), as
   32-bit hashes.  Exact copies of a text are put aside: one of them represents the rest.
2. Frequencies are counted over all records in a table of fixed size, 2**BUCKET_BITS bytes.
3. A record's vector for clustering holds the TOP rarest features that it shares with others,
   weighted by a power of their idf; its whole set of features stays beside it for the exact check.
4. Nodes are bisected level by level, all open nodes of a level in the same jobs: Lloyd iterations
   whose sums are added up by feature range, until a node is compact or has NODE_ROWS rows; what is
   left of it is bisected on in one task, by the same rule.
5. An exact check on the whole sets connects the records of a leaf; what it connects is a fragment.
6. A split may tear a matter apart.  So the fragments, each with its centre and its most typical
   record, are bisected again, PASSES times from other starts, and those that meet in a leaf
   and pass the exact check become one.
7. TOP features and a heuristic decide so far who meets whom.  What they miss is found exactly: all pairs
   of records in different groups whose whole vectors, without TOP, are similar to NEAR, by a prefix filter.
   Where such a pair passes the exact check, and the most typical records of both groups do, the groups become one.

No step compares all rows of a large group: a leaf is checked in blocks of BLOCK_ROWS rows, and the
passes over fragments connect the blocks.  Only similar_pairs, which lists pairs, does, block by block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import components
from ..session import drop, stored
from .bisect import ATTEMPTS, ROUNDS, bisect, coin, take

#: Entries of the frequency table, as a power of two: 16 MB as bytes.
BUCKET_BITS = 24
#: Features of a vector for clustering; the exact check has all of them.
TOP = 8
#: Powers of the idf that weigh a feature in clustering and in the exact check.
POWER_CLUSTER, POWER_CHECK = 4.0, 2.0
#: Mean similarity at which a node is a leaf.
COMPACT = 0.3
#: Similarity that connects two records, and the one that two records of a group need to be a pair.
LINK, PAIR = 0.35, 0.2
#: Passes over the fragments.
PASSES = 3
#: Similarity of two whole vectors for clustering at which records that pass the exact check are of one group, whatever leaves they are in.
NEAR = 0.5
#: Length of a vector's part that isn't in its head, rounding that bounds allow for, and pairs that are looked at in one piece.
TAIL, SLACK, PIECE = 0.2, 1e-3, 1_000_000
#: Rows of a node that one task bisects on.
NODE_ROWS = 131_072
#: Dimensions of a centre in the cluster's splits, as a power of two: at most 8 MB a plane.
CENTRE_BITS = 20
#: Planes that are broadcast at a time, 64 MB at most; where a level has more, rows and planes are joined by node.
PLANES = 8
#: Rows that are compared with each other in one block.
BLOCK_ROWS = 2_000
#: Rows of a leaf up to which its pairs are listed with it, and up to which leaves are checked many at a time.
LISTED, SMALL = 128, 12
#: Steps of a stored idf to the unit; 255 marks a feature that no other record has.
STEPS, ALONE = 12.0, 255
#: Ranges that sums of features and the frequency table are split into.
RANGES = 64

_HAN = r"\p{Han}"
_SEPARATORS = r"[^\x00-\x7f\p{Latin}\p{Greek}\p{Cyrillic}\p{Arabic}\p{Hebrew}\p{Hangul}\p{Devanagari}\p{Thai}\p{Hiragana}\p{Katakana}]+"  # beyond ASCII
_PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def _han_pairs(text: str) -> list[str]:
    pairs, before = [], ""
    for ch in text:
        han = "㐀" <= ch <= "鿿"
        if han and before:
            pairs.append(before + ch)
        before = ch if han else ""
    return pairs


def _spaced(lower: pa.Array) -> pa.Array:
    """A blank for each separator: ASCII ones by a table over the whole buffer, others by a pattern where there are any."""
    flat = pa.concat_arrays([lower])
    _, offsets, data = flat.buffers()
    if data is None:
        return flat
    plain = pa.StringArray.from_buffers(len(flat), offsets, pa.py_buffer(data.to_pybytes().translate(_PLAIN)))
    beyond = pc.invert(pc.string_is_ascii(plain))
    return pc.replace_with_mask(plain, beyond, pc.replace_substring_regex(plain.filter(beyond), _SEPARATORS, " "))


def feature_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, hashes): the sorted distinct 32-bit features of each text, one text after another."""
    lower = pc.utf8_lower(pc.fill_null(texts, ""))
    words = pc.ascii_split_whitespace(_spaced(lower))
    flat = words.flatten().dictionary_encode()
    names = flat.dictionary.to_pylist()
    codes = np.fromiter((zlib.crc32(n.encode()) for n in names), np.uint64, len(names))
    keep = np.fromiter((bool(n) for n in names), bool, len(names))
    index = flat.indices.to_numpy(zero_copy_only=False)
    counts = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    key = (doc << np.uint64(32) | codes[index])[keep[index]] if len(names) else np.zeros(0, np.uint64)
    with_han = np.flatnonzero(pc.match_substring_regex(lower, _HAN).to_numpy(zero_copy_only=False))
    more = []
    for i in with_han:
        pairs = set(_han_pairs(lower[int(i)].as_py()))
        more.append(np.fromiter((zlib.crc32(p.encode()) for p in pairs), np.uint64, len(pairs)) | np.uint64(i) << np.uint64(32))
    key = np.concatenate([key, *more])
    key.sort()  # far faster than np.unique, which hashes
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    lengths = np.bincount((key >> np.uint64(32)).astype(np.int64), minlength=len(texts))
    return lengths, (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _binary(lengths: np.ndarray, values: np.ndarray) -> pa.Array:
    """Binary values from the concatenated values of all rows."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths * values.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _values(array: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, values) of a binary column without nulls."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    size = np.dtype(dtype).itemsize
    offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    values = np.frombuffer(data, dtype)[offsets[0] // size : offsets[-1] // size] if data is not None else np.zeros(0, dtype)
    return np.diff(offsets) // size, values


def _batch(**columns) -> pa.RecordBatch:  # noqa: ANN003
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lengths, hashes = feature_sets(b.column("text"))
        yield _batch(id=b.column("id"), text_hash=b.column("text_hash"), body=_binary(lengths, hashes))


# ---- frequencies ------------------------------------------------------------------------------
_PART = "span int, at binary, n binary"
_WIDTH = (1 << BUCKET_BITS) // RANGES


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << BUCKET_BITS, np.uint32)
    for b in batches:
        _, hashes = _values(b.column("body"), np.uint32)
        bucket, n = np.unique(hashes >> np.uint32(32 - BUCKET_BITS), return_counts=True)
        counts[bucket] += n.astype(np.uint32)
    used = [np.flatnonzero(counts[s * _WIDTH : (s + 1) * _WIDTH]).astype(np.uint32) for s in range(RANGES)]
    values = [counts[s * _WIDTH : (s + 1) * _WIDTH][at] for s, at in enumerate(used)]
    yield _batch(span=pa.array(range(RANGES), pa.int32()), at=pa.array([x.tobytes() for x in used], pa.binary()), n=pa.array([x.tobytes() for x in values], pa.binary()))


def _range_steps(rows: int):
    def steps(table: pa.Table) -> pa.Table:
        counts = np.zeros(_WIDTH, np.int64)
        for at, n in zip(table.column("at").to_pylist(), table.column("n").to_pylist(), strict=True):
            counts[np.frombuffer(at, np.uint32)] += np.frombuffer(n, np.uint32)
        idf = np.minimum(np.log(rows / counts.clip(1)), np.log(max(rows / 8, 2)))
        out = np.where(counts == 0, 0, np.where(counts == 1, ALONE, np.clip(np.round(idf * STEPS), 0, ALONE - 1))).astype(np.uint8)
        return pa.table({"span": table.column("span")[:1], "steps": pa.array([out.tobytes()], pa.binary())})

    return steps


def idf_table(features: DataFrame, rows: int) -> np.ndarray:
    """The idf of each bucket in steps; ALONE where one record has the feature.  The driver gets one byte for each bucket, 16 MB."""
    got = features.select("body").mapInArrow(_partial_counts, _PART).groupBy("span").applyInArrow(_range_steps(rows), "span int, steps binary").collect()
    table = np.zeros(1 << BUCKET_BITS, np.uint8)
    for r in got:
        table[r["span"] * _WIDTH : (r["span"] + 1) * _WIDTH] = np.frombuffer(r["steps"], np.uint8)
    return table


def _weighted(lengths: np.ndarray, levels: np.ndarray, cap: float, power: float) -> np.ndarray:
    """Weights of the features of each row, of length one in all."""
    weight = np.maximum(np.where(levels == ALONE, cap, np.minimum(levels / STEPS, cap)), 1e-3) ** power
    doc = np.repeat(np.arange(len(lengths)), lengths)
    return (weight / np.maximum(np.sqrt(np.bincount(doc, weight * weight, len(lengths))), 1e-12)[doc]).astype(np.float32)


_ITEM = "key string, size long, feats binary, weights binary, body binary"


def _to_items(table, cap: float):
    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = np.frombuffer(table.value, np.uint8)
        for b in batches:
            lengths, hashes = _values(b.column("body"), np.uint32)
            level = steps[hashes >> np.uint32(32 - BUCKET_BITS)]
            doc = np.repeat(np.arange(len(lengths)), lengths)
            shared = np.flatnonzero(level != ALONE)  # those of one record alone can't draw records together
            order = shared[np.lexsort((-level[shared].astype(np.int16), doc[shared]))]
            n = np.bincount(doc[order], minlength=len(lengths))
            near = order[np.arange(len(order)) - (np.cumsum(n) - n)[doc[order]] < TOP]
            kept = np.bincount(doc[near], minlength=len(lengths))
            weights = _weighted(kept, level[near], cap, POWER_CLUSTER)
            yield _batch(key=b.column("id"), size=pa.array(np.ones(len(lengths), np.int64)), feats=_binary(kept, hashes[near]), weights=_binary(kept, weights), body=b.column("body"))

    return items


# ---- splits by the whole cluster --------------------------------------------------------------
@dataclass
class Planes:
    """The planes between the halves of some nodes: positions are node number and dimension in one, sorted."""

    nodes: np.ndarray
    tries: np.ndarray
    bias: np.ndarray
    at: np.ndarray
    diff: np.ndarray

    @classmethod
    def of(cls, rows: list[dict]) -> Planes:
        rows = sorted(rows, key=lambda r: r["node"])
        at = [np.frombuffer(r["at"], np.uint32).astype(np.int64) + (i << CENTRE_BITS) for i, r in enumerate(rows)]
        diff = [np.frombuffer(r["diff"], np.float32) for r in rows]
        empty = [np.zeros(0)]
        return cls(
            np.array([r["node"] for r in rows], np.int64), np.array([r["tries"] for r in rows], np.int64), np.array([r["bias"] for r in rows], float),
            np.concatenate(at or empty).astype(np.int64), np.concatenate(diff or empty).astype(np.float32),
        )

    def plain(self) -> tuple:
        """What is broadcast: a worker may read it before it can import this module."""
        return self.nodes, self.tries, self.bias, self.at, self.diff

    def sides(self, part: tuple, node: np.ndarray, ids: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
        """(which rows are in a node that is being split, which of these go to the second half).

        A node without a plane yet starts from a random hyperplane, after ATTEMPTS of them from the rows' ids."""
        indptr, indices, data = part
        n = len(node)
        where = np.minimum(np.searchsorted(self.nodes, node), max(0, len(self.nodes) - 1))
        active = self.nodes[where] == node if len(self.nodes) else np.zeros(n, bool)
        row = np.repeat(np.arange(n), np.diff(indptr))
        has = np.zeros(len(self.nodes), bool)
        has[self.at >> CENTRE_BITS] = True
        score = np.zeros(n)
        if len(self.at):
            key = (where[row] << CENTRE_BITS) | (indices & ((1 << CENTRE_BITS) - 1))
            spot = np.minimum(np.searchsorted(self.at, key), len(self.at) - 1)
            score = np.bincount(row, np.where(self.at[spot] == key, self.diff[spot], 0.0) * data, n)
        side = score > self.bias[where] if len(self.nodes) else np.zeros(n, bool)
        start = active & ~has[where] if len(self.nodes) else np.zeros(n, bool)
        if start.any():
            tries = self.tries[where]
            sign = np.where(coin(indices, salt + 1000 * tries[row]), 1.0, -1.0)
            hyper = np.where(tries < ATTEMPTS, np.bincount(row, data * sign, n) > 0, coin(ids, salt + 1000 * tries))
            side = np.where(start, hyper, side)
        return active, active & side


_SUM = "node long, half int, span int, tries int, rows long, at binary, sum binary"
_PLANE = "node long, tries int, bias double, mean double, at binary, diff binary"
_ROW = "key string, size long, feats binary, weights binary, body binary, hash long, node long"


def _csr(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths, feats = _values(table.column("feats"), np.uint32)
    _, weights = _values(table.column("weights"), np.float32)
    indptr = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=indptr[1:])
    return indptr, feats.astype(np.int64), weights.astype(np.float64)


def _numbers(column) -> np.ndarray:  # noqa: ANN001
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


def _hashes(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    return _numbers(table.column("hash")).astype(np.int64).view(np.uint64)


class _Adder:
    """Sums of rows' vectors by node, half and dimension; what has come in is added up whenever it grows large."""

    def __init__(self) -> None:
        self.keys, self.values, self.held = [], [], 0
        self.rows: dict[tuple[int, int], int] = {}

    def add(self, node: np.ndarray, half: np.ndarray, part: tuple) -> None:
        key = 2 * node + half
        for k, n in zip(*np.unique(key, return_counts=True), strict=True):
            self.rows[int(k)] = self.rows.get(int(k), 0) + int(n)
        row = np.repeat(np.arange(len(node)), np.diff(part[0]))
        self.keys.append((key[row] << CENTRE_BITS) | (part[1] & ((1 << CENTRE_BITS) - 1)))
        self.values.append(part[2])
        self.held += len(row)
        if self.held > 2_000_000:
            self.settle()

    def settle(self) -> None:
        keys, where = np.unique(np.concatenate(self.keys), return_inverse=True)
        self.keys, self.values, self.held = [keys], [np.bincount(where, np.concatenate(self.values), len(keys))], 0

    def batch(self, planes: Planes) -> pa.RecordBatch:
        out: dict[str, list] = {c.split()[0]: [] for c in _SUM.split(", ")}
        if self.keys:
            self.settle()
            keys, values, width = self.keys[0], self.values[0].astype(np.float32), CENTRE_BITS - (RANGES.bit_length() - 1)
            ends = np.flatnonzero(np.append(True, np.diff(keys >> width) != 0).tolist() + [True]) if len(keys) else np.zeros(1, int)
            seen = set()
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                k, span = int(keys[a] >> CENTRE_BITS), int((keys[a] >> width) & (RANGES - 1))
                rows = 0 if k in seen else self.rows[k]
                seen.add(k)
                at = (keys[a:b] & ((1 << width) - 1)).astype(np.uint16)
                for name, v in zip(out, (planes.nodes[k >> 1], k & 1, span, planes.tries[k >> 1], rows, at.tobytes(), values[a:b].tobytes()), strict=True):
                    out[name].append(v)
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))


def _add_span(table: pa.Table) -> pa.Table:
    dense = np.zeros((1 << CENTRE_BITS) // RANGES, np.float64)
    for at, values in zip(table.column("at").to_pylist(), table.column("sum").to_pylist(), strict=True):
        dense[np.frombuffer(at, np.uint16)] += np.frombuffer(values, np.float32)
    used = np.flatnonzero(dense).astype(np.uint16)
    first = table.slice(0, 1)
    rows = pa.array([pc.sum(table.column("rows")).as_py()], pa.int64())
    sums = pa.array([dense[used].astype(np.float32).tobytes()], pa.binary())
    return pa.table([*first.columns[:4], rows, pa.array([used.tobytes()], pa.binary()), sums], names=first.schema.names)


def _to_plane(table: pa.Table) -> pa.Table:
    """The plane between the halves of one node, and the node's mean similarity."""
    width = (1 << CENTRE_BITS) // RANGES
    centre, rows = np.zeros((2, 1 << CENTRE_BITS)), [0, 0]
    tries = 0
    for r in table.to_pylist():
        centre[r["half"], r["span"] * width + np.frombuffer(r["at"], np.uint16).astype(np.int64)] = np.frombuffer(r["sum"], np.float32)
        rows[r["half"]] += r["rows"]
        tries = r["tries"]
    n = sum(rows)
    total = centre.sum(0)
    mean = float(total @ total - n) / max(1, n * (n - 1))
    at, diff, bias = np.zeros(0, np.uint32), np.zeros(0, np.float32), 0.0
    if min(rows) == 0:
        tries += 1
    else:
        centre /= np.array(rows)[:, None]
        plane = (centre[1] - centre[0]).astype(np.float32)
        at = np.flatnonzero(plane).astype(np.uint32)
        diff, bias = plane[at], float(centre[1] @ centre[1] - centre[0] @ centre[0]) / 2
    out = {"node": table.column("node")[:1], "tries": pa.array([tries], pa.int32()), "bias": pa.array([bias]), "mean": pa.array([mean])}
    return pa.table(out | {"at": pa.array([at.tobytes()], pa.binary()), "diff": pa.array([diff.tobytes()], pa.binary())})


def _moved(table, node: np.ndarray):  # noqa: ANN001, ANN202
    return table.set_column(table.schema.get_field_index("node"), "node", pa.array(node, pa.int64()))


def _walked(b, path: list) -> np.ndarray:  # noqa: ANN001
    """The present node of each row, by the planes of the levels above."""
    node, part, ids = _numbers(b.column("node")), _csr(b), _hashes(b)
    for planes, salt in path:
        active, side = Planes(*planes.value).sides(part, node, ids, salt)
        node = np.where(active, 2 * node + side, node)
    return node


class Splitter:
    """Rows with their nodes while the cluster splits those above node_rows.

    Up to `planes` planes are broadcast, and a row's node is found anew in each pass from the planes of the levels above.
    Where a level has more, rows and planes are joined by node, in parts of node_rows rows, and the rows are stored with their
    new nodes.  Both ways do the same arithmetic."""

    def __init__(self, items: DataFrame, salt: int, node_rows: int, planes: int) -> None:
        self.base = items.withColumn("hash", F.xxhash64("key")).withColumn("node", F.lit(1).cast("long"))
        self.path: list[tuple] = []  # broadcast planes of the levels since base, with their salts
        self.salt, self.node_rows, self.planes = salt, node_rows, planes
        self.stored = False

    def rows(self, *columns: str) -> DataFrame:
        """The rows with their present nodes; only some columns if any are named."""
        path = self.path
        names = list(columns) or [c.split()[0] for c in _ROW.split(", ")]

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                moved = _moved(b, _walked(b, path))
                yield moved.select(names)

        held = self.base if not columns else self.base.select(*dict.fromkeys([*columns, "feats", "weights", "hash", "node"]))
        if not path:
            return held.select(*names)
        kinds = dict(c.split() for c in _ROW.split(", "))
        return held.mapInArrow(move, ", ".join(f"{c} {kinds[c]}" for c in names))

    def sizes(self) -> dict[int, int]:
        """Rows of each node; a node has node_rows rows or so, hence few next to the rows."""
        return {int(r["node"]): int(r["n"]) for r in self.rows("node").groupBy("node").agg(F.count("*").alias("n")).collect()}

    def _met(self, sizes: dict[int, int], planes: DataFrame, run, shape: str, whole: bool) -> DataFrame:  # noqa: ANN001
        """run(rows, planes) for each node, large ones in parts."""
        spark = planes.sparkSession
        parts = spark.createDataFrame([(k, -(-n // self.node_rows)) for k, n in sizes.items()], "node long, parts int")
        rows = self.rows() if whole else self.rows("feats", "weights", "hash", "node")
        left = rows.join(parts, "node").withColumn("part", F.pmod("hash", F.col("parts")).cast("int")).drop("parts")
        right = planes.join(parts, "node").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        return left.groupBy("node", "part").cogroup(right.groupBy("node", "part")).applyInArrow(run, shape)

    def split(self, sizes: dict[int, int], level: int, compact: float) -> set[int]:
        """Split all the given nodes but those that are compact, which are returned."""
        spark, salt, path = self.base.sparkSession, self.salt + level, self.path
        wide = len(sizes) > self.planes
        first = [{"node": k, "tries": 0, "bias": 0.0, "mean": 0.0, "at": b"", "diff": b""} for k in sizes]
        table = spark.createDataFrame([tuple(r.values()) for r in first], _PLANE) if wide else None
        now, tight = first, set()
        for i in range(ROUNDS):
            if wide:

                def meet(rows: pa.Table, planes: pa.Table) -> pa.Table:
                    at, part, adder = Planes.of(planes.to_pylist()), _csr(rows), _Adder()
                    active, side = at.sides(part, _numbers(rows.column("node")), _hashes(rows), salt)
                    if len(at.nodes):
                        adder.add(np.zeros(rows.num_rows, np.int64), side.astype(np.int64), part)
                    return pa.Table.from_batches([adder.batch(at)])

                sums = self._met(sizes, table, meet, _SUM, False)
            else:
                sent = spark.sparkContext.broadcast(Planes.of(now).plain())

                def total(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
                    adder, at = _Adder(), Planes(*sent.value)
                    for b in batches:
                        node, part = _walked(b, path), _csr(b)
                        active, side = at.sides(part, node, _hashes(b), salt)
                        mine = np.flatnonzero(active)
                        where = np.searchsorted(at.nodes, node[mine])
                        adder.add(where, side[mine].astype(np.int64), take(*part, mine))
                    yield adder.batch(at)

                sums = self.base.select("feats", "weights", "hash", "node").mapInArrow(total, _SUM)
            planes = sums.groupBy("node", "half", "span").applyInArrow(_add_span, _SUM).groupBy("node").applyInArrow(_to_plane, _PLANE)
            if wide:
                before, table = table, stored(planes.where(F.col("mean") < compact) if i == 0 else planes, "planes")
                if i == 0:
                    tight = set(sizes) - {int(r["node"]) for r in table.select("node").collect()}
                else:
                    drop(before)
            else:
                got = [r.asDict() for r in planes.collect()]
                sent.destroy()
                if i == 0:
                    tight = {int(r["node"]) for r in got if r["mean"] >= compact}
                now = [r for r in got if r["node"] not in tight]
                table = None
            sizes = {k: n for k, n in sizes.items() if k not in tight}
            if not sizes:
                return tight
        if wide:

            def move(rows: pa.Table, planes: pa.Table) -> pa.Table:
                at, node = Planes.of(planes.to_pylist()), _numbers(rows.column("node"))
                active, side = at.sides(_csr(rows), node, _hashes(rows), salt)
                return _moved(rows, np.where(active, 2 * node + side, node)).select([c.split()[0] for c in _ROW.split(", ")])

            moving = self._met(sizes, table, move, _ROW, True)
            rest = self.rows().join(F.broadcast(spark.createDataFrame([(k,) for k in sizes], "node long")), "node", "left_anti").select(*moving.columns)
            moved = stored(moving.unionByName(rest), "nodes")
            if self.stored:
                drop(self.base)
            drop(table)
            self.base, self.path, self.stored = moved, [], True
        else:
            self.path = [*path, (spark.sparkContext.broadcast(Planes.of(now).plain()), salt)]
        return tight


def nodes_of(items: DataFrame, rows: int, salt: int, *, compact: float, node_rows: int, block_rows: int, planes: int) -> DataFrame:
    """Items with node and part: nodes of at most node_rows rows, part -1, and larger ones that are compact, in parts of block_rows rows."""
    splitter, level = Splitter(items, salt, node_rows, planes), 0
    sizes, tight = {1: rows}, {}
    while large := {k: n for k, n in sizes.items() if n > node_rows and k not in tight}:
        tight |= {k: large[k] for k in splitter.split(large, level, compact)}
        sizes = splitter.sizes()
        level += 1
    placed = splitter.rows()
    if not tight:
        return placed.withColumn("part", F.lit(-1))
    parts = items.sparkSession.createDataFrame([(k, -(-n // block_rows)) for k, n in tight.items()], "node long, parts int")
    return placed.join(parts, "node", "left").withColumn("part", F.coalesce(F.pmod("hash", F.col("parts")).cast("int"), F.lit(-1))).drop("parts")


# ---- leaves and fragments ---------------------------------------------------------------------
def _whole(bodies, table, cap: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:  # noqa: ANN001
    """Vectors for the exact check from whole sets of features."""
    lengths, feats = _values(bodies, np.uint32)
    levels = np.frombuffer(table.value, np.uint8)[feats >> np.uint32(32 - BUCKET_BITS)]
    indptr = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=indptr[1:])
    return indptr, feats.astype(np.int64), _weighted(lengths, levels, cap, POWER_CHECK)


def similarities(indptr: np.ndarray, indices: np.ndarray, data: np.ndarray, cut: int | None = None) -> np.ndarray:
    """Dot products of all rows, or of the first `cut` rows with the others; features of one row alone add to that row's own only."""
    n = len(indptr) - 1
    row = np.repeat(np.arange(n), np.diff(indptr))
    own = np.bincount(row, data.astype(np.float64) ** 2, n)
    features, local, count = np.unique(indices, return_inverse=True, return_counts=True)
    shared = count > 1
    stay = shared[local]
    row, data, local, width = row[stay], data[stay], (np.cumsum(shared) - 1)[local[stay]], int(shared.sum())
    step = max(16, 4_000_000 // max(1, n))
    cut_at = n if cut is None else cut
    out = np.zeros((cut_at, n if cut is None else n - cut), np.float32)
    for a in range(0, width, step):
        mine = slice(None) if width <= step else (local >= a) & (local < a + step)
        dense = np.zeros((n, min(step, width - a)), np.float32)
        dense[row[mine], local[mine] - a] = data[mine]
        out += dense[:cut_at] @ (dense if cut is None else dense[cut:]).T
    if cut is None:
        np.fill_diagonal(out, own)
    return out


def connected(links: np.ndarray) -> np.ndarray:
    """The smallest row that each row is connected to, of a symmetric matrix."""
    n = len(links)
    if links.all():
        return np.zeros(n, np.int64)
    label = np.arange(n)
    links = links | np.eye(n, dtype=bool)
    while True:
        new = np.where(links, label[None, :], n).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def small_leaves(leaf: np.ndarray, whole: tuple, link: float, pair: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(label, total, first, second) of rows in leaves of SMALL rows or fewer, all leaves at once; leaf numbers rise from 0.

    label: the first row of what the row is connected to; total: the sum of its similarities within that; first and second: the pairs."""
    n = len(leaf)
    size = np.bincount(leaf)
    start = np.cumsum(size) - size
    base = np.cumsum(size * size) - size * size
    flat = np.zeros(int((size * size).sum()), np.float64)
    row = np.repeat(np.arange(n), np.diff(whole[0]))
    key = (leaf[row] << 32) | whole[1]
    order = np.argsort(key, kind="stable")
    key, row, value = key[order], row[order], whole[2][order]
    runs = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    length = np.diff(np.append(runs, len(key)))
    for k in range(2, SMALL + 1):
        at = runs[length == k][:, None] + np.arange(k)
        if not len(at):
            continue
        r, v, one = row[at], value[at], leaf[row[at[:, 0]]]
        local = r - start[one][:, None]
        for i in range(k):
            for j in range(i + 1, k):
                np.add.at(flat, base[one] + local[:, i] * size[one] + local[:, j], v[:, i] * v[:, j])
    label, total, first, second = np.arange(n), np.ones(n), [], []
    for m in range(2, SMALL + 1):
        mine = np.flatnonzero(size == m)
        if not len(mine):
            continue
        same = flat[base[mine][:, None] + np.arange(m * m)].reshape(-1, m, m)
        same = same + same.transpose(0, 2, 1)
        links = (same >= link) | np.eye(m, dtype=bool)
        own = np.tile(np.arange(m), (len(mine), 1))
        while True:
            new = np.where(links, own[:, None, :], m).min(2)
            if (new == own).all():
                break
            own = new
        together = own[:, :, None] == own[:, None, :]
        rows = start[mine][:, None] + np.arange(m)
        label[rows] = start[mine][:, None] + own
        total[rows] = 1 + (same * together).sum(2)
        leaf_no, i, j = np.nonzero(np.triu(together & (same >= pair), 1))
        first.append(start[mine][leaf_no] + i)
        second.append(start[mine][leaf_no] + j)
    none = [np.zeros(0, np.int64)]
    return label, total, np.concatenate(first or none), np.concatenate(second or none)


_GROWN = "kind int, key string, fragment string, listed boolean, partners array<string>, size long, feats binary, weights binary, body binary"
MEMBER, FRAGMENT = 0, 1


def _grower(table, cap: float, compact: float, link: float, pair: float, block_rows: int, salt: int):  # noqa: ANN001, ANN202
    """One node -> a row for each of its rows with the fragment it belongs to, and a row for each fragment."""

    def grow(node: pa.Table) -> pa.Table:
        node = node.sort_by("key").combine_chunks()  # the same leaves whatever order the rows came in
        n = node.num_rows
        part = _csr(node)
        leaf = np.zeros(n, np.int64) if node.column("part")[0].as_py() >= 0 else bisect(*part, _hashes(node), compact, salt)
        order = np.argsort(leaf, kind="stable")
        ends = np.flatnonzero(np.append(np.append(True, np.diff(leaf[order]) != 0), True))
        sizes = np.diff(ends)
        fragment, total = np.arange(n), np.ones(n)  # a fragment is named by its first row
        listed = np.ones(n, bool)
        first, second = [], []
        large = np.flatnonzero(sizes > block_rows)
        cuts = np.sort(np.concatenate([ends[:-1], *(np.arange(ends[k] + block_rows, ends[k + 1], block_rows) for k in large)])).astype(np.int64)
        stops = np.append(cuts[1:], n)
        wide = np.repeat(sizes > LISTED, -(-sizes // block_rows))
        several = np.flatnonzero(stops - cuts > 1)
        listed[order[np.repeat(wide, stops - cuts)]] = False
        at = 0
        while at < len(several):  # so many leaves at a time that their whole vectors stay small
            until = at + 1
            while until < len(several) and stops[several[until]] - cuts[several[at]] < 20_000:
                until += 1
            mine = np.concatenate([order[cuts[k] : stops[k]] for k in several[at:until]])
            whole = _whole(node.column("body").take(pa.array(mine)), table, cap)
            length = stops[several[at:until]] - cuts[several[at:until]]
            little = np.repeat(length <= SMALL, length)
            if little.any():
                rows = mine[little]
                label, sums, i, j = small_leaves(np.repeat(np.arange(int((length <= SMALL).sum())), length[length <= SMALL]), take(*whole, np.flatnonzero(little)), link, pair)
                fragment[rows], total[rows] = rows[label], sums
                first.append(rows[i])
                second.append(rows[j])
            begin = 0
            for k in several[at:until]:
                rows = order[cuts[k] : stops[k]]
                if len(rows) <= SMALL:
                    begin += len(rows)
                    continue
                lo, hi = begin, begin + len(rows)
                begin = hi
                a, b = whole[0][lo], whole[0][hi]
                same = similarities(whole[0][lo : hi + 1] - a, whole[1][a:b], whole[2][a:b])
                label = connected(same >= link)
                fragment[rows] = rows[label]
                own = label[:, None] == label[None, :]
                total[rows] = (same * own).sum(1)
                if not wide[k]:
                    i, j = np.nonzero(np.triu(own & (same >= pair), 1))
                    first.append(rows[i])
                    second.append(rows[j])
            at = until
        keys = node.column("key").combine_chunks()
        keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
        x, y = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (first, second))
        x, y = np.minimum(x, y), np.maximum(x, y)  # rows are in the order of their keys
        by = np.argsort(x, kind="stable")
        offsets = np.zeros(n + 1, np.int32)
        np.cumsum(np.bincount(x, minlength=n), out=offsets[1:])
        partners = pa.ListArray.from_arrays(pa.array(offsets), keys.take(pa.array(y[by])))
        # each fragment: its centre, its most typical row and its size
        heads, of = np.unique(fragment, return_inverse=True)
        weight = _numbers(node.column("size"))
        row = np.repeat(np.arange(n), np.diff(part[0]))
        pairs, where = np.unique((of[row].astype(np.int64) << 32) | part[1], return_inverse=True)
        centre = np.bincount(where, part[2] * weight[row], len(pairs))
        holder = pairs >> 32
        best = np.lexsort((-centre, holder))
        count = np.bincount(holder, minlength=len(heads))
        best = best[np.arange(len(best)) - (np.cumsum(count) - count)[holder[best]] < TOP]
        kept = np.bincount(holder[best], minlength=len(heads))
        norm = np.sqrt(np.bincount(holder[best], centre[best] ** 2, len(heads)))
        unit = (centre[best] / np.maximum(norm, 1e-12)[holder[best]]).astype(np.float32)
        typical = np.lexsort((np.arange(n), -np.round(total, 5), of))
        typical = typical[np.searchsorted(of[typical], np.arange(len(heads)))]
        m = len(heads)
        nothing = lambda kind, k: pa.nulls(k, kind)
        names = [c.split()[0] for c in _GROWN.split(", ")]
        members = pa.table([
            pa.array(np.full(n, MEMBER, np.int32)), keys, keys.take(pa.array(fragment)), pa.array(listed), partners,
            nothing(pa.int64(), n), nothing(pa.binary(), n), nothing(pa.binary(), n), nothing(pa.binary(), n),
        ], names=names)
        bodies = node.column("body").take(pa.array(typical))
        sizes_of = pa.array(np.bincount(of, weight, m).astype(np.int64))
        own = pa.table([
            pa.array(np.full(m, FRAGMENT, np.int32)), keys.take(pa.array(heads)), keys.take(pa.array(heads)), nothing(pa.bool_(), m), nothing(pa.list_(pa.string()), m),
            sizes_of, _binary(kept, (pairs[best] & 0xFFFFFFFF).astype(np.uint32)), _binary(kept, unit), bodies,
        ], names=names)
        return pa.concat_tables([members, own])

    return grow


# ---- pairs that no leaf brought together ------------------------------------------------------
_POSTING, _HEAD = "feature long, room float, no long", "no long, head binary, head_weights binary, tail float"


def _ranked(bodies, table, cap: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:  # noqa: ANN001
    """(lengths, features, weights, room): vectors for clustering of all features that other records have too, rarest first.

    room: the length of the vector from that feature on; no pair whose first common feature it is can be more similar than the product of both."""
    lengths, feats = _values(bodies, np.uint32)
    levels = np.frombuffer(table.value, np.uint8)[feats >> np.uint32(32 - BUCKET_BITS)]
    doc = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((feats, -levels.astype(np.int16), doc))
    order = order[levels[order] != ALONE]
    lengths = np.bincount(doc[order], minlength=len(lengths))
    weights = _weighted(lengths, levels[order], cap, POWER_CLUSTER)
    total = np.append(0.0, np.cumsum(weights.astype(np.float64) ** 2))
    room = np.sqrt(np.maximum(np.repeat(total[np.cumsum(lengths)], lengths) - total[:-1], 0))
    return lengths, feats[order], weights, room


def _to_postings(table, cap: float, near: float):  # noqa: ANN001, ANN202
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths, feats, _, room = _ranked(b.column("body"), table, cap)
            keep = room >= near - SLACK
            no = np.repeat(_numbers(b.column("no")), lengths)[keep]
            yield _batch(feature=pa.array(feats[keep].astype(np.int64)), room=pa.array(room[keep].astype(np.float32)), no=pa.array(no))

    return post


def _to_heads(table, cap: float):  # noqa: ANN001, ANN202
    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths, feats, weights, room = _ranked(b.column("body"), table, cap)
            doc, keep = np.repeat(np.arange(len(lengths)), lengths), room >= TAIL
            tail = np.sqrt(np.bincount(doc[~keep], weights[~keep].astype(np.float64) ** 2, len(lengths))).astype(np.float32)
            kept = np.bincount(doc[keep], minlength=len(lengths))
            yield _batch(no=b.column("no"), head=_binary(kept, feats[keep]), head_weights=_binary(kept, weights[keep]), tail=pa.array(tail))

    return head


def _pairer(near: float):  # noqa: ANN202
    """Pairs (a, b) of rows of different groups that have a feature in common and may be similar to near."""

    def pair(rows: pa.Table) -> pa.Table:
        one = rows.column("i")[0].as_py() == rows.column("j")[0].as_py()
        rows = rows.sort_by([("feature", "ascending"), ("grp", "ascending")]).combine_chunks()
        feature, grp, no, room, part, tail = (_numbers(rows.column(c)) for c in ("feature", "grp", "no", "room", "part", "tail"))
        n = rows.num_rows
        changed = feature[1:] != feature[:-1]

        def end(turns: np.ndarray) -> np.ndarray:
            """For each row the end of its run."""
            stops = np.append(np.flatnonzero(turns) + 1, n)
            return stops[np.searchsorted(stops, np.arange(n), side="right")]

        own = end(changed | (grp[1:] != grp[:-1]))
        count = end(changed) - own  # each row meets those of the groups after its own
        lengths, feats = _values(rows.column("head"), np.uint32)
        _, weights = _values(rows.column("head_weights"), np.float32)
        starts = np.cumsum(lengths) - lengths
        key = (np.repeat(np.arange(n), lengths) << 32) | feats
        by = np.argsort(key)
        key, value = key[by], weights[by].astype(np.float64)
        first, second, before = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.append(0, np.cumsum(count))
        at = 0
        while at < n:
            until = max(at + 1, int(np.searchsorted(before, before[at] + PIECE, side="right")) - 1)
            c = count[at:until]
            x = np.repeat(np.arange(at, until), c)
            y = np.repeat(own[at:until] - before[at:until] + before[at], c) + np.arange(len(x))
            may = room[x].astype(np.float64) * room[y] >= near - SLACK
            if not one:
                may &= part[x] != part[y]
            x, y = x[may], y[may]
            if len(x):
                of = np.repeat(np.arange(len(x)), lengths[x])
                spot = np.arange(len(of)) - np.repeat(np.cumsum(lengths[x]) - lengths[x], lengths[x]) + np.repeat(starts[x], lengths[x])
                sought = (y[of] << 32) | feats[spot]
                found = np.minimum(np.searchsorted(key, sought), len(key) - 1)
                hit = key[found] == sought
                common = np.bincount(of[hit], weights[spot[hit]] * value[found[hit]], len(x))
                may = common + np.maximum(tail[x], tail[y]) >= near - SLACK
                first.append(no[x[may]])
                second.append(no[y[may]])
            at = until
        a, b = np.concatenate(first), np.concatenate(second)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return pair


def _dots(one: tuple, other: tuple, n: int) -> np.ndarray:
    """Dot products of so many rows of (lengths, features, weights) with the same rows of another."""
    x, y = ((np.repeat(np.arange(n), lengths).astype(np.int64) << 32) | feats for lengths, feats, _ in (one, other))
    order = np.argsort(y)
    at = np.minimum(np.searchsorted(y[order], x), max(0, len(y) - 1))
    hit = y[order][at] == x if len(y) else np.zeros(len(x), bool)
    return np.bincount(x[hit] >> 32, one[2][hit].astype(np.float64) * other[2][order][at[hit]], n) if hit.any() else np.zeros(n)


def _linker(table, cap: float, near: float, link: float):  # noqa: ANN001, ANN202
    """The groups of each pair that is similar enough, by all its features."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies = [b.column(c) for c in ("body_a", "body_b")]
            close = _dots(*(_ranked(x, table, cap)[:3] for x in bodies), b.num_rows) >= near
            whole = [_whole(x, table, cap) for x in bodies]
            close &= _dots(*((np.diff(indptr), feats, weights) for indptr, feats, weights in whole), b.num_rows) >= link
            yield pa.RecordBatch.from_arrays([b.column(c).filter(pa.array(close)) for c in ("group_a", "group_b")], ["a", "b"])

    return check


def missed_links(own: DataFrame, items: DataFrame, typical: DataFrame, table, cap: float, near: float, link: float, block_rows: int, texts: int) -> DataFrame:  # noqa: ANN001
    """(a, b): groups of which a record of one and a record of the other are similar to near by their whole vectors, and to link by the exact check.

    Since one pair may be a chance, the same must hold of the most typical records (key, body) of both.

    Prefix filter: a record is listed under its rarest features while what follows is near long.  A list of one group's rows
    alone is left out, in the others only rows of different groups meet, long lists in blocks; the features of both that
    matter go along, so that few pairs have their texts' whole sets fetched."""
    numbered = items.where("length(feats) > 0").select(F.xxhash64("key").alias("no"), "body")
    placed = own.select(F.xxhash64("id").alias("no"), "group_id")
    postings = stored(numbered.mapInArrow(_to_postings(table, cap, near), _POSTING).join(placed.select("no", F.xxhash64("group_id").alias("grp")), "no"), "postings")
    several = postings.groupBy("feature").agg(F.count("*").alias("n"), F.min("grp").alias("low"), F.max("grp").alias("high")).where("low < high")
    dealt = postings.join(several.select("feature", F.ceil(F.col("n") / block_rows).cast("int").alias("parts")), "feature").join(numbered.mapInArrow(_to_heads(table, cap), _HEAD), "no")
    dealt = dealt.withColumn("part", F.pmod("no", F.col("parts")).cast("int")).withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    task = F.when(F.col("parts") > 1, F.col("feature")).otherwise(F.pmod(F.xxhash64("feature"), F.lit(max(1, texts // 10_000))))
    dealt = dealt.select(task.alias("task"), (F.col("parts") > 1).alias("large"), F.least("part", "meets").alias("i"), F.greatest("part", "meets").alias("j"), "part", "feature", "grp", "no", "room", "head", "head_weights", "tail")
    pairs = stored(dealt.groupBy("large", "task", "i", "j").applyInArrow(_pairer(near), "a long, b long").distinct(), "candidates")
    drop(postings)
    ends = stored(numbered.join(pairs.select(F.col("a").alias("no")).union(pairs.select("b")).distinct(), "no", "left_semi").join(placed, "no"), "ends")
    side = lambda c: ends.select(F.col("no").alias(c), F.col("body").alias(f"body_{c}"), F.col("group_id").alias(f"group_{c}"))
    links = stored(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_linker(table, cap, near, link), "a string, b string").distinct(), "links")
    drop(pairs)
    drop(ends)
    side = lambda c: typical.select(F.col("key").alias(c), F.col("key").alias(f"group_{c}"), F.col("body").alias(f"body_{c}"))
    passed = stored(links.join(side("a"), "a").join(side("b"), "b").mapInArrow(_linker(table, cap, near, link), "a string, b string"), "links")
    drop(links)
    return passed


def _add_centres(table: pa.Table) -> pa.Table:
    """One centre of the fragments of a group, by their sizes."""
    lengths, feats = _values(table.column("feats"), np.uint32)
    _, weights = _values(table.column("weights"), np.float32)
    feats, where = np.unique(feats, return_inverse=True)
    centre = np.bincount(where, weights * np.repeat(_numbers(table.column("size")), lengths), len(feats))
    centre = (centre / max(float(np.sqrt(centre @ centre)), 1e-12)).astype(np.float32)
    return pa.table({"key": table.column("now")[:1], "feats": pa.array([feats.tobytes()], pa.binary()), "weights": pa.array([centre.tobytes()], pa.binary())})


@dataclass
class Similar:
    """What similar_groups found: tables in the shared folder and the broadcast frequency table."""

    members: DataFrame  # id, group_id, copy_of
    rows: DataFrame  # id, group_id, fragment, listed, partners; of distinct texts
    items: DataFrame  # the vectors of the rows
    centres: DataFrame  # key (group_id), feats, weights
    table: object
    cap: float
    pair: float
    block_rows: int
    texts: int


def similar_groups(df: DataFrame, *, compact: float = COMPACT, link: float = LINK, pair: float = PAIR, passes: int = PASSES, near: float = NEAR, node_rows: int = NODE_ROWS, block_rows: int = BLOCK_ROWS, planes: int = PLANES) -> Similar:
    """Cluster records (id, text) by what they deal with.

    `members` of the result has one row for each id: id, group_id (the smallest id of the group's texts)
    and copy_of (the id that stands for this row's text; null for that id itself).

    Rows with a null id or text are left out, for they have no name or no matter.  An id delivered
    more than once counts once, with one of its texts.  Texts without any word form groups of
    their own, unless they are copies.  Ties are broken by id.  Other columns of df are ignored, and an
    empty table has no groups.  node_rows, block_rows and planes bound memory; they don't decide what is similar.
    """
    rows = df.select(F.col("id").cast("string").alias("id"), F.col("text").cast("string").alias("text")).where("id is not null and text is not null")
    hashed = rows.withColumn("text_hash", F.xxhash64(F.trim(F.regexp_replace("text", r"\s+", " "))))
    features = stored(hashed.mapInArrow(_to_features, "id string, text_hash long, body binary").withColumn("no", F.monotonically_increasing_id()), "features")
    spark = features.sparkSession
    # one row for each id, then one for each text: only ids and hashes are shuffled
    chosen = features.groupBy("id").agg(F.min(F.struct("text_hash", "no")).alias("r")).select("id", "r.*")
    leads = chosen.groupBy("text_hash").agg(F.min(F.struct("id", "no")).alias("lead"), F.count("*").alias("copies"))
    spare = features.select("no").join(leads.select(F.col("lead.no").alias("no")), "no", "left_anti")
    texts = stored(features.join(spare, "no", "left_anti").select("id", "body"), "texts")
    count = texts.count()
    steps = idf_table(texts, max(1, count))
    cap = max(1.0, float(steps[steps != ALONE].max(initial=0)) / STEPS)
    table = spark.sparkContext.broadcast(steps.tobytes())
    items = stored(texts.mapInArrow(_to_items(table, cap), _ITEM), "items")
    drop(texts)
    bound = items.where("length(feats) > 0")  # the others share no feature with any other record
    grown, maps, made = None, [], []
    for i in range(passes + 1):
        source, n = (bound, count) if i == 0 else (grown.where(F.col("kind") == FRAGMENT).select("key", "size", "feats", "weights", "body"), fragments)
        placed = nodes_of(source, n, 10_000 * (i + 1), compact=compact, node_rows=node_rows, block_rows=block_rows, planes=planes)
        new = stored(placed.groupBy("node", "part").applyInArrow(_grower(table, cap, compact, link, pair, block_rows, 10_000 * (i + 1) + 5_000), _GROWN), "grown")
        if i == 0:
            leaves = new
        else:
            maps.append(new.where((F.col("kind") == MEMBER) & (F.col("key") != F.col("fragment"))).select(F.col("key").alias("was"), F.col("fragment").alias("now")))
        made.append(new)
        grown, fragments = new, new.where(F.col("kind") == FRAGMENT).count()
    own = leaves.where(F.col("kind") == MEMBER).select(F.col("key").alias("id"), "fragment", "listed", "partners", F.col("fragment").alias("group_id"))
    for m in maps:
        own = own.join(m, F.col("group_id") == F.col("was"), "left").withColumn("group_id", F.coalesce("now", "group_id")).drop("was", "now")
    alone = items.where("length(feats) = 0").select(F.col("key").alias("id"), F.col("key").alias("fragment"), F.lit(True).alias("listed"), F.array().cast("array<string>").alias("partners"), F.col("key").alias("group_id"))
    own = stored(own.unionByName(alone), "groups")
    for grew in made[:-1]:
        drop(grew)
    centres = grown.where(F.col("kind") == FRAGMENT).select("key", "size", "feats", "weights")
    links = missed_links(own, items, grown.where(F.col("kind") == FRAGMENT).select("key", "body"), table, cap, near, link, block_rows, count)
    if not links.isEmpty():
        joined = components(links).where("node <> component").select(F.col("node").alias("was"), F.col("component").alias("now"))
        apart, own = own, stored(own.join(joined, F.col("group_id") == F.col("was"), "left").withColumn("group_id", F.coalesce("now", "group_id")).drop("was", "now"), "groups")
        drop(apart)
        centres = centres.join(joined, F.col("key") == F.col("was"), "left").withColumn("now", F.coalesce("now", "key"))
        whole = centres.join(joined.select("now").distinct(), "now", "left_semi").groupBy("now").applyInArrow(_add_centres, "key string, feats binary, weights binary")
        centres = stored(centres.join(joined.select("now").distinct(), "now", "left_anti").select("key", "feats", "weights").unionByName(whole), "centres")
        drop(grown)
    drop(links)
    copies = chosen.join(leads.where("copies > 1"), "text_hash").where("id <> lead.id").select("id", F.col("lead.id").alias("copy_of"))
    of_copies = copies.join(own.select(F.col("id").alias("copy_of"), "group_id"), "copy_of").select("id", "group_id", "copy_of")
    members = own.select("id", "group_id", F.lit(None).cast("string").alias("copy_of")).unionByName(of_copies)
    centres = centres.select("key", "feats", "weights")
    return Similar(members, own, items, centres, table, cap, pair, block_rows, count)


# ---- pairs and report -------------------------------------------------------------------------
def _comparer(table, cap: float, pair: float):  # noqa: ANN001, ANN202
    """Pairs (id_a, id_b) of each group's rows, of one block or of two."""

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("grp", "ascending"), ("part", "ascending"), ("id", "ascending")]).combine_chunks()
        grp = rows.column("grp").combine_chunks().dictionary_encode()
        grp = (grp.chunk(0) if isinstance(grp, pa.ChunkedArray) else grp).indices.to_numpy()
        block = _numbers(rows.column("part"))
        one = rows.column("i")[0].as_py() == rows.column("j")[0].as_py()
        ends = np.flatnonzero(np.append(np.append(True, np.diff(grp) != 0), True))
        whole = _whole(rows.column("body"), table, cap)
        first, second = [], []
        for lo, hi in zip(ends[:-1], ends[1:], strict=True):
            cut = None if one else int((block[lo:hi] == block[lo]).sum())
            a, b = whole[0][lo], whole[0][hi]
            same = similarities(whole[0][lo : hi + 1] - a, whole[1][a:b], whole[2][a:b], cut) >= pair
            i, j = np.nonzero(np.triu(same, 1) if one else same)
            first.append(lo + i)
            second.append(lo + (0 if one else cut) + j)
        x, y = np.concatenate(first), np.concatenate(second)
        a, b = rows.column("id").take(pa.array(x)), rows.column("id").take(pa.array(y))
        less = pc.less(a, b)
        return pa.table({"id_a": pc.if_else(less, a, b), "id_b": pc.if_else(less, b, a)})

    return compare


def compared(rows: DataFrame, groups: Similar) -> DataFrame:
    """(id_a, id_b) of the pairs in each grp of rows (grp, id, body), all of them, block by block in a large group; small groups share tasks."""
    sizes = rows.groupBy("grp").agg(F.count("*").alias("n"))
    dealt = rows.join(sizes, "grp").withColumn("parts", F.ceil(F.col("n") / groups.block_rows).cast("int"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    buckets = max(1, groups.texts // 10_000)
    task = F.when(F.col("parts") > 1, F.col("grp")).otherwise(F.pmod(F.xxhash64("grp"), F.lit(buckets)).cast("string"))
    dealt = dealt.select(task.alias("task"), (F.col("parts") > 1).alias("large"), "grp", F.least("part", "meets").alias("i"), F.greatest("part", "meets").alias("j"), "part", "id", "body")
    return dealt.groupBy("large", "task", "i", "j").applyInArrow(_comparer(groups.table, groups.cap, groups.pair), "id_a string, id_b string")


def similar_pairs(groups: Similar) -> DataFrame:
    """(id_a, id_b): pairs of different texts of a group that pass the exact check, and each copy with the id that stands for its text.

    Pairs of a small leaf come from its task; those of groups put together from several fragments, and of large
    leaves, are found here."""
    rows = groups.rows
    open_groups = rows.where(~F.col("listed") | (F.col("fragment") != F.col("group_id"))).select("group_id").distinct()
    listed = rows.join(open_groups, "group_id", "left_anti").select(F.col("id").alias("id_a"), F.explode("partners").alias("id_b"))
    rest = rows.select("id", "group_id").join(open_groups, "group_id", "left_semi")
    whole = groups.items.select(F.col("key").alias("id"), "body").join(rest, "id").select(F.col("group_id").alias("grp"), "id", "body")
    copies = groups.members.where("copy_of is not null").select(F.least("id", "copy_of").alias("id_a"), F.greatest("id", "copy_of").alias("id_b"))
    return listed.unionByName(compared(whole, groups)).unionByName(copies)


def _nearness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dot product of each row's vector with its group's centre."""
    for b in batches:
        near = _dots(*((*_values(b.column(f), np.uint32), _values(b.column(w), np.float32)[1]) for f, w in (("feats", "weights"), ("centre", "centre_weights"))), b.num_rows)
        yield _batch(leaf=b.column("leaf"), id=b.column("id"), records=b.column("records"), near=pa.array(near))


def group_report(groups: Similar, members: int = 3) -> DataFrame:
    """(leaf, records, typical): groups of two records or more with their sizes and the members nearest to the centre.

    Every id is a record, exact copies of a text too; of these, typical names only the one that stands for the text.
    The nearest are found part by part, so no task holds a large group."""
    sized = groups.members.groupBy(F.col("group_id").alias("leaf")).agg(F.count("*").alias("records")).where("records > 1")
    vectors = groups.items.select(F.col("key").alias("id"), "feats", "weights")
    centre = groups.centres.select(F.col("key").alias("leaf"), F.col("feats").alias("centre"), F.col("weights").alias("centre_weights"))
    empty = F.lit(b"")
    of = groups.rows.select("id", F.col("group_id").alias("leaf")).join(sized, "leaf").join(vectors, "id").join(centre, "leaf", "left")
    of = of.select("leaf", "id", "records", "feats", "weights", F.coalesce("centre", empty).alias("centre"), F.coalesce("centre_weights", empty).alias("centre_weights"))
    near = of.mapInArrow(_nearness, "leaf string, id string, records long, near double")
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("records") / groups.block_rows)).alias("part")
    best = lambda column: F.slice(F.sort_array(column), 1, members)
    some = near.select("leaf", "records", part, F.struct((-F.round("near", 5)).alias("far"), "id").alias("m")).groupBy("leaf", "records", "part").agg(best(F.collect_list("m")).alias("ms"))
    merged = some.groupBy("leaf", "records").agg(best(F.flatten(F.collect_list("ms"))).alias("ms"))
    return merged.select("leaf", "records", F.transform("ms", lambda m: m["id"]).alias("typical"))
