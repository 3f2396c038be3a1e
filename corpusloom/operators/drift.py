"""Schemas that drift between the files of a feed.

Each file is profiled once, in the scan: for every field its JSON types and a sketch of its
content of fixed size.  A file then meets the file before it in its feed.  Fields that are gone
and fields that are new are matched by similarity flooding: pairs of nodes of the two schema
graphs (containers, fields, JSON types, content kinds) start with the likeness of their content
and names, hand their scores on along edges of the same label until the scores settle, and a
one-to-one choice of the best pairs remains.  From the matches follow the changes, the names
under which all files agree, and with those the cast and union of all records.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Collection, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

#: Entries of a content sketch; positions are stored as bytes.
SKETCH = 256
#: Likeness of content below which a field didn't take over another's content.
SAME_CONTENT = 0.45
#: Flooding ends after so many rounds, or when no score moves by more than this.
ROUNDS, SETTLED = 50, 1e-3
#: The containers whose members are fields of their own, unless others are given.
CONTAINERS = ("messages", "tools", "tools.function")

_NUMBER = re.compile(r"-?\d{1,15}(\.\d+)?")
_LETTERS, _DIGITS, _RUNS, _MIXED = re.compile(r"[^\W\d_]"), re.compile(r"[0-9]"), re.compile(r"(\w)\1+"), re.compile(r"[0-9a]+")

#: A number with a fraction, or beyond 64 bits, has a bit more; to the report both are numbers.
_FRACTION = 32
_TYPES = {str: 1, bool: 4, int: 2, float: 2 | _FRACTION, dict: 8, list: 16, type(None): 0}
_TYPE_NAMES = {1: "string", 2: "number", 4: "boolean", 8: "object", 16: "array"}


def fields_of(record: dict, containers: Collection[str] | None = CONTAINERS) -> Iterator[tuple[str, object]]:
    """(path, value) of every field of a record.

    The members of containers are fields of their own (x, messages.x, tools.x and tools.function.x by default); what lies below
    any other field is part of its value.  With None, every object and every array of objects is a container."""

    def walk(inside: dict, above: str) -> Iterator[tuple[str, object]]:
        for name, value in inside.items():
            path = above + name
            members = value if isinstance(value, list) else [value]
            if any(isinstance(m, dict) for m in members) if containers is None else path in containers:
                for m in members:
                    if isinstance(m, dict):
                        yield from walk(m, path + ".")
            else:
                yield path, value

    yield from walk(record, "")


@lru_cache(1 << 16)
def _bucket(kind: str) -> int:
    return zlib.crc32(kind.encode()) % SKETCH


def _number_kinds(value: float) -> list[tuple[int, float]]:
    size = math.log10(abs(value)) if value and math.isfinite(value) else -1.0
    return [(_bucket(f"size {round(size)}"), 2.0), (_bucket("whole" if isinstance(value, int) or value.is_integer() else "fraction"), 1.0)]


def _string_kinds(value: str) -> list[tuple[int, float]]:
    text = value.strip()
    if len(text) < 18 and _NUMBER.fullmatch(text):
        return _number_kinds(float(text) if "." in text else int(text))
    if len(text) <= 40 and " " not in text:
        shape = _RUNS.sub(r"\1", _DIGITS.sub("9", _LETTERS.sub("a", text)))
        out = [(zlib.crc32(f"word {text.lower()}".encode()) % SKETCH, 1.5), (_bucket(f"shape {_MIXED.sub('a', shape)}"), 1.5)]
    else:
        out = [(_bucket("prose"), 2.5)]
    return [*out, (_bucket(f"length {len(text).bit_length()}"), 0.7), (_bucket("text"), 0.5)]


@lru_cache(1 << 16)
def _short_kinds(value: str) -> list[tuple[int, float]]:
    return _string_kinds(value)


def _kinds(value: object, depth: int = 0) -> Iterable[tuple[int, float]]:
    """Features of one value's content, as places in a sketch: shapes and sizes of its scalars, its words, the keys inside."""
    if isinstance(value, bool):
        return ((_bucket("boolean"), 3.0),)
    if isinstance(value, (int, float)):
        return _number_kinds(value)
    if isinstance(value, str):
        return _short_kinds(value) if len(value) <= 40 else _string_kinds(value)
    out: list[tuple[int, float]] = []
    if isinstance(value, dict):
        share = 1 / max(1, len(value))
        for key, inner in value.items():
            out.append((_bucket(f"key {key}"), 0.7))
            if depth < 6:
                out += [(at, weight * share) for at, weight in _kinds(inner, depth + 1)]
    elif isinstance(value, list) and depth < 6:
        share = 1 / max(1, len(value))
        for inner in value:
            out += [(at, weight * share) for at, weight in _kinds(inner, depth + 1)]
    return out


def pack(sketch: np.ndarray) -> bytes:
    """The used entries of a sketch: their positions, then their values."""
    used = np.flatnonzero(sketch)
    return used.astype(np.uint8).tobytes() + sketch[used].astype(np.float32).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    n = len(packed) // 5
    sketch = np.zeros(SKETCH, np.float32)
    sketch[np.frombuffer(packed, np.uint8, n)] = np.frombuffer(packed[n:], np.float32)
    return sketch


def _no_json(constant: str) -> None:
    raise ValueError(constant)


def _as_object(body: str | None) -> dict | None:
    """The JSON object of a line; None for anything else, NaN and Infinity included."""
    if not body:
        return None
    try:
        found = json.loads(body, parse_constant=_no_json)
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


_PROFILE = "table_name string, feed string, file_path string, batch_day string, field_path string, types int, sketch binary"


def _profiler(containers: Collection[str] | None):
    return lambda batches: _profile(batches, containers)


def _profile(batches: Iterator[pa.RecordBatch], containers: Collection[str] | None) -> Iterator[pa.RecordBatch]:
    """One row for each file and field of a partition; a row without field_path for each file."""
    seen: dict[tuple, list] = {}
    for b in batches:
        columns = [b.column(n).to_pylist() for n in ("table_name", "feed", "file_path", "batch_day", "body")]
        for *file, body in zip(*columns, strict=True):
            seen.setdefault((*file, None), [0, None])
            for path, value in fields_of(_as_object(body) or {}, containers):
                at = seen.get((*file, path)) or seen.setdefault((*file, path), [0, [0.0] * SKETCH])
                at[0] |= _TYPES[type(value)] | (_FRACTION if type(value) is int and not -(1 << 63) <= value < 1 << 63 else 0)
                for place, weight in _kinds(value):
                    at[1][place] += weight
    rows = [(*key, mask, None if sketch is None else pack(np.array(sketch, np.float32))) for key, (mask, sketch) in seen.items()]
    names = [x.split()[0] for x in _PROFILE.split(", ")]
    schema = pa.schema([(n, pa.int32() if n == "types" else pa.binary() if n == "sketch" else pa.string()) for n in names])
    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)


def name_likeness(a: str, b: str) -> float:
    """Share of letter pairs two names have in common, apart from case, underscores and endings of the path."""
    def pairs(path: str) -> set[str]:
        name = re.sub(r"[^a-z0-9]", "", path.rsplit(".", 1)[-1].lower())
        return {name[i : i + 2] for i in range(len(name) - 1)} or {name}

    x, y = pairs(a), pairs(b)
    return 2 * len(x & y) / (len(x) + len(y))


def _container(path: str) -> str:
    return path.rpartition(".")[0]


def _edges(fields: dict[str, tuple[int, np.ndarray]]) -> list[tuple[str, str, str]]:
    """The schema graph: (from, label, to) over containers, fields, names and types."""
    out = []
    for path, (types, _) in fields.items():
        holder = _container(path)
        while holder:
            out.append((_container(holder) or "record", "holds", holder))
            holder = _container(holder)
        out.append((_container(path) or "record", "field", path))
        out.append((path, "named", "name " + path.rsplit(".", 1)[-1]))
        out += [(path, "type", f"type {name}") for bit, name in _TYPE_NAMES.items() if types & bit]
    return list(dict.fromkeys(out))


def flood(before: dict[str, tuple[int, np.ndarray]], after: dict[str, tuple[int, np.ndarray]]) -> dict[tuple[str, str], float]:
    """Scores of pairs of fields of two files, after similarity flooding."""
    def likeness(a: str, b: str) -> float:
        if a in before and b in after:
            x, y = before[a][1], after[b][1]
            norm = float(np.linalg.norm(x) * np.linalg.norm(y))
            content = float(x @ y) / norm if norm else 0.0
            return 0.7 * content + 0.3 * name_likeness(a, b)
        return 1.0 if a == b else 0.0

    by_label: dict[str, list] = {}
    for s, label, t in _edges(after):
        by_label.setdefault(label, []).append((s, t))
    links: list[tuple[tuple[str, str], tuple[str, str], str]] = []
    for s, label, t in _edges(before):
        for u, v in by_label.get(label, ()):
            if label == "field" and s != u and not (s.startswith(u + ".") or u.startswith(s + ".")):
                continue  # a field may move into or out of a container within its own (`function`), nowhere else
            links.append(((s, u), (t, v), label))
    nodes = list(dict.fromkeys(n for a, b, _ in links for n in (a, b)))
    at = {n: i for i, n in enumerate(nodes)}
    start = np.array([likeness(*n) for n in nodes])
    src, dst = np.array([at[a] for a, _, _ in links], int), np.array([at[b] for _, b, _ in links], int)
    labels = np.array([x for *_, x in links])
    weight_out, weight_in = np.zeros(len(links)), np.zeros(len(links))
    for label in set(labels.tolist()):
        mine = labels == label
        weight_out[mine] = 1 / np.bincount(src[mine], minlength=len(nodes))[src[mine]]
        weight_in[mine] = 1 / np.bincount(dst[mine], minlength=len(nodes))[dst[mine]]
    score = start.copy()
    for _ in range(ROUNDS):
        flow = np.bincount(dst, weight_out * score[src], len(nodes)) + np.bincount(src, weight_in * score[dst], len(nodes))
        new = start + score + flow
        new /= new.max(initial=1e-12)
        moved, score = np.abs(new - score).max(initial=0), new
        if moved < SETTLED:
            break
    return {n: float(score[i]) for n, i in at.items() if n[0] in before and n[1] in after}


def content_likeness(a: np.ndarray, b: np.ndarray) -> float:
    norm = float(np.linalg.norm(a) * np.linalg.norm(b))
    return float(a @ b) / norm if norm else 0.0


def match_fields(before: dict[str, tuple[int, np.ndarray]], after: dict[str, tuple[int, np.ndarray]]) -> list[tuple[str, str]]:
    """(old, new): gone fields whose content a new field takes over, one to one, best scores first.

    A field that is null everywhere has no content; it matches only under the same last name."""
    gone, new = set(before) - set(after), set(after) - set(before)
    if not gone or not new:
        return []
    scores = flood(before, after)
    ranked = sorted(((s, a, b) for (a, b), s in scores.items() if a in gone and b in new), key=lambda x: (-x[0], x[1], x[2]))
    out, taken = [], set()
    for _, a, b in ranked:
        x, y = before[a][1], after[b][1]
        moved = a.rsplit(".", 1)[-1] == b.rsplit(".", 1)[-1]
        same = content_likeness(x, y) >= SAME_CONTENT if x.any() and y.any() else moved
        if (same or moved) and not {("old", a), ("new", b)} & taken:
            taken |= {("old", a), ("new", b)}
            out.append((a, b))
    return sorted(out)


def _sketches(fields: dict[str, tuple[int, list[bytes]]]) -> dict[str, tuple[int, np.ndarray]]:
    return {path: (types, sum(map(unpack, parts), np.zeros(SKETCH, np.float32))) for path, (types, parts) in fields.items()}


def file_changes(before: dict[str, tuple[int, list[bytes]]], after: dict[str, tuple[int, list[bytes]]]) -> list[tuple[str, str, str | None]]:
    """(field_path, change, old_path) from one file to the next; content is looked at only where fields are gone and others new."""
    matches = match_fields(_sketches(before), _sketches(after)) if set(before) - set(after) and set(after) - set(before) else []
    renamed, old = {b: a for a, b in matches}, {a for a, _ in matches}
    rows = []
    for path in sorted(set(before) | set(after)):
        if path in renamed:
            rows.append((path, "renamed", renamed[path]))
        elif path not in before:
            rows.append((path, "added", None))
        elif path not in after:
            if path not in old:
                rows.append((path, "removed", None))
        elif after[path][0] & ~before[path][0] & ~_FRACTION:
            rows.append((path, "type_changed", None))
    return rows


_CHANGES = "table_name string, feed string, file_path string, field_path string, change string, old_path string"
#: Profile rows of the files that one call compares.
COMPARED = 20_000


def _compare(table: pa.Table) -> pa.Table:
    """The changes of some files, each against the file before it in its feed."""
    files: dict[tuple, tuple[dict, dict]] = {}
    columns = [table.column(n).to_pylist() for n in ("table_name", "feed", "file_path", "side", "field_path", "types", "sketch")]
    for *file, side, path, types, sketch in zip(*columns, strict=True):
        fields = files.setdefault(tuple(file), ({}, {}))[side == "after"]
        if path is not None and sketch is not None:
            mask, parts = fields.get(path, (0, []))
            fields[path] = (mask | types, [*parts, sketch])
    rows = [(*file, *change) for file, (before, after) in files.items() for change in file_changes(before, after)]
    names = [c.split()[0] for c in _CHANGES.split(", ")]
    return pa.table({n: pa.array([r[i] for r in rows], pa.string()) for i, n in enumerate(names)})


def profiles(lines: DataFrame, containers: Collection[str] | None = CONTAINERS) -> DataFrame:
    """Fields of each file: table_name, feed, file_path, batch_day, field_path, types, sketch; partial, one row for each partition that holds part of the file."""
    need = ["table_name", "feed", "file_path", "batch_day", "body"]
    return lines.select(*(F.col(n).cast("string").alias(n) for n in need)).mapInArrow(_profiler(containers), _PROFILE)


def schema_changes(lines: DataFrame, containers: Collection[str] | None = CONTAINERS) -> DataFrame:
    """Changes of fields from file to file.

    lines: table_name, feed, file_path, batch_day, body; other columns are ignored.  Returns
    table_name, feed, file_path, field_path, change ('added', 'removed', 'renamed', 'type_changed')
    and old_path (of a renamed field).  containers: the fields whose members are fields of their own; None for all.  Files of a feed are ordered by batch_day, then file_path.

    Lines that aren't JSON objects, null bodies among them, have no fields; a file of such lines
    only is a file without fields.  Lines delivered again, late or out of order change nothing.
    Rows with a null feed form one feed, and so do null file paths one file.  An empty table has no
    changes.  No step gathers a file's lines or a feed's fields in one task: what meets is the
    profile of two files, whose size follows the number of their fields.
    """
    return _changes(stored(profiles(lines, containers), "profiles"))


def _changes(own: DataFrame) -> DataFrame:
    files = own.where("field_path is null").groupBy("table_name", "feed", "file_path").agg(F.min("batch_day").alias("day"))
    order = Window.partitionBy("table_name", "feed").orderBy(F.col("day").asc_nulls_first(), F.col("file_path").asc_nulls_first())
    steps = files.withColumn("n", F.row_number().over(order)).select("table_name", "feed", "file_path", "n")
    at = own.alias("p").join(
        steps.alias("s"), on=[F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("table_name", "feed", "file_path")]
    ).select("p.table_name", "p.feed", "p.file_path", "p.field_path", "p.types", "p.sketch", "s.n")
    later = steps.select(F.col("table_name").alias("t"), F.col("feed").alias("f"), F.col("file_path").alias("next_path"), (F.col("n") - 1).alias("m"))
    before = at.join(later, F.col("table_name").eqNullSafe(F.col("t")) & F.col("feed").eqNullSafe(F.col("f")) & (F.col("n") == F.col("m")))
    before = before.select("table_name", "feed", F.col("next_path").alias("file_path"), F.lit("before").alias("side"), "field_path", "types", "sketch")
    after = at.where("n > 1").select("table_name", "feed", "file_path", F.lit("after").alias("side"), "field_path", "types", "sketch")
    buckets = max(8, -(-own.count() // COMPARED))
    file = F.pmod(F.xxhash64("table_name", "feed", "file_path"), F.lit(buckets))
    return before.unionByName(after).groupBy(file.alias("bucket")).applyInArrow(_compare, _CHANGES)


def common_names(changes: DataFrame, uses: dict[str, int]) -> dict[str, str]:
    """path -> the path under which all files agree: of names that a rename links, the most used one.

    The driver gets the distinct renames, whose number follows the number of field names, not of records."""
    pairs = [(r["old_path"], r["field_path"]) for r in changes.where("change = 'renamed'").select("old_path", "field_path").distinct().collect()]
    lead: dict[str, str] = {}

    def find(x: str) -> str:
        while lead.get(x, x) != x:
            x = lead[x]
        return x

    for a, b in sorted(pairs):
        lead[find(a)] = find(b)
    groups: dict[str, list[str]] = {}
    for x in {p for pair in pairs for p in pair}:
        groups.setdefault(find(x), []).append(x)
    return {x: max(g, key=lambda p: (uses.get(p, 0), p)) for g in groups.values() for x in g}


def column_of(path: str, paths: dict[str, int]) -> str:
    """The column of a list member's field; tools.function.x keeps `function` where tools.x is another field."""
    holder, key = path.split(".", 1)[0], path.rsplit(".", 1)[-1]
    return path.split(".", 1)[1] if path != f"{holder}.{key}" and f"{holder}.{key}" in paths else key


def _unifier(names: dict[str, str], types: dict[str, int]):
    """Lines -> records under common names: scalars cast to the field's one type, everything else as JSON text."""

    def cast(path: str, value: object) -> object:
        if value is None:
            return None
        mask = types.get(path, 1)
        if mask == 2:
            return value if isinstance(value, int) else None
        if mask == 2 | _FRACTION:
            return float(value) if isinstance(value, (int, float)) else None
        if mask == 4:
            return value if isinstance(value, bool) else None
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)

    def unify(body: str | None) -> str | None:
        record = _as_object(body)
        if record is None:
            return None
        out: dict = {}
        for name, value in record.items():
            if name not in ("messages", "tools"):
                path = names.get(name, name)
                out[path] = cast(path, value) if out.get(path) is None else out[path]
                continue
            members = []
            for member in value if isinstance(value, list) else [value] if isinstance(value, dict) else []:
                flat = {}
                for path, v in fields_of({name: [member]}):
                    path = names.get(path, path)
                    key = column_of(path, types)
                    flat[key] = cast(path, v) if flat.get(key) is None else flat[key]
                members.append(flat)
            out[name] = members
        return json.dumps(out, ensure_ascii=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies = pa.array([unify(x) for x in b.column("body").to_pylist()], pa.string())
            yield b.set_column(b.schema.get_field_index("body"), "body", bodies)

    return run


def unified_records(lines: DataFrame) -> DataFrame:
    """All records of all files as one table, under common names and types.

    lines: as for schema_changes, with record_no, line_no and arrived_at.  Returns table_name,
    feed, file_path, line_no, record_no and `record`, a struct with one column for each common
    field; `messages` and `tools` are arrays of structs.  A field that was a whole number of 64 bits in every
    file is a long, any other number a double, a boolean a boolean, anything else a string (JSON text where it wasn't one).  A line
    delivered several times (same table, file and line) counts once, as it arrived last; ties go to
    the larger record_no; a line without line_no is known by its record_no.  `messages` or `tools` given as one
    object is a list of it.  Lines that aren't JSON objects are left out.
    """
    own = stored(profiles(lines), "profiles")
    changes = _changes(own)
    known = own.where("field_path is not null").groupBy("field_path").agg(F.bit_or("types").alias("types"), F.count_distinct("file_path").alias("n")).collect()
    names = common_names(changes, {r["field_path"]: r["n"] for r in known})
    types: dict[str, int] = {}
    for r in known:
        path = names.get(r["field_path"], r["field_path"])
        types[path] = types.get(path, 0) | r["types"]
    spark_type = lambda mask: {2: "long", 2 | _FRACTION: "double", 4: "boolean"}.get(mask, "string")
    top, inner = {}, {c: {} for c in ("messages", "tools")}
    for path, mask in sorted(types.items()):
        holder = path.split(".", 1)[0]
        if "." in path and holder in inner:
            key = column_of(path, types)
            inner[holder][key] = inner[holder].get(key, 0) | mask
        else:
            top[path] = mask
    quoted = lambda fields: ", ".join(f"`{n.replace('`', '``')}`: {spark_type(m)}" for n, m in fields.items())
    shape = ", ".join([quoted(top)] * bool(top) + [f"{c}: array<struct<{quoted(inner[c])}>>" for c in inner if inner[c]])
    keep = ["table_name", "feed", "file_path", "line_no", "record_no", "body"]
    last = lines.groupBy("table_name", "feed", "file_path", "line_no", F.when(F.col("line_no").isNull(), F.col("record_no")).alias("unnumbered")).agg(F.max_by(F.struct("record_no", "body"), F.struct("arrived_at", "record_no")).alias("r"))
    flat = last.select("table_name", "feed", "file_path", "line_no", "r.record_no", "r.body").select(*keep)
    done = flat.mapInArrow(_unifier(names, types), flat.schema).where("body is not null")
    return done.select(*keep[:-1], F.from_json("body", f"struct<{shape}>").alias("record"))
