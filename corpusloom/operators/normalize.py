"""Source records to canonical pretraining rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..functions.text import conversation_text, int_or_null, normal_text, string_or_null
from ..schema import PRETRAINING_SCHEMA

#: Names a field may have in a source, best first.
CANDIDATES = {
    "text": ("text", "content", "body", "document", "conversations", "messages"),
    "id": ("id", "doc_id", "uuid", "document_id"),
    "url": ("url", "uri", "link", "metadata.url"),
    "token_count": ("token_count", "num_tokens", "n_tokens", "metadata.token_count"),
}


@dataclass(frozen=True)
class Source:
    """A named source and the tags that hold for all its records."""

    name: str
    domain: str | None = None
    subdomain: str | None = None
    subset: str | None = None
    license: str | None = None
    language: str | None = None
    upstream_source: str | None = None
    synthetic: bool = False
    fields: dict[str, str] = field(default_factory=dict)


def resolve(df: DataFrame, source: Source) -> dict[str, str | None]:
    """field -> column, once for the source: an explicit one, else the first candidate there is.  A dotted candidate is there if its root is."""
    have = set(df.columns)
    return {f: source.fields.get(f) or next((c for c in names if c.split(".")[0] in have), None) for f, names in CANDIDATES.items()}


def inspect(df: DataFrame, source: Source) -> dict[str, object]:
    """Whether a source can be normalised: ok, needs_mapping, empty, or error where it can't be read, and what is missing."""
    found = resolve(df, source)
    try:
        status = "needs_mapping" if found["text"] is None else "ok" if df.take(1) else "empty"
    except Exception as e:  # noqa: BLE001 - whatever stops a source from being read is what is reported
        return {"source": source.name, "status": "error", "fields": found, "columns": df.columns, "warnings": [str(e).split("\n", 1)[0]]}
    return {"source": source.name, "status": status, "fields": found, "columns": df.columns, "warnings": [f"no {f} field" for f, c in found.items() if c is None]}


def _text(df: DataFrame, column: str | None) -> Column:
    if column is None:
        return F.lit(None).cast("string")
    kind = df.select(column).schema[0].dataType
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
        return conversation_text(F.col(column))
    return F.col(column).cast("string")


def to_pretraining(df: DataFrame, source: Source, form: bool = True) -> DataFrame:
    """The 20 canonical columns: text normalised, tags from the source, anything still null copied from the record's field of the same name.

    form False leaves the text's Unicode form and spaces as they are.  Null texts stay null.  Columns
    the canon doesn't have are dropped."""
    found = resolve(df, source)
    tags = {"source_dataset": source.name, "domain": source.domain, "subdomain": source.subdomain, "subset": source.subset, "license": source.license, "language": source.language, "upstream_source": source.upstream_source}
    have = {c.lower(): c for c in df.columns}
    text = _text(df, found["text"])
    made: dict[str, Column] = {"text": normal_text(text) if form else text}
    for name in ("id", "url"):
        made[name] = string_or_null(F.col(found[name])) if found[name] else F.lit(None).cast("string")
    made["token_count"] = int_or_null(F.col(found["token_count"])) if found["token_count"] else F.lit(None).cast("long")
    out = []
    for f in PRETRAINING_SCHEMA.fields:
        own = made.get(f.name, F.lit(tags.get(f.name)).cast(f.dataType))
        if f.name == "synthetic":
            own = F.lit(source.synthetic)
        elif f.name not in ("text", "dedup_keep") and f.name in have:
            own = F.coalesce(own.cast(f.dataType), F.col(have[f.name]).cast("string").try_cast(f.dataType))
        out.append(own.cast(f.dataType).alias(f.name))
    return df.select(*out)
