"""Scalar functions on texts, ids and conversations, as column expressions."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: All white space that Python's str.split knows.
SPACE = r"(?U)[\s\x1c-\x1f]+"


@pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


@pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def _composed(t: Column, form) -> Column:  # noqa: ANN001
    # ASCII is its own normal form: those rows reach Python as nulls
    return F.coalesce(form(F.when(t.rlike(r"[^\x00-\x7F]"), t)), t)


def one_space(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, SPACE, " "))


def normal_text(t: Column) -> Column:
    """NFC, one space for every run of white space, none outside; null stays null."""
    return one_space(_composed(t, _nfc))


def cluster_text(t: Column) -> Column:
    """NFKC and single spaces; null counts as empty."""
    return one_space(_composed(F.coalesce(t, F.lit("")), _nfkc))


def text_hash(normal: Column) -> Column:
    """SHA-256 of a text in hex; null counts as empty."""
    return F.sha2(F.coalesce(normal, F.lit("")), 256)


def stable_hash(seed: object, *parts: Column) -> Column:
    """Sixteen hex digits that order like the unsigned 64-bit number they stand for: SHA-256 of seed and parts, with zero bytes between."""
    joined: list[Column] = [F.lit(str(seed))]
    for p in parts:
        joined += [F.lit("\0"), p.cast("string")]
    return F.substring(F.sha2(F.concat(*joined), 256), 1, 16)


def as_unsigned(h16: Column) -> Column:
    return F.conv(h16, 16, 10).cast("decimal(20,0)")


def scrub_line(line: Column) -> Column:
    """A raw line without control characters: runs of NUL become a space, the others but tab and line ends go."""
    return F.trim(F.regexp_replace(F.regexp_replace(line, r"\x00+", " "), r"[\x01-\x08\x0b\x0c\x0e-\x1f\x7f]", ""))


def conversation_text(turns: Column) -> Column:
    """Turns as lines `role: content`; a turn without role is its content, null turns and contents are left out."""
    line = lambda t: F.when(t["role"].isNotNull() & t["content"].isNotNull(), F.concat(t["role"], F.lit(": "), t["content"])).otherwise(t["content"])
    return F.array_join(F.transform(turns, line), "\n")


def string_or_null(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s != "", s)


def int_or_null(c: Column) -> Column:
    return c.cast("string").try_cast("bigint")


def url_host(url: Column) -> Column:
    """Lower-cased host; '' where there is none."""
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))


def shape_flags(t: Column) -> list[Column]:
    """html_like, code_like and non_ascii (in the first 4096 characters) as 0 or 1, and bytes; null counts as empty."""
    low, whole = F.lower(F.coalesce(t, F.lit(""))), F.coalesce(t, F.lit(""))
    flag = lambda c, n: c.cast("int").alias(n)
    return [
        flag(F.contains(low, F.lit("<html")) | F.contains(low, F.lit("</div>")), "html_like"),
        flag(F.contains(whole, F.lit("def ")) | F.contains(whole, F.lit("function ")) | F.contains(whole, F.lit("#include")), "code_like"),
        flag(F.substring(whole, 1, 4096).rlike(r"[^\x00-\x7F]"), "non_ascii"),
        F.octet_length(whole).cast("long").alias("bytes"),
    ]


def truncated(s: Column, n: int) -> Column:
    """At most n characters, the last three dots where some are cut; null reads N/A."""
    return F.when(s.isNull(), "N/A").when(F.length(s) <= n, s).otherwise(F.concat(F.substring(s, 1, n - 3), F.lit("...")))


def first_user_message(turns: Column, n: int = 40) -> Column:
    """Start of the first user's turn that says something."""
    said = F.filter(turns, lambda t: (t["role"] == "user") & (t["content"] != ""))
    return F.when(F.size(said) > 0, truncated(F.trim(F.get(said, F.lit(0))["content"]), n)).otherwise("")


def model_provider(model: Column, required: bool = True) -> Column:
    """What stands before the first slash; without one, null, or the whole name where not required."""
    return F.when(F.contains(model, F.lit("/")), F.split_part(model, F.lit("/"), F.lit(1))).otherwise(F.lit(None).cast("string") if required else model)


def length_bin(tokens: Column, edges: Sequence[int]) -> Column:
    """The smallest edge that holds the count; the last edge has no upper end, null stays null."""
    checked = check_edges(edges)
    out = F.when(tokens.isNull(), F.lit(None).cast("long"))
    for e in checked[:-1]:
        out = out.when(tokens <= e, F.lit(e).cast("long"))
    return out.otherwise(F.lit(checked[-1]).cast("long"))


def check_edges(edges: Sequence[int]) -> list[int]:
    """Edges of length bins: at least one, positive, strictly rising."""
    out = [int(e) for e in edges]
    if not out or out[0] <= 0 or any(a >= b for a, b in zip(out, out[1:], strict=False)):
        raise ValueError(f"length bins must be positive and strictly rising: {edges}")
    return out


def uuid5(name: Column, namespace: str = "6ba7b8119dad11d180b400c04fd430c8") -> Column:
    """The version-5 UUID of a name in a namespace (that of URLs by default)."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    nibble = F.substring(F.lit("89ab"), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1), F.lit(1))
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"), F.substring(digest, 14, 3), F.lit("-"), nibble, F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12)
    )


def cell_preview(c: Column, kind: str, n: int = 20) -> Column:
    """A value in a table cell: null, true, [3 items], {2 keys} or a shortened string."""
    if kind.startswith("array"):
        shown = F.concat(F.lit("["), F.size(c).cast("string"), F.lit(" items]"))
    elif kind.startswith("map"):
        shown = F.concat(F.lit("{"), F.size(c).cast("string"), F.lit(" keys}"))
    elif kind.startswith("struct"):
        shown = F.lit(f"{{{kind.count(':')} keys}}")
    else:
        shown = truncated(c.cast("string"), n)
    return F.when(c.isNull(), "null").otherwise(shown)


def readable_size(n: float) -> str:
    """Bytes as a person reads them: 512 B, 1.5 KB, 2.0 GB."""
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if n < 1024 or unit == "TB":
            return f"{int(n)} B" if unit == "B" else f"{n:.1f} {unit}"
        n /= 1024
    raise AssertionError


def urn(application: str, kind: str, *parts: str | int | None) -> str:
    """The name that a record's UUID is made of: urn:<application>:<kind>:v1:<compact ASCII JSON of the parts>."""
    return f"urn:{application}:{kind}:v1:" + json.dumps(list(parts), separators=(",", ":"))
