"""Token budget: tokens of each text, records whose count is wrong, totals by source, language and domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import TOKENIZERS, VOCABULARY, with_tokens

#: How many times too large or too small a recorded count may be.
TOLERANCE = 2.5
#: Spellings of the languages, by two-letter code.
LANGUAGE_SPELLINGS = {
    "en": "en eng english", "de": "de deu ger german deutsch", "fr": "fr fra fre french", "es": "es spa spanish",
    "zh": "zh zho chi cmn chinese", "it": "it ita italian", "pt": "pt por portuguese", "ja": "ja jpn japanese", "ru": "ru rus russian",
}
UNKNOWN_SPELLINGS = ("", "und", "unk", "unknown", "none", "null", "n_a", "na", "xx")


def tidy_tag(c: Column) -> Column:
    """A tag in lower case, with underscores for blanks and hyphens; 'unknown' where it says nothing."""
    tag = F.regexp_replace(F.lower(F.trim(c)), r"[\s\-_/]+", "_")
    return F.when(tag.isNull() | tag.isin(*UNKNOWN_SPELLINGS), "unknown").otherwise(tag)


def language_code(c: Column) -> Column:
    """The two-letter code of a language however it is spelt; regions are dropped, other tags kept as they are."""
    tag = F.split_part(tidy_tag(c), F.lit("_"), F.lit(1))
    pairs = [F.lit(x) for code, names in LANGUAGE_SPELLINGS.items() for name in names.split() for x in (name, code)]
    return F.coalesce(F.element_at(F.create_map(*pairs), tag), tag)


def counted(df: DataFrame, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """id, recorded (token_count), tokens, source_dataset, language and domain of each row, tags in one spelling.

    Null texts have 0 tokens.  A null id stays null; other columns are ignored."""
    rows = df.select("id", F.col("token_count").cast("long").alias("recorded"), "text", *(f(F.col(n)).alias(n) for n, f in (("source_dataset", tidy_tag), ("language", language_code), ("domain", tidy_tag))))
    return with_tokens(rows, tokenizers=tokenizers, vocabulary=vocabulary)


def wrong_counts(rows: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(id): records whose recorded count is null, not positive, or more than tolerance times too large or too small; each id once, null ids left out.

    A text without tokens makes any positive count wrong."""
    wrong = F.col("recorded").isNull() | (F.col("recorded") <= 0) | (F.col("recorded") > F.col("tokens") * tolerance) | (F.col("recorded") * tolerance < F.col("tokens"))
    return rows.where(wrong & F.col("id").isNotNull()).select("id").distinct()


def once(rows: DataFrame) -> DataFrame:
    """Each id once: of rows delivered again under the same id, the one with most tokens; rows without an id all stay."""
    named = rows.where("id is not null").groupBy("id").agg(F.max(F.struct("tokens", "recorded", "source_dataset", "language", "domain")).alias("r")).select("id", "r.*")
    return named.unionByName(rows.where("id is null"), allowMissingColumns=True)


def totals(rows: DataFrame) -> DataFrame:
    """Documents and tokens by source_dataset, language and domain, and their sums over each of the three and over all, marked '*'."""
    keys = ["source_dataset", "language", "domain"]
    sets = once(rows).groupingSets([keys, ["source_dataset"], ["language"], ["domain"], []], *keys).agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"), *(F.grouping(k).alias(f"all_{k}") for k in keys))
    return sets.select(*(F.when(F.col(f"all_{k}") == 1, "*").otherwise(F.col(k)).alias(k) for k in keys), "documents", F.coalesce("tokens", F.lit(0)).alias("tokens"))
