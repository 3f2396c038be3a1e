"""Tokenising with an existing tokenizer, loaded once for each task."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .text import SPACE

#: Texts that a tokenizer encodes at once.
BATCH = 1000


def whitespace_tokens(t: Column) -> Column:
    """Number of words between white space: the tokenizer of last resort, without Python."""
    words = F.filter(F.split(F.trim(F.regexp_replace(F.coalesce(t, F.lit("")), SPACE, " ")), " "), lambda w: w != "")
    return F.size(words).cast("long")


@dataclass(frozen=True)
class TokenizerContract:
    """A tokenizer's identity and the special ids a pack needs; workers load the file and must find the same hash."""

    path: str
    eos_id: int
    pad_id: int
    digest: str

    @classmethod
    def load(cls, path: str, eos: str, pad: str | None = None, reuse_eos: bool = False) -> TokenizerContract:
        """pad None with reuse_eos pads with EOS; otherwise PAD must exist and differ from EOS."""
        from tokenizers import Tokenizer

        with open(path, "rb") as f:
            digest = hashlib.sha256(f.read()).hexdigest()[:16]
        tok = Tokenizer.from_file(path)
        eos_id = tok.token_to_id(eos)
        if eos_id is None:
            raise ValueError(f"the tokenizer has no token {eos!r}")
        if pad is None:
            if not reuse_eos:
                raise ValueError("name a pad token, or allow EOS to be reused")
            return cls(path, eos_id, eos_id, digest)
        pad_id = tok.token_to_id(pad)
        if pad_id is None or (pad_id == eos_id and not reuse_eos):
            raise ValueError(f"{pad!r} is no pad token of its own")
        return cls(path, eos_id, pad_id, digest)


def file_encoder(path: str) -> Callable[[], Callable[[list[str]], list[list[int]]]]:
    """A maker of an encoder for a tokenizers JSON file; special tokens are neither added nor recognised in text."""

    def make() -> Callable[[list[str]], list[list[int]]]:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        encode = getattr(tok, "encode_batch_fast", tok.encode_batch)  # without character offsets, where the library can
        return lambda texts: [e.ids for e in encode(texts, add_special_tokens=False)]

    return make


def tokenize(df: DataFrame, make_encoder: Callable[[], Callable[[list[str]], list[list[int]]]], text: str = "text") -> DataFrame:
    """Adds input_ids (int array) and token_count to all columns; a null text counts as empty. One pass, no shuffle."""
    base = df.drop("input_ids", "token_count")
    schema = StructType([*base.schema.fields, StructField("input_ids", ArrayType(IntegerType())), StructField("token_count", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make_encoder()
        for b in batches:
            for i in range(0, max(b.num_rows, 1), BATCH):
                part = b.slice(i, BATCH)
                ids = encode([t or "" for t in part.column(text).to_pylist()])
                counts = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum()))
                made = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*part.columns, made, pa.array(counts)], [*part.schema.names, "input_ids", "token_count"])

    return base.mapInArrow(run, schema)


def counts(df: DataFrame, by: str, tokens: str = "token_count") -> DataFrame:
    """records, tokens and tokens a record, by a column; 0 tokens a record where there are none."""
    return df.groupBy(by).agg(F.count("*").alias("records"), F.coalesce(F.sum(tokens), F.lit(0)).alias("tokens"), F.coalesce(F.round(F.avg(F.coalesce(tokens, F.lit(0))), 6), F.lit(0.0)).alias("tokens_a_record"))
