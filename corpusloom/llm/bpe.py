"""Tokens of texts under an existing byte-level BPE vocabulary, counted without making the tokens.

A text is cut into pieces; each distinct piece is merged once, as a linked list of symbols with a
priority queue of merges, and the surviving symbols are counted; a text's count is the sum over its
pieces.  Distinct pieces are few next to their occurrences, so a task remembers their counts.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Where the vocabularies are on every machine, and the one used unless another is named.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pattern of pieces that these vocabularies were made with.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct pieces a task remembers before it starts afresh.
REMEMBERED = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def surviving_symbols(piece: bytes, ranks: dict[bytes, int]) -> int:
    """Symbols left of a piece when no further pair can be merged, lowest rank first, leftmost on ties."""
    n = len(piece)
    if n < 2 or piece in ranks:
        return min(n, 1)
    start = list(range(n))  # where the symbol begins that this one follows, and where the next begins
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    end = list(range(1, n + 1))
    queue = [(rank, i, i + 2) for i in start[:-1] if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(queue)
    left = n
    while queue:
        _, i, stop = heapq.heappop(queue)
        j = after[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue  # one of the two symbols has grown or gone since
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[i] < n:
            before[after[i]] = i
        left -= 1
        for a in (before[i], i):
            if a >= 0 and after[a] < n:
                to = end[after[a]]
                if (rank := ranks.get(piece[a:to])) is not None:
                    heapq.heappush(queue, (rank, a, to))
    return left


class _Counts(dict):
    """piece -> tokens, filled on demand."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = self[piece] = surviving_symbols(piece.encode("utf-8", "replace"), self.ranks)
        return n


class TokenCounter:
    """Counts the tokens of texts; one for each task."""

    def __init__(self, path: str) -> None:
        self.counts = _Counts(read_ranks(path))
        self.pieces = regex.compile(PIECES).findall

    def count(self, text: str | None) -> int:
        """0 for a null or empty text."""
        return sum(map(self.counts.__getitem__, self.pieces(text))) if text else 0


def with_tokens(df: DataFrame, text: str = "text", into: str = "tokens", keep: list[str] | None = None, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns in keep (all but the text by default) and the number of tokens of each text.

    Null and empty texts have 0 tokens; texts are counted whole, however long.  A column that is
    already called like the count is replaced.  One pass, no shuffle."""
    keep = [c for c in (keep if keep is not None else [c for c in df.columns if c != text]) if c.lower() != into.lower()]
    path = f"{tokenizers}/{vocabulary}"
    given = df.select(*keep, df[text].alias("__text"))
    schema = given.select(*keep).schema.add(into, "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(path)
        for b in batches:
            n = pa.array([counter.count(t) for t in b.column("__text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], [*b.schema.names[:-1], into])

    return given.mapInArrow(count, schema)
