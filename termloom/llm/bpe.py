"""Byte-level BPE encoding of a corpus with a public vocabulary (problem 6).

Texts are split by the vocabulary's pattern; each distinct piece is merged once per worker with the contiguous
rank array method and then found in a table, so that the merge loop runs for new words only.  Nothing is shuffled.

Contiguous rank array: a word is its list of part boundaries and, beside it, the rank of each two adjacent parts.
The smallest rank is found by a scan, its inner boundary is deleted, and the two ranks at its sides are refreshed,
until no adjacent parts form a vocabulary entry.  The scan is linear, so words beyond ``LONG_WORD`` bytes keep the
same arrays as a linked list with a heap over the ranks; the result is the same, in n log n.
"""

from __future__ import annotations

import base64
import heapq
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the split pattern of the 50k byte-level vocabularies; white space is Unicode's property.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
LONG_WORD = 200
#: Words a worker remembers; beyond that it starts anew (speed only, never the result).
CACHE_WORDS = 400_000
NONE = 1 << 60


def default_vocabulary() -> str:
    """The rank file used where no path is given: that of the environment variable, else of the installed package."""
    if p := os.environ.get("TERMLOOM_TOKENIZERS"):
        return os.path.join(p, "byte_bpe_50k.tiktoken")
    try:
        import public_tokenizers

        return public_tokenizers.path("byte_bpe_50k.tiktoken")
    except ImportError:
        return "/opt/tokenizers/byte_bpe_50k.tiktoken"


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks by piece, from the bytes of a rank file (base64 piece, space, rank)."""
    return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in data.splitlines() if line.strip())}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) > LONG_WORD:
        return _merge_long(word, ranks)
    get = ranks.get
    bounds = list(range(len(word) + 1))
    pairs = [get(word[i : i + 2], NONE) for i in range(len(word) - 1)]
    while pairs and (low := min(pairs)) != NONE:
        i = pairs.index(low)
        del bounds[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = get(word[bounds[i] : bounds[i + 2]], NONE)
        if i:
            pairs[i - 1] = get(word[bounds[i - 1] : bounds[i + 1]], NONE)
    return [ranks[word[a:b]] for a, b in zip(bounds, bounds[1:])]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(word)
    end = list(range(1, n + 1))  # of the part that starts here; 0: no part starts here
    before = list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        mid = end[i]
        if not mid or mid >= n or ranks.get(word[i : end[mid]]) != rank:
            continue
        end[i], end[mid] = end[mid], 0
        if end[i] < n:
            before[end[i]] = i
            if (r := ranks.get(word[i : end[end[i]]])) is not None:
                heapq.heappush(heap, (r, i))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p : end[i]])) is not None:
            heapq.heappush(heap, (r, p))
    return [ranks[word[i : end[i]]] for i in range(n) if end[i]]


class Encoder(dict):
    """Pieces of text with their ids; a missing one is merged when first asked for."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.split = regex.compile(SPLIT).findall

    def __missing__(self, piece: str) -> array:
        ids = array("i", merge_word(piece.encode("utf-8", "surrogatepass"), self.ranks))
        if len(piece) <= LONG_WORD:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str | None) -> array:
        """Ids of a text; an empty array for null and for the empty text."""
        ids = array("i")
        for x in map(self.__getitem__, self.split(text or "")):
            ids += x
        return ids


_ENCODERS: dict[int, Encoder] = {}


def encoder(data: bytes) -> Encoder:
    """The worker's encoder for a rank file; one is kept between batches and tasks."""
    key = hash(data)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(read_ranks(data))
    return _ENCODERS[key]


def _shared_vocabulary(df: DataFrame, path: str | None):
    with open(path or default_vocabulary(), "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())  # a fixed file of less than 1 MB


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of each row, whatever other columns there are.

    Null and empty texts give an empty list; white space alone is encoded like any text; rows with equal or null ids
    each give a row; an empty table gives an empty one.  Map-only."""
    shared = _shared_vocabulary(df, vocabulary)
    src = df.select(F.col(id_col).alias("rec"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        for b in batches:
            texts, step = b.column(1), 1024
            for at in range(0, len(b), step):
                flat, sizes = array("i"), [0]
                for t in texts.slice(at, step).to_pylist():
                    for x in map(enc.__getitem__, enc.split(t or "")):
                        flat += x
                    sizes.append(len(flat))
                if sizes[-1] >= 2**31:
                    raise OverflowError("more than 2**31 token ids in one batch")
                ids = pa.ListArray.from_arrays(pa.array(np.array(sizes, np.int32)), pa.array(np.frombuffer(flat, np.int32) if flat else np.empty(0, np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, step), ids], names=["rec", "ids"])

    kind = dict(src.dtypes)["rec"]
    return src.mapInArrow(run, f"rec {kind}, ids array<int>").withColumnRenamed("rec", id_col)


def with_token_count(df: DataFrame, text_col: str = "text", vocabulary: str | None = None, name: str = "n_tokens") -> DataFrame:
    """``df`` without ``text_col``, with the number of tokens of it (0 for null and empty texts).  Map-only."""
    shared = _shared_vocabulary(df, vocabulary)
    keep = [c for c in df.columns if c not in (text_col, name)]
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        for b in batches:
            n = [sum(map(len, map(enc.__getitem__, enc.split(t)))) if t else 0 for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*keep, name])

    fields = ", ".join(f"`{c}` {k}" for c, k in src.dtypes[:-1])
    return src.mapInArrow(run, f"{fields}, `{name}` bigint")
