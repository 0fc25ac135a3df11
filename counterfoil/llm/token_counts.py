"""Token counts by heap-and-linked-list byte-pair merging.

A text becomes a linked list of characters. A heap holds every adjacent pair that is a
piece of the vocabulary, lowest rank first, the left one first among equals. The best
pair is popped and merged, its two new neighbours are pushed, pairs that no longer stand
are skipped. The count is the number of initial symbols less the number of merges; no
identifiers are made. A character outside the vocabulary counts as its UTF-8 bytes.

A text is cut where no piece of the vocabulary reaches over the cut, so its chunks are
merged one by one, and the counts of recent short chunks are remembered in a table of
bounded size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from counterfoil.llm.common import MARK, SPACE, Memo, cutter, marked

NORMAL, UNUSED, USER_DEFINED = 1, 5, 4
BPE = 2
#: Chunk counts that a Python worker remembers, twice this many at most.
REMEMBERED = 600_000
TOKEN_LIMIT = 4096


def piece_ranks(model: bytes) -> dict[str, int]:
    """Rank of each piece of a byte-pair model with byte fallback, marks as spaces; equal scores have equal ranks."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    norm = proto.normalizer_spec
    if proto.trainer_spec.model_type != BPE or not proto.trainer_spec.byte_fallback:
        raise ValueError("a byte-pair model with byte fallback is needed")
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not (
        norm.add_dummy_prefix and norm.escape_whitespaces
    ):
        raise ValueError("only models without normalisation, with a mark in front, are read")
    if any(p.type in (UNUSED, USER_DEFINED) for p in proto.pieces):
        raise ValueError("unused and user-defined pieces are not supported")
    scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
    rank = {score: place for place, score in enumerate(sorted(set(scores.values()), reverse=True))}
    return {piece.replace(MARK, SPACE): rank[score] for piece, score in scores.items()}


def merged_count(chunk: str, ranks: dict[str, int]) -> int:
    """Tokens of one chunk."""
    symbols: list[str] = list(chunk)
    end = len(symbols)
    count = end + sum(len(s.encode("utf-8", "replace")) - 1 for s in symbols if s not in ranks)
    right = list(range(1, end + 1))
    left = list(range(-1, end - 1))
    pairs = enumerate(map(add, symbols, symbols[1:]))
    heap = [(ranks[pair], at, pair) for at, pair in pairs if pair in ranks]
    heapq.heapify(heap)
    while heap:
        _, at, pair = heapq.heappop(heap)
        after = right[at]
        if after == end or not symbols[at] or symbols[at] + symbols[after] != pair:
            continue
        symbols[at], symbols[after] = pair, ""
        count -= 1
        beyond = right[at] = right[after]
        if beyond < end:
            left[beyond] = at
            new = pair + symbols[beyond]
            if new in ranks:
                heapq.heappush(heap, (ranks[new], at, new))
        before = left[at]
        if before >= 0:
            new = symbols[before] + pair
            if new in ranks:
                heapq.heappush(heap, (ranks[new], before, new))
    return count


class Counter:
    """Counts tokens of whole texts."""

    def __init__(self, model: bytes, remembered: int = REMEMBERED):
        ranks = piece_ranks(model)
        self.memo = Memo(lambda chunk: merged_count(chunk, ranks), remembered)
        self.cut = cutter(ranks).findall

    def count(self, text: str | None) -> int:
        return sum(map(self.memo.__getitem__, self.cut(marked(text)))) if text else 0


@lru_cache(maxsize=2)
def _counter(model: bytes) -> Counter:
    return Counter(model)


def token_count(text: str | Column, model: bytes) -> Column:
    """Column of token counts; NULL and empty texts count 0. The model (below 10 MB) goes with the plan."""
    if len(model) > 10_000_000:
        raise ValueError("model files above 10 MB are not sent with a plan")

    @F.pandas_udf("long")
    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(model)
        for batch in texts:
            yield pd.Series([counter.count(t) for t in batch], dtype="int64")

    return counted(text)


def count_tokens(docs: DataFrame, model: bytes, text: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """``docs`` without its text, with n_bytes, n_tokens and over_limit (n_tokens > ``limit``).

    One pass without a shuffle; rows stay one to one, repeated rows and NULL ids included.
    NULL texts are empty texts: 0 bytes, 0 tokens. Columns of ``docs`` with the names of
    the three results, in any case, are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    taken = {text.lower(), "n_bytes", "n_tokens", "over_limit"}
    kept = [f"`{c}`" for c in docs.columns if c.lower() not in taken]
    return docs.select(
        *kept, F.octet_length(whole).cast("long").alias("n_bytes"), token_count(whole, model).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
