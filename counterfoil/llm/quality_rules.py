"""Quality rules by repetition coverage: which part of a text lies inside what it repeats.

Words become random 64-bit numbers; a rolling polynomial hash gives every window of n
words its number, for several n at once in numpy. A window that comes again is checked
word by word against its first occurrence. The characters of words inside windows that
repeat an earlier one, and of lines that repeat an earlier line, are measured against all
characters of words; for short n the most frequent window alone is measured.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import WORD

# Highest share of characters, by window length.
MOST_FREQUENT = {2: 0.20, 3: 0.18, 4: 0.16}
REPEATED = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
REPEATED_LINES = 0.20
BASE_WINDOW = 8
LEAST_WORDS = 20
SYMBOLS = "#*$%&|<>"

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
COVERAGE = (
    ", ".join(f"top_{n} double" for n in MOST_FREQUENT)
    + ", "
    + ", ".join(f"repeated_{n} double" for n in REPEATED)
    + ", repeated_lines double"
)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _numbers(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each word its place among the different words, and a 64-bit number."""
    places = {word: place for place, word in enumerate(dict.fromkeys(words))}
    hashes = np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "replace")) for w in places], dtype=np.uint64)
    place = np.fromiter(map(places.__getitem__, words), dtype=np.int64, count=len(words))
    return place, hashes[place]


def _windows(numbers: np.ndarray, n: int, rolled: np.ndarray | None) -> np.ndarray:
    """Hash of each window of n words, from the windows of n - 1 words."""
    if rolled is None:
        return numbers.copy()
    return rolled[:-1] * _STEP + numbers[n - 1 :]


def _first_places(hashes: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """For each window the first window with the same words (itself, if there is none before it)."""
    order = np.argsort(hashes, kind="stable")
    same = np.concatenate([[False], hashes[order][1:] == hashes[order][:-1]])
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    first = np.empty(len(order), dtype=np.int64)
    first[order] = order[start]
    again = np.flatnonzero(first != np.arange(len(first)))
    wrong = np.zeros(len(again), dtype=bool)
    for k in range(n):
        wrong |= place[again + k] != place[first[again] + k]
    if wrong.any():  # two windows share a hash: look these up by their words
        seen: dict[tuple[int, ...], int] = {}
        for at in np.flatnonzero(np.isin(hashes, hashes[again[wrong]])):
            first[at] = seen.setdefault(tuple(place[at : at + n].tolist()), at)
    return first


def _inside(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in a window that begins at one of ``starts``."""
    change = np.zeros(words + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + n, -1)
    return np.cumsum(change[:-1]) > 0


def measured(text: str | None) -> tuple:
    """The values of ``BASE`` and ``COVERAGE`` for one whole text."""
    text = text or ""
    words = WORD.findall(text)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    chars = int(lengths.sum())
    seen: set[str] = set()
    dup_lines = dup_chars = 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
            dup_chars += sum(map(len, WORD.findall(line)))
        elif WORD.search(line):
            seen.add(line)
    base = [len(words), chars, sum(map(text.count, SYMBOLS)), dup_lines, 0]
    cover = dict.fromkeys([*MOST_FREQUENT, *REPEATED], 0.0)
    rolled = None
    if words:
        place, numbers = _numbers(words)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        for n in range(1, min(len(words), max(REPEATED)) + 1):
            rolled = _windows(numbers, n, rolled)
            if n not in cover:
                continue
            first = _first_places(rolled, place, n)
            again = np.flatnonzero(first != np.arange(len(first)))
            if not len(again):
                break  # no longer window can repeat either
            if n in MOST_FREQUENT:
                times = np.bincount(first)
                most = np.flatnonzero(times == times.max())
                size = (upto[most + n] - upto[most]) * times.max()
                cover[n] = min(1.0, float(size.max()) / chars)
            else:
                cover[n] = float(lengths[_inside(again, n, len(words))].sum()) / chars
            if n == BASE_WINDOW:
                base[4] = int(_inside(np.union1d(again, first[again]), n, len(words)).sum())
    return (*base, *cover.values(), dup_chars / chars if chars else 0.0)


def repetition(text: str | Column) -> Column:
    """Column of structs with the fields of ``BASE`` and ``COVERAGE``."""

    @F.pandas_udf(f"{BASE}, {COVERAGE}")
    def measures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in f"{BASE}, {COVERAGE}".split(", ")]
        for batch in texts:
            yield pd.DataFrame([measured(t) for t in batch], columns=names)

    return measures(text)


def apply_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, the shares and kept for each row of ``docs``.

    One pass without a shuffle. NULL and empty texts have no words and fail the base rule.
    ``kept``: the base rule holds and no share passes its limit. Ties between most frequent
    windows go to the one with more characters. Repeated rows get equal answers.
    """
    measures = docs.select("doc_id", repetition("text").alias("m")).select("doc_id", "m.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    fine = F.col("repeated_lines") <= REPEATED_LINES
    for n, limit in MOST_FREQUENT.items():
        fine &= F.col(f"top_{n}") <= limit
    for n, limit in REPEATED.items():
        fine &= F.col(f"repeated_{n}") <= limit
    return measures.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fine)
