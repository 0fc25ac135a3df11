"""What several corpus operators share: words, folds, sentence-piece chunks, bounded caches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words, and how many folds there are.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_SQL = r"[^\x20\x09-\x0D]+"
FOLDS = 5

#: The mark that a model has for a space. Here both are a space, which keeps most strings at a byte a character.
MARK, SPACE = "▁", " "
#: Ways to cut a text, finest first. Whether there is a cut depends on two neighbours alone:
#: before a space that follows something else, and in the finer way where letters meet others.
_LETTER = r"[^\W\d_\xb2\xb3\xb9\xbc-\xbe]"
CUTS = (
    re.compile(f"{SPACE}*(?:{_LETTER}+|(?:(?!{SPACE}|{_LETTER}).)+)|{SPACE}+", re.DOTALL),
    re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+"),
    re.compile(".+", re.DOTALL),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: str | Column) -> Column:
    """crc32 of the id as text, modulo 5; NULL ids have no fold."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % FOLDS


def held_out(doc_id: str | Column) -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def learnable(doc_id: str | Column) -> Column:
    return F.coalesce(fold(doc_id) != 0, F.lit(False))


def marked(text: str) -> str:
    """The text as a sentence-piece model without normalisation sees it: a mark is a space, and there is one in front."""
    return SPACE + text.replace(MARK, SPACE) if text else ""


def cutter(pieces: Iterable[str]) -> re.Pattern:
    """The finest of ``CUTS`` that goes through no piece: merges never reach over such a cut."""
    pieces = [p.replace(MARK, SPACE) for p in pieces]
    return next(cut for cut in CUTS if all(len(cut.findall(p)) == 1 for p in pieces))


class Memo(dict):
    """Remembers what ``compute`` gave for recent short keys; at most 2 * ``room`` of them.

    Keys seen since the last turn move to the new generation, so frequent ones stay. A
    forgotten key is computed again, with the same result.
    """

    def __init__(self, compute: Callable[[str], Any], room: int, longest: int = 64):
        super().__init__()
        self.compute, self.room, self.longest, self.older = compute, room, longest, {}

    def __missing__(self, key: str) -> Any:
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.room:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value
