"""SimHash near-duplicates, candidates pruned by the pigeonring principle.

A fingerprint of 64 bits is seen as a ring of 16 segments of 4 bits. If two fingerprints
differ in at most 4 bits, then from some segment on every chain of consecutive segments
keeps within its share of them: chains of 3 segments differ in 0 bits, of 7 in at most
1, of 11 in 2, of 15 in 3. So from that start 3 segments are equal, and of the next 4
at least 3: 16 starts times 4 segments left out give 64 keys of 24 bits, and two
fingerprints within the distance share one of them. What shares a key is pruned by the
chain's budgets, then the whole distance is checked. A pair is kept at its first start
and one key only, so no pair comes twice.

Equal fingerprints are one class; links are between classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import WORD
from counterfoil.llm.components import components
from counterfoil.session import pin

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
SEGMENTS, WIDTH = 16, 4
EXACT = 3
#: Segments of a chain that may hold a difference at the second step: all but one are equal.
NEXT = 4
_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if it is set in over half the hashes of the word shingles; 0 without words."""
    found = WORD.findall((text or "").translate(_LOWER))
    if not found:
        return 0
    shingles = map(" ".join, zip(*(found[k:] for k in range(words)))) if len(found) >= words else [" ".join(found)]
    total, count = np.zeros(64, dtype=np.int64), 0
    hashes = np.array([xxhash.xxh64_intdigest(s.encode("utf-8", "replace"), SEED) for s in shingles], dtype="<u8")
    for lo in range(0, len(hashes), 65_536):
        some = hashes[lo : lo + 65_536]
        total += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        count += len(some)
    return int(np.packbits(2 * total > count, bitorder="little").view("<u8")[0])


def fingerprint_of(text: str | Column, words: int = SHINGLE_WORDS) -> Column:
    """Column of fingerprints as signed 64-bit numbers."""

    @F.pandas_udf("long")
    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, words) for t in batch], dtype=np.uint64).view(np.int64))

    return prints(text)


def hexadecimal(number: str | Column) -> Column:
    return F.lpad(F.lower(F.hex(number)), 16, "0")


def _turned(bits: Column, start: Column | int) -> Column:
    """The ring with segment ``start`` first, in the lowest bits."""
    if isinstance(start, int):
        by = start * WIDTH
        return bits if by == 0 else F.shiftrightunsigned(bits, by).bitwiseOR(F.shiftleft(bits, 64 - by))
    by = (start * WIDTH).cast("int")  # shifts count modulo 64, so a turn by nothing is right too
    return F.call_function("shiftrightunsigned", bits, by).bitwiseOR(F.call_function("shiftleft", bits, 64 - by))


def _segments(first: int, last: int) -> int:
    """Mask of segments first to last - 1, as a signed number."""
    mask = (1 << last * WIDTH) - (1 << first * WIDTH)
    return mask - (1 << 64) if mask >> 63 else mask


def _within_budgets(turned: Column, max_bits: int) -> Column:
    """Whether all chains from the first segment on keep their share of the differences."""
    fine = F.lit(True)
    for bits in range(max_bits):
        # The longest chain whose share is still below bits + 1.
        length = -(-(bits + 1) * SEGMENTS // max_bits) - 1
        fine &= F.bit_count(turned.bitwiseAND(F.lit(_segments(0, length)))) <= bits
    return fine & (F.bit_count(turned) <= max_bits)


def links(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of different values of ``classes.bits`` that differ in at most ``max_bits`` bits.

    Keys are joined, never gathered: Spark splits a key that many fingerprints share, and
    only true pairs leave the join. ``max_bits`` up to 4.

    Spark sizes exploded rows as if they were as few as before, 64 times too low, and would
    broadcast them; so this join is told to merge.
    """
    if not 1 <= max_bits <= MAX_BITS:
        raise ValueError("keys are laid out for distances of 1 to 4 bits")
    starts = [
        F.struct(
            F.lit(start * NEXT + left).alias("way"),
            _turned(F.col("bits"), start)
            .bitwiseAND(F.lit(_segments(0, EXACT + NEXT) & ~_segments(EXACT + left, EXACT + left + 1)))
            .alias("part"),
        )
        for start in range(SEGMENTS)
        for left in range(NEXT)
    ]
    keys = classes.select("bits", F.explode(F.array(*starts)).alias("k")).select(
        # A part takes 28 bits, the way goes below it.
        F.shiftleft("k.part", 8).bitwiseOR(F.col("k.way").cast("long")).alias("key"),
        "bits",
    )
    left, right = keys.select("key", F.col("bits").alias("a")), keys.select(F.col("key").alias("key_b"), F.col("bits").alias("b"))
    apart = F.col("a").bitwiseXOR(F.col("b"))
    way = F.col("key").bitwiseAND(F.lit(255))
    first = F.coalesce(
        *[
            F.when(_within_budgets(_turned(apart, start), max_bits), F.lit(start * NEXT) + _left_out(_turned(apart, start)))
            for start in range(SEGMENTS)
        ]
    )
    near = (F.col("a") < F.col("b")) & _within_budgets(_turned(apart, F.shiftright(way, 2)), max_bits)
    return left.join(right.hint("merge"), (F.col("key") == F.col("key_b")) & near & (way == first)).select("a", "b")


def _left_out(turned: Column) -> Column:
    """Of the segments of the second step the one that differs, the first if none does."""
    found = F.lit(0)
    for place in reversed(range(1, NEXT)):
        mask = _segments(EXACT + place, EXACT + place + 1)
        found = F.when(turned.bitwiseAND(F.lit(mask)) != 0, place).otherwise(found)
    return found


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint, component_id, links of its fingerprint, for each row of ``docs`` (doc_id, text).

    component_id is the least doc_id that can be reached over links and equal
    fingerprints, the row's own included; NULL ids are reached but never least, and a
    component of NULL ids has NULL. NULL and blank texts have the fingerprint 0 and link
    like others; repeated rows stay, with one answer.
    """
    prints = pin(docs.select("doc_id", fingerprint_of("text", words).alias("bits")))
    return prints.join(_placed(prints, max_bits), "bits").select(
        "doc_id", hexadecimal("bits").alias("fingerprint"), "component_id", "links"
    )


def _placed(prints: DataFrame, max_bits: int) -> DataFrame:
    """For each fingerprint of ``prints`` (doc_id, bits): root of its component, component_id, links."""
    rows = prints.count()
    classes = pin(prints.groupBy("bits").agg(F.min("doc_id").alias("least")), rows=rows)
    near = pin(links(classes, max_bits))
    linked = components(near).withColumnRenamed("node", "bits")
    degree = near.select(F.explode(F.array("a", "b")).alias("bits")).groupBy("bits").agg(F.count("*").alias("links"))
    # Both written first, so that nothing but the join happens where a large component is; Spark then splits it.
    placed = pin(classes.join(linked, "bits", "left").withColumn("root", F.coalesce("root", "bits")), rows=rows)
    roots = pin(placed.groupBy("root").agg(F.min("least").alias("component_id")), rows=rows)
    # Exploded too, so as in ``links``.
    return (
        placed.join(roots, "root")
        .join(degree.hint("merge"), "bits", "left")
        .select("bits", "root", "component_id", F.coalesce("links", F.lit(0)).alias("links"))
    )


def one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stand for their group: of each component one row, all columns as they were.

    It is the row with the least doc_id (NULL only if there is no other); of several such
    rows the one with the least fingerprint, then the least in its columns in their order.
    """
    rows = pin(
        docs.select(
            F.col("doc_id").alias("id"), fingerprint_of("text", words).alias("bits"), F.struct("*").alias("row")
        )
    )
    roots = _placed(rows.select(F.col("id").alias("doc_id"), "bits"), max_bits).select("bits", "root")
    chosen = (
        rows.groupBy("bits")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("first"))
        .join(roots, "bits")
        .groupBy("root")
        .agg(F.min(F.struct("first", "bits")).alias("first"))
        .select(F.col("first.first.id").alias("least"), F.col("first.bits").alias("chosen"))
    )
    return (
        rows.join(chosen, (F.col("bits") == F.col("chosen")) & F.col("id").eqNullSafe(F.col("least")))
        .groupBy("chosen")
        .agg(F.min("row").alias("row"))
        .select("row.*")
    )
