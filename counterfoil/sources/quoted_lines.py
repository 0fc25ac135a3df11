"""Records of quoted text files, read in splits, with line breaks inside quotes.

A line break ends a record if the quotes before it are even in number: quotes only enclose
fields, and stand doubled inside them. A split does not know how many stand before it. So each split
counts its own first; running sums over the splits of a file tell which of them begin inside
quotes. Then every split puts its lines together by itself, and only the piece in front of its first
true record and the one behind its last are joined with those of its neighbours.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Sent to the Python workers with the job, so that they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE = '"'
#: Whole records, and pieces of one that lies in several splits: what it begins with, goes on with, ends with.
WHOLE, BEGIN, INSIDE, END = range(4)
PIECES = "file long, split long, at long, kind int, record string"


class Splits:
    """Puts the lines of splits together; ``inside`` are the (file, split) that begin inside quotes."""

    def __init__(self, inside: set[tuple[int, int]]):
        self.inside = inside
        self.now: tuple[int, int] | None = None
        self.open: list[str] = []
        self.head = False
        self.at = 0

    def _piece(self, kind: int, lines: list[str]) -> pa.RecordBatch:
        return self._batch(pa.array(["\n".join(lines)]), kind)

    def _batch(self, records: pa.Array, kind: int) -> pa.RecordBatch:
        n = len(records)
        at = pa.array(np.arange(self.at, self.at + n))
        self.at += n
        place = [pa.array(np.full(n, value)) for value in self.now]
        return pa.RecordBatch.from_arrays(
            [*place, at, pa.array(np.full(n, kind, np.int32)), records], ["file", "split", "at", "kind", "record"]
        )

    def finish(self) -> Iterator[pa.RecordBatch]:
        """What is open at the end of a split."""
        if self.now is not None and (self.open or self.head):
            yield self._piece(INSIDE if self.head else BEGIN, self.open)
        self.open, self.head, self.at = [], False, 0

    def add(self, file: int, split: int, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        if (file, split) != self.now:
            yield from self.finish()
            self.now = (file, split)
            self.head = self.now in self.inside
        quotes = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False)
        starts_open = bool(self.open or self.head)
        open_after = (np.cumsum(quotes) + starts_open) % 2 == 1
        ends = np.flatnonzero(~open_after)
        first = 0
        if starts_open:
            if not len(ends):
                self.open += lines.to_pylist()
                return
            first = int(ends[0]) + 1
            yield self._piece(END if self.head else WHOLE, self.open + lines.slice(0, first).to_pylist())
            self.open, self.head = [], False
        last = int(ends[-1]) + 1 if len(ends) else 0
        closed, begins = open_after[first:last], np.arange(first, last)
        if last > first:
            if not closed.any():
                yield self._batch(lines.slice(first, last - first), WHOLE)
            else:
                # Lines of a record have the number of records that end before them.
                record = np.concatenate([[0], np.cumsum(~closed)[:-1]])
                opens = np.flatnonzero(np.concatenate([[True], record[1:] != record[:-1]]))
                offsets = pa.array(np.concatenate([opens, [len(begins)]]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, lines.slice(first, last - first))
                yield self._batch(pc.binary_join(lists, "\n"), WHOLE)
        self.open = lines.slice(last).to_pylist() if last < len(lines) else []


def _lines(spark: SparkSession, path: str) -> DataFrame:
    place = F.xxhash64(F.input_file_name()).alias("file"), F.input_file_block_start().cast("long").alias("split")
    return spark.read.option("lineSep", "\n").text(path).select(*place, "value")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, at, record): every record of the text files at ``path``, line breaks inside quotes kept.

    The header is the record with split 0 and at 0. Records that lie in several splits have the place of their first
    piece. Quotes that are never closed leave one record to the end of the file. What the driver holds is a pair of
    numbers for each split that begins inside quotes.
    """
    lines = _lines(spark, path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    splits = lines.groupBy("file", "split").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    counted = splits.withColumn("before", F.coalesce(F.sum("quotes").over(before), F.lit(0)))
    inside = {(r["file"], r["split"]) for r in counted.where("before % 2 = 1").collect()}

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Splits(inside)
        for batch in batches:
            file, split = batch.column("file").to_numpy(), batch.column("split").to_numpy()
            cuts = np.flatnonzero((file[1:] != file[:-1]) | (split[1:] != split[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if hi > lo:
                    yield from state.add(int(file[lo]), int(split[lo]), batch.column("value").slice(lo, hi - lo))
        yield from state.finish()

    pieces = lines.mapInArrow(put_together, PIECES)
    whole = pieces.where(F.col("kind") == WHOLE).drop("kind")
    if not inside:
        # What is open at the end then belongs to no other split: a quote that is never closed.
        return pieces.drop("kind")
    order = Window.partitionBy("file").orderBy("split", "at")
    parts = pieces.where(F.col("kind") != WHOLE).withColumn(
        "_record", F.sum((F.col("kind") == BEGIN).cast("int")).over(order)
    )
    listed = F.sort_array(F.collect_list(F.struct("split", "at", "record")))
    joined = parts.groupBy("file", "_record").agg(listed.alias("p")).select(
        "file", F.col("p")[0]["split"].alias("split"), F.col("p")[0]["at"].alias("at"),
        F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"),
    )
    return whole.unionByName(joined)
