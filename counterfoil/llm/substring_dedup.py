"""Removal of word passages that repeat anywhere, by a compacted De Bruijn graph.

Every window of words is an edge of a De Bruijn graph; its nodes are the windows one word
shorter. What is wanted are the edges that occur twice or more. Two edges that follow each
other in a text share a node, and a path of edges that always follow each other is one edge
of the compacted graph.

1. Compaction where a text is read: windows in a row whose least hash of ``SEED_WORDS``
   words, their seed, is the same piece of text are one path. Equal windows have equal seeds,
   so where passages repeat, paths repeat, but for those that reach over the ends. About one path
   is kept per thirteen words.
2. Seeds that occur once hold no repeat and go. Of the others, paths that occur twice are
   repeated as a whole. Where a seed has paths of one occurrence, these are opened: their windows
   are single edges, compared with each other and with one copy of each repeated path of the seed.
3. Compaction across paths: where two repeated paths always follow each other, counts
   of the link and of both say so, and a join carries that back to every occurrence. Runs become
   long spans.
4. Verification at the source: each span's words are read again at its coordinates. A span is
   removed only if its digest occurs twice among the spans of its name.

Texts are written once, bucketed by their key, so that steps 2 to 4 move coordinates, not texts.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from counterfoil.llm.common import Memo
from counterfoil.session import pin, scratch_path

WINDOW_WORDS = 35
SEED_WORDS = 8
#: Words that a Python worker remembers the hashes of, twice this many at most.
REMEMBERED = 300_000
#: Words of a text that are looked at together; places in them fit the low bits of an order of seeds.
PLACE_BITS = 24
#: Rows of texts that a step holds at a time.
ROWS = 500

KEY = ["_row", "_tag"]


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text; bytes split where the blank and the five controls from 9 to 13 stand, and nowhere else."""
    return text.split()


class Reader:
    """Words of texts and their hashes."""

    def __init__(self, window: int, seed: int):
        self.window, self.seed = window, seed
        self.hashes = Memo(xxhash.xxh64_intdigest, REMEMBERED)

    def read(self, words: list[bytes]) -> np.ndarray:
        return np.array(list(map(self.hashes.__getitem__, words)), dtype=np.uint64)

    def paths(self, texts: list[list[bytes]]) -> tuple[np.ndarray, ...]:
        """Place of the text, first window, last window, seed and edge of each path of the texts, looked at together."""
        hashes = self.read(list(chain.from_iterable(texts)))
        text_of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        room = (1 << PLACE_BITS) - self.window
        parts = []
        for at in range(0, max(1, len(hashes)), room):
            piece = slice(at, at + room + self.window - 1)
            first, last, seeds = self._paths(hashes[piece], text_of[piece])
            parts.append((first + at, last + at, seeds))
        first, last, seeds = (np.concatenate(part) for part in zip(*parts))
        source = text_of[first]
        return source, first, last, first - begins[source], last - begins[source], seeds, hashes

    def _paths(self, hashes: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        windows = len(hashes) - self.window + 1
        if windows < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        seeds = np.zeros(len(hashes) - self.seed + 1, np.uint64)
        for at in range(self.seed):
            seeds = seeds * np.uint64(0x9E3779B97F4A7C15) + hashes[at : at + len(seeds)]
        seeds ^= seeds >> np.uint64(32)
        seeds *= np.uint64(0xD6E8FEB86659FD93)
        seeds ^= seeds >> np.uint64(32)
        # Of equal hashes in a window the leftmost counts: places stand in the low bits.
        low = np.uint64(PLACE_BITS)
        least = (seeds >> low << low) | np.arange(len(seeds), dtype=np.uint64)
        width, wanted = 1, self.window - self.seed + 1
        while width < wanted:
            step = min(width, wanted - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        place = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        # Windows that reach into the next text are none.
        own = text_of[:windows] == text_of[self.window - 1 :]
        starts = (place[1:] != place[:-1]) | (own[1:] != own[:-1]) | (text_of[1:windows] != text_of[: windows - 1])
        first = np.flatnonzero(np.concatenate([[True], starts]))
        last = np.concatenate([first[1:] - 1, [windows - 1]])
        first, last = first[own[first]], last[own[first]]
        return first, last, seeds[place[first]].astype(np.int64)


def _edges(hashes: np.ndarray, first: list[int], last: list[int], window: int, mask: int) -> np.ndarray:
    """A 64-bit hash of the words of each path."""
    held = memoryview(hashes.tobytes())
    names = [xxhash.xxh3_64_intdigest(held[8 * a : 8 * (b + window)]) & mask for a, b in zip(first, last)]
    return np.array(names, dtype=np.uint64).astype(np.int64)


def _column(values, kind: pa.DataType) -> pa.Array:
    """Texts come as bytes."""
    return pa.array(values, pa.binary()).cast(kind) if kind == pa.string() else pa.array(values, kind)


def _per_batch(
    rows: DataFrame, columns: str, work: Callable[[list[list[bytes]], dict[str, list]], list], copied: tuple[str, ...] = ()
) -> DataFrame:
    """Rows that ``work`` finds in the words of texts, with the text's key and the columns ``copied``.

    ``work`` takes the words of some texts and their other columns, and returns the place of the text of each row found and
    one sequence per column of ``columns``.
    """
    kept = [*KEY, *copied]
    given = [c for c in rows.columns if c not in (*kept, "text")]
    names = [c.split()[0] for c in columns.split(", ")]
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    kinds = [types[c.split()[1]] for c in columns.split(", ")]
    plain = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                words = [words_of(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
                source, *values = work(words, {c: batch.column(c).to_pylist() for c in given})
                taken = pa.array(source, pa.int64())
                joined = [_column(v, kind) for v, kind in zip(values, kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(c).take(taken) for c in kept] + joined, [*kept, *names])

    return rows.mapInArrow(found, f"{plain}, {columns}")


def _bucketed(rows: DataFrame) -> DataFrame:
    """``rows`` written in the shared folder in buckets of their key, so that joins on it move only the other side."""
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"texts_{uuid.uuid4().hex}"
    writer = rows.write.bucketBy(buckets, *KEY).sortBy(*KEY).option("compression", "zstd")
    writer.option("path", scratch_path(spark, "texts")).saveAsTable(name)
    return spark.table(name)


def _texts(docs: DataFrame, text: str) -> DataFrame:
    """_row, _tag, doc_id, text, copies: rows with one doc_id and text are one, counted before the shuffle.

    The key is made of 96 bits of hashes of both, so it is the same in every run.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return _bucketed(
        docs.select(F.col("doc_id"), whole.alias("text"))
        .select(F.xxhash64("doc_id", "text").alias("_row"), F.hash("text", "doc_id").alias("_tag"), "doc_id", "text")
        .groupBy(*KEY)
        .agg(F.any_value("doc_id").alias("doc_id"), F.any_value("text").alias("text"), F.count("*").alias("copies"))
    )


def repeated_spans(texts: DataFrame, window: int = WINDOW_WORDS, seed: int = SEED_WORDS, bits: int = 64) -> DataFrame:
    """_row, _tag, first, last, seed, edge, gone: verified spans of windows that also start elsewhere.

    ``texts`` is as ``_texts`` writes it. ``first`` and ``last`` are windows, so a span covers the words first to
    last + window - 1. Rows that are not ``gone`` only witness a window of another row. ``bits`` of the names of paths
    are used; fewer make names clash, which verification finds.
    """
    mask = (1 << bits) - 1
    reader = Reader(window, seed)

    def paths_of(texts: list[list[bytes]], given: dict[str, list]) -> list:
        source, first, last, at, to, seeds, hashes = reader.paths(texts)
        return [source, at, to, seeds, _edges(hashes, first.tolist(), last.tolist(), window, mask)]

    def windows_of(texts: list[list[bytes]], given: dict[str, list]) -> list:
        found = []
        for place, (words, asked) in enumerate(zip(texts, given["asked"])):
            for p in asked:
                first, last = p["first"], p["last"]
                starts = list(range(last - first + 1))
                edges = _edges(reader.read(words[first : last + window]), starts, starts, window, mask)
                found += [(place, first + at, p["seed"], edge, p["weight"]) for at, edge in zip(starts, edges.tolist())]
        return [list(c) for c in zip(*found)] if found else [[]] * 5

    # A text that occurs twice with its doc_id repeats itself.
    weighed = texts.select(*KEY, F.least("copies", F.lit(2)).cast("int").alias("weight"), "text")
    paths = pin(_per_batch(weighed, "first int, last int, seed long, edge long", paths_of, ("weight",)))
    shared = pin(
        paths.groupBy("seed")
        .agg(F.sum("weight").alias("n"), F.min("edge").alias("_least"), F.max("edge").alias("_most"))
        .filter("n > 1")
        .select("seed", "n", F.expr("_least <> _most").alias("mixed"))
    )
    near = pin(paths.join(shared, "seed"))
    variants = pin(
        near.filter("mixed")
        .groupBy("seed", "edge")
        .agg(F.sum("weight").alias("n"), F.min(F.struct(*KEY, "first", "last")).alias("one"))
    )
    # A path of one occurrence is opened, and one occurrence of each repeated path of its seed.
    asked = variants.select(
        "one.*", "seed", F.least("n", F.lit(2)).cast("int").alias("weight")
    ).groupBy(*KEY).agg(F.collect_list(F.struct("first", "last", "seed", "weight")).alias("asked"))
    opened = pin(
        _per_batch(
            texts.select(*KEY, "text").join(asked, KEY), "at int, seed long, edge long, weight int", windows_of
        )
    )
    windows = pin(
        opened.groupBy("seed", "edge")
        .agg(F.sum("weight").alias("n"), F.count_if(F.col("weight") == 1).alias("single"))
        .filter("n > 1 and single > 0")
        .select("seed", "edge")
    )
    single = opened.join(windows, ["seed", "edge"], "left_semi").select(
        *KEY, F.col("at").alias("first"), F.col("at").alias("last"), "seed", "edge", (F.col("weight") == 1).alias("gone")
    )
    mixed = near.filter("mixed").drop("n").join(variants.filter("n > 1").select("seed", "edge", "n"), ["seed", "edge"])
    whole = near.filter("not mixed").unionByName(mixed).drop("mixed")

    spans = _compacted(whole).withColumn("gone", F.lit(True)).unionByName(single)
    return _verified(texts, pin(spans), window)


def _compacted(whole: DataFrame) -> DataFrame:
    """Runs of paths of ``whole`` that always follow each other, named after the first path."""
    along = Window.partitionBy(*KEY).orderBy("first")
    following = F.lead(F.struct("first", "n", "seed", "edge")).over(along)
    steps = pin(
        whole.withColumn("_next", following).select(
            *whole.columns,
            F.when(
                (F.col("_next.first") == F.col("last") + 1) & (F.col("_next.n") == F.col("n")),
                F.xxhash64("seed", "edge", "_next.seed", "_next.edge"),
            ).alias("link"),
        )
    )
    # As often as both paths: no other path follows the first, none else leads to the second.
    solid = pin(
        steps.filter("link is not null")
        .groupBy("link")
        .agg(F.sum("weight").alias("together"), F.max("n").alias("n"))
        .filter("together = n")
        .select("link", F.lit(True).alias("solid"))
    )
    linked = steps.filter("link is not null").join(solid, "link", "left").unionByName(
        steps.filter("link is null").withColumn("solid", F.lit(False))
    )
    begins = F.when(F.coalesce(F.lag("solid").over(along), F.lit(False)), 0).otherwise(1)
    runs = linked.withColumn("_begins", begins).withColumn("_run", F.sum("_begins").over(along))
    head = F.min_by(F.struct("seed", "edge"), "first")
    return runs.groupBy(*KEY, "_run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), head.alias("_head")
    ).select(*KEY, "first", "last", "_head.seed", "_head.edge")


def _verified(texts: DataFrame, spans: DataFrame, window: int) -> DataFrame:
    """``spans`` whose words, read at their coordinates, are those of another span of the same name and length."""

    def digests_of(texts: list[list[bytes]], given: dict[str, list]) -> list:
        found = []
        for place, (words, held) in enumerate(zip(texts, given["spans"])):
            for s in held:
                digest = hashlib.blake2b(b" ".join(words[s["first"] : s["last"] + window]), digest_size=16).digest()
                found.append((place, s["first"], s["last"], s["seed"], s["edge"], digest))
        return [list(c) for c in zip(*found)] if found else [[]] * 6

    lists = spans.groupBy(*KEY).agg(F.collect_list(F.struct("first", "last", "seed", "edge")).alias("spans"))
    read = _per_batch(
        texts.select(*KEY, F.least("copies", F.lit(2)).cast("int").alias("weight"), "text").join(lists, KEY),
        "first int, last int, seed long, edge long, digest binary", digests_of, ("weight",),
    )
    name = F.xxhash64("seed", "edge", F.col("last") - F.col("first"))
    alone = pin(
        read.groupBy(name.alias("name"), "digest")
        .agg(F.sum("weight").alias("n"), F.min(F.struct(*KEY, "first", "last")).alias("one"))
        .filter("n = 1")
        .select("one.*")
    )
    return spans if alone.isEmpty() else spans.join(alone, [*KEY, "first", "last"], "left_anti")


def remove_repeats(
    docs: DataFrame, text: str = "text", window: int = WINDOW_WORDS, seed: int = SEED_WORDS, bits: int = 64
) -> DataFrame:
    """doc_id, text, n_words, n_removed: every row of ``docs`` without the words that repeated windows cover.

    A window is ``window`` consecutive words of one row; it is repeated if its words also start anywhere else, in the
    same row too. All occurrences go, judged on the input. The words that stay are joined by one space.

    NULL texts are empty texts; texts shorter than a window lose nothing. Rows that are equal in doc_id and text repeat each
    other; each is returned. NULL doc_ids stay NULL. Other columns are not looked at.
    """
    texts = _texts(docs, text)
    gone = repeated_spans(texts, window, seed, bits).filter("gone")
    lists = gone.groupBy(*KEY).agg(F.collect_list(F.struct("first", "last")).alias("spans"))

    def kept_of(texts: list[list[bytes]], given: dict[str, list]) -> list:
        kept = []
        for words, spans in zip(texts, given["spans"]):
            if spans:
                gone = np.zeros(len(words) + 1, np.int64)
                for s in spans:
                    gone[s["first"]] += 1
                    gone[s["last"] + window] -= 1
                words = [w for w, covered in zip(words, np.cumsum(gone[:-1]).tolist()) if not covered]
            kept.append(words)
        sizes = [len(words) for words in texts]
        return [list(range(len(texts))), [b" ".join(k) for k in kept], sizes, [n - len(k) for n, k in zip(sizes, kept)]]

    rows = _per_batch(
        texts.join(lists, KEY, "left"), "kept string, n_words long, n_removed long", kept_of, ("doc_id", "copies")
    )
    every = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return rows.select("doc_id", F.col("kept").alias("text"), "n_words", "n_removed", every.alias("_copy")).drop("_copy")
