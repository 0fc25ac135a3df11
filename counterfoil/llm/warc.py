"""WARC archives of pages, and their index by external merge.

Writing: each partition becomes one archive of gzip members, one per record, in the
shared folder, under a name of its own; the rows that come back name archive, offset and
length. Only archives named in the written index count, so a task that ran twice leaves
a file that nobody reads.

Index: the captures of an archive are a run, sorted by URL key, time and record. Ranges of
(URL key, time, record) go to partitions, and in each a loser tree merges the runs that
reach into it: one global order over all archives, a hot URL included.

Reading: captures are read from their archives by offset, parsed record by record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import Any
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow.fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from counterfoil.session import pin, scratch_path

#: A record stands for its payload from this size on; smaller ones are all responses.
LEAST_BYTES = 0
#: Captures of an archive, at most, and how many bytes of one archive a task reads.
ARCHIVE_RECORDS = 5000
READ_BYTES = 16_000_000
#: About the rows of the index that a range of the merge holds in memory.
RANGE_ROWS = 100_000
# Ids are texts here: pandas would turn whole numbers beside NULL into floats.
INDEX = (
    "urlkey string, stamp string, record_id string, record_type string, refers_to string, "
    "payload_digest string, payload_bytes bigint, archive string, offset bigint, length bigint"
)
READ = (
    "record_id string, record_type string, refers_to string, url string, stamp string, "
    "payload_digest string, payload_bytes bigint, named_digest string, payload binary"
)
NO_ID = "none"
_ORDER = ["urlkey", "stamp", "record_id"]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the last to the first, then path and query, lower case."""
    try:
        parts = urlsplit((url or "").strip())
        host = ",".join(reversed((parts.hostname or "").split(".")))
    except ValueError:  # no URL; the text itself is the key
        return (url or "").strip().lower()
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{host}){path}".lower()


# ---- records


def record(headers: Iterable[tuple[str, str | None]], block: bytes) -> bytes:
    """One WARC record as a gzip member; headers without a value are left out."""
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in headers if value is not None)]
    lines.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one member; raises ValueError if it is no whole record."""
    whole = zlib.decompress(member, 31)
    head, gap, rest = whole.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    size = int(headers["Content-Length"])
    if lines[0] != "WARC/1.1" or not gap or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return headers, rest[:size]


def _uri(url: str | None) -> str | None:
    return None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]")


def _record_of(row: dict[str, Any]) -> tuple[bytes, dict[str, Any]]:
    payload = (row["payload"] or "").encode("utf-8", "replace")
    revisit = row["record_type"] == "revisit"
    block = b"" if revisit else payload
    found = digest(payload)
    member = record(
        [
            ("WARC-Type", row["record_type"]),
            ("WARC-Record-ID", f"<urn:page:{row['record_id']}>"),
            ("WARC-Date", row["stamp"]),
            ("WARC-Target-URI", _uri(row["url"])),
            ("WARC-Refers-To", f"<urn:page:{row['refers_to']}>" if revisit else None),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
            ("WARC-Payload-Digest", f"sha1:{found}"),
            ("Content-Type", "text/html; charset=utf-8"),
        ],
        block,
    )
    return member, {"urlkey": url_key(row["url"]), "payload_digest": found, "payload_bytes": len(payload)}


# ---- write


def roles(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """record_id, url, stamp, payload, record_type, refers_to of ``pages`` (page_id, url, stamp, payload).

    Of equal payloads of at least ``least_bytes`` bytes the least page_id is the response;
    rows that share that id are responses too. Pages without an id are responses, nothing
    refers to them. Payloads meet by their SHA-256 and length, minima are combined before the shuffle.
    """
    raw = F.encode(F.coalesce("payload", F.lit("")), "UTF-8")
    marked = pages.withColumn("_same", F.concat_ws(":", F.sha2(raw, 256), F.length(raw)))
    first = pin(
        marked.groupBy("_same").agg(F.min("page_id").alias("_first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    )
    revisit = (F.octet_length(F.coalesce("payload", F.lit(""))) >= least_bytes) & (F.col("page_id") > F.col("_first"))
    return (
        marked.join(first, "_same", "left")
        .withColumn("revisit", F.coalesce(revisit, F.lit(False)))
        .select(
            F.coalesce(F.col("page_id").cast("string"), F.lit(NO_ID)).alias("record_id"),
            "url",
            "stamp",
            "payload",
            F.when(F.col("revisit"), "revisit").otherwise("response").alias("record_type"),
            F.when(F.col("revisit"), F.col("_first").cast("string")).alias("refers_to"),
        )
    )


def write(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write archives of ``pages`` below ``folder``; returns the written index (``INDEX``).

    ``folder`` is a URI that all executors reach. A task streams its rows: memory holds a
    batch, an archive at most ``ARCHIVE_RECORDS`` records.
    """
    names = [f.split()[0] for f in INDEX.split(", ")]

    def archived(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        for batch in batches:
            for lo in range(0, len(batch), ARCHIVE_RECORDS):
                name, offset, rows = f"{uuid.uuid4().hex}.warc.gz", 0, []
                with files.open_output_stream(f"{root}/{name}", compression=None) as out:
                    for row in batch.iloc[lo : lo + ARCHIVE_RECORDS].to_dict("records"):
                        member, more = _record_of(row)
                        out.write(member)
                        rows.append(row | more | {"archive": name, "offset": offset, "length": len(member)})
                        offset += len(member)
                rows.sort(key=lambda r: [r[c] or "" for c in _ORDER])  # a run
                yield pd.DataFrame(rows, columns=names)

    return pin(roles(pages, least_bytes).mapInPandas(archived, INDEX))


# ---- merge


class LoserTree:
    """Merges sorted runs of (key, value): the least head is the winner, inner nodes keep the losers.

    Taking the winner replays one path from its leaf to the root. Equal keys come in the
    order of the runs.
    """

    def __init__(self, runs: list[Iterator[tuple[Any, Any]]]):
        self.runs = runs
        self.heads: list[tuple[Any, Any] | None] = [next(run, None) for run in runs]
        self.losers = [-1] * max(1, len(runs))
        self.winner = self._play(1) if runs else -1

    def _beats(self, a: int, b: int) -> bool:
        left, right = self.heads[a], self.heads[b]
        if left is None or right is None:
            return right is None and (left is not None or a < b)
        return (left[0], a) < (right[0], b)

    def _play(self, node: int) -> int:
        """Winner below ``node``; nodes from the number of runs on are leaves."""
        if node >= len(self.runs):
            return node - len(self.runs)
        a, b = self._play(2 * node), self._play(2 * node + 1)
        a, b = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = b
        return a

    def __iter__(self) -> Iterator[Any]:
        while self.winner >= 0 and (head := self.heads[self.winner]) is not None:
            yield head[1]
            at = self.winner
            self.heads[at] = next(self.runs[at], None)
            node = (at + len(self.runs)) // 2
            while node:
                if self._beats(self.losers[node], at):
                    self.losers[node], at = at, self.losers[node]
                node //= 2
            self.winner = at


def merge_index(index: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The captures of all runs (``INDEX``) in one order by URL key, time and record, with ``place`` and ``capture``.

    Partitions are ranges of the order; ``place`` is the range and the row in it, the k-th
    smallest pair is the k-th capture of all. ``capture`` counts captures of a URL key over all ranges.
    A range, about ``range_rows`` rows of the index without payloads, is held in memory and merged from its runs.
    Equal keys (repeated rows) go by archive and offset.
    """
    columns = index.columns

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = [b for b in batches if len(b)]
        if not whole:
            return
        rows = pd.concat(whole, ignore_index=True)
        keys = list(zip(*(rows[c].fillna("") for c in [*_ORDER, "archive"]), rows["offset"]))
        runs = [
            iter([(keys[k], k) for k in places])
            for _, places in sorted(rows.groupby("archive", sort=True).indices.items())
        ]
        order = list(LoserTree(runs))
        out = rows.iloc[order].reset_index(drop=True)
        out["place"] = range(len(out))
        out["capture"] = out.groupby("urlkey").cumcount() + 1
        yield out

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema]
    least = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    captures = index.count()
    number = max(least, -(-captures // range_rows))
    ranges = index.repartitionByRange(number, *_ORDER, "archive", "offset")
    rows = pin(
        ranges.sortWithinPartitions("archive", *_ORDER, "offset")
        .withColumn("part", F.spark_partition_id())
        .mapInPandas(merged, ", ".join([*kinds, "part int", "place bigint", "capture bigint"])),
        rows=captures,
    )
    # Only the first key of a range can have begun in earlier ones: one row a range at most.
    before = Window.partitionBy("urlkey").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        rows.groupBy("urlkey", "part")
        .agg(F.count("*").alias("n"))
        .select("urlkey", "part", F.sum("n").over(before).alias("earlier"))
        .filter("earlier > 0")
    )
    return rows.join(earlier, ["urlkey", "part"], "left").select(
        *columns,
        F.struct("part", "place").alias("place"),
        (F.col("capture") + F.coalesce("earlier", F.lit(0))).alias("capture"),
    )


# ---- read


def read(index: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records that ``index`` names, read back from their archives (``READ``).

    Size and digest are those of the block as read; ``named_digest`` stands in the headers. Captures of
    ``READ_BYTES`` of an archive meet in a task and are read in the order of their offsets. Without
    ``payload`` the blocks stay in the tasks.
    """
    names = [f.split()[0] for f in READ.split(", ")]

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, rows in batch.groupby("archive", sort=False):
                out, size = [], 0
                with files.open_input_file(f"{root}/{name}") as archive:
                    for offset, length in zip(rows["offset"].tolist(), rows["length"].tolist()):
                        archive.seek(offset)
                        headers, block = parse(archive.read(length))
                        out.append(
                            (
                                _named(headers["WARC-Record-ID"]),
                                headers["WARC-Type"],
                                _named(headers.get("WARC-Refers-To")),
                                headers.get("WARC-Target-URI"),
                                headers["WARC-Date"],
                                digest(block),
                                len(block),
                                headers["WARC-Payload-Digest"].removeprefix("sha1:"),
                                block if payload else None,
                            )
                        )
                        size += len(block) * payload
                        if size > READ_BYTES:
                            yield pd.DataFrame(out, columns=names)
                            out, size = [], 0
                yield pd.DataFrame(out, columns=names)

    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.floor(F.col("offset") / READ_BYTES)
    return (
        index.select("archive", "offset", "length")
        .repartition(tasks, "archive", part)  # with a number, for these rows are small and what they name is not
        .sortWithinPartitions("archive", "offset")
        .mapInPandas(parsed, READ)
    )


def _named(uri: str | None) -> str | None:
    return None if uri is None else uri.removeprefix("<urn:page:").removesuffix(">")


def resolved(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of records read back.

    A revisit gets size and digest of the response it refers to that has the digest it names.
    """
    found = pin(records.drop("payload", "url", "stamp"))
    revisits = found.filter("record_type = 'revisit'")
    bodies = pin(
        found.filter("record_type = 'response'")
        .join(
            revisits.select(F.col("refers_to").alias("record_id"), F.col("named_digest").alias("payload_digest")).distinct(),
            ["record_id", "payload_digest"],
            "left_semi",
        )
        .select(
            F.col("record_id").alias("refers_to"),
            F.col("payload_digest").alias("named_digest"),
            F.col("payload_bytes").alias("_bytes"),
            F.col("payload_digest").alias("_digest"),
        )
        .distinct()
    )
    return found.join(bodies, ["refers_to", "named_digest"], "left").select(
        F.when(F.col("record_id") != NO_ID, F.col("record_id")).cast("long").alias("page_id"),
        F.when(F.col("record_type") == "revisit", F.col("_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(F.col("record_type") == "revisit", F.col("_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def archive_pages(pages: DataFrame, stamp: Column, least_bytes: int = LEAST_BYTES) -> tuple[DataFrame, str]:
    """Write ``pages`` (page_id, url, html) captured at ``stamp`` (a WARC-Date text): merged index, folder of the archives."""
    folder = scratch_path(pages.sparkSession, "warc")
    rows = pages.select("page_id", "url", stamp.alias("stamp"), F.col("html").alias("payload"))
    return pin(merge_index(write(rows, folder, least_bytes))), folder


def round_trip(pages: DataFrame, stamp: Column, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write ``pages``, merge the index, read every record back from it: a row per page.

    NULL pages are empty payloads. Repeated rows each have a record. NULL ids and URLs are
    written without them. No pages give no archives and no rows.
    """
    index, folder = archive_pages(pages, stamp, least_bytes)
    return resolved(read(index, folder, payload=False))
