"""WARC archives of captured pages, and their index merged into globally ordered capture histories.

Writing: captures with equal payloads are grouped by digest, one of a group becomes the response and the
others revisit it; records are sorted by (URL key, timestamp, id) inside a partition, and a task writes them one gzip
member a record, so an archive is a sorted run on disk in which a record can be sought by its offset. A manifest
lists the archives of the tasks that counted; what a lost task left behind is in none.
Reading: a task streams an archive, record by record, and gives the run's index lines. Runs are dealt by ranges of the
key, whose number follows that of the lines; within a range a loser tree merges the shares of the runs.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from gridloom.llm.common import bounded, shared_checkpoint

RECORD_END = b"\r\n\r\n"
BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
MANIFEST = "manifest.json"

#: Bytes of compressed records after which a task begins another archive, and that it reads at a time.
ARCHIVE_BYTES, READ_BYTES = 16 << 20, 1 << 20
#: Index lines that a task merges, on average.
RANGE_LINES = 200_000
#: Index lines in one Arrow batch.
LINES = 5000

INDEX_SCHEMA = (
    "url_key string, timestamp string, page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, archive string, record_offset long"
)


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 20 bits (5 hex digits) are 4 base32 digits."""
    sha = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(sha, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), *BASE32)


def url_key(url: Column) -> Column:
    """Sort-friendly key: host labels reversed and joined by commas, then ``)`` and the path, lower case, no scheme."""
    rest = F.regexp_replace(F.lower(url), r"^[a-z][a-z0-9+.-]*://|#.*$", "")
    host = F.regexp_replace(F.regexp_extract(rest, r"^([^/?]*)", 1), r"^www\.", "")
    path = F.regexp_extract(rest, r"^[^/?]*(.*)$", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(path == "", "/").otherwise(path))


#: Pages carry no time; captures begin here.
FIRST_DAY = "2024-01-01"


def utc(day: Column, seconds: Column) -> Column:
    """The UTC time that lies ``seconds`` after the start of ``day``, as ISO text; days and seconds know no time zone, so the session's plays no part."""
    part = lambda of, size: F.lpad((F.pmod(seconds, F.lit(of)) / size).cast("long").cast("string"), 2, "0")
    date = F.date_add(day, F.floor(seconds / 86400).cast("int")).cast("string")
    return F.concat(date, F.lit("T"), part(86400, 3600), F.lit(":"), part(3600, 60), F.lit(":"), part(60, 1), F.lit("Z"))


def captures(pages: DataFrame) -> DataFrame:
    """What a record needs of each page. Pages carry no time, so a capture's time is 2024-01-01 plus its id in seconds."""
    known = F.pmod(F.coalesce(F.col("page_id").cast("long"), F.lit(0)), F.lit(1_000_000_000))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("payload"),
    ).select(
        "*",
        payload_digest(F.col("payload")).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        url_key(F.col("url")).alias("url_key"),
        utc(F.lit(FIRST_DAY).cast("date"), known).alias("timestamp"),
    )


def file_system(path: str):
    """(file system, path in it) of a path or URI, in whatever store it names."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Archives(WriterCommitMessage):
    paths: list[str]


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def write(self, iterator) -> Archives:
        store, folder = file_system(self.folder)
        store.create_dir(folder, recursive=True)
        paths, out, size = [], None, 0
        for batch in iterator:
            for part in bounded(iter([batch])):
                for head, block in zip(part.column("head").to_pylist(), part.column("block").to_pylist(), strict=True):
                    if out is None:
                        paths.append(f"{folder}/{uuid.uuid4().hex}.warc.gz")
                        out, size = store.open_output_stream(paths[-1], compression=None), 0
                    packer = zlib.compressobj(wbits=31)
                    member = packer.compress(head.encode() + block.encode() + RECORD_END) + packer.flush()
                    out.write(member)
                    size += len(member)
                    if size >= ARCHIVE_BYTES:
                        out.close()
                        out = None
        if out is not None:
            out.close()
        return Archives(paths)

    def commit(self, messages) -> None:
        store, folder = file_system(self.folder)
        store.create_dir(folder, recursive=True)
        paths = sorted(p for m in messages if m is not None for p in m.paths)
        with store.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps(paths).encode())

    def abort(self, messages) -> None:
        store, _ = file_system(self.folder)
        for message in messages:
            for path in message.paths if message is not None else ():
                store.delete_file(path)


@dataclass
class Archive(InputPartition):
    path: str


class ArchiveReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[Archive]:
        store, folder = file_system(self.folder)
        with store.open_input_stream(f"{folder}/{MANIFEST}") as listed:
            return [Archive(path) for path in json.loads(listed.read())]

    def read(self, partition: Archive | None):
        import pyarrow as pa

        if partition is None:  # there is no archive
            return

        store, _ = file_system(self.folder)
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [x.strip().split()[0] for x in INDEX_SCHEMA.split(",")]

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        rows = []
        with store.open_input_file(partition.path) as source:
            for at, headers, block in records(source):
                rows.append(index_line(partition.path, at, headers, block))
                if len(rows) == LINES:
                    yield table(rows)
                    rows = []
        if rows:
            yield table(rows)


class WarcSource(DataSource):
    """Spark's reader and writer of a folder of archives: rows to write have head and block, rows read are index lines."""

    @classmethod
    def name(cls) -> str:
        return "gridloom_warc"

    def schema(self) -> str:
        return INDEX_SCHEMA

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"])

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options["path"])


def joined_with_responses(rows: DataFrame) -> DataFrame:
    """Captures with ``response_id``, the largest id of those that share their payload.

    Digests alone are grouped. The groups are dealt anew for the join (their digest is computed, so their own order does not
    serve), as only then does Spark's skew join split the pages of a payload that a third of all pages share.
    """
    kept = rows.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("response_id"))
    return rows.join(kept.withColumn("payload_digest", F.concat("payload_digest", F.lit(""))), ["payload_digest", "payload_bytes"])


def write_archives(pages: DataFrame, folder: str, min_payload: int = 0) -> None:
    """Write one WARC record per page into archives under ``folder``, which is a new one.

    Of captures with equal payloads of at least ``min_payload`` bytes, the one with the largest page_id
    is written as response, the others revisit it without a payload. A payload is shuffled once.
    """
    joined = joined_with_responses(captures(pages))
    revisit = (F.col("payload_bytes") >= min_payload) & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    block = F.when(revisit, "").otherwise(F.col("payload"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    number = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), number, F.lit(">"))),
        line("WARC-Date", F.col("timestamp")),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        line("X-URL-Key", F.regexp_replace("url_key", r"[\r\n]", "")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("response_id").cast("string"), F.lit(">"))),
            ),
        ).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    record = joined.select("url_key", "timestamp", "page_id", head.alias("head"), block.alias("block"))
    pages.sparkSession.dataSource.register(WarcSource)
    sorted_ = record.sortWithinPartitions("url_key", "timestamp", "page_id").select("head", "block")
    sorted_.write.format(WarcSource.name()).option("path", folder).mode("append").save()


def _parsed(record: bytes, at: int) -> tuple[dict[str, str], bytes]:
    """Headers and block of the bytes of one record."""
    end = record.find(RECORD_END)
    version, *lines = record[: max(end, 0)].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no record at {at}")
    headers = dict(x.split(": ", 1) for x in lines)
    stop = end + 4 + int(headers["Content-Length"])
    if record[stop:] != RECORD_END:
        raise ValueError(f"the record at {at} does not end where it should")
    return headers, record[end + 4 : stop]


def records(source, at: int = 0) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of the records of an archive file from the one at offset ``at`` on; one record is held at a time."""
    source.seek(at)
    held = b""
    while held or (held := source.read(READ_BYTES)):
        unpacker, parts, size = zlib.decompressobj(wbits=31), [], 0
        while not unpacker.eof:
            if not held and not (held := source.read(READ_BYTES)):
                raise ValueError(f"the record at {at} breaks off")
            parts.append(unpacker.decompress(held))
            size += len(held) - len(unpacker.unused_data)
            held = unpacker.unused_data
        yield at, *_parsed(b"".join(parts), at)
        at += size


def read_record(path: str, offset: int) -> tuple[dict[str, str], bytes]:
    """Headers and block of the record at ``offset`` of an archive, as the index names them."""
    store, path = file_system(path)
    with store.open_input_file(path) as source:
        _, headers, block = next(records(source, offset))
    return headers, block


def index_line(path: str, at: int, headers: dict[str, str], block: bytes) -> tuple:
    """The index line of a record; a payload that is there is checked against its digest and length."""
    import base64
    import hashlib

    number = lambda s: None if s in ("", "<urn:page:null>") else int(s[len("<urn:page:") : -1])
    digest, length = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["X-Payload-Length"])
    if headers["WARC-Type"] == "response":
        digest, length = base64.b32encode(hashlib.sha1(block).digest()).decode(), len(block)
        if (f"sha1:{digest}", str(length)) != (headers["WARC-Payload-Digest"], headers["X-Payload-Length"]):
            raise ValueError(f"{path}: the payload at {at} is damaged")
    refers = number(headers.get("WARC-Refers-To", ""))
    return (headers["X-URL-Key"], headers["WARC-Date"], number(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], length, digest, headers["WARC-Type"], refers, path, at)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """Index lines of all archives; the lines of an archive are a run sorted by (url_key, timestamp, page_id)."""
    spark.dataSource.register(WarcSource)
    return shared_checkpoint(spark.read.format(WarcSource.name()).option("path", folder).load())


class LoserTree:
    """K-way merge: inner nodes hold losers, the root's winner is replayed along one path."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, self.k = runs, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.losers = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._replay(leaf)

    def _less(self, a: int, b: int) -> bool:
        if a < 0 or b < 0:
            return a < 0  # places not filled yet win, so that every run enters the tree
        x, y = self.heads[a], self.heads[b]
        return y is None if x is not None and y is None else x is not None and (x, a) < (y, b)

    def _replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self._less(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and (top := self.heads[self.losers[0]]) is not None:
            yield top
            winner = self.losers[0]
            self.heads[winner] = next(self.runs[winner], None)
            self._replay(winner)


def merge_index(index: DataFrame) -> DataFrame:
    """Index lines in globally ordered capture histories, with ``range``, ``place`` in it, and ``capture_rank``, the place among all.

    Lines are dealt to ranges of (url_key, timestamp, page_id, archive, record_offset), of which no two lines share one, so
    neither a host nor a URL with a third of the captures makes a large range, and a range has about RANGE_LINES lines
    whatever their number. It holds them as Arrow columns; the share of each run keeps its order, and a loser tree
    merges the shares. Null ids come first in a tie.
    """
    import pyarrow as pa

    def merge(batches):
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        url, time, page, archive = (table.column(c).combine_chunks() for c in ("url_key", "timestamp", "page_id", "archive"))
        names = archive.dictionary_encode().indices.to_numpy()

        def run(first: int, end: int):
            for i in range(first, end):
                known = page[i].as_py()
                yield (url[i].as_py(), time[i].as_py(), -1 if known is None else known), i

        # Sorted by archive and offset, so a run's share lies together.
        starts = [0, *[i + 1 for i in range(len(names) - 1) if names[i] != names[i + 1]], len(names)]
        order = [i for _, i in LoserTree([run(a, b) for a, b in zip(starts, starts[1:], strict=False)])]
        merged = table.take(pa.array(order)).append_column("place", pa.array(range(len(order)), pa.int64()))
        yield from merged.combine_chunks().to_batches(max_chunksize=10_000)

    n = max(1, -(-index.count() // RANGE_LINES))
    ranged = index.repartitionByRange(n, "url_key", "timestamp", "page_id", "archive", "record_offset").sortWithinPartitions("archive", "record_offset")
    merged = shared_checkpoint(ranged.withColumn("range", F.spark_partition_id()).mapInArrow(merge, INDEX_SCHEMA + ", range int, place long"))
    sizes = merged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))  # one row a range
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    ahead = sizes.select("range", F.coalesce(before, F.lit(0)).alias("ahead"))
    return merged.join(F.broadcast(ahead), "range").withColumn("capture_rank", F.col("ahead") + F.col("place")).drop("ahead")


def archive_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` as WARC records under ``folder``, read the archives back and merge their index.

    Returns the merged index: page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, timestamp, url,
    capture_rank, range, place, and archive and record_offset, by which ``read_record`` finds the record.
    Null html is an empty payload, null url an empty one; a null page_id is never a response that others
    name unless the whole group has none; rows that repeat the id of a response are responses too; an
    empty table gives an empty table; other columns are not looked at.
    """
    spark = pages.sparkSession
    write_archives(pages, folder)
    return merge_index(read_index(spark, folder))
