"""Large JSON arrays: read by many tasks, split at record borders; written as sorted parts that make one array.

A reader of whole documents takes a file in one task. Here a file is cut at closing braces wherever Spark cuts it into splits, inside
strings and records too. A first pass tells of each split how it changes the state of a parser, both for a start outside and inside a
string; from these few numbers a split, its true start follows; the second pass then hands out the records. Only a record
that reaches over the border of a split is put together from its parts by a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
#: Records that a task hands on together.
ROWS = 2000


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    m = "_metadata."
    return spark.read.option("lineSep", "}").text(path).select(
        F.col(m + "file_path").alias("file"), F.col(m + "file_block_start").alias("start"), "value",
        F.octet_length("value").alias("bytes"), F.col(m + "file_size").alias("file_bytes"),
    )


def _splits(batches: Iterator) -> Iterator[tuple[tuple, Iterator[tuple[str, bool, int]]]]:
    """Of each split of a task its name (file, start, bytes of the file), and its pieces: text, whether it is the split's last, bytes with the brace."""
    from itertools import groupby

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("file", "start", "file_bytes", "value", "bytes")), strict=True)

    def marked(own):
        held = next(own)
        for x in own:
            yield held[3], False, held[4] + 1
            held = x
        yield held[3], True, held[4] + 1

    for name, own in groupby(rows(), key=lambda r: r[:3]):
        yield name, marked(own)


def _summaries(batches: Iterator) -> Iterator:
    """Per split: whether it turns outside into inside; for a start outside and one inside, the change of depth and its least on the way, up to the brace of the last piece."""
    import pyarrow as pa

    out = []
    for (file, start, file_bytes), pieces in _splits(batches):
        inside, depth, least, size = 0, [0, 0], [0, 0], 0
        for value, last, own in pieces:
            size += own
            for token in TOKEN.findall(value if last else value + "}"):
                if token == '"':
                    inside ^= 1
                elif token in "{[":
                    depth[inside] += 1
                elif token in "}]":
                    depth[inside] -= 1
                    least[inside] = min(least[inside], depth[inside])
        out.append((file, start, file_bytes, size, inside, *depth, *least))
    names = ("file", "start", "file_bytes", "bytes", "turns", "depth_outside", "depth_inside", "least_outside", "least_inside")
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64() if i else pa.string()) for i in range(len(names))], names=list(names))


def _starts(rows: list) -> dict[tuple[str, int], tuple]:
    """From the summaries of all splits, in order: (inside, depth, number of the split where the open record began, own number, whether the last piece ends in a brace).

    Every piece but perhaps the last of a file ended in one; with it the pieces would be a byte longer than the file.
    """
    found, inside, depth, owner, size = {}, 0, 0, 0, 0
    for number, r in enumerate(rows):
        ends_file = number + 1 == len(rows) or rows[number + 1]["file"] != r["file"]
        size += r["bytes"]
        closed = not ends_file or size == r["file_bytes"]
        size = 0 if ends_file else size
        found[r["file"], r["start"]] = (inside, depth, owner, number, closed)
        grown, least = (r["depth_inside"], r["least_inside"]) if inside else (r["depth_outside"], r["least_outside"])
        inside ^= r["turns"]
        if closed and not inside:
            grown -= 1
            least = min(least, grown)
        if depth <= 1 or depth + least <= 1:
            owner = number
        depth += grown
    return found


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The objects of a JSON array (a file, or a folder whose parts make one or several arrays) with ``schema``; other elements are dropped.

    An absent field and null are both null. The driver gets one small row per split of the input. A file whose top is not an array has no rows.
    """
    pieces = _pieces(spark, path)
    summary = "file string, start long, file_bytes long, bytes long, turns long, depth_outside long, depth_inside long, least_outside long, least_inside long"
    starts = _starts(sorted(pieces.mapInArrow(_summaries, summary).collect(), key=lambda r: (r["file"], r["start"])))

    def records(batches):
        import pyarrow as pa

        kinds = (pa.int64(), pa.int64(), pa.string())
        batch = lambda: pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["owner", "part", "record"])
        out: list[tuple] = []
        for name, own in _splits(batches):
            inside, depth, owner, number, closed = starts[name[:2]]
            held = [] if depth > 1 else None  # the text of the open record so far
            whole = depth <= 1  # whether it began in this split
            for value, last, _ in own:
                text = value if last and not closed else value + "}"
                begin = 0
                for token in TOKEN.finditer(text):
                    c = token[0]
                    if c == '"':
                        inside ^= 1
                    elif inside or len(c) > 1:
                        continue
                    elif c in "{[":
                        if depth == 1:
                            held, begin, whole = [], token.start(), True
                        depth += 1
                    else:
                        depth -= 1
                        if depth == 1 and held is not None:
                            held.append(text[begin : token.end()])
                            out.append((None if whole else owner, number, "".join(held)))
                            held = None
                if held is not None:
                    held.append(text[begin:])
                if len(out) >= ROWS:
                    yield batch()
                    out.clear()
            if held:
                out.append((number if whole else owner, number, "".join(held)))
        yield batch()

    found = pieces.mapInArrow(records, "owner long, part long, record string")
    parts = F.sort_array(F.collect_list(F.struct("part", "record")))
    over = found.where("owner IS NOT NULL").groupBy("owner").agg(F.array_join(F.transform(parts, lambda x: x["record"]), "").alias("record"))
    every = found.where("owner IS NULL").select("record").unionByName(over.select("record"))
    return every.where(F.col("record").startswith("{")).select(F.from_json("record", schema).alias("r")).where("r IS NOT NULL").select("r.*")


def _ends(placed: DataFrame):
    return placed.agg(F.min("_place").alias("first"), F.max("_place").alias("last")).first()


def _at(end) -> Column:
    return (F.col("_place.file") == end["file"]) & (F.col("_place.row") == end["row"])


def _placed(stored: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Rows of stored Parquet files with where they lie: files sort by name as they were written."""
    place = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return stored.select(place.alias("_place"), F.struct(*fields).alias("_row"))


def _write_lines(lines: DataFrame, path: str) -> None:
    lines.repartitionByRange("_place").sortWithinPartitions("_place").select("value").write.mode("overwrite").text(path)


def write_json_array(stored: DataFrame, path: str, fields: tuple[str, ...]) -> None:
    """Write rows read from Parquet as text parts in the same order that make one JSON array when they are put together by name."""
    placed = _placed(stored, fields)
    ends = _ends(placed)
    if ends["first"] is None:
        stored.sparkSession.range(1, numPartitions=1).select(F.lit("[]").alias("value")).write.mode("overwrite").text(path)
        return
    before, after = F.when(_at(ends["first"]), "[").otherwise(","), F.when(_at(ends["last"]), "]").otherwise("")
    _write_lines(placed.select("_place", F.concat(before, F.to_json("_row", {"ignoreNullFields": "false"}), after).alias("value")), path)


def write_csv_document(stored: DataFrame, path: str, fields: tuple[str, ...]) -> None:
    """Write rows read from Parquet as text parts in the same order that make one CSV document, whose header is in the first part alone."""
    placed, header = _placed(stored, fields), ",".join(fields)
    ends = _ends(placed)
    if ends["first"] is None:
        stored.sparkSession.range(1, numPartitions=1).select(F.lit(header).alias("value")).write.mode("overwrite").text(path)
        return
    line = F.to_csv("_row", {"escape": '"'})
    _write_lines(placed.select("_place", F.concat(F.when(_at(ends["first"]), header + "\n").otherwise(""), line).alias("value")), path)
