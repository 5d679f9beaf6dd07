"""Pieces that the training-data operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The columns of ``documents``; pipeline stages hand on exactly these.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Rows and bytes that a task looks at together (more bytes only where one row has more).
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def row_key() -> dict[str, Column]:
    """What tells a row from all others that differ from it, whatever its id: ``_doc`` and ``_mark``.

    ``_mark`` is a hash of the text, negative where the row has no id; ``_doc`` is the id, or another hash of the text.
    """
    lowest = -(1 << 63)
    text, known = text_of(), F.col("doc_id").isNotNull()
    mark = F.when(known, F.xxhash64(text).bitwiseAND(F.lit(~lowest))).otherwise(F.xxhash64(text).bitwiseOR(F.lit(lowest)))
    return {"_doc": F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit(1), text)), "_mark": mark}


def row_keys(docs: DataFrame) -> DataFrame:
    """(doc, mark, text) of the rows of ``docs``; null text is read as the empty one."""
    return docs.select(*[c.alias(name[1:]) for name, c in row_key().items()], text_of().alias("text"))


def bounded(batches: Iterator, most_bytes: int | None = None) -> Iterator:
    """Arrow batches cut into parts of bounded size: memory in Python follows the part, whatever batches the session makes."""
    for batch in batches:
        rows = max(1, min(BATCH_ROWS, (most_bytes or BATCH_BYTES) * batch.num_rows // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only on one machine (a local master, as in tests) is a folder made here where it is unset.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever store it lies."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared folder, so that a lost executor costs no more than its running tasks."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def number_rows(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number all rows from 0 in the order of ``keys`` (nulls first) without a global sort in one task.

    Rows are range-partitioned and sorted, and frozen there by a checkpoint; a table with one row
    a partition then gives each partition its offset. Equal keys are split over partitions by the
    place a row was read at, so one key with a third of the rows does not make one large task.
    """
    spark = df.sparkSession
    ranged = (
        df.withColumn("_read_at", F.monotonically_increasing_id())
        .repartitionByRange(shuffle_partitions(spark), *keys, "_read_at")
        .sortWithinPartitions(*keys, "_read_at")
        .drop("_read_at")
        .withColumn("_placed_at", F.monotonically_increasing_id())
    )
    ranged = shared_checkpoint(ranged)
    part, place = F.shiftright("_placed_at", 33), F.col("_placed_at").bitwiseAND(F.lit((1 << 33) - 1))
    ranged = ranged.select("*", part.alias("_part"), place.alias("_place"))
    # One row a partition: its size is bound by the number of partitions, not by the data.
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_place") + F.col("_offset"))
        .drop("_placed_at", "_part", "_place", "_offset")
    )
