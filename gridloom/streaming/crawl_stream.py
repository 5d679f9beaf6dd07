"""Pages that arrive as a stream: the same extraction, and a keyed merge per batch into the endpoint table.

The table lies in buckets of its key. A batch rewrites the buckets that its keys fall in and no others; a manifest that is swapped in one
step says which batch wrote each bucket last, so readers see the table before a batch or after it. What no manifest names any more goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.functions import fixed as X
from gridloom.functions.endpoints import record_key
from gridloom.jobs.crawl import page_texts
from gridloom.operators import dedupe, extract, records, validate
from gridloom.sources import files

BUCKETS = 64


def extracted(pages: DataFrame, day: str) -> DataFrame:
    """Good endpoint records of a stream or table of pages, with the order columns site and page_ord; no state is kept."""
    found = records.site_records(extract.site_endpoints(page_texts(pages)), day, ("site", "page_ord"))
    return validate.good(validate.normalize(found))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*record_key()), F.lit(buckets)).cast("int").alias("bucket")


def _paths(folder: str, written: dict[str, int], only: list[int] | None = None) -> list[str]:
    chosen = written if only is None else {str(b): written[str(b)] for b in only if str(b) in written}
    return [f"{folder}/batch={batch}/bucket={bucket}" for bucket, batch in sorted(chosen.items(), key=lambda x: int(x[0]))]


def read_table(spark: SparkSession, folder: str) -> DataFrame:
    """The endpoint table as the last whole batch left it."""
    paths = _paths(folder, files.manifest(spark, folder).get("buckets", {}))
    return spark.read.parquet(*paths).select(*X.ENDPOINT_FIELDS) if paths else spark.createDataFrame([], X.ENDPOINT_SCHEMA)


def merge_batch(spark: SparkSession, folder: str, batch: DataFrame, batch_id: int, buckets: int = BUCKETS) -> None:
    """Merge a batch into the table: its buckets as they are, then the batch, made unique by key.

    A batch that is run again after its manifest was written changes nothing; one that was stopped before writes the same files anew. A table
    keeps the number of buckets that it was begun with. Each batch's own files stay for one batch after they were replaced, for readers.
    """
    now = files.manifest(spark, folder)
    written, last = now.get("buckets", {}), now.get("batch", -1)
    if batch_id <= last:
        return
    buckets = now.get("number", buckets)
    order = F.struct(F.lit(1).alias("later"), "site", "page_ord", "domain", "port", "scheme")
    rows = batch.withColumn("ord", order).select("ord", *X.ENDPOINT_FIELDS)
    touched = sorted(r["bucket"] for r in rows.select(_bucket(buckets)).distinct().collect())
    if paths := _paths(folder, written, touched):
        empty = F.struct(F.lit(0).alias("later"), F.lit("").alias("site"), F.lit(0).alias("page_ord"), "domain", "port", "scheme")
        rows = spark.read.parquet(*paths).withColumn("ord", empty).select("ord", *X.ENDPOINT_FIELDS).union(rows)
    merged = dedupe.unique_first(rows).select(*X.ENDPOINT_FIELDS, _bucket(buckets))
    if touched:
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/batch={batch_id}")
    replaced = _paths(folder, written, touched)
    files.swap_manifest(spark, folder, {
        "version": str(batch_id), "batch": batch_id, "number": buckets, "buckets": written | {str(b): batch_id for b in touched}, "replaced": replaced,
    })
    for path in now.get("replaced", []):
        files.delete(spark, path)


def start(pages: DataFrame, folder: str, checkpoint: str, day: str, available_now: bool = True, buckets: int = BUCKETS) -> StreamingQuery:
    """Follow a stream of pages (site, pool_name, page_ord, url, content_type, body)."""
    spark = pages.sparkSession
    writer = extracted(pages, day).writeStream.option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(lambda batch, batch_id: merge_batch(spark, folder, batch, batch_id, buckets))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
