"""Resampling towards a target: hashed n-gram counts of corpus and target, importance weights, and a draw without replacement.

DuckDB runs inside the tasks: it unnests the words of a batch, makes n-grams of them with a window, and hashes them by a zlib CRC
function that is registered with it. The buckets of each document, and the bucket counts of each batch, are spilled to Parquet in
the shared folder, so the texts are read once; Spark merges the counts, scores the documents from the spilled buckets and ranks them.
"""

from __future__ import annotations

import math
import uuid
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import delete_folder, number_rows, shared_folder, text_of
from gridloom.llm.duck import map_by_sql

#: Words: runs of ASCII letters and digits and of everything beyond ASCII, with A to Z in lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCH_BYTES = 4 << 20


def _register_crc(buckets: int):
    def prepare(con) -> None:
        import numpy as np
        import pyarrow as pa

        def crc_bucket(features):
            column = features.combine_chunks() if isinstance(features, pa.ChunkedArray) else features
            column = column.cast(pa.string())
            _, offsets, data = column.buffers()
            places = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].tolist()
            text, ends = data.to_pybytes() if data else b"", iter(places[1:])
            crcs = np.fromiter(map(zlib.crc32, map(text.__getitem__, map(slice, places, ends))), np.uint32, len(column))
            return pa.array((crcs % np.uint32(buckets)).astype(np.int32))

        con.create_function("crc_bucket", crc_bucket, ["VARCHAR"], "INTEGER", type="arrow")

    return prepare


def _features_sql(longest: int) -> str:
    """A row a document with the bucket of each of its features, and one with the counts of the batch."""
    grams = ["SELECT place, word AS feature FROM follow"]
    ahead, gram, last = [], "word", ""
    for k in range(1, longest):
        ahead.append(f", lead(word, {k}) OVER (PARTITION BY place ORDER BY spot) AS word{k}")
        gram, last = f"{gram} || ' ' || word{k}", f"word{k}"
        grams.append(f"SELECT place, {gram} FROM follow WHERE {last} IS NOT NULL")
    return f"""
    WITH texts AS MATERIALIZED (
      SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM batch
    ), unnested AS (SELECT place, unnest(words) AS word, unnest(range(len(words))) AS spot FROM texts),
    follow AS (SELECT place, word{"".join(ahead)} FROM unnested),
    hashed AS MATERIALIZED (SELECT place, crc_bucket(feature) AS bucket FROM ({" UNION ALL ".join(grams)})),
    of_text AS (SELECT place, list(bucket) AS buckets FROM hashed GROUP BY place),
    of_batch AS (SELECT bucket, count(*) AS held FROM hashed GROUP BY bucket)
    SELECT doc_id, len(words) AS n_words, coalesce(buckets, []) AS buckets, NULL::INTEGER[] AS total_buckets, NULL::BIGINT[] AS total_held FROM texts LEFT JOIN of_text USING (place)
    UNION ALL SELECT NULL, NULL, NULL, list(bucket), list(held) FROM of_batch
    """


def spill_features(texts: DataFrame, path: str, longest: int, buckets: int) -> DataFrame:
    """Write the features of (doc_id, text) to ``path`` and read them back: doc_id, n_words, buckets of each text; total_buckets, total_held of each batch."""
    columns = {"doc_id": "long", "n_words": "long", "buckets": "array<int>", "total_buckets": "array<int>", "total_held": "array<long>"}
    map_by_sql(texts, _features_sql(longest), columns, _register_crc(buckets), BATCH_BYTES).write.parquet(path)
    return texts.sparkSession.read.parquet(path)


def bucket_counts(spilled: DataFrame) -> dict[int, int]:
    """How many features a bucket holds, for the buckets that hold any: at most as many numbers as there are buckets."""
    held = spilled.where("total_held IS NOT NULL").select(F.explode(F.arrays_zip("total_buckets", "total_held")).alias("x"))
    counts = held.groupBy(F.col("x.total_buckets").alias("bucket")).agg(F.sum("x.total_held").alias("held"))
    return {r["bucket"]: r["held"] for r in counts.collect()}


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int) -> list[int]:
    """What a feature of each bucket adds: a thousand times the logarithm of its share in the target over that in the corpus, add-one smoothed."""
    all_corpus, all_target = sum(corpus.values()) + buckets, sum(target.values()) + buckets
    share = lambda b: float((target.get(b, 0) + 1) * all_corpus) / float((corpus.get(b, 0) + 1) * all_target)
    return [math.floor(1000 * math.log(share(b))) for b in range(buckets)]


def gumbel(key: Column, seed: int) -> Column:
    """A seeded draw of a key from the Gumbel distribution, in thousandths."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, longest: int = 2, buckets: int = 10000, least_words: int = 20, percent: int = 25, seed: int = 7
) -> DataFrame:
    """One row a document: doc_id, n_words, n_features, weight, score, rank.

    ``target`` is a table with a ``text`` column. Features are runs of 1 to ``longest`` words. ``weight`` is the floored mean of the gains
    of a document's features, 0 without any; ``score`` adds the seeded draw of its id. Of the documents of ``least_words`` words or more,
    ``percent`` in a hundred (rounded down) with the highest scores are drawn and ranked from 1; ties go to the smaller id, and no id is the
    smallest. The others have no rank. Null text has no words; repeated rows are rows of their own, and tie; an empty table gives an empty
    table, an empty target gives every bucket the smoothed share of nothing; other columns are not looked at.

    The memory of a task follows its batch, which is as large as the longest text at least. The driver gets ``buckets`` counts.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/importance-{uuid.uuid4().hex}"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    corpus = spill_features(texts, f"{folder}/corpus", longest, buckets)
    wanted = spill_features(target.select(F.lit(None).cast("long").alias("doc_id"), text_of().alias("text")), f"{folder}/target", longest, buckets)
    gain = F.split(F.lit(",".join(map(str, gains(bucket_counts(corpus), bucket_counts(wanted), buckets)))), ",").cast("array<long>")
    features = F.size("buckets").cast("long")
    rows = corpus.where("n_words IS NOT NULL").select(
        "doc_id", "n_words", features.alias("n_features"), F.aggregate("buckets", F.lit(0).cast("long"), lambda total, b: total + F.get(gain, b)).alias("total")
    )
    mean = F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(F.lit(0).cast("long"))
    scored = rows.select("doc_id", "n_words", "n_features", mean.alias("weight")).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    ordered = scored.withColumns({"_short": F.col("n_words") < least_words, "_down": -F.col("score")})
    ranked = number_rows(ordered, ["_short", "_down", "doc_id"], "_at")  # frozen there, so the spilled features may go
    delete_folder(spark, folder)
    drawn = percent * ranked.where(~F.col("_short")).count() // 100
    rank = F.when(F.col("_at") < drawn, F.col("_at") + 1).cast("long")
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))
