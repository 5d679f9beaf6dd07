"""Exact dedup: group by a 128-bit content hash, compare bytes inside groups, keep one stable id.

Rows are grouped by the hash and by the text itself, so texts that merely share a hash never meet
in a group; copies within a task are merged before the shuffle, so a text that a third of all rows
hold costs one row a task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import text_of


def content_hash(text: Column) -> Column:
    """128 bits of the text's content."""
    return F.md5(text.cast("binary"))


def duplicate_groups(docs: DataFrame, keep: str = "smallest", hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per distinct text: content_hash, text_sha256, keep_id, group_size.

    ``keep`` is ``smallest`` or ``largest``: which doc_id of equal texts stays.
    """
    chosen = {"smallest": F.min, "largest": F.max}[keep]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return (
        texts.groupBy(hashed(F.col("text")).alias("content_hash"), "text")
        .agg(chosen("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("content_hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    )


def mark_duplicates(docs: DataFrame, keep: str = "smallest", hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty. Rows that repeat the id that stays are all marked kept. A null
    doc_id never stays unless a group has no other. An empty table gives an empty table; other
    columns are not looked at. Only hashes and ids are joined, never texts; a hot hash meets one
    row of groups, so the skew join may split it.
    """
    groups = duplicate_groups(docs, keep, hashed)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        hashed(text_of()).alias("content_hash"),
        F.sha2(text_of(), 256).alias("text_sha256"),
    )
    return rows.join(groups, ["content_hash", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def deduplicate(docs: DataFrame, keep: str = "smallest", hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """``docs`` with one row of each distinct text, all columns kept; repeated rows leave one.

    Ties of doc_id are broken by the other columns, so the result does not depend on row order.
    Null text counts as empty, and comes back as it was in the row that stays.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    pick = {"smallest": F.min, "largest": F.max}[keep]
    known = F.col("doc_id").isNotNull() if keep == "largest" else F.col("doc_id").isNull()
    row = F.struct(known.alias("_known"), F.col("doc_id"), F.col("text").isNull().alias("_null"), *[F.col(c) for c in others])
    whole = docs.groupBy(hashed(text_of()).alias("_hash"), text_of().alias("_text")).agg(pick(row).alias("_row"))
    text = F.when(F.col("_row._null"), F.lit(None)).otherwise(F.col("_text"))
    return whole.select(*[text.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])
