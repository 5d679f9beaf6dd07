"""Sharding by a Feistel permutation over global row numbers (DataFrame functions only).

Rows are numbered in the order (doc_id, size, text_crc32). A Feistel network with two unequal
halves, a = ceil(sqrt(N)) and b = ceil(N / a), permutes [0, a * b); a number that falls on or
beyond N walks the cycle until it is below N, so the result is a permutation of [0, N) itself.
The permuted number p gives shard p mod S and slot p div S. Nothing but N and the key decides, so
any worker can compute the shard and slot of any row number, and shard sizes differ by one at most.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import number_rows, text_of

#: Round keys of the network, and the prime field in which rounds mix.
ROUND_KEYS, PRIME = (1_234_567, 987_654_321, 55_555_553, 1_700_000_009), 2_147_483_647

#: Steps of a walk. Fewer than a = ceil(sqrt(N)) of a * b numbers lie beyond N, so a walk takes k steps with
#: probability under N ** (-k / 2); with at most 64 such numbers no walk can be longer.
WALK_STEPS = 64


def halves(rows: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    return a, max(1, -(-rows // a))


def _once(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the network over [0, a * b)."""
    rounds = F.array(*[
        F.struct(F.lit((k + seed) % PRIME).cast("long").alias("k"), F.lit(a if i % 2 == 0 else b).cast("long").alias("m"))
        for i, k in enumerate(ROUND_KEYS)
    ])

    def mixed(right: Column, key: Column) -> Column:
        u = (right * 48_271 + key) % PRIME
        return ((u * u) % PRIME * 16_807 + u) % PRIME

    right = x % b
    start = F.struct(((x - right) / b).cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(
        rounds,
        start,
        lambda s, k: F.struct(s["r"].alias("l"), ((s["l"] + mixed(s["r"], k["k"])) % k["m"]).cast("long").alias("r")),
        lambda s: s["l"] * b + s["r"],
    )


def permuted(row: Column, rows: int, seed: int = 0) -> Column:
    """The place of row number ``row`` in the shuffled order of ``rows`` rows."""
    a, b = halves(rows)
    steps = F.sequence(F.lit(1), F.lit(WALK_STEPS))
    walked = F.aggregate(steps, _once(row, a, b, seed), lambda x, _: F.when(x < rows, x).otherwise(_once(x, a, b, seed)))
    return F.when(walked < rows, walked).otherwise(F.raise_error(F.lit("a cycle walk did not end")).cast("long"))


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 0) -> DataFrame:
    """Deal ``docs`` into ``shards`` shards under the law ``rows``: counts at most one apart.

    Returns doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, law, shard, slot (gapless
    from 0 in each shard) and grown_shard (null: this law does not keep rows in place when a shard
    is added). Null text has no bytes and crc32 0; a null doc_id sorts first; repeated rows each get
    a slot of their own; an empty table gives an empty table; other columns are not looked at.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text_of()) + 8).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
    )
    numbered = number_rows(rows, ["doc_id", "size", "text_crc32"], "row")
    total = numbered.count()
    place = permuted(F.col("row"), total, seed)
    return numbered.withColumn("place", place).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
