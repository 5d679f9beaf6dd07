"""Joins and folds over keys that a large share of all rows may have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys of a join that are told apart by their number of rows, per shuffle partition.
HOT_KEYS = 4


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], times: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has one row per key and, as ``times``, how many of ``rows`` hold the key.

    The most frequent keys, HOT_KEYS for each shuffle partition whatever the data, are joined by broadcast, so their rows stay where
    they are; of the others none has more than 1 / (HOT_KEYS * partitions) of the rows, and they are shuffled. ``how``
    is inner or left; null keys meet nothing. Returns the columns of ``rows`` and the values of ``table`` but for ``times``.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = [c for c in table.columns if c not in (*keys, times)]
    named = table.select(*keys, F.struct(*[F.col(c) for c in values]).alias("_value"), F.col(times).alias("_times"))
    hot = named.orderBy(F.desc("_times"), *keys).limit(HOT_KEYS * partitions).select(*keys, F.col("_value").alias("_hot"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    warm = marked.where(F.col("_hot").isNotNull()).select(*rows.columns, F.col("_hot").alias("_value"))
    cold = marked.where(F.col("_hot").isNull()).select(*rows.columns).join(named.select(*keys, "_value"), keys, how).select(*rows.columns, "_value")
    return warm.unionByName(cold).select(*rows.columns, *[F.col(f"_value.{c}").alias(c) for c in values])
