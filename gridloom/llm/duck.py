"""DuckDB inside the tasks of a Spark stage: Spark deals the rows out, a task puts one SQL query to each of its batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame

from gridloom.llm.common import bounded


def map_by_sql(df: DataFrame, sql: str, columns: dict[str, str], prepare: Callable | None = None, most_bytes: int | None = None) -> DataFrame:
    """The rows that ``sql`` makes of each batch of ``df``, which it sees as the table ``batch``.

    ``columns`` are the names and Spark types of the result, all of them long, int, string, or arrays of these. ``prepare`` is called
    with each new connection, to register functions. A connection lives as long as its task, is in memory alone and
    has one thread; batches hold at most 2000 rows and ``most_bytes`` (more only where one row has more).
    """
    import pyarrow as pa

    plain = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    kinds = {k: plain[v] if v in plain else pa.list_(plain[v.removeprefix("array<").removesuffix(">")]) for k, v in columns.items()}
    schema = pa.schema(list(kinds.items()))

    def run(batches: Iterator) -> Iterator:
        import duckdb

        with duckdb.connect(":memory:", config={"threads": 1}) as con:
            if prepare:
                prepare(con)
            for batch in bounded(batches, most_bytes):
                con.register("batch", pa.Table.from_batches([batch]))
                yield from con.sql(sql).to_arrow_table().select(list(kinds)).cast(schema).to_batches()
                con.unregister("batch")

    return df.mapInArrow(run, ", ".join(f"{k} {v}" for k, v in columns.items()))
