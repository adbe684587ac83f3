"""Result sinks: write the result rows to a JDBC table or to a file table.

The original inserted its single row with a prepared statement and offered a
batched insert helper; Spark's JDBC writer does both (one prepared INSERT,
``batchsize`` rows per round trip, one transaction per partition).

``append_*`` add rows, so a repeated run adds them again, as the original's did.
``replace_files`` can be run again: the table is partitioned by task, and the rows
of a task that is written take the place of those that it had (Spark's dynamic
partition overwrite; the new files are committed as a whole when the job ends, so
that a run that fails leaves the old rows). Spark's JDBC writer has no such mode:
a database needs a key on the task and a merge of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import constants as C


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str = "session_aggr_stat",
    properties: dict[str, str] | None = None,
    batchsize: int = 1000,
    partitions: int | None = None,
) -> None:
    """Append ``df`` to a database table. ``partitions`` sets the number of
    connections (each partition writes over its own); the rows are dealt out
    anew, so that the job before keeps its own tasks."""
    out = df.repartition(partitions) if partitions else df
    out.write.option("batchsize", str(batchsize)).jdbc(url, table, mode="append", properties=dict(properties or {}))


def append_files(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Append ``df`` to a directory table (parquet by default)."""
    writer = df.write.mode("append").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def replace_files(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ("taskid",)) -> None:
    """Write ``df`` to a directory table partitioned by ``partition_by``; the
    partitions that ``df`` has rows of are replaced, all others stay. A partition
    column of ``df`` must not be NULL in rows that are to be found by it."""
    missing = [c for c in partition_by if c not in df.columns]
    if missing or not partition_by:
        raise ValueError(f"no column to replace rows by: {missing or partition_by}")
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt)
    writer.partitionBy(*partition_by).save(path)


def stat_columns_in_order(df: DataFrame) -> DataFrame:
    """The 17 result columns in the order of the session_aggr_stat table."""
    return df.select(*C.STAT_COLUMNS)
