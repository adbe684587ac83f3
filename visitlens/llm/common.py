"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: What separates the words of the contamination and license rules.
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: 256-entry byte table: A-Z to a-z, ASCII other than letters and digits to a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it
    (local runs, or the same path on each node; else submit it with --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH")) if x)


def id_text(name: str = "doc_id") -> Column:
    """An integer id as text for a Python worker: pandas would turn a batch of ids
    with a null into doubles, which hold no more than 53 bits."""
    return F.col(name).cast("long").cast("string").alias(name)


def with_id(rows: DataFrame, name: str = "doc_id") -> DataFrame:
    """``rows`` of a Python worker with the id as an integer again."""
    return rows.withColumn(name, F.col(name).cast("long"))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, all other characters as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def word_array(text: Column) -> Column:
    """Lower-cased words of a text (null: none), as array<string>."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), WORD_BREAK)
    return F.array_remove(parts, "")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a ``local[...]`` session without that setting falls back to a
    temporary folder; a cluster session without it is an error.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


#: Spark's own setting (4.1 on): the shuffle files of an execution go when it has ended.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files. Else they stay until the driver
    happens to collect its garbage, and a query of many steps holds those of
    several steps at once; the files that a step writes are all that is read again."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def saved(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder as a table and read back: the
    lineage ends there and each later read of the table costs one scan."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/step-{uuid.uuid4().hex}"
    with shuffles_go(df.sparkSession):
        df.write.parquet(path, compression="zstd")  # a query's steps stay until it ends
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint (files that go when the DataFrame is collected)."""
    shared_dir(df.sparkSession)
    with shuffles_go(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # the setting holds for DataFrames made under it
