"""Corpus pipeline: the documents through five stages of ``visitlens.llm``.

Each stage takes (spark, docs, sf_dir) and returns what the next one reads:
toxic documents go, repeated lines go, one document of each near-duplicate
group stays, contaminated documents go, the rest is encoded. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitlens.llm import decontaminate, line_dedup, piece_codec, simhash_dedup, toxicity
from visitlens.llm.common import importable, saved, table
from visitlens.llm.queries import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return toxicity.clean_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.clean_documents(docs, segments=True)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return simhash_dedup.first_of_groups(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256, decoded_sha256."""
    importable(spark)
    return piece_codec.encoded(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_dedup", drop_copies),
    ("decontamination", drop_contaminated),
    ("piece_codec", encode),
]

#: The trained toxicity score and the piece encoding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
