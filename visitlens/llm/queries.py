"""Registered queries of this subpackage: opN_<name>(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate, host_reputation, license_scan, line_dedup, merkle, mtree, page_quality, pii, piece_codec, simhash_dedup, spelling, token_store,
    toxicity, vector_tree,
)
from .common import importable, saved, table

#: Fixed by the contract of op2: host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
GOOD_SHARE = 0.6

#: Fixed by the contract of op4: phrase, label.
LICENSE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), segments=True)


def op2_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the quality of its own text, learned from the labelled documents."""
    pages = table(spark, sf_dir, "pages")
    model = page_quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return host_reputation.judge_rows(pages, page_quality.outcomes(pages, model), URL_RULES, GOOD_SHARE)


def op3_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encoded(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), with_ids=False)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), LICENSE_PHRASES)


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).withColumn("held_out", F.coalesce(toxicity.held_out(), F.lit(False)))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op8_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_store(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = saved(spelling.vocabulary(spelling.altered_runs(table(spark, sf_dir, "documents"))))
    return spelling.spelling_variants(words)


def op12_vector_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_tree.neighbours(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 7 divides the hash of the doc_id, the checked copy has one more in n_chars."""
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string")) % 7 == 0
    n_chars = F.col("n_chars").cast("decimal(20,0)")
    return merkle.verified(table(spark, sf_dir, "documents"), n_chars=F.when(tampered, n_chars + 1).otherwise(n_chars))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_line_dedup, op2_host_reputation, op3_piece_codec, op4_license_scan, op5_simhash_dedup,
        op6_toxicity, op7_decontamination, op8_mtree_topk, op9_token_store, op10_pii, op11_spelling_variants, op12_vector_tree,
        op13_merkle_manifest,
    ]

    def ready(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return f(spark, sf_dir)

        return run

    return {f.__name__: ready(f) for f in found}
