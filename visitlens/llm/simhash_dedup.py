"""SimHash near-duplicate groups with pigeonring candidate filtering.

A document's words (A-Z lower-cased, split at ASCII white space) give 3-word
shingles, repeats included; its fingerprint has a bit where more than half
of the shingles' XXH64 values (seed 42) have it. Documents whose fingerprints
differ in at most 3 bits are linked, and groups are the connected components.

Pigeonring: cut 64 bits into a ring of four 16-bit segments. If all four differ
by at most 3 bits in sum, some segment starts a chain whose first 1, 2, 3
segments differ by at most 3/4, 6/4, 9/4 bits, that is by 0, 1 and 2. So a
chain's first segment is equal, and of its second one at least one byte is:
24 equal bits make a join key, eight keys for each fingerprint. The chain's
budgets then prune the candidates before the full Hamming check.

Only distinct fingerprints are joined, so any number of exact copies is one
row there. Null and empty texts have fingerprint zero and are linked like any
other; null doc_ids are kept (their group's id is the smallest known one);
repeated rows are returned as often as given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, id_text, saved, with_id
from .components import components

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SEGMENTS, SEGMENT_BITS, MAX_BITS = 4, 16, 3


def fingerprint(text: str, shingle: int = 3, block: int = 1 << 16) -> int:
    """The unsigned fingerprint of one text."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    starts = np.append(0, ends[: n - 1]).tolist()
    stops = (ends[len(words) - n :] - 1).tolist()
    votes = np.zeros(64, np.int64)
    for a in range(0, n, block):
        h = [xxh64_intdigest(joined[i:j], 42) for i, j in zip(starts[a : a + block], stops[a : a + block], strict=True)]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) with fp as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = np.array([fingerprint(t, shingle) for t in pdf["text"].fillna("")], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text_hash": pdf["text_hash"], "fp": fp})

    rows = docs.select(id_text(), F.xxhash64("text").alias("text_hash"), "text")
    return with_id(rows.mapInPandas(run, "doc_id string, text_hash long, fp long"))


def segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, SEGMENT_BITS * (i % SEGMENTS)).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))


def ring_keys(fp: Column) -> Column:
    """Eight keys: chain start, byte of the second segment, their 24 bits."""
    keys = []
    for i in range(SEGMENTS):
        for byte in (0, 1):
            second = F.shiftright(segment(fp, i + 1), 8 * byte).bitwiseAND(F.lit(255))
            keys.append(F.lit((2 * i + byte) << 24) + segment(fp, i) * F.lit(256) + second)
    return F.array(*keys)


def links(fps: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b, of the distinct fingerprints ``fps`` (fp) that
    differ in at most MAX_BITS bits."""
    keyed = fps.select("fp", F.explode(ring_keys(F.col("fp"))).alias("key"))
    left, right = keyed.select(F.col("fp").alias("a"), "key"), keyed.select(F.col("fp").alias("b"), "key")
    diff = F.col("a").bitwiseXOR(F.col("b"))
    start = F.shiftright("key", 25).cast("int")
    turned = F.expr("0L")
    for i in range(SEGMENTS):  # the ring turned so that the chain starts at bit 0
        by = SEGMENT_BITS * i
        ring = F.shiftrightunsigned(diff, by).bitwiseOR(F.shiftleft(diff, 64 - by)) if i else diff
        turned = F.when(start == i, ring).otherwise(turned)
    chain = [F.bit_count(turned.bitwiseAND(F.lit((1 << SEGMENT_BITS * k) - 1))) <= k * MAX_BITS // SEGMENTS for k in (2, 3)]
    near = (F.col("a") < F.col("b")) & chain[0] & chain[1] & (F.bit_count(diff) <= MAX_BITS)
    return left.join(right, "key").where(near).select("a", "b").distinct()


def grouped(docs: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, text_hash, fp), and their fingerprints (fp, root, component_id)."""
    found = saved(fingerprints(docs, shingle))
    nodes = cut(found.groupBy("fp").agg(F.min("doc_id").alias("least")))
    groups = components(links(nodes.select("fp")))
    named = nodes.join(groups, nodes.fp == groups.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return found, cut(named.join(ids, "root").select("fp", "root", "component_id"))


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each row."""
    found, by_fp = grouped(docs, shingle)
    return found.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_groups(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id (null
    ids last), of its texts the one of the smallest hash, once if it is repeated."""
    found, by_fp = grouped(docs, shingle)
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    first = found.join(by_fp, "fp").groupBy("root").agg(F.min(place).alias("first"))
    keep = first.select(F.col("first.doc_id").alias("_doc"), F.col("first.text_hash").alias("_hash"))
    same = docs["doc_id"].cast("long").eqNullSafe(keep["_doc"]) & (F.xxhash64(docs["text"]) == keep["_hash"])
    return docs.join(keep, same, "left_semi").dropDuplicates(["doc_id", "text"])
