"""Benchmark decontamination with DataFrame operations only.

Words are lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII
characters. The windows of a benchmark item are its runs of 13 consecutive
words; an item of fewer words is one window, an item without words none. The
distinct windows are hashed; the words of each document are scanned window by
window against that table, and a hash hit is verified word by word. Document
words inside an occurrence are hit; a document is contaminated if its hit words
are at least a twentieth of its words.

The windows are broadcast only if their table is within ``broadcast_windows``
rows (a count is taken first; a window's row has 13 words); a larger one is
joined by hash. Windows of the benchmark that equal each other are one row with
the list of their items.

Null texts have no words. Rows that repeat a (doc_id, text) whole get the same
result each. Columns besides doc_id and text (item_id and text) are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, saved, word_array

WINDOW = 13
SHARE = 20  # contaminated: SHARE * hit words >= words


def window_hash(size: int) -> str:
    return "xxhash64(" + ", ".join(f"get(words, pos + {i})" for i in range(size)) + ")"


def windows_of(texts: DataFrame, size: int) -> DataFrame:
    """``texts`` (keys, words) with a row for each run of ``size`` words: pos,
    key (its hash); words stays for verification."""
    enough = texts.where(F.size("words") >= size)
    at = enough.select("*", F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("pos"))
    return at.select("*", F.expr(window_hash(size)).alias("key"))


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(len, win, items): each distinct window and the items that have it."""
    items = benchmark.select("item_id", word_array(F.col("text")).alias("words")).where("size(words) > 0")
    long = windows_of(items, size).select(F.lit(size).alias("len"), "item_id", F.expr(f"slice(words, pos + 1, {size})").alias("win"))
    short = items.where(F.size("words") < size).select(F.size("words").alias("len"), "item_id", F.col("words").alias("win"))
    return (
        long.union(short)
        .groupBy("len", "win")
        .agg(F.collect_set("item_id").alias("items"))
        .select("len", "win", "items")
    )


def scanned(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, broadcast_windows: int = 1_000_000) -> DataFrame:
    """(doc_id, text_hash, n_words, pos, len, items, lead): every occurrence,
    and one ``lead`` row for each row of ``docs`` (its first position; len and
    items null if nothing occurs there), so that one pass gives both."""
    windows = saved(benchmark_windows(benchmark, size))
    lengths = windows.groupBy("len").count().collect()  # at most ``size`` rows
    small = sum(r["count"] for r in lengths) <= broadcast_windows
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), word_array(F.col("text")).alias("words"))
    parts = []
    for length in sorted((r["len"] for r in lengths), reverse=True) or [size]:
        last = F.greatest(F.size("words") - length, F.lit(0))
        at = texts.select("*", F.size("words").cast("long").alias("n_words"), F.explode(F.sequence(F.lit(0), last)).alias("pos"))
        at = at.select("*", F.expr(window_hash(length)).alias("key"))
        own = windows.where(F.col("len") == length).select(F.expr(key_of_win(length)).alias("win_key"), "len", "win", "items")
        same = F.expr(f"slice(words, pos + 1, {length}) = win")
        if small:
            own = F.broadcast(own)
        else:  # a window's words travel, not its text's
            at, same = at.withColumn("words", F.expr(f"slice(words, pos + 1, {length})")), F.expr("words = win")
        hit = at.join(own, (F.col("key") == F.col("win_key")) & same, "inner" if parts else "left")
        hit = hit if parts else hit.where("items is not null or pos = 0")
        lead = F.lit(not parts) & (F.col("pos") == 0)
        parts.append(hit.select("doc_id", "text_hash", "n_words", "pos", "len", "items", lead.alias("lead")))
    return saved(reduce(DataFrame.union, parts))


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, pos, len, items) of every occurrence."""
    return scanned(docs, benchmark, size).where("items is not null").select("doc_id", "text_hash", "pos", "len", "items")


def key_of_win(size: int) -> str:
    return "xxhash64(" + ", ".join(f"get(win, {i})" for i in range(size)) + ")"


def hit_words(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_hit): the words inside the union of occurrences.

    The occurrences of a document are at most its words times the lengths."""
    spans = found.select("doc_id", "text_hash", "pos", (F.col("pos") + F.col("len")).alias("end")).distinct()
    w = Window.partitionBy("doc_id", "text_hash").orderBy("pos", "end")
    before = F.coalesce(F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("pos", "before"))
    return spans.withColumn("before", before).groupBy("doc_id", "text_hash").agg(F.sum(new).alias("n_hit"))


def judged(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, broadcast_windows: int = 1_000_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the
    text's hash for each row of ``docs``."""
    scan = scanned(docs, benchmark, size, broadcast_windows)
    # rows that repeat a (doc_id, text) have one set of occurrences
    found = cut(scan.where("items is not null").select("doc_id", "text_hash", "pos", "len", "items").distinct())
    items = (
        found.select("doc_id", "text_hash", F.explode("items").alias("item"))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.col("item").cast("string")).alias("items"))
    )
    per = _merge(hit_words(found), items)
    per = per.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "n_hit", "items")
    base = scan.where("lead").select("doc_id", "text_hash", "n_words")
    out = base.join(per, base["doc_id"].eqNullSafe(per["_doc"]) & (base["text_hash"] == per["_hash"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce(F.array_join(F.array_sort("items"), ","), F.lit(""))
    return out.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"),
        "text_hash",
    )


def _merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner join on the null-safe (doc_id, text_hash)."""
    b = b.withColumnsRenamed({"doc_id": "_b_doc", "text_hash": "_b_hash"})
    same = a["doc_id"].eqNullSafe(b["_b_doc"]) & (a["text_hash"] == b["_b_hash"])
    return a.join(b, same).drop("_b_doc", "_b_hash")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = judged(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(bad["_doc"]) & (F.xxhash64(docs["text"]) == bad["_hash"])
    return docs.join(bad, same, "left_anti")


def without_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with clean_words: the words outside of every
    occurrence, as array<string>."""
    found = hits(docs, benchmark).select("doc_id", "text_hash", F.explode(F.expr("sequence(pos, pos + len - 1)")).alias("at"))
    gone = found.groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("gone"))
    gone = gone.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    own = docs.select("doc_id", "text", word_array(F.col("text")).alias("words"))
    out = own.join(gone, own["doc_id"].eqNullSafe(gone["_doc"]) & (F.xxhash64(own["text"]) == gone["_hash"]), "left")
    stay = F.expr("array_except(sequence(0, size(words) - 1), gone)")
    kept = F.when(F.col("gone").isNull(), F.col("words")).otherwise(F.transform(stay, lambda i: F.get(F.col("words"), i)))
    return out.select("doc_id", "text", kept.alias("clean_words"))
