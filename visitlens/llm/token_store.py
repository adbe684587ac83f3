"""Token files: one id array with Elias-Fano encoded document boundaries.

``write_tokens`` sorts the documents by doc_id into range partitions,
encodes each text, appends the end id and writes segments. A segment is a
self-contained binary file of whole documents, of about ``segment_ids`` ids
(a single longer document makes a longer one):

    header   "TKEF", version, id width, documents, ids, null doc_ids,
             smallest doc_id, span of doc_ids, low-bit widths
    bounds   Elias-Fano sequence of the documents' end offsets
    doc_ids  Elias-Fano sequence of doc_id minus the smallest one
    ids      concatenated, 2 or 4 bytes each

An Elias-Fano sequence of n numbers up to u stores floor(log2(u / n)) low bits
of each and the rest as gaps in unary: about 2 + log2(u / n) bits a number,
no 64-bit table. ``select`` finds the i-th set bit through a sampled popcount
directory. The segments are the rows of a table in any storage that Spark
writes (part, segment, documents, ids, payload), so a lost executor's
half-written part never shows. Global offsets come from the parts' totals.

Null text counts as empty (end id only). Null doc_ids come first, as in
Spark's ascending order. Rows of one doc_id are ordered by their text.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_text, shared_dir, with_id
from .piece_codec import slices
from .word_cache import WordCache

HEADER = struct.Struct("<4sHHQQQqQBB6x")
MAGIC, VERSION, SAMPLE = b"TKEF", 1, 256


class EliasFano:
    """A non-decreasing sequence of n integers from 0 to u."""

    def __init__(self, n: int, low: int, lows: np.ndarray, highs: np.ndarray):
        self.n, self.low, self.lows, self.highs = n, low, lows, highs
        ones = np.bitwise_count(highs).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])[::SAMPLE]  # set bits before each SAMPLE bytes

    @staticmethod
    def width(n: int, u: int) -> int:
        return max(0, (u // n).bit_length() - 1) if n else 0

    @classmethod
    def encode(cls, values: np.ndarray, u: int) -> EliasFano:
        n = len(values)
        low = cls.width(n, u)
        v = values.astype(np.uint64)
        bits = (v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
        lows = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        high = np.zeros((u >> low) + n + 1, np.uint8)
        high[(v >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
        return cls(n, low, lows, np.packbits(high, bitorder="little"))

    @staticmethod
    def sizes(n: int, low: int, u: int) -> tuple[int, int]:
        return (n * low + 7) // 8, ((u >> low) + n + 1 + 7) // 8

    def tobytes(self) -> bytes:
        return self.lows.tobytes() + self.highs.tobytes()

    @classmethod
    def read(cls, raw: memoryview, at: int, n: int, low: int, u: int) -> tuple[EliasFano, int]:
        a, b = cls.sizes(n, low, u)
        part = np.frombuffer(raw, np.uint8, a + b, at)
        return cls(n, low, part[:a], part[a:]), at + a + b

    def select(self, i: int) -> int:
        """The i-th number, from one directory block of the high bits."""
        block = int(np.searchsorted(self.before, i, side="right")) - 1
        part = np.unpackbits(self.highs[block * SAMPLE : (block + 1) * SAMPLE], bitorder="little")
        place = block * SAMPLE * 8 + int(np.flatnonzero(part)[i - int(self.before[block])])
        low, first = 0, i * self.low
        if self.low:
            some = np.unpackbits(self.lows[first // 8 : (first + self.low + 7) // 8], bitorder="little")
            for k, bit in enumerate(some[first % 8 : first % 8 + self.low].tolist()):
                low |= bit << k
        return (place - i) << self.low | low

    def all(self) -> np.ndarray:
        high = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n] - np.arange(self.n)
        out = high.astype(np.uint64) << np.uint64(self.low)
        if self.low:
            bits = np.unpackbits(self.lows, bitorder="little", count=self.n * self.low).reshape(self.n, self.low)
            out |= (bits.astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return out.astype(np.int64)


def pack(doc_ids: list[int | None], docs: list[np.ndarray], wide: bool) -> bytes:
    """One segment: documents in ascending doc_id order, nulls first."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    gaps = known.astype(np.uint64) - np.uint64(least % (1 << 64)) if len(known) else known.astype(np.uint64)
    span = int(gaps[-1]) if len(known) else 0
    ends = np.cumsum([len(x) for x in docs]) if docs else np.zeros(0, np.int64)
    total = int(ends[-1]) if docs else 0
    bounds, names = EliasFano.encode(ends, total), EliasFano.encode(gaps, span)
    head = HEADER.pack(MAGIC, VERSION, 4 if wide else 2, len(docs), total, nulls, least, span, bounds.low, names.low)
    ids = np.concatenate(docs).astype("<u4" if wide else "<u2") if docs else np.zeros(0, "<u2")
    return head + bounds.tobytes() + names.tobytes() + ids.tobytes()


class Segment:
    """Reader of one segment: ``document(i)`` without decoding the others."""

    def __init__(self, payload: bytes):
        magic, version, width, self.n, self.total, self.nulls, self.least, span, a, b = HEADER.unpack_from(payload)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token segment")
        raw = memoryview(payload)
        self.bounds, at = EliasFano.read(raw, HEADER.size, self.n, a, self.total)
        self.names, at = EliasFano.read(raw, at, self.n - self.nulls, b, span)
        self.ids = np.frombuffer(raw, "<u4" if width == 4 else "<u2", self.total, at)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i - 1) if i else 0 : self.bounds.select(i)]

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [self.least + int(v) % (1 << 64) for v in self.names.all()]  # gaps of up to 64 bits

    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], self.bounds.all()])


class WordEncoder:
    """Texts to ids with the tokenizers library, which sees each blank-separated
    word once: its pre-tokenizer never joins characters across white space. Special
    tokens in a text, in their exact case, give their own ids, as the library does."""

    def __init__(self, path: str, max_words: int = 600_000):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        added = self.lib.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("only added tokens that stand for their exact characters are known here")
        self.special = {t.content: np.array([i], np.int32) for i, t in added.items()}
        self.part = re.compile(f"({'|'.join(map(re.escape, self.special))})") if added else None
        self.wide = self.lib.get_vocab_size() > 1 << 16
        self.cache = WordCache(self.words, max_words)

    def words(self, words: list[str], joined: int = 50) -> tuple[np.ndarray, np.ndarray]:
        """Encodes runs of words joined by a mark that no word holds and that is
        one token wherever it stands alone."""
        mark, mark_id = self._mark(words)
        runs = [f" {mark} ".join([*words[i : i + joined], ""]) for i in range(0, len(words), joined)]
        ids = np.concatenate([np.array(e.ids, np.int32) for e in self.lib.encode_batch_fast(runs, add_special_tokens=False)])
        marks = np.flatnonzero(ids == mark_id)
        if len(marks) != len(words):  # a character that normalises to the mark
            each = [e.ids for e in self.lib.encode_batch_fast(words, add_special_tokens=False)]
            return np.array([i for e in each for i in e], np.int32), np.array([len(e) for e in each], np.int64)
        return ids[ids != mark_id], np.diff(np.append(-1, marks)) - 1

    def _mark(self, words: list[str]) -> tuple[str, int]:
        held = set().union(*words)
        for c in map(chr, range(0x21, 0x3000)):
            if c not in held and not c.isalnum() and not c.isspace() and len(i := self.lib.encode(c, add_special_tokens=False).ids) == 1:
                return c, i[0]
        raise ValueError("these words leave no character to part them")

    def texts(self, texts: list[str], end: int) -> list[np.ndarray]:
        parts = {i: self.part.split(t) for i, t in enumerate(texts) if self.part and self.part.search(t)}
        out = self.cache.split_texts([self.plain(t) if i not in parts else "" for i, t in enumerate(texts)], 0, 1)
        if parts:  # text, special token, text and so on
            flat = iter(self.cache.split_texts([self.plain(t) for p in parts.values() for t in p[::2]]))
            for i, p in parts.items():
                ids = [self.special[t] if k % 2 else next(flat) for k, t in enumerate(p)]
                out[i] = np.concatenate([*ids, np.zeros(1, np.int32)])
        for ids in out:
            ids[-1] = end
        return out

    def plain(self, text: str) -> str:
        """plain(text), unless its lower case would make a special token."""
        low = plain(text)
        return text if self.part and low is not text and self.part.search(low) else low


#: Latin-1 bytes to classes: "." and "," D, other marks P, the rest (letters,
#: digits, white space) a.
_CLASS = bytes(
    ord("D" if c in ".," else "a" if c.isalnum() or c in "\t\n\x0b\x0c\r \x85\xa0" else "P") for c in map(chr, range(256))
)


def plain(text: str) -> str:
    """A text of the same ids with fewer different words: lower case (where no
    character composes with another one), and a blank before "." and "," that
    stand beside no other mark (the pre-tokenizer parts them from the word)."""
    try:
        classes = text.encode("latin-1").translate(_CLASS)
    except UnicodeEncodeError:
        return text
    text = text.lower()
    if b"DD" in classes or b"DP" in classes or b"PD" in classes:
        return text
    return text.replace(",", " ,").replace(".", " .")


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One encoder for the tasks that a Python worker runs in turn."""
    return WordEncoder(path)


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end: int = 2, segment_ids: int = 1 << 20) -> None:
    """Encode ``docs`` (doc_id, text) and write the segments to ``path``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, names, held, size, k = word_encoder(tokenizer), [], [], 0, 0
        part = None
        for pdf in batches:
            part = int(pdf["part"].iloc[0]) if part is None and len(pdf) else part
            texts = pdf["text"].fillna("").tolist()
            keys = [None if x is None else int(x) for x in pdf["doc_id"]]
            for a, b in slices(texts, 6_000_000):
                for key, ids in zip(keys[a:b], encoder.texts(texts[a:b], end), strict=True):
                    if held and size + len(ids) > segment_ids:
                        yield one(part, k, names, held, size, encoder.wide)
                        names, held, size, k = [], [], 0, k + 1
                    names.append(key)
                    held.append(ids)
                    size += len(ids)
        if held:
            yield one(part, k, names, held, size, encoder.wide)

    def one(part: int, k: int, names: list, held: list, size: int, wide: bool) -> pd.DataFrame:
        return pd.DataFrame({"part": [part], "segment": [k], "n_docs": [len(held)], "n_ids": [size], "payload": [pack(names, held, wide)]})

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "text")
        .select(F.spark_partition_id().alias("part"), id_text(), "text")
    )
    schema = "part int, segment int, n_docs long, n_ids long, payload binary"
    ordered.mapInPandas(run, schema).write.parquet(path)


def bases(spark: SparkSession, path: str) -> DataFrame:
    """(part, segment, base): the ids of all segments before each one.

    The running sum is taken within each part, and over the parts' totals
    (one row for each partition written, however large the corpus is)."""
    sizes = spark.read.schema("part int, segment int, n_ids long").parquet(path)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("parts_before"))
    inside = Window.partitionBy("part").orderBy("segment")
    return (
        sizes.withColumn("inside", F.sum("n_ids").over(inside) - F.col("n_ids"))
        .join(before, "part")
        .select("part", "segment", (F.col("parts_before") + F.col("inside")).alias("base"))
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Each document of the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part, segment, payload in zip(pdf["part"], pdf["segment"], pdf["payload"], strict=True):
                s = Segment(payload)
                off, ids = s.offsets(), s.ids.astype("<u4")
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                names = [None if x is None else str(x) for x in s.doc_ids()]
                yield pd.DataFrame(
                    {"part": part, "segment": segment, "doc_id": names, "inside": off[:-1], "n_tokens": np.diff(off), "ids_crc32": crc}
                )

    files = spark.read.schema("part int, segment int, payload binary").parquet(path)
    schema = "part int, segment int, doc_id string, inside long, n_tokens long, ids_crc32 long"
    docs = with_id(files.mapInPandas(run, schema))  # the ids stay in their tasks; only these numbers are joined
    start = (F.col("base") + F.col("inside")).alias("start")
    return docs.join(bases(spark, path), ["part", "segment"]).select("doc_id", start, "n_tokens", "ids_crc32")


def token_store(docs: DataFrame, tokenizer: str, path: str | None = None, end: int = 2) -> DataFrame:
    """Write ``docs`` to ``path`` (default: a new table in the shared folder)
    and read the files back."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, tokenizer, path, end)
    return read_tokens(spark, path)
