"""SentencePiece BPE by vectorised merge rounds.

A text is cut into words that no vocabulary piece spans. The words that a
batch shows for the first time become one flat numpy array of symbols. Each
round finds, per word, the best-ranked pair of neighbours (a segmented
minimum), merges its occurrences from the left and compacts the array; words
without a mergeable pair leave it. The result equals the library's, which
merges one best pair after another:

* only pairs of one score are merged in a round, the leftmost of overlapping
  ones first;
* where the merged piece could take part in a pair of the same or a better
  score, only the leftmost occurrence is merged in that round.

Characters outside the vocabulary become UTF-8 byte pieces. Null text counts
as empty (begin and end id only). Repeated rows are encoded row by row; other
input columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import id_text, with_id
from .word_cache import WordCache

SPACE = "▁"
FAR = np.iinfo(np.int64).max
SHIFT = 21


class PieceEncoder:
    """Encoder over the vocabulary of a SentencePiece BPE model file.

    ``max_words``: bound of the word cache; beyond it the cache starts anew.
    """

    def __init__(self, model_file: str, max_words: int = 250_000):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        sp = self.lib
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        piece = {sp.id_to_piece(i): i for i in normal}
        if any(SPACE in p.lstrip(SPACE) for p in piece):
            raise ValueError("pieces span words: this vocabulary cannot be encoded word by word")
        if any(c not in piece for p in piece for c in p):
            raise ValueError("a piece holds a character that is no piece")
        self.byte0 = sp.piece_to_id("<0x00>")
        if not sp.is_byte(self.byte0):
            raise ValueError("the model has no byte pieces")
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        scores = {i: sp.get_score(i) for i in normal}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        rank = np.full(n, len(order), np.int64)
        for i, s in scores.items():
            rank[i] = order[s]
        pairs, bigrams = {}, set()
        for p, i in piece.items():
            bigrams.update(zip(p, p[1:], strict=False))
            for k in range(1, len(p)):
                a, b = piece.get(p[:k]), piece.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << SHIFT | b] = i
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.rank = rank[self.made]
        self.unsafe = np.zeros(n, bool)
        for part in (self.keys >> SHIFT, self.keys & ((1 << SHIFT) - 1)):
            self.unsafe[part[self.rank <= rank[part]]] = True
        self.bigrams = np.array(sorted(ord(a) << SHIFT | ord(b) for a, b in bigrams), np.int64)
        self.char = np.full(0x110000, -1, np.int64)
        for p, i in piece.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        apart = "\n" if not any("\n" in p for p in piece) else ""
        self.tokens = re.compile(f" *[^ {apart}]+| +" + (f"|{apart}" if apart else "")).findall
        self.cache = WordCache(self.words, max_words)

    def _found(self, table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, key), len(table) - 1)
        return at, table[at] == key

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and the number of each."""
        code = np.frombuffer("".join(words).replace(" ", SPACE).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        n = np.array([len(w) for w in words], np.int64)
        owner = np.repeat(np.arange(len(words)), n)
        sym = self.char[code]
        known = sym >= 0
        if len(self.bigrams):
            joined = self._found(self.bigrams, code[:-1] << SHIFT | code[1:])[1]
        else:
            joined = np.zeros(max(len(code) - 1, 0), bool)
        joined &= (owner[1:] == owner[:-1]) & known[1:] & known[:-1]
        seg = np.concatenate([[0], np.cumsum(~joined)]) if len(code) else np.zeros(0, np.int64)
        at = np.arange(len(code))
        out = np.where(known, sym, -1 - code)
        alive = np.ones(len(code), bool)  # by first character: is still a symbol's start
        while len(sym) > 1:
            pos, ok = self._found(self.keys, sym[:-1] << SHIFT | sym[1:])
            ok &= seg[:-1] == seg[1:]
            rank = np.append(np.where(ok, self.rank[pos], FAR), FAR)
            starts = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
            best = np.minimum.reduceat(rank, starts)
            inside = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(seg))))
            lowest = best[inside]
            pick = np.flatnonzero((rank == lowest) & (lowest < FAR))
            if not len(pick):
                break
            run = np.append(True, np.diff(pick) > 1)  # overlapping ones: every other, from the left
            first = pick[run][np.cumsum(run) - 1]
            pick = pick[(pick - first) % 2 == 0]
            made = self.made[pos[pick]]
            risky = np.zeros(len(starts), bool)
            risky[inside[pick[self.unsafe[made]]]] = True
            leads = np.append(True, inside[pick[1:]] != inside[pick[:-1]])
            keep = leads | ~risky[inside[pick]]
            pick, made = pick[keep], made[keep]
            sym[pick] = made
            out[at[pick]] = made
            alive[at[pick + 1]] = False
            stay = lowest < FAR
            stay[pick + 1] = False
            sym, seg, at = sym[stay], seg[stay], at[stay]
        ids, owner = out[alive], owner[alive]
        counts = np.ones(len(ids), np.int64)
        strange = np.flatnonzero(ids < 0)
        if len(strange):
            raw = [chr(-1 - c).encode("utf-8", "surrogatepass") for c in ids[strange].tolist()]
            counts[strange] = [len(b) for b in raw]
            start = np.cumsum(counts) - counts
            full = np.repeat(ids, counts)
            for s, b in zip(start[strange].tolist(), raw, strict=True):
                full[s : s + len(b)] = np.frombuffer(b, np.uint8) + self.byte0
            ids, owner = full, np.repeat(owner, counts)
        return ids.astype(np.int32), np.bincount(owner, minlength=len(words)).astype(np.int64)

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text with begin and end id."""
        cut = [self.tokens(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        out = self.cache.texts(cut, 1, 1)
        for ids in out:
            ids[0], ids[-1] = self.begin, self.end
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.lib.decode(ids.tolist())


@lru_cache(maxsize=1)
def piece_encoder(model_file: str) -> PieceEncoder:
    """One encoder for the tasks that a Python worker runs in turn."""
    return PieceEncoder(model_file)


def slices(texts: list[str], most: int = 500_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters (one text at least)."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encoded(docs: DataFrame, model_file: str, with_ids: bool = True) -> DataFrame:
    """doc_id, ids (array<int>, if asked for), n_tokens, ids_sha256,
    decoded_sha256 for each row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = piece_encoder(model_file)
        for pdf in batches:
            texts = pdf["text"].fillna("").tolist()
            for a, b in slices(texts):
                rows = []
                for ids in encoder.texts(texts[a:b]):
                    row = [ids] if with_ids else []
                    row += [len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest()]
                    rows.append([*row, hashlib.sha256(encoder.decode(ids).encode("utf-8")).hexdigest()])
                names = ["ids"] * with_ids + ["n_tokens", "ids_sha256", "decoded_sha256"]
                out = pd.DataFrame(rows, columns=names)
                out.insert(0, "doc_id", pdf["doc_id"].iloc[a:b].array)
                yield out

    ids = "ids array<int>, " if with_ids else ""
    schema = f"doc_id string, {ids}n_tokens long, ids_sha256 string, decoded_sha256 string"
    return with_id(docs.select(id_text(), "text").mapInPandas(run, schema))
