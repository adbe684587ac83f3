"""Spelling variants: words of a vocabulary that differ by one code point.

Words are the maximal runs of letters of the texts, counted with a partial
aggregation on the map side; those that occur too seldom or are too short go.

Two words at one edit share a half: with ``a`` code points in the shorter one,
either its first a // 2 or its last a - a // 2 stand in both. So each word is
dealt out by its first and by its last half, for the two lengths that the shorter
one may have, keys without a shorter word or of a single one are dropped, and the
keys are hashed into bins. In a bin, an FM-index of the delimited words
``#w1#w2#...`` and one of the text read backwards form the bidirectional index
(``Index``). The shorter words of the keys are searched in two schemes: the first
half matched exactly, symbol by symbol on the right, then the rest with one error
and the delimiter; and the last half exactly on the left, then the rest with one
error. The error is a symbol put in or another one; a symbol left out is found
from the other word. All words of a bin are searched side by side as arrays of
suffix-rank intervals. Of a scheme's two parts only the later one may hold the
error, so each runs in one direction, over the index that extends there.

A key with more than ``HOT_CHARS`` code points of words is not put into one bin:
the part that its words don't share is halved again, and each of its words is
dealt out by the longer halves, until the keys are small or what differs is one
code point of an alphabet of 90 (``keyed``). So a third of all words may begin
alike; no link is lost, and no word is compared with all of its group.

Null and empty texts have no words; a null doc_id counts as an empty one in what
``altered_runs`` hashes. Repeated rows count each. Other columns are not read. An
empty table gives no rows. Of equally frequent near words the first one in
code-point order is the form.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, saved

LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS = 7
BIN_CHARS = 200_000  # code points of a bin, in the mean
HOT_CHARS = 500_000  # of a key that is dealt out further
ASKED = 4096  # words of a bin that are searched side by side


def altered_runs(docs: DataFrame, every: int = 31, least: int = MIN_CHARS) -> DataFrame:
    """word: a row for each run of at least ``least`` letters, A-Z lowered; of
    those whose hash with the doc_id ``every`` divides, one code point is gone."""
    run = F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0)))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), run.alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("_id", F.lit(":"), "run")))
    gone = "concat(left(run, CAST(h % length(run) AS INT)), substring(run, CAST(h % length(run) AS INT) + 2))"
    return rows.selectExpr(f"CASE WHEN h % {int(every)} = 0 THEN {gone} ELSE run END AS word")


def vocabulary(words: DataFrame, least: int = MIN_CHARS, occurrences: int = 2) -> DataFrame:
    """word, n."""
    counted = words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= occurrences)


def _key() -> str:
    return "concat_ws(':', a, l, r, left(word, l), right(word, r)) AS key"


def keyed(words: DataFrame, hot_chars: int = HOT_CHARS) -> DataFrame:
    """key, ahead, asks, word, n: words that share a key, of two at least;
    ``ahead`` tells whether the key is their beginning (its search goes ahead),
    ``asks`` whether the word is of the key's shorter length."""
    ends = "inline(array(struct(true AS ahead, a div 2 AS l, 0 AS r), struct(false AS ahead, 0 AS l, a - a div 2 AS r)))"
    rows = words.selectExpr("word", "n", "inline(array(struct(length(word) AS a), struct(length(word) - 1 AS a)))")
    rows = rows.selectExpr("*", ends).selectExpr("*", _key())
    done = []
    while True:
        sizes = rows.groupBy("key").agg(
            F.count("*").alias("words"), F.sum(F.length("word")).alias("chars"), F.bool_or(F.expr("length(word) = a")).alias("any_asks")
        ).where("words > 1 AND any_asks").drop("any_asks")
        rows = saved(rows.join(sizes, "key"))
        hot = rows.where((F.col("chars") > hot_chars) & (F.col("words") > 2) & F.expr("a - l - r > 1"))
        done.append(rows.where((F.col("chars") <= hot_chars) | (F.col("words") <= 2) | F.expr("a - l - r <= 1")))
        if hot.isEmpty():
            break
        gap = "(a - l - r)"
        halves = f"inline(array(struct(l + {gap} div 2 AS l, r), struct(l, r + {gap} - {gap} div 2 AS r)))"
        rows = hot.selectExpr("word", "n", "a", "ahead", halves).selectExpr("*", _key())
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.selectExpr("key", "ahead", "length(word) = a AS asks", "word", "n")


def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """The suffix array of ``text``, by doubling; its last symbol is the only 0."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.cumsum(np.concatenate(([0], text[order][1:] != text[order][:-1])))
    at = np.empty(n, np.int64)
    at[order] = rank
    k = 1
    while at[order[-1]] < n - 1 and k < n:
        second = np.zeros(n, np.int64)
        second[: n - k] = at[k:] + 1
        both = at * (n + 1) + second
        order = np.argsort(both, kind="stable")
        at[order] = np.cumsum(np.concatenate(([0], both[order][1:] != both[order][:-1])))
        k *= 2
    return order


class Index:
    """An FM-index of delimited words: ``rows`` is sorted by (symbol, row) over
    the Burrows-Wheeler transform, so that the place of (c, i) in it is where the
    rows below i that have c before them end after one more symbol."""

    def __init__(self, words: list[np.ndarray]):
        self.size = sum(map(len, words)) + len(words) + 2
        text = np.ones(self.size, np.int64)  # 1 delimits
        start = np.cumsum([1] + [len(w) + 1 for w in words])
        for s, w in zip(start, words, strict=False):
            text[s : s + len(w)] = w
        text[-1] = 0
        order = suffix_ranks(text)
        self.before = text[order - 1]
        self.rows = np.sort(self.before * self.size + np.arange(self.size))
        self.letters = np.unique(text[text > 1])
        # suffixes that begin with a delimiter and a word: the word's number
        of = np.full(self.size, -1)
        of[start[:-1] - 1] = np.arange(len(words))
        self.word = of[order]

    def step(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals with symbol ``c`` in front."""
        return np.searchsorted(self.rows, c * self.size + lo), np.searchsorted(self.rows, c * self.size + hi)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """(interval's number, symbol, its interval) of the letters that stand in
        front. Equal intervals are looked up once: the rows of a small one, all
        letters for a large one."""
        pair, of = np.unique(lo * (self.size + 1) + hi, return_inverse=True)
        lo, hi = pair // (self.size + 1), pair % (self.size + 1)
        many = hi - lo
        small, large = np.flatnonzero(many <= len(self.letters)), np.flatnonzero(many > len(self.letters))
        sizes = many[small]
        row = np.arange(sizes.sum()) + np.repeat(lo[small] - np.cumsum(sizes) + sizes, sizes)
        each = np.concatenate((np.repeat(small, sizes) << 32 | self.before[row], np.repeat(large, len(self.letters)) << 32 | np.tile(self.letters, len(large))))
        each = np.unique(each)
        own, c = each >> 32, each & 0xFFFFFFFF
        lo, hi = self.step(c, lo[own], hi[own])
        there = (c > 1) & (lo < hi)
        own, c, lo, hi = own[there], c[there], lo[there], hi[there]
        # from the distinct intervals back to all
        first, last = np.searchsorted(own, np.arange(len(pair))), np.searchsorted(own, np.arange(len(pair)), "right")
        sizes = (last - first)[of]
        at = np.arange(sizes.sum()) + np.repeat(first[of] - np.cumsum(sizes) + sizes, sizes)
        return np.repeat(np.arange(len(of)), sizes), c[at], lo[at], hi[at]


def _fewer(index: Index, flat_at: np.ndarray, state: tuple) -> tuple:
    """States of the same word, place, interval and error, kept once."""
    lo, err = state[2], state[4]
    _, kept = np.unique((flat_at * index.size + lo) * 2 + err, return_index=True)
    return tuple(x[kept] for x in state)


def one_error(index: Index, words: list[np.ndarray], asked: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(asked word, found word): words of the index that have one more symbol than
    an asked one, or one other, after its last ``exact`` symbols (which the index
    reads first)."""
    # symbols in reading order, from the word's end; 1 delimits
    lens = np.array([len(words[q]) for q in asked])
    flat = np.concatenate([np.append(words[q][::-1], 1) for q in asked])
    base = np.cumsum(lens + 1) - (lens + 1)
    # all start behind a delimiter
    lo, hi = index.step(np.ones(len(asked), np.int64), np.zeros(len(asked), np.int64), np.full(len(asked), index.size))
    for k in range(int(exact.max(initial=0))):
        on = np.flatnonzero((exact > k) & (hi - lo > 1))  # an interval of one is the word itself
        lo[on], hi[on] = index.step(flat[base[on] + k], lo[on], hi[on])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # states: asked word, its symbols read, interval, error made
    keep = np.flatnonzero(hi - lo > 1)
    q, pos, lo, hi, err = keep, exact[keep].astype(np.int64), lo[keep], hi[keep], np.zeros(len(keep), bool)
    while len(q):
        c = flat[base[q] + pos]
        end = pos == lens[q]
        nlo, nhi = index.step(c, lo, hi)
        hit = end & err & (nlo < nhi)
        found.append((asked[q[hit]], index.word[nlo[hit]]))
        on = ~end & (nlo < nhi) & (err | (nhi - nlo > 1))
        states = [(q[on], pos[on] + 1, nlo[on], nhi[on], err[on])]  # the same symbol
        free = np.flatnonzero(~err)
        of, letter, blo, bhi = index.branches(lo[free], hi[free])
        of = free[of]
        put = np.ones(len(of), bool)
        states.append((q[of], pos[of], blo, bhi, put))  # one put in
        other = ~end[of] & (letter != c[of])
        states.append((q[of][other], pos[of][other] + 1, blo[other], bhi[other], put[other]))  # another one
        q, pos, lo, hi, err = (np.concatenate(x) for x in zip(*states, strict=True))
        if len(q) > 4 * len(keep):  # repeated symbols lead to the same words
            q, pos, lo, hi, err = _fewer(index, base[q] + pos, (q, pos, lo, hi, err))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2
    pair = np.unique(a * np.int64(len(words)) + b)
    return pair // len(words), pair % len(words)


def near_in(words: list[str], ahead: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of numbers of distinct ``words`` at one edit: those marked ``ahead``
    are searched from their beginnings, those marked ``behind`` from their ends,
    among words of the same length and longer ones. A pair of unlike lengths
    comes both ways, one of the same length from either word that is marked."""
    codes = [np.frombuffer(w.encode("utf-32-le"), np.uint32).astype(np.int64) + 2 for w in words]
    lens = np.array([len(c) for c in codes])
    out = [(np.zeros(0, int), np.zeros(0, int))]
    # an FM-index puts symbols in front: the backwards text serves searches ahead
    for mark, turned, exact in ((ahead, True, lens // 2), (behind, False, lens - lens // 2)):
        asked = np.flatnonzero(mark)
        if len(asked):
            texts = [c[::-1] for c in codes] if turned else codes
            index = Index(texts)
            for block in np.array_split(asked, -(-len(asked) // ASKED)):
                out.append(one_error(index, texts, block, exact[block]))
    a, b = (np.concatenate(x) for x in zip(*out, strict=True))
    longer = lens[a] != lens[b]
    return np.concatenate((a, b[longer])), np.concatenate((b, a[longer]))


def _near_of_bin(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.assign(ahead=rows["ahead"] & rows["asks"], behind=~rows["ahead"] & rows["asks"])
    own = rows.groupby("word", sort=False).agg(n=("n", "first"), ahead=("ahead", "max"), behind=("behind", "max")).reset_index()
    a, b = near_in(own["word"].tolist(), own["ahead"].to_numpy(bool), own["behind"].to_numpy(bool))
    word, n = own["word"].to_numpy(object), own["n"].to_numpy(np.int64)
    return pd.DataFrame({"word": word[a], "near": word[b], "near_n": n[b]})


def near_words(words: DataFrame, bin_chars: int = BIN_CHARS, hot_chars: int = HOT_CHARS) -> DataFrame:
    """word, near, near_n: each pair of ``words`` (word, n) at one edit, both ways."""
    rows = keyed(words, hot_chars)
    chars = rows.agg(F.sum(F.length("word"))).first()[0] or 0
    bins = 1 + chars // bin_chars
    dealt = rows.withColumn("bin", F.pmod(F.xxhash64("key"), F.lit(bins)))
    pairs = dealt.groupBy("bin").applyInPandas(lambda pdf: _near_of_bin(pdf), "word string, near string, near_n long")
    return pairs.groupBy("word", "near").agg(F.max("near_n").alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of words with a form: a jump doubles in each round."""
    at = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("_word"), F.col("root").alias("_on"))
        new = saved(at.join(on, at["root"] == on["_word"], "left").select("word", "root", "_on"))
        if new.where("_on is not null").isEmpty():
            return at
        at = new.select("word", F.coalesce("_on", "root").alias("root"))


def spelling_variants(words: DataFrame, times: int = 10, bin_chars: int = BIN_CHARS, hot_chars: int = HOT_CHARS) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary (word, n): the form is
    the most frequent near word, if it is ``times`` as frequent."""
    pairs = near_words(words, bin_chars, hot_chars)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    by_word = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = words.join(by_word, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0L) AS n_near",
        f"CASE WHEN -best.less >= {int(times)} * n THEN best.near END AS form", f"CASE WHEN -best.less >= {int(times)} * n THEN -best.less END AS form_n",
    )
    rows = saved(rows)
    found = rows.join(roots(rows.where("form is not null")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
