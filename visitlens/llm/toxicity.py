"""Toxicity by multiple-instance learning.

A document is a bag of sentences; only documents are labelled. A sentence's
score is logistic in its words and word beginnings (weights of 0 or more), a document's the noisy-or of its
sentences: 1 - prod(1 - p). Training ascends the likelihood of the document
labels, which gives the blame to the sentences that explain them; scoring
returns those sentences too.

Training reads at most ``max_docs`` labelled documents (those of the smallest
xxhash64(doc_id); that bound is a parameter of the model, fitted in one task: the
driver holds the weights only) and words that occur in ``min_docs`` of them or more;
a word is counted over whole texts. Scoring runs over all rows, whole texts, in tasks.

Null and empty texts have one empty sentence. Labels with null doc_id or label
are ignored. Without both labels the score is the share of label 1. Repeated
rows are scored row by row; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, importable, with_id

sentences_of = re.compile(r"[^.!?\n]+").findall
words_of = re.compile(r"[^\W\d_]+").findall

MAX_DOCS, MIN_DOCS, THRESHOLD = 4000, 6, 0.7
STEMS = (4, 6)


def features(text: str) -> set[str]:
    """Words of a lower-cased sentence and the beginnings of longer ones, which
    stand for inflected and compounded forms."""
    words = set(words_of(text))
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in STEMS))


@dataclass
class Model:
    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The noisy-or of a text and its sentences (start, end, p) of p >= 0.5."""
        keys, clean, found = self.weights.keys(), 0.0, []
        none = float(np.log1p(-_sigmoid(self.bias)))
        for m in re.finditer(r"[^.!?\n]+", text):
            hit = keys & features(m[0].lower())
            if not hit:
                clean += none
                continue
            p = min(_sigmoid(self.bias + sum(map(self.weights.__getitem__, hit))), 1 - 1e-12)
            clean += float(np.log1p(-p))
            if p >= 0.5:
                found.append((m.start(), m.end(), p))
        return (-float(np.expm1(clean)) if clean else _sigmoid(self.bias)), found


def _sigmoid(z: float) -> float:
    return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def train(texts: list[str], labels: list[int], min_docs: int = MIN_DOCS, epochs: int = 100, rate: float = 1.0, l2: float = 1e-4, toxic_weight: float = 1.4) -> Model:
    """Adagrad ascent of the noisy-or likelihood over whole documents, in which
    a toxic one counts ``toxic_weight`` times."""
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return Model(bias=float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    seen = Counter()
    for t in texts:
        seen.update(set().union(*(features(s.lower()) for s in sentences_of(t))))
    vocab = {w: i for i, w in enumerate(sorted(w for w, n in seen.items() if n >= min_docs))}
    del seen
    word, size, doc = array("i"), array("i"), array("i")
    for d, t in enumerate(texts):
        for sentence in sentences_of(t) or [""]:
            ids = [vocab[w] for w in features(sentence.lower()) if w in vocab]
            word.extend(ids)
            size.append(len(ids))
            doc.append(d)
    s = len(doc)
    word, doc = np.array(word, np.int64), np.array(doc, np.int64)
    sent = np.repeat(np.arange(s), size)
    counts = np.bincount(doc, minlength=len(y))
    w, b = np.zeros(len(vocab)), -np.log(np.maximum(counts.mean(), 1.0)) - 2.0
    gw, gb = np.full(len(vocab), 1e-6), 1e-6
    for _ in range(epochs):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(sent, w[word], s), -30, 30)))
        p = np.minimum(p, 1 - 1e-9)
        whole = np.maximum(-np.expm1(np.bincount(doc, np.log1p(-p), len(y))), 1e-9)
        # of the log likelihood by a sentence's logit: p (1 - P) / P if toxic, else -p
        slope = np.where(y[doc] == 1, toxic_weight * p * (1 - whole[doc]) / whole[doc], -p) / len(y)
        dw = np.bincount(word, slope[sent], len(vocab)) - l2 * w / len(y)
        db = slope.sum()
        gw, gb = gw + dw * dw, gb + db * db
        # harm adds up: no word of a sentence takes back what another one says
        w, b = np.maximum(w + rate * dw / np.sqrt(gw), 0), b + rate * db / np.sqrt(gb)
    return Model(float(b), {v: float(w[i]) for v, i in vocab.items() if abs(w[i]) > 0.05})


def held_out() -> object:
    """Rows whose labels are never read: crc32(doc_id as text) mod 3 is 1."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Model:
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out()).select("doc_id", "toxic")
    chosen = known.orderBy(F.xxhash64("doc_id"), "toxic").limit(max_docs)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").limit(2 * max_docs)  # one partition

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple] = set()
        for pdf in batches:
            seen.update(zip(*(pdf[c].tolist() for c in ("doc_id", "toxic")), pdf["text"].fillna("").tolist(), strict=True))
        used = sorted((d, text, toxic) for d, toxic, text in seen)
        model = train([x[1] for x in used], [int(x[2]) for x in used])
        yield pd.DataFrame({"word": [None, *model.weights], "weight": [model.bias, *model.weights.values()]})

    importable(docs.sparkSession)
    found = rows.mapInPandas(run, "word string, weight double").collect()
    weights = {r["word"]: r["weight"] for r in found} or {None: train([], []).bias}  # no task for no rows
    return Model(weights.pop(None), weights)


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted, spans (start, end, score of the sentences that
    offend, in characters) for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the words of max_docs texts

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for pdf in batches:
            out = [own.score(t) for t in pdf["text"].fillna("")]
            score = [x[0] for x in out]
            spans = [[{"start": a, "end": b, "score": p} for a, b, p in x[1]] for x in out]
            yield pd.DataFrame(
                {"doc_id": pdf["doc_id"], "score": score, "predicted": [int(x >= threshold) for x in score], "spans": spans}
            )

    schema = "doc_id string, score double, predicted int, spans array<struct<start:int,end:int,score:double>>"
    return with_id(docs.select(id_text(), "text").mapInPandas(run, schema))


def clean_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def passes(texts: pd.Series) -> pd.Series:
        own = shared.value
        return pd.Series([own.score(t)[0] < threshold for t in texts.fillna("")], dtype=bool)

    return docs.where(passes("text"))  # the other columns stay where they are
