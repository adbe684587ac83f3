"""Quality of a page's own text, learned from labelled documents.

A document is described by counts that need no word list (length, different
words, the most frequent word's share, letters, digits, capitals, word length,
sentence marks, other marks, compressed size). A logistic model in their
standard scores and squares is fitted to the quality labels and scores the text
of a page: its html without tags, comments, scripts, styles, head and navigation.

Training reads at most ``max_docs`` labelled documents (those of the smallest
xxhash64(doc_id); that bound is a parameter of the model, fitted on the driver).
Scoring runs over all pages in tasks. Labels with null doc_id or quality and
null texts are ignored; where one label alone is given, it is the outcome of all
pages; without labels, and for null html, the outcome is null.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_DOCS = 4000
_HIDDEN = re.compile(r"(?is)<(script|style|head|nav)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)")
_TAG = re.compile(r"<[^<>]*+>")


class Model(NamedTuple):
    weights: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        return _sigmoid(_expanded(described(texts), self.mean, self.deviation) @ self.weights)


def page_text(html: str) -> str:
    return unescape(_TAG.sub(" ", _HIDDEN.sub(" ", html)))


def described(texts: list[str]) -> np.ndarray:
    out = []
    for t in texts:
        words, raw = t.split(), t.encode("utf-8", "surrogatepass")
        n, c, found = max(1, len(words)), max(1, len(t)), Counter(words)
        letters, digits = sum(map(str.isalpha, t)), sum(map(str.isdigit, t))
        out.append(
            (
                np.log(n), len(found) / n, max(found.values(), default=0) / n, letters / c, digits / c, sum(map(str.isupper, t)) / c,
                sum(map(len, words)) / n, sum(map(t.count, ".,!?")) / c, 1 - (letters + digits + sum(map(str.isspace, t))) / c,
                len(zlib.compress(raw, 1)) / max(1, len(raw)),
            )
        )
    return np.array(out).reshape(len(texts), 10)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _expanded(rows: np.ndarray, mean: np.ndarray, deviation: np.ndarray) -> np.ndarray:
    z = np.clip((rows - mean) / deviation, -4, 4)
    return np.hstack([np.ones((len(z), 1)), z, z * z])


def train(rows: np.ndarray, y: np.ndarray) -> Model | None:
    """Newton steps on the ridge-penalised likelihood."""
    if not len(rows):
        return None
    mean, deviation = rows.mean(0), rows.std(0) + 1e-9
    x = _expanded(rows, mean, deviation)
    w = np.zeros(x.shape[1])
    if y.min() == y.max():
        w[0] = 40 if y[0] else -40
        return Model(w, mean, deviation)
    for _ in range(30):
        p = _sigmoid(x @ w)
        w += np.linalg.solve((x.T * (p * (1 - p))) @ x + np.eye(len(w)), x.T @ (y - p) - w)
    return Model(w, mean, deviation)


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Model | None:
    known = labels.where("doc_id is not null and quality is not null").select("doc_id", F.col("quality").cast("double").alias("good"))
    texts = docs.where("text is not null")
    ids = texts.select("doc_id").join(known.select("doc_id"), "doc_id").distinct()
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [] if pdf.empty else described(pdf["text"].tolist()).tolist()
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "row": rows})

    few = texts.join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described_rows = few.mapInPandas(run, "doc_id long, row array<double>")  # the texts stay in their tasks
    found = described_rows.join(F.broadcast(known.join(F.broadcast(chosen), "doc_id")), "doc_id")
    rows = found.orderBy(F.xxhash64("doc_id"), "doc_id", "row", "good").limit(max_docs).collect()
    return train(np.array([r["row"] for r in rows]), np.array([r["good"] for r in rows], float))


def outcomes(pages: DataFrame, model: Model | None) -> DataFrame:
    """page_id, url, good (1 where a good text is the likelier, else 0) by row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            known = pdf["html"].notna().to_numpy()
            good = np.full(len(pdf), np.nan)
            if model is not None and known.any():
                good[known] = model.scores([page_text(h) for h in pdf["html"][known]]) >= 0.5
            yield pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"], "good": pd.array(good).astype("Int64")})

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInPandas(run, "page_id long, url string, good int")
