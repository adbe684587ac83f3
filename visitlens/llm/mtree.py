"""Exact top-k by inner product through M-trees, best node first.

Vectors become integers floor(scale * x). An inner product is no metric, but
|q - x|^2 = |q|^2 + |x|^2 - 2 q.x: with one more coordinate sqrt(R^2 - |x|^2)
on each stored vector (R: the largest norm of the tree) and 0 on the query, all
stored vectors have norm R, and the largest inner product is the least distance.

Rows are dealt into blocks by a hash of their id, of about ``block_rows`` each.
A block's vectors form one M-tree of paged nodes: each entry has its pivot,
covering radius and distance to the parent's pivot. A query keeps a heap of
nodes by their least possible distance and stops when it exceeds the k-th best.
Before an entry's distance is computed, |d(q, parent) - d(parent, entry)| minus
its radius, from stored numbers, may exclude it. Bounds are floating-point with
a margin; scores are exact 64-bit integers, ties go to the smaller id.

The query set (ids divisible by ``every``) meets each block in blocks of
``query_rows``; k rows for each query and block are shuffled, then the best k
taken. Vectors that are null or hold null or non-finite components take no part,
nor do rows without an id. Shorter vectors count as filled up with zeros.
Scores must fit 64 bits.
Candidates are all rows of other ids; rows that repeat an id are candidates each.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

PAGE = 256  # most entries of a node


class Node:
    """A page: entries' pivots (rows of the tree's vectors), distances to the
    page's own pivot, and for inner pages radii and child pages."""

    __slots__ = ("children", "radius", "rows", "to_parent")

    def __init__(self, rows: np.ndarray, to_parent: np.ndarray, radius: np.ndarray | None = None, children: list | None = None):
        self.rows, self.to_parent, self.radius, self.children = rows, to_parent, radius, children


class MTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x, self.page = ids[order], vectors[order].astype(np.int64), page
        x = self.x.astype(float)
        self.norm2 = (x * x).sum(1)
        self.r2 = float(self.norm2.max(initial=0.0))
        self.p = np.hstack([x, np.sqrt(np.maximum(self.r2 - self.norm2, 0))[:, None]])
        # below that (2^40 a product, sums of up to 4,096) floating point is exact
        self.wide = float(np.abs(self.x).max(initial=0)) >= 1 << 20 or self.x.shape[1] > 4096
        self.slack = 1e-6 * (1 + np.sqrt(self.r2))
        self.computed = 0
        self.root = self._build(np.arange(len(ids)), 0) if len(ids) else None

    def _far(self, rows: np.ndarray, pivot: int) -> np.ndarray:
        d = self.p[rows] - self.p[pivot]
        return np.sqrt((d * d).sum(1))

    def _build(self, rows: np.ndarray, pivot: int) -> Node:
        """Bulk load: spread pivots, each row to its nearest, pages below."""
        if len(rows) <= self.page:
            return Node(rows, self._far(rows, pivot))
        wanted = min(self.page, -(-len(rows) // self.page) + 1)
        pivots, near = [], np.full(len(rows), np.inf)
        owner = np.zeros(len(rows), np.int64)
        nxt = int(np.argmax(self._far(rows, pivot)))
        for k in range(wanted):
            d = self._far(rows, rows[nxt])
            closer = d < near
            near[closer], owner[closer] = d[closer], k
            pivots.append(rows[nxt])
            nxt = int(np.argmax(near))
            if near[nxt] == 0:
                break
        if len(pivots) == 1:  # equal vectors: plain pages of them
            owner = np.arange(len(rows)) * wanted // len(rows)
            pivots = [rows[0]] * wanted
        kept, radius, children = [], [], []
        for k, pv in enumerate(pivots):
            own = rows[owner == k]
            if len(own):
                kept.append(pv)
                radius.append(float(self._far(own, pv).max()))
                children.append(self._build(own, pv))
        kept = np.array(kept)
        return Node(kept, self._far(kept, pivot), np.array(radius), children)

    def top(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The best k (score, id), best first, without rows of the query's id."""
        if self.root is None:
            return []
        width = max(len(query), self.x.shape[1])
        q = np.zeros(width, np.int64)
        q[: len(query)] = query
        q = q[: self.x.shape[1]]  # what lies beyond meets zeros
        at = np.append(q.astype(float), 0.0)
        q2 = float((at * at).sum())
        best: list[tuple[int, int]] = []  # a heap of (score, -id)
        heap, n = [(0.0, 0, self.root, None)], 0
        limit = np.inf
        while heap and heap[0][0] <= limit:
            _, _, node, to_pivot = heapq.heappop(heap)
            rows, radius = node.rows, node.radius if node.radius is not None else 0.0
            if to_pivot is not None and np.isfinite(limit):  # stored distances first
                open_ = np.abs(to_pivot - node.to_parent) - radius <= limit
                if not open_.all():
                    rows = rows[open_]
                    radius = radius[open_] if node.radius is not None else 0.0
            else:
                open_ = None
            self.computed += len(rows)
            if node.radius is None:
                scores = self.x[rows] @ q if self.wide else self.p[rows, :-1] @ at[:-1]
                ids = self.ids[rows]
                fair = ids != query_id
                if len(best) == k:
                    fair &= scores >= best[0][0]
                elif fair.sum() > k:
                    fair &= scores >= np.partition(scores[fair], -k)[-k]
                for s, i in zip(scores[fair].astype(np.int64).tolist(), ids[fair].tolist(), strict=True):
                    if len(best) < k:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heappushpop(best, (s, -i))
                if len(best) == k:
                    limit = np.sqrt(max(q2 + self.r2 - 2.0 * best[0][0], 0.0)) + self.slack + 1e-9 * np.sqrt(q2)
                continue
            d = self.p[rows] - at
            far = np.sqrt((d * d).sum(1))
            least = far - radius
            children = node.children if open_ is None else [c for c, o in zip(node.children, open_, strict=True) if o]
            for j in np.flatnonzero(least <= limit).tolist():
                n += 1
                heapq.heappush(heap, (float(least[j]), n, children[j], float(far[j])))
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def integers(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v array<long>) of the rows that take part."""
    x = F.col("embedding")
    whole = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    return vectors.where("vec_id is not null").where(whole).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def _matrix(rows: pd.Series) -> np.ndarray:
    width = max((len(r) for r in rows), default=0)
    if rows.map(len).eq(width).all():
        return np.array(rows.tolist(), np.int64).reshape(len(rows), width)
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, block_rows: int = 8192, query_rows: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score: the best k of each query."""
    rows = saved(integers(vectors, scale))
    n = rows.count()
    blocks, rounds = max(1, -(-n // block_rows)), max(1, -(-n // every // query_rows))
    seed = F.xxhash64("vec_id", "v")
    dealt = rows.select(F.pmod(seed, F.lit(blocks)).cast("int").alias("block"), "vec_id", "v")
    stored = dealt.select("block", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round"), F.lit(False).alias("asks"), "vec_id", "v")
    asked = rows.where(F.col("vec_id") % every == 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(rounds)).cast("int").alias("round"), F.lit(True).alias("asks"), "vec_id", "v",
    )

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        own, ask = pdf[~pdf["asks"]], pdf[pdf["asks"]]
        tree = MTree(own["vec_id"].to_numpy(np.int64), _matrix(own["v"]))
        found = [
            (q, p, s, i)
            for p, (q, v) in enumerate(zip(ask["vec_id"].tolist(), ask["v"], strict=True))
            for s, i in tree.top(q, np.asarray(v, np.int64), k)
        ]
        return pd.DataFrame([(q, i, s) for q, _, s, i in found], columns=["query_id", "vec_id", "score"])

    near = stored.union(asked).groupBy("block", "round").applyInPandas(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
