"""Nearest neighbours by a hierarchical k-means tree, best bin first.

Nearness is the inner product. With one more coordinate sqrt(R^2 - |x|^2) on each
stored vector (R: the largest norm) and 0 on the query, the largest inner product
is the least distance, and k-means works on distances.

``fit``: the tree is fitted on a sample, the ``SAMPLE_VALUES`` / width (at most
``SAMPLE_ROWS``) rows of least hash: a node's rows are split into up to ``BRANCH``
clusters until a leaf stands for about ``leaf_rows`` rows of the table, at most
``MOST_LEAVES`` leaves in all. That bounds what the driver holds and each task
gets. Every row of the table then goes down to its leaf. Leaves next to each other
in the tree are packed into pages of about ``page_rows`` rows; a larger leaf is
dealt into several pages by a hash, so equal vectors may be a third of all rows.

Search: a priority queue holds nodes by their centroids' distances; the best one
is taken, a leaf is visited, an inner node puts its children in. How many leaves
are visited is calibrated: of ``CALIBRATION`` queries the exact neighbours are
found in one pass over all rows, and the visits widen until the share of those
that lie in visited leaves reaches ``recall``. A query goes once to each page that
holds leaves it visits, with their numbers. Pages and queries meet sorted by page:
a task holds one page and streams its queries past it, each over the rows of its
leaves. The best k of each query and page are shuffled once more and the best k
taken. Leaves next to each other in the tree are often visited together, so a
query has far fewer pages than leaves.

Rows whose vector is null, empty, zero or holds null or non-finite components
take no part, nor do rows without an id. Shorter vectors count as filled up with
zeros. Of several rows with a query's id the least vector asks; none of them is a
candidate of it. Other repeated rows are candidates each. Ties go to the smaller
id. Scores are sums of products in double precision, in the order of the
components. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

SAMPLE_ROWS, SAMPLE_VALUES = 20_000, 4_000_000
BRANCH, ROUNDS = 16, 12
MOST_LEAVES = 4096
CALIBRATION = 128
PART = 1 << 22  # scores worked out at once


def participants(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the rows that take part."""
    x = F.col("embedding")
    whole = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & whole & F.exists(x, lambda c: c != 0))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of doubles, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lens = np.diff(column.offsets.to_numpy())
    if (lens == width).all():
        return flat.reshape(len(lens), width)
    out = np.zeros((len(lens), width))
    out[np.arange(width) < lens[:, None]] = flat
    return out


class Tree:
    """Nodes in preorder: ``center``; ``children`` of inner nodes, ``leaf`` number
    of the others."""

    def __init__(self, sample: np.ndarray, norm2: float, leaf_sample: int, seed: int = 7):
        self.norm2, self.rng = norm2, np.random.default_rng(seed)
        self.center, self.children, self.leaf, self.leaves = [], [], [], 0
        x = self.lifted(sample)
        self._grow(x, x.mean(0), max(1, leaf_sample))
        self.center = np.array(self.center)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(self.norm2 - (x * x).sum(1), 0))[:, None]])

    def _grow(self, x: np.ndarray, center: np.ndarray, leaf_sample: int) -> int:
        me = len(self.center)
        self.center.append(center)
        self.children.append([])
        self.leaf.append(-1)
        parts = self._split(x, leaf_sample) if len(x) > leaf_sample else []
        if len(parts) < 2:
            self.leaf[me] = self.leaves
            self.leaves += 1
        else:
            self.children[me] = [self._grow(p, c, leaf_sample) for p, c in parts]
        return me

    def _split(self, x: np.ndarray, leaf_sample: int) -> list[tuple[np.ndarray, np.ndarray]]:
        k = min(BRANCH, max(2, -(-len(x) // leaf_sample)))
        centers = [x[self.rng.integers(len(x))]]
        near = ((x - centers[0]) ** 2).sum(1)
        while len(centers) < k and near.max() > 0:  # each next one far from the others
            centers.append(x[self.rng.choice(len(x), p=near / near.sum())])
            near = np.minimum(near, ((x - centers[-1]) ** 2).sum(1))
        c = np.array(centers)
        for _ in range(ROUNDS):
            own = nearest(x, c)
            kept = np.unique(own)
            c = np.array([x[own == j].mean(0) for j in kept])
        own = nearest(x, c)
        return [(x[own == j], c[j]) for j in np.unique(own)]

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each stored vector goes down to."""
        x = self.lifted(x)
        out = np.empty(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            own = nearest(x[rows], self.center[self.children[node]])
            todo += [(child, rows[own == j]) for j, child in enumerate(self.children[node]) if (own == j).any()]
        return out

    def visits(self, q: np.ndarray, most: int) -> Iterator[list[int]]:
        """For each query the ``most`` leaves that it visits, in order."""
        q = np.hstack([q, np.zeros((len(q), 1))])
        size = (self.center * self.center).sum(1)
        for part in np.array_split(q, 1 + len(q) * len(size) // PART):
            far = size - 2 * part @ self.center.T
            for d in far:
                heap, found = [(d[0], 0)], []
                while heap and len(found) < most:
                    _, node = heapq.heappop(heap)
                    if self.children[node]:
                        for child in self.children[node]:
                            heapq.heappush(heap, (d[child], child))
                    else:
                        found.append(self.leaf[node])
                yield found


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The centre nearest to each row."""
    size = (centers * centers).sum(1)
    parts = np.array_split(x, 1 + len(x) * len(centers) // PART)
    return np.concatenate([np.argmin(size - 2 * p @ centers.T, 1) for p in parts])


class Pages:
    """Which pages each leaf's rows lie in: ``first`` and ``parts``."""

    def __init__(self, rows: np.ndarray, page_rows: int):
        self.first, self.parts = np.zeros(len(rows), np.int64), np.ones(len(rows), np.int64)
        page, filled = 0, 0
        for leaf, n in enumerate(rows.tolist()):
            if filled and filled + n > page_rows:
                page, filled = page + 1, 0
            self.first[leaf] = page
            filled += n
            if n > page_rows:
                self.parts[leaf] = -(-n // page_rows)
                page, filled = page + int(self.parts[leaf]), 0

    def of(self, leaves: list[int]) -> dict[int, list[int]]:
        """The pages of visited leaves, each with its leaves."""
        found: dict[int, list[int]] = {}
        for x in leaves:
            for p in range(self.first[x], self.first[x] + self.parts[x]):
                found.setdefault(p, []).append(x)
        return found


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties to the smaller id."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def score_rows(
    q: np.ndarray, q_ids: np.ndarray, q_leaves: list, x: np.ndarray, ids: np.ndarray, leaf: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query's place, ids, scores) of the best k rows of its leaves for each
    query; a rough product leaves few candidates, whose scores are then summed one
    by one."""
    low = int(leaf.min(initial=0))
    seen = np.zeros(int(leaf.max(initial=0)) - low + 1, bool)
    slack = 1e-9 * np.sqrt((q * q).sum(1)) * np.sqrt((x * x).sum(1).max(initial=0.0))
    part = max(1, PART // max(1, len(x)))
    for start in range(0, len(q), part):
        rough = q[start : start + part] @ x.T
        for j, row in enumerate(rough, start):
            seen[:] = False
            seen[np.asarray(q_leaves[j], np.int64) - low] = True
            row = np.where((ids == q_ids[j]) | ~seen[leaf - low], -np.inf, row)
            at = np.flatnonzero(np.isfinite(row) if len(row) <= k else row >= max(np.partition(row, -k)[-k] - slack[j], -1.7e308))
            if len(at):
                scores = np.cumsum(x[at] * q[j], axis=1)[:, -1]
                kept = best(scores, ids[at], k)
                yield j, ids[at][kept], scores[kept]


class Index:
    """The fitted tree, the table's rows with leaf and page, and the visits."""

    def __init__(self, vectors: DataFrame, k: int, every: int, leaf_rows: int = 128, page_rows: int = 8192, recall: float = 0.95):
        self.k, self.every = k, every
        rows = participants(vectors)
        norm2 = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
        n, width, most = rows.agg(F.count("*"), F.max(F.size("v")), F.max(norm2)).first()
        self.width = width or 0
        sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // max(1, self.width))))
        sample = matrix(sample.select("v").toArrow()["v"], self.width) if n else np.zeros((1, 0))
        leaf_rows = max(leaf_rows, -(-n // MOST_LEAVES))
        self.tree = Tree(sample, float(most or 0.0), len(sample) * leaf_rows // max(n, 1))
        self.rows = saved(self._with_leaf(rows))
        sizes = np.zeros(self.tree.leaves, np.int64)
        for leaf, count in self.rows.groupBy("leaf").count().collect():  # at most MOST_LEAVES and a few rows
            sizes[leaf] = count
        self.pages = Pages(sizes, page_rows)
        asks = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
        self.queries = saved(asks)
        self.visits, self.calibrated = self._calibrated(recall)

    def _with_leaf(self, rows: DataFrame) -> DataFrame:
        tree, width = self.tree, self.width

        def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                leaf = tree.leaf_of(matrix(b.column("v"), width))
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), *b.columns], ["leaf", *b.schema.names])

        kind = rows.schema["v"].dataType.simpleString()
        return rows.mapInArrow(down, f"leaf long, vec_id long, v {kind}")

    def _calibrated(self, recall: float) -> tuple[int, float]:
        """Leaves to visit, and the share of true neighbours that they reach."""
        asked = self.queries.orderBy(F.xxhash64(F.lit(1), "vec_id"), "vec_id").limit(CALIBRATION).toArrow()
        if not asked.num_rows:
            return 1, 1.0
        q, q_ids, width, k = matrix(asked["v"], self.width), asked["vec_id"].to_numpy(), self.width, self.k

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: list[list] = [[np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)] for _ in q_ids]
            for b in batches:
                x, ids, leaf = matrix(b.column("v"), width), b.column("vec_id").to_numpy(), b.column("leaf").to_numpy()
                of = np.arange(len(ids))
                for j, row in enumerate(q @ x.T):
                    row = np.where(ids == q_ids[j], -np.inf, row)
                    some = of[np.isfinite(row)]
                    if len(some) > k:
                        some = some[row[some] >= np.partition(row[some], -k)[-k]]
                    joined = [np.concatenate(y) for y in zip(kept[j], (row[some], ids[some], leaf[some]), strict=True)]
                    at = best(joined[0], joined[1], k)
                    kept[j] = [y[at] for y in joined]
            rows = [np.concatenate(y) for y in zip(*kept, strict=True)]
            asked_by = np.repeat(q_ids, [len(y[0]) for y in kept])
            yield pa.RecordBatch.from_arrays([pa.array(asked_by), *map(pa.array, rows)], ["query_id", "score", "vec_id", "leaf"])

        near = self.rows.mapInArrow(exact, "query_id long, score double, vec_id long, leaf long")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "leaf").collect()
        want: dict[int, list[int]] = {}
        for query, leaf in near:  # at most CALIBRATION * k rows
            want.setdefault(query, []).append(leaf)
        needed = []  # visits until a neighbour's leaf is reached
        for query, leaves in zip(q_ids.tolist(), self.tree.visits(q, self.tree.leaves), strict=True):
            place = {leaf: v for v, leaf in enumerate(leaves, 1)}
            needed += [place[x] for x in want.get(query, ())]
        needed = np.array(needed)
        visits = 1
        while len(needed) and (needed <= visits).mean() < recall:
            visits += 1
        return visits, float((needed <= visits).mean()) if len(needed) else 1.0

    def search(self) -> DataFrame:
        """query_id, rank, vec_id, score."""
        tree, pages, width, visits, k = self.tree, self.pages, self.width, self.visits, self.k
        kind = self.rows.schema["v"].dataType.simpleString()

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for start in range(0, b.num_rows, 512):  # a query is copied to each of its pages
                    some = b.slice(start, 512)
                    to = [pages.of(leaves) for leaves in tree.visits(matrix(some.column("v"), width), visits)]
                    copies = some.take(pa.array(np.repeat(np.arange(some.num_rows), [len(x) for x in to])))
                    page = pa.array([p for x in to for p in x], pa.int64())
                    leaves = pa.array([y for x in to for y in x.values()], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([page, leaves, *copies.columns], ["page", "leaves", *copies.schema.names])

        first, parts = (F.array(*map(F.lit, x.tolist())) for x in (pages.first, pages.parts))
        if len(pages.first) > 64:  # too long for a literal in a plan that is read
            first, parts = (F.from_json(F.lit(str(x.tolist())), "array<long>") for x in (pages.first, pages.parts))
        page = F.get(first, F.col("leaf").cast("int")) + F.pmod(F.xxhash64("vec_id", "v"), F.get(parts, F.col("leaf").cast("int")))
        stored = self.rows.select(page.alias("page"), F.lit(False).alias("asks"), F.array("leaf").alias("leaves"), "vec_id", "v")
        asked = self.queries.mapInArrow(ask, f"page long, leaves array<long>, vec_id long, v {kind}")
        asked = asked.select("page", F.lit(True).alias("asks"), "leaves", "vec_id", "v")
        met = stored.union(asked).repartition("page").sortWithinPartitions("page", "asks")

        def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            none = [np.zeros((0, width)), np.zeros(0, np.int64), np.zeros(0, np.int64)]
            at, held, (x, ids, leaf) = None, [], none
            for b in batches:
                page, asks, vec_id = (b.column(c).to_numpy(zero_copy_only=False) for c in ("page", "asks", "vec_id"))
                vec, leaves = matrix(b.column("v"), width), b.column("leaves")
                turn = np.flatnonzero((page[1:] != page[:-1]) | (asks[1:] != asks[:-1])) + 1
                for s, e in zip([0, *turn.tolist()], [*turn.tolist(), len(page)], strict=True):
                    if s == e:
                        continue
                    if page[s] != at:  # the page before goes
                        at, held, (x, ids, leaf) = page[s], [], none
                    if not asks[s]:
                        held.append((vec[s:e], vec_id[s:e], leaves[s:e].flatten().to_numpy()))
                        continue
                    if held:
                        x, ids, leaf = (np.concatenate([a, *b]) for a, b in zip((x, ids, leaf), zip(*held, strict=True), strict=True))
                        held = []
                    found = list(score_rows(vec[s:e], vec_id[s:e], leaves[s:e].to_pylist(), x, ids, leaf, k)) if len(x) else []
                    if found:
                        by = np.repeat([vec_id[s + j] for j, _, _ in found], [len(i) for _, i, _ in found])
                        cols = [by, np.concatenate([i for _, i, _ in found]), np.concatenate([p for _, _, p in found])]
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, cols)), ["query_id", "vec_id", "score"])

        near = met.mapInArrow(stream, "query_id long, vec_id long, score double")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(vectors: DataFrame, k: int = 20, every: int = 20, **sizes: float) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose
    vec_id ``every`` divides."""
    return Index(vectors, k, every, **sizes).search()
