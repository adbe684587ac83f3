"""Spelling variants, the vector tree and the Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("visitlens.llm")
from pyspark.sql import functions as F
from visitlens.llm import merkle, spelling, vector_tree
from visitlens.llm.common import importable, saved


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


# 11 spelling variants -------------------------------------------------------


def lowered(text):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text)


def words_brute(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def variants_brute(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if n[v] >= 10 * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


def variants(words, **sizes):
    found = spelling.spelling_variants(words, **sizes)
    return sorted(map(tuple, found.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def noisy(rnd, w):
    i, x = rnd.randrange(len(w)), rnd.random()
    letter = rnd.choice("abcéÿ")
    return w if x < 0.8 else w[:i] + w[i + 1 :] if x < 0.87 else w[:i] + letter + w[i + (x < 0.94) :]


@pytest.mark.parametrize("sizes", [{}, {"bin_chars": 300, "hot_chars": 60}])
def test_spelling_variants_equal_brute_force(spark, sizes):
    rnd = random.Random(len(sizes))
    base = ["".join(rnd.choice("abcéÿ") for _ in range(rnd.randint(7, 11))) for _ in range(200)]
    rows = [
        (i if i % 9 else None, " ".join(noisy(rnd, base[int(200 * rnd.random() ** 3)]) for _ in range(60)).upper() + " short ab×cdefghi")
        for i in range(120)
    ]
    rows += [(5, None), (6, ""), rows[0], rows[0], (7, "Straße-DEFGHIJ defghij1defghij")]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, word string, n long")
    words = saved(spelling.vocabulary(spelling.altered_runs(docs)))
    n = words_brute(rows)
    assert {r.word: r.n for r in words.collect()} == n
    assert variants(words, **sizes) == variants_brute(n)


def test_spelling_of_very_long_words_and_of_none(spark):
    long = "z" * 20_000
    words = spark.createDataFrame([(long, 50), (long + "z", 5), (long[:-1] + "y", 2), ("abcdefg", 1)], "word string, n long")
    got = {r[0][-3:]: r[1:] for r in variants(words) if len(r[0]) > 9}
    assert len(got) == 2  # both ends in zzz: the shorter one is told apart below
    by_n = {r[3]: r for r in variants(words)}
    assert by_n[5][1] == long and by_n[5][4] == 1 and by_n[2][1] == long and by_n[2][4] == 1 and by_n[50][4] == 2
    assert variants(words.where("false")) == []
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.vocabulary(spelling.altered_runs(docs)).collect() == []


def test_forms_are_followed_to_the_last(spark):
    chain = ["aaaaaaa", "aaaaaab", "aaaaabb", "aaaabbb", "aaabbbb", "aabbbbb"]
    words = spark.createDataFrame([(w, 10**k * 2) for k, w in enumerate(chain)], "word string, n long")
    assert {r[2] for r in variants(words)} == {"aabbbbb"}


def test_hot_halves_are_dealt_out_further(spark):
    rnd = random.Random(3)
    alphabet = "abcdefgh"
    words = {"".join(["prefix"] + [rnd.choice(alphabet) for _ in range(6)]) for _ in range(3000)}
    df = spark.createDataFrame([(w, 2) for w in sorted(words)], "word string, n long")
    rows = spelling.keyed(df, hot_chars=2000)
    most = rows.groupBy("key").agg(F.sum(F.length("word")).alias("chars")).agg(F.max("chars")).first()[0]
    assert most <= 2000
    pairs = {(r.word, r.near) for r in spelling.near_words(df, bin_chars=5000, hot_chars=2000).collect()}
    by_rest = {}
    for w in words:
        for i in range(len(w)):
            by_rest.setdefault((i, w[:i] + w[i + 1 :]), []).append(w)
    assert pairs == {(a, b) for ws in by_rest.values() for a in ws for b in ws if a != b}


def test_suffix_ranks():
    rnd = random.Random(9)
    for n in (1, 2, 50, 300):
        text = [rnd.randint(1, 3) for _ in range(n)] + [0]
        assert spelling.suffix_ranks(np.array(text)).tolist() == sorted(range(n + 1), key=lambda i: text[i:])


# 12 vector tree -------------------------------------------------------------


def nearest_brute(rows, k, every):
    fit = [(i, [float(c) for c in v]) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    asks = {}
    for i, v in fit:
        if i % every == 0:
            asks[i] = min(v, asks.get(i, v))
    found = {}
    for i, q in asks.items():
        scores = [(-sum(a * b for a, b in zip(q, v)), j) for j, v in fit if j != i]
        found[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return found


def by_query(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(found.setdefault(r.query_id, [])) + 1
        found[r.query_id].append((r.vec_id, r.score))
    return found


VECTORS = "vec_id long, embedding array<float>, leaf long, v string"


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "v") for i, v in rows], VECTORS)


def test_vector_tree_finds_all_where_it_visits_all(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, np.round(rnd.normal(size=5) * (1 + i % 3), 2).astype(np.float32).tolist()) for i in range(400)]
    rows += [(0, [1.0] * 5), (20, rows[20][1]), (2**53 + 1, [0.5] * 5), (2**53 + 3, [0.5] * 5), (-(2**63), [0.5, 0.5]), (60_000, [2.0] * 8)]
    rows += [(None, [1.0] * 5), (1000, None), (1001, []), (1002, [0.0] * 5), (1003, [1.0, None]), (1004, [float("nan")]), (1005, [float("inf")])]
    index = vector_tree.Index(vector_table(spark, rows), 20, 20, leaf_rows=8, page_rows=24, recall=1.0)
    index.visits = index.tree.leaves
    got, want = by_query(index.search().collect()), nearest_brute(rows, 20, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12, atol=1e-12)


def test_vector_tree_recall_is_calibrated(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    index = vector_tree.Index(vector_table(spark, rows), 20, 20, leaf_rows=16, page_rows=64)
    got, want = by_query(index.search().collect()), nearest_brute(rows, 20, 20)
    share = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert 0.95 <= index.calibrated and share >= 0.93
    assert index.visits < index.tree.leaves


def test_equal_vectors_fill_several_pages(spark):
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(i, [math.cos(i), math.sin(i)]) for i in range(300, 400)]
    df = vector_table(spark, rows)
    index = vector_tree.Index(df, 5, 20, leaf_rows=10, page_rows=32)
    assert index.pages.parts.max() >= 9
    got = by_query(index.search().collect())
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[280]] == [0, 1, 2, 3, 4]
    few = by_query(vector_tree.neighbours(df.where("vec_id < 3")).collect())
    assert [i for i, _ in few[0]] == [1, 2]
    assert vector_tree.neighbours(df.where("false")).collect() == []
    assert vector_tree.neighbours(df.where("vec_id = 0")).collect() == []


# 13 Merkle manifest ---------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def manifest_brute(rows):
    """rows of (doc_id, source, lang, n_chars, text)"""
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        by[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {x: levels([leaf(r) for r in by[x]]) for x in langs}
    tops = levels([trees[x][-1][0] for x in langs])
    out = []
    for g, x in enumerate(langs):
        for i, r in enumerate(by[x]):
            steps = []
            for tree, p in ((trees[x], i), (tops, g)):
                for level in tree[:-1]:
                    steps.append((p % 2 == 1, level[p ^ 1] if p ^ 1 < len(level) else None))
                    p //= 2
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            acc = leaf((*r[:3], r[3] + 1, r[4]) if changed else r)
            for left, s in steps:
                acc = H(acc) if s is None else H(s, acc) if left else H(acc, s)
            root = tops[-1][0]
            out.append((r[0], leaf(r), trees[x][-1][0], root, H(*[s for _, s in steps if s]), acc, acc == root))
    return sorted(out, key=repr)


def manifest(spark, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string, grp string, at long, node string, leaf string"
    docs = spark.createDataFrame([(*r, "g", 0, "n", "l") for r in rows], schema)
    n = F.col("n_chars").cast("decimal(20,0)")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    found = merkle.verified(docs, n_chars=F.when(tampered, n + 1).otherwise(n))
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("n, langs", [(0, "a"), (1, "a"), (3, "ab"), (17, "a"), (40, ["a", "", None, "é", "z"]), (257, "a"), (700, ["a", "a", "a", None])])
def test_manifest_equals_brute_force(spark, n, langs):
    rnd = random.Random(n)
    rows = [
        (rnd.choice([None, rnd.randrange(10**6), 2**53 + 1 + i, -(2**63)]), rnd.choice(["s", None, "é|:"]), rnd.choice(langs),
         rnd.choice([None, i, 2**63 - 1]), rnd.choice(["", "t", None, "日本" * 5, "x" * 50_000]))
        for i in range(n)
    ]
    rows += rows[: n // 4]  # repeated rows
    assert manifest(spark, rows) == manifest_brute(rows)


def test_manifest_of_many_langs(spark):
    rows = [(i, "s", f"lang{i // 2}", i, "t") for i in range(600)]
    assert manifest(spark, rows) == manifest_brute(rows)


def test_manifest_proves_without_joins(spark):
    docs = spark.createDataFrame([(i, "s", "a", i, "t") for i in range(10)], "doc_id long, source string, lang string, n_chars long, text string")
    plan = merkle.proofs(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
