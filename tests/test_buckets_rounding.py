"""Bucket edges and exact half-up rounding."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from visitlens import constants as C
from visitlens.functions.rounding import half_up, half_up_reference, half_up_sql
from visitlens.operators.stats import bucket_counts, histogram

EDGES = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]


def _python_bucket(v, buckets):
    for name, lo, hi in buckets:
        if v >= lo and (hi is None or v <= hi):
            return name
    return None


def test_bucket_edges(spark):
    df = spark.createDataFrame([(v, v) for v in EDGES], "visit_length bigint, step_length bigint")
    counts = bucket_counts(df).first().asDict()
    assert counts[C.SESSION_COUNT] == len(EDGES)
    for kind, buckets in (("visit", C.VISIT_LENGTH_BUCKETS), ("step", C.STEP_LENGTH_BUCKETS)):
        for name, _, _ in buckets:
            expected = sum(1 for v in EDGES if _python_bucket(v, buckets) == name)
            assert counts[f"{kind}_{name}"] == expected, (kind, name)
    # 0 is in no bucket of either kind
    assert _python_bucket(0, C.VISIT_LENGTH_BUCKETS) is None


def test_histogram_lists_every_bucket(spark):
    df = spark.createDataFrame([(5, 2)], "visit_length bigint, step_length bigint")
    rows = {r.bucket: r.sessions for r in histogram(bucket_counts(df), "visit").collect()}
    assert set(rows) == {C.SESSION_COUNT} | {n for n, _, _ in C.VISIT_LENGTH_BUCKETS}
    assert rows["4s_6s"] == 1 and rows["30m"] == 0 and rows[C.SESSION_COUNT] == 1


def test_half_up_matches_decimal_rule(spark):
    rng = random.Random(7)
    values = [n / d for d in range(1, 201) for n in range(0, d + 1)]
    values += [rng.random() * 4 for _ in range(3000)] + [3 / 40, 0.125, 0.005, 0.015, 201 / 40, 1e-12, 123.455]
    values += [-v for v in values[-3007:]]
    df = spark.createDataFrame([(float(v),) for v in values], "d double")
    got = df.select(half_up(F.col("d")).alias("c"), F.expr(half_up_sql("d")).alias("s")).collect()
    expected = [half_up_reference(v) for v in values]
    mismatches = [(v, g, e) for v, g, e in zip(values, got, expected) if g.c != e or g.s != e]
    assert not mismatches, mismatches[:5]


def test_known_rounding_cases(spark):
    df = spark.createDataFrame([(3 / 40,), (0.125,), (-0.125,), (-3 / 40,), (-0.001,), (None,)], "d double")
    assert [r[0] for r in df.select(half_up(F.col("d"))).collect()] == [0.07, 0.13, -0.13, -0.07, 0.0, None]
