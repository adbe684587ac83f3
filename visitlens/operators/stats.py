"""Duration / step histograms and the session_aggr_stat row.

The original counted buckets with a string accumulator updated inside a
filter. Here the counts are ordinary aggregate columns (``count_if``), so they
are exact with any number of tasks, retries or partitions, and come out of a
single-row aggregation (partial counts per task, one tiny final exchange).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.rounding import ratio_sql


def _bucket_sql(value: str, lo: int, hi: int | None) -> str:
    return f"{value} >= {lo}" if hi is None else f"{value} BETWEEN {lo} AND {hi}"


def bucket_count_columns(visit: str = "visit_length", step: str = "step_length") -> list[Column]:
    """session_count plus one count per visit bucket and per step bucket."""
    cols = [F.expr(f"count(1) AS {C.SESSION_COUNT}")]
    cols += [F.expr(f"count_if({_bucket_sql(visit, lo, hi)}) AS visit_{n}") for n, lo, hi in C.VISIT_LENGTH_BUCKETS]
    cols += [F.expr(f"count_if({_bucket_sql(step, lo, hi)}) AS step_{n}") for n, lo, hi in C.STEP_LENGTH_BUCKETS]
    return cols


def bucket_number_sql(value: str, buckets: tuple) -> str:
    """The bucket of ``value`` as its number in ``buckets``; NULL outside all."""
    return f"CASE {' '.join(f'WHEN {_bucket_sql(value, lo, hi)} THEN {i}' for i, (_, lo, hi) in enumerate(buckets))} END"


def bucket_sum_columns(n: str, visit_bucket: str, step_bucket: str) -> list[Column]:
    """The columns of :func:`bucket_count_columns` over rows that stand for ``n``
    sessions each, whose buckets are numbers."""
    cols = [F.expr(f"sum({n}) AS {C.SESSION_COUNT}")]
    for kind, bucket, names in (("visit", visit_bucket, C.VISIT_LENGTH_BUCKETS), ("step", step_bucket, C.STEP_LENGTH_BUCKETS)):
        cols += [F.expr(f"sum(CASE WHEN {bucket} = {i} THEN {n} ELSE 0L END) AS {kind}_{name}") for i, (name, _, _) in enumerate(names)]
    return cols


def bucket_counts(sessions: DataFrame) -> DataFrame:
    """One row of counts over all sessions (0 counts when there are none)."""
    return sessions.agg(*bucket_count_columns())


_COUNT_NAMES = [f"visit_{n}" for n, _, _ in C.VISIT_LENGTH_BUCKETS] + [f"step_{n}" for n, _, _ in C.STEP_LENGTH_BUCKETS]
_RATIO_NAMES = [C.visit_ratio_column(n) for n, _, _ in C.VISIT_LENGTH_BUCKETS] + [
    C.step_ratio_column(n) for n, _, _ in C.STEP_LENGTH_BUCKETS
]


def with_ratios(counts: DataFrame, taskid_sql: str) -> DataFrame:
    """taskid, session_count and the 15 ratios of the counts of ``bucket_counts``.

    The ratios come from one ``transform`` over the array of the 15 counts, so
    the exact rounding expression appears once in the plan, not 15 times."""
    arr = f"array({', '.join(_COUNT_NAMES)})"
    ratios = f"transform({arr}, x -> {ratio_sql('x', C.SESSION_COUNT)}) AS _ratios"
    step = counts.selectExpr(f"CAST({taskid_sql} AS BIGINT) AS taskid", f"CAST({C.SESSION_COUNT} AS BIGINT) AS {C.SESSION_COUNT}", ratios)
    return step.selectExpr("taskid", C.SESSION_COUNT, *[f"_ratios[{i}] AS {n}" for i, n in enumerate(_RATIO_NAMES)])


def stat_row(counts: DataFrame, taskid: int) -> DataFrame:
    """The 17-column session_aggr_stat row; ratios half-up at 2 decimals,
    NULL when no session was selected."""
    return with_ratios(counts, str(int(taskid)))


def histogram(counts: DataFrame, kind: str) -> DataFrame:
    """(bucket, sessions) rows for every bucket of ``kind`` ('visit' or 'step'),
    zeros included, plus a ``session_count`` total row."""
    buckets = C.VISIT_LENGTH_BUCKETS if kind == "visit" else C.STEP_LENGTH_BUCKETS
    renamed = counts.select(
        F.col(C.SESSION_COUNT).cast("bigint").alias(C.SESSION_COUNT),
        *[F.col(f"{kind}_{name}").cast("bigint").alias(name) for name, _, _ in buckets],
    )
    return renamed.unpivot(
        ids=[], values=[C.SESSION_COUNT] + [name for name, _, _ in buckets],
        variableColumnName="bucket", valueColumnName="sessions",
    )
