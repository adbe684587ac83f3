"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's parquet tables through lazy views, so its work
grows with the tables and no job runs while a query is built. Parameters live in ``params_catalog`` and are
shared with the SQL oracle (``oracle.py``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.params import TaskParams
from ..operators.funnel import one_step_convert_rate
from ..operators.kvrecord import record_roundtrip
from ..operators.products import click_share_by_user, product_status
from ..operators.sessions import aggregate_sessions, scan_actions
from ..operators.stats import bucket_counts, histogram
from ..operators.timeline import action_time_keys
from ..operators.topn import top_categories, top_sessions
from ..session import local_table
from ..sources import fixtures
from . import params_catalog as P
from .by_task import session_aggr_stat_by_task
from .session_stat import category_counts_for_task, drop_flags, order_session_columns, session_aggr_stat, sessions_for_task

Query = Callable[[SparkSession, str], DataFrame]


def _actions(spark: SparkSession, sf_dir: str, params: TaskParams | None = None) -> DataFrame:
    """The action view over ``events``; a task's dates become a timestamp range
    that the parquet reader sees."""
    start, end = params.date_range() if params else (None, None)
    return fixtures.user_visit_action(spark, sf_dir, start, end)


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.user_info(spark, sf_dir)


def action_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = P.FLAGSHIP
    return scan_actions(_actions(spark, sf_dir, p), p.start_date, p.end_date)


def session_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = P.FLAGSHIP
    return aggregate_sessions(scan_actions(_actions(spark, sf_dir, p), p.start_date, p.end_date), with_lists=True)


def session_user_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = P.FLAGSHIP
    kept = sessions_for_task(_actions(spark, sf_dir, p), _users(spark, sf_dir), p, with_lists=True, apply_filters=False)
    return order_session_columns(kept)


def _session_filter(params: TaskParams) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        kept = sessions_for_task(_actions(spark, sf_dir, params), _users(spark, sf_dir), params, with_lists=True)
        return order_session_columns(drop_flags(kept))

    return run


def _histogram(kind: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        p = P.FLAGSHIP
        kept = sessions_for_task(_actions(spark, sf_dir, p), _users(spark, sf_dir), p, apply_filters=False)
        return histogram(bucket_counts(kept.select("visit_length", "step_length")), kind)

    return run


def _stat(params: TaskParams) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return session_aggr_stat(_actions(spark, sf_dir, params), _users(spark, sf_dir), params)

    return run


def task_table(spark: SparkSession) -> DataFrame:
    return local_table(spark, P.TASK_ROWS, [("task_id", "BIGINT"), ("task_name", "STRING"), ("task_param", "STRING")])


def by_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_aggr_stat_by_task(_actions(spark, sf_dir), _users(spark, sf_dir), task_table(spark))


def ratio_half_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_share_by_user(_actions(spark, sf_dir))


def product_status_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_status(fixtures.product_info(spark, sf_dir))


def action_time_keys_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return action_time_keys(_actions(spark, sf_dir))


def kv_record_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_roundtrip(session_user_join(spark, sf_dir))


def _category_counts(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    return category_counts_for_task(_actions(spark, sf_dir, params), _users(spark, sf_dir), params)


def _top10_category(params: TaskParams) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return top_categories(_category_counts(spark, sf_dir, params), P.TASK_ID)

    return run


def _top10_session(params: TaskParams) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        per = _category_counts(spark, sf_dir, params)
        return top_sessions(per, top_categories(per, P.TASK_ID), P.TASK_ID)

    return run


def page_one_step_convert_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = P.TOP_PAGE_FLOW
    scanned = scan_actions(_actions(spark, sf_dir, p), p.start_date, p.end_date)
    return one_step_convert_rate(spark, scanned, p.page_flow())


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "session_aggr_stat": _stat(P.FLAGSHIP),
        "action_date_range": action_date_range,
        "session_aggregate": session_aggregate,
        "session_user_join": session_user_join,
        "visit_length_histogram": _histogram("visit"),
        "step_length_histogram": _histogram("step"),
        "session_aggr_stat_filtered": _stat(P.FILTERS["all"]),
        "session_aggr_stat_empty": _stat(P.EMPTY),
        "session_aggr_stat_by_task": by_task,
        "ratio_half_up": ratio_half_up,
        "product_status": product_status_query,
        "action_time_keys": action_time_keys_query,
        "kv_record_roundtrip": kv_record_roundtrip,
        "top10_category": _top10_category(P.FLAGSHIP),
        "top10_session": _top10_session(P.FLAGSHIP),
        "top10_category_filtered": _top10_category(P.FILTERS["keyword"]),
        "top10_session_filtered": _top10_session(P.FILTERS["keyword"]),
        "page_one_step_convert_rate": page_one_step_convert_rate,
    }
    for name, params in P.FILTERS.items():
        out[f"session_filter_{name}"] = _session_filter(params)
    return out
