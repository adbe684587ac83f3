"""The session-analysis job as one DataFrame plan.

scan (the date range prunes date partitions; three columns read) -> partial
and final aggregation by session -> inner join with users (Catalyst pushes
user filters below the join) -> task filters -> one-row bucket counts ->
ratios.

Shuffles: one on session_id, after map-side partial aggregation. Then the
user join: sort-merge with AQE skew splitting, unless AQE measures a side
under the broadcast threshold (small inputs only). Last, the single-row
exchange of the 16 partial counters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..constants import LOCAL_SESSION_TASK_ID
from ..functions.params import TaskParams
from ..operators.filters import session_predicate, user_predicate
from ..operators.sessions import SESSION_COLUMNS, USER_FIELDS, aggregate_sessions, join_users, scan_actions
from ..operators.stats import bucket_counts, stat_row
from ..operators.topn import category_counts_by_session


def sessions_for_task(
    actions: DataFrame,
    users: DataFrame,
    params: TaskParams,
    with_lists: bool = False,
    apply_filters: bool = True,
) -> DataFrame:
    """Sessions of the task's date range, joined with their user and filtered."""
    start, end = params.date_range()
    scanned = scan_actions(actions, start, end)
    sessions = aggregate_sessions(
        scanned,
        with_lists=with_lists,
        keywords=params.keyword_list() if apply_filters else None,
        category_ids=params.category_list() if apply_filters else None,
    )
    joined = join_users(sessions, users)
    if apply_filters:
        predicate = session_predicate(params)
        if predicate is not None:
            joined = joined.where(predicate)
    return joined


def session_aggr_stat(
    actions: DataFrame,
    users: DataFrame,
    params: TaskParams,
    taskid: int = LOCAL_SESSION_TASK_ID,
) -> DataFrame:
    """The 17-column result row of one task."""
    kept = sessions_for_task(actions, users, params)
    return stat_row(bucket_counts(kept.select("visit_length", "step_length")), taskid)


def category_counts_for_task(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """(session, category) counts over the actions of the sessions that pass the task."""
    counts = category_counts_by_session(scan_actions(actions, *params.date_range()), params)
    passed = user_predicate(params)
    kept = users.where(passed) if passed is not None else users
    return counts.join(kept.select("user_id"), "user_id", "left_semi")


def drop_flags(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in ("kw_hit", "cat_hit") if c in df.columns])


def order_session_columns(df: DataFrame) -> DataFrame:
    return df.select(*(SESSION_COLUMNS + USER_FIELDS))
