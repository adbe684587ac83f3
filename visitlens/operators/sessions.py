"""Actions -> sessions -> sessions with their user.

One ``groupBy("session_id")`` replaces the original ``groupByKey`` plus a
per-session loop. All per-session values are fixed-width aggregates (min,
max, count, bool_or), so Spark aggregates partially on the map side before
the shuffle: a session holding a third of all rows still leaves each map task
as one row. Keyword / category *lists* are only built when the output asks for
them: actions are first reduced to distinct (session, value) rows, which carry
the fixed-width values too, so that no duplicate ever enters a list's buffer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.params import TaskError
from ..functions.timekeys import parse_time_sql
from ..session import sql_literal

SESSION_COLUMNS = (
    "session_id", "user_id", "search_keywords", "click_category_ids", "visit_length", "step_length",
)
USER_FIELDS = ("age", "professional", "city", "sex")


def scan_actions(actions: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    """Actions whose ``date`` text lies in [start, end] (string compare, inclusive).

    A missing bound is an error: the original spliced the text ``null`` into
    its SQL and silently selected nothing.
    """
    if start_date is None or end_date is None:
        raise TaskError("startDate and endDate are required")
    return actions.where(f"date >= {sql_literal(start_date)} AND date <= {sql_literal(end_date)}")


def _in_list(expr: str, items: list[str]) -> str:
    return f"{expr} IN ({', '.join(sql_literal(x) for x in items)})"


def keyword_hit(keywords: list[str]) -> str:
    """Per-action SQL test for the keyword filter: any comma-separated piece of
    the searched text is one of the list."""
    if not keywords:
        return "false"
    return f"coalesce(arrays_overlap(split(search_keyword, ',', -1), {sql_literal(keywords)}), false)"


def category_hit(category_ids: list[str]) -> str:
    """Per-action SQL test for the category filter. Ids compare as text, like
    the original; category 0 and NULL never count as clicked."""
    if not category_ids:
        return "false"
    return f"coalesce(click_category_id <> 0 AND {_in_list('CAST(click_category_id AS STRING)', category_ids)}, false)"


def aggregate_sessions(
    actions: DataFrame,
    with_lists: bool = False,
    keywords: list[str] | None = None,
    category_ids: list[str] | None = None,
) -> DataFrame:
    """Group actions by session.

    Columns: session_id, user_id (largest non-zero id, else 0), visit_length
    (whole seconds between first and last parsable action time), step_length
    (number of actions); with ``with_lists`` also search_keywords and
    click_category_ids (sorted distinct values joined by ','; '' when none);
    ``kw_hit`` / ``cat_hit`` when a keyword / category filter is given.
    """
    flags = {}
    if keywords is not None:
        flags["kw_hit"] = keyword_hit(keywords)
    if category_ids is not None:
        flags["cat_hit"] = category_hit(category_ids)
    if with_lists:
        rows = _distinct_values(actions, flags)
        aggs = [
            "max(_user) AS _user", "min(_start) AS _start", "max(_end) AS _end", "sum(step_length) AS step_length",
            "collect_list(_kw) AS _kws", "collect_list(_cat) AS _cats", *[f"bool_or({flag}) AS {flag}" for flag in flags],
        ]
    else:
        t = parse_time_sql("action_time")
        rows = actions
        aggs = [
            "max(CASE WHEN user_id <> 0 THEN user_id END) AS _user", f"min({t}) AS _start", f"max({t}) AS _end", "count(1) AS step_length",
            *[f"bool_or({test}) AS {flag}" for flag, test in flags.items()],
        ]
    cols = ["session_id", "coalesce(_user, 0L) AS user_id"]
    if with_lists:
        cols += [
            "array_join(array_sort(_kws), ',') AS search_keywords",
            "array_join(transform(array_sort(_cats), x -> CAST(x AS STRING)), ',') AS click_category_ids",
        ]
    cols += ["timestampdiff(SECOND, _start, _end) AS visit_length", "step_length", *flags]
    return rows.groupBy("session_id").agg(*[F.expr(a) for a in aggs]).selectExpr(*cols)


def _distinct_values(actions: DataFrame, flags: dict[str, str]) -> DataFrame:
    """One row per session and value: a keyword ``_kw``, a category ``_cat``, or
    neither; with the actions that it stands for as fixed-width values. An action
    that has both is counted as a step in the keyword's row only."""
    kw = "CASE WHEN search_keyword <> '' THEN search_keyword END"
    cat = "CASE WHEN click_category_id <> 0 THEN click_category_id END"
    one = "named_struct('_kw', _k, '_cat', CASE WHEN _k IS NULL THEN _c END, '_step', 1L)"
    two = "named_struct('_kw', CAST(NULL AS STRING), '_cat', _c, '_step', 0L)"
    rows = actions.selectExpr(
        "session_id", "CASE WHEN user_id <> 0 THEN user_id END AS _user", f"{parse_time_sql('action_time')} AS _t", f"{kw} AS _k", f"{cat} AS _c",
        *[f"{test} AS {flag}" for flag, test in flags.items()],
    )
    values = f"inline(CASE WHEN _k IS NOT NULL AND _c IS NOT NULL THEN array({one}, {two}) ELSE array({one}) END)"
    rows = rows.selectExpr("session_id", "_user", "_t", *flags, values)
    return rows.groupBy("session_id", "_kw", "_cat").agg(*map(F.expr, [
        "max(_user) AS _user", "min(_t) AS _start", "max(_t) AS _end", "sum(_step) AS step_length",
        *[f"bool_or({flag}) AS {flag}" for flag in flags],
    ]))


def join_users(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Inner equi-join of sessions and users on user_id (sessions without a
    user row vanish; a duplicated user id multiplies its sessions).

    No broadcast hint: AQE broadcasts a side only when its measured size is
    under the threshold (small inputs); otherwise it is a sort-merge join and
    AQE splits a hot user id (e.g. the 0 of anonymous sessions).
    """
    return sessions.join(users.selectExpr("user_id", *USER_FIELDS), "user_id", "inner")
