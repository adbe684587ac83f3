"""Top categories and, per top category, top sessions.

Only the record shapes of these two results are fixed by the original
(taskid, categoryid, clickCount, orderCount, payCount and taskid, categoryid,
sessionid, clickCount); the ranking rules are ours:

* a category's counts are the click actions on it and the order / pay
  actions whose comma-joined id lists contain it, over the actions of the
  sessions that pass the task; id NULL or 0 is never a category;
* categories rank by clicks, orders, pays (all descending), then id;
* per top category, sessions with at least one click on it rank by clicks
  descending, then session id.

Plan: one scan. Actions are reduced to one row per (session, category) with
partial aggregation, which also carries what the task's filters need of the
session (its user, its keyword and category hits); a window over a session's rows,
as many as it has categories, gives them to each row, and a semi-join keeps the
rows of sessions whose user passes. The top-10 sessions read this table twice in
the same shape, so that its shuffles are reused. The top-k per category is limited
per map task before the shuffle (Spark's partial window group limit), so a
category clicked in most sessions never lands in one window task whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.params import TaskParams
from .filters import hit_predicate
from .sessions import category_hit, keyword_hit

TOP_CATEGORIES = 10
TOP_SESSIONS = 10


def category_counts_by_session(actions: DataFrame, params: TaskParams | None = None) -> DataFrame:
    """(session_id, user_id, category_id, click_count, order_count, pay_count), one
    row per pair that has any count; with keyword or category filters in
    ``params`` only those of sessions that pass them."""
    ids = "transform(split({col}, ',', -1), x -> TRY_CAST(x AS BIGINT))"
    flags = {}
    if params is not None and params.keyword_list() is not None:
        flags["kw_hit"] = keyword_hit(params.keyword_list())
    if params is not None and params.category_list() is not None:
        flags["cat_hit"] = category_hit(params.category_list())
    # an action without a category leaves a row of no category: it may name the user
    events = actions.selectExpr(
        "session_id",
        "CASE WHEN user_id <> 0 THEN user_id END AS user",
        *[f"{test} AS {flag}" for flag, test in flags.items()],
        "inline_outer(filter(concat("
        "  array(named_struct('category_id', click_category_id, 'kind', 0)),"
        f"  transform(coalesce({ids.format(col='order_category_ids')}, array()), c -> named_struct('category_id', c, 'kind', 1)),"
        f"  transform(coalesce({ids.format(col='pay_category_ids')}, array()), c -> named_struct('category_id', c, 'kind', 2))"
        "), e -> e.category_id <> 0))",
    )
    pairs = events.groupBy("session_id", "category_id").agg(
        F.max("user").alias("user"),
        *[F.expr(f"bool_or({flag}) AS {flag}") for flag in flags],
        F.expr("count_if(kind = 0) AS click_count"),
        F.expr("count_if(kind = 1) AS order_count"),
        F.expr("count_if(kind = 2) AS pay_count"),
    )
    whole = pairs.selectExpr(
        "session_id", "category_id", "click_count", "order_count", "pay_count",
        "coalesce(max(user) OVER (PARTITION BY session_id), 0L) AS user_id",
        *[f"bool_or({flag}) OVER (PARTITION BY session_id) AS {flag}" for flag in flags],
    )
    kept = whole.where("category_id IS NOT NULL")
    passed = hit_predicate(params) if params is not None else None
    if passed is not None:
        kept = kept.where(passed)
    return kept.select("session_id", "user_id", "category_id", "click_count", "order_count", "pay_count")


def top_categories(per_session: DataFrame, taskid: int, k: int = TOP_CATEGORIES) -> DataFrame:
    """taskid, categoryid, clickCount, orderCount, payCount of the top k categories."""
    totals = per_session.groupBy("category_id").agg(
        F.expr("sum(click_count) AS clickCount"),
        F.expr("sum(order_count) AS orderCount"),
        F.expr("sum(pay_count) AS payCount"),
        F.expr("count(session_id) AS sessions"),
    )
    # ids are unique: what follows them decides nothing, but keeps session_id in
    # the table as top_sessions reads it
    top = totals.orderBy(
        F.col("clickCount").desc(), F.col("orderCount").desc(), F.col("payCount").desc(), F.col("category_id").asc(), "sessions"
    ).limit(k)
    return top.selectExpr(
        f"CAST({int(taskid)} AS BIGINT) AS taskid",
        "category_id AS categoryid",
        "CAST(clickCount AS BIGINT) AS clickCount",
        "CAST(orderCount AS BIGINT) AS orderCount",
        "CAST(payCount AS BIGINT) AS payCount",
    )


def top_sessions(
    per_session: DataFrame,
    categories: DataFrame,
    taskid: int,
    k: int = TOP_SESSIONS,
) -> DataFrame:
    """taskid, categoryid, sessionid, clickCount: per category of ``categories``
    (at most TOP_CATEGORIES rows, so the broadcast is bounded), the k sessions
    with most clicks on it, ties by session id.

    ``row_number() <= k`` lets Spark put a partial per-group limit before the
    shuffle (``WindowGroupLimit`` Partial), so every map task sends at most k
    rows per category and a category clicked in most sessions never lands in
    one window task whole."""
    cats = F.broadcast(categories.select(F.col("categoryid").alias("category_id")))
    rows = per_session.join(cats, "category_id", "left_semi")
    # a category's sessions are unique: the counts behind them decide nothing, but
    # keep this table in the shape in which top_categories reads it; sessions
    # without a click come last and go after the ranking for the same reason
    order = [F.col("click_count").desc(), F.col("session_id").asc(), F.col("order_count"), F.col("pay_count")]
    ranked = rows.withColumn("_rn", F.row_number().over(Window.partitionBy("category_id").orderBy(*order)))
    return ranked.where((F.col("_rn") <= k) & (F.col("click_count") > 0)).select(
        F.lit(taskid).cast("bigint").alias("taskid"),
        F.col("category_id").alias("categoryid"),
        F.col("session_id").alias("sessionid"),
        F.col("click_count").cast("bigint").alias("clickCount"),
    )
