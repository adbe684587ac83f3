"""Views of the original job's three input tables, derived from the driver tables.

The original job generates ``user_visit_action``, ``user_info`` and
``product_info`` with an unseeded random generator. We keep their schemas and
derive them deterministically from ``events``, ``customer`` ⋈ ``nation`` and
``part`` (FIXTURES.md §4). The views are lazy projections over the parquet
scans, so Catalyst prunes columns and pushes filters into the reader.
"""

from __future__ import annotations

import datetime as _dt
import re
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import SEARCH_WORDS

ACTION_COLUMNS = (
    "date", "user_id", "session_id", "page_id", "action_time", "search_keyword",
    "click_category_id", "click_product_id", "order_category_ids", "order_product_ids",
    "pay_category_ids", "pay_product_ids", "city_id",
)

USER_COLUMNS = ("user_id", "username", "name", "age", "professional", "city", "sex")

# Seconds of the day are divided by this per user % 5, so that sessions of
# different users have very different lengths (FIXTURES.md §4).
_TIME_DIVISORS = (1, 10, 100, 1000, 10000)

_CANONICAL_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


_HANDLES: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table handle, reused within a session (the file listing and
    footer read happen once, like a catalog table). ``forget`` re-lists."""
    path = f"{sf_dir}/{name}.parquet"
    handles = _HANDLES.setdefault(spark, {})
    if path not in handles:
        handles[path] = spark.read.parquet(path)
    return handles[path]


def forget(spark: SparkSession) -> None:
    """Drop the cached table handles of ``spark`` (files changed on disk)."""
    _HANDLES.pop(spark, None)


def _canonical_day(text: str | None) -> _dt.date | None:
    if text is None or not _CANONICAL_DATE.match(text):
        return None
    try:
        return _dt.date.fromisoformat(text)
    except ValueError:
        return None


def ts_prefilter(start_date: str | None, end_date: str | None) -> Column | None:
    """Timestamp bounds equivalent to ``start <= date <= end`` on the string date.

    ``date`` is ``ts`` printed as ``yyyy-MM-dd``, so for canonical bounds the
    string range equals a half-open timestamp range, which the parquet reader
    can use for row-group skipping (the production table would be partitioned
    by ``date`` instead). Non-canonical bounds get no pre-filter; the exact
    string predicate is always applied as well.
    """
    lo, hi = _canonical_day(start_date), _canonical_day(end_date)
    if lo is None or hi is None:
        return None
    return F.expr(
        f"ts >= TIMESTAMP_NTZ '{lo.isoformat()} 00:00:00' "
        f"AND ts < TIMESTAMP_NTZ '{(hi + _dt.timedelta(days=1)).isoformat()} 00:00:00'"
    )


_WORDS_SQL = "array(" + ", ".join("'" + w + "'" for w in SEARCH_WORDS) + ")"
_DIVISORS_SQL = "array(" + ", ".join(str(d) for d in _TIME_DIVISORS) + ")"

# Spark SQL expressions of the 13 action columns over ``events`` (FIXTURES.md §4);
# ``k`` is the integer in ``props``, ``sq`` the squeezed second of the day.
_EVENT_KEYS = (
    "*",
    "CAST(get_json_object(props, '$.k') AS INT) AS k",
    f"CAST(floor((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / element_at({_DIVISORS_SQL}, "
    "CAST(user_id % 5 + 1 AS INT))) AS BIGINT) AS sq",
    "CAST(CAST(ts AS DATE) AS STRING) AS day_text",
)
_ACTION_EXPRS = (
    "day_text AS date",
    "CASE WHEN event_id % 97 = 5 THEN CAST(0 AS BIGINT) ELSE user_id END AS user_id",
    "CASE WHEN user_id % 10 = 0 THEN concat('m', CAST(user_id AS STRING)) "
    "WHEN user_id % 10 = 1 THEN concat('h', CAST(user_id AS STRING), '-', CASE WHEN dayofmonth(ts) <= 15 THEN '1' ELSE '2' END) "
    "ELSE concat('d', CAST(user_id AS STRING), '-', CAST(dayofmonth(ts) AS STRING)) END AS session_id",
    "CAST(event_id % 10 AS BIGINT) AS page_id",
    "concat(day_text, ' ', CAST(floor(sq / 3600) AS BIGINT), ':', lpad(CAST(CAST(floor((sq % 3600) / 60) AS BIGINT) AS STRING), 2, '0'), "
    "':', lpad(CAST(sq % 60 AS STRING), 2, '0')) AS action_time",
    f"CASE WHEN event_type = 'view' THEN element_at({_WORDS_SQL}, CAST(k % 10 + 1 AS INT)) END AS search_keyword",
    "CASE WHEN event_type = 'click' THEN CAST(k AS BIGINT) END AS click_category_id",
    "CASE WHEN event_type = 'click' THEN CAST((k * 7) % 100 AS BIGINT) END AS click_product_id",
    "CASE WHEN event_type = 'purchase' AND k % 2 = 0 THEN CAST((k * 3) % 100 AS STRING) END AS order_category_ids",
    "CASE WHEN event_type = 'purchase' AND k % 2 = 0 THEN CAST(k AS STRING) END AS order_product_ids",
    "CASE WHEN event_type = 'purchase' AND k % 2 = 1 THEN CAST((k * 3) % 100 AS STRING) END AS pay_category_ids",
    "CASE WHEN event_type = 'purchase' AND k % 2 = 1 THEN CAST(k AS STRING) END AS pay_product_ids",
    "CAST(user_id % 10 AS BIGINT) AS city_id",
)


def user_visit_action(
    spark: SparkSession,
    sf_dir: str,
    start_date: str | None = None,
    end_date: str | None = None,
) -> DataFrame:
    """``user_visit_action`` (13 columns) derived from ``events`` (lazy).

    ``start_date``/``end_date`` only add a pushed-down timestamp pre-filter
    for callers that read the derived view directly (the CLI on a fixture
    folder); the caller still applies the date predicate itself
    (``scan_actions``).
    """
    ev = _table(spark, sf_dir, "events")
    pre = ts_prefilter(start_date, end_date)
    if pre is not None:
        ev = ev.where(pre)
    return ev.selectExpr(*_EVENT_KEYS).selectExpr(*_ACTION_EXPRS)


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_info`` (7 columns) from ``customer`` ⋈ ``nation``; every 17th key is left out
    so that the session ⋈ user inner join drops sessions."""
    cust = _table(spark, sf_dir, "customer").where("c_custkey % 17 <> 3")
    nation = _table(spark, sf_dir, "nation")
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey, "inner").selectExpr(
        "CAST(c_custkey AS BIGINT) AS user_id",
        "concat('user', CAST(c_custkey AS STRING)) AS username",
        "c_name AS name",
        "CAST((c_custkey * 7) % 60 AS INT) AS age",
        "c_mktsegment AS professional",
        "n_name AS city",
        "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``product_info`` (3 columns) from ``part``; status JSON in ``extend_info``."""
    return _table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS BIGINT) AS product_id",
        "p_name AS product_name",
        "concat('{\"product_status\": ', CAST(p_partkey % 2 AS STRING), '}') AS extend_info",
    )


def preview(spark: SparkSession, sf_dir: str, n: int = 1) -> dict[str, list]:
    """First ``n`` rows of each input table, as a smoke check of the adapter
    (``take`` stops after the first rows it needs; nothing else is read)."""
    return {
        "user_visit_action": user_visit_action(spark, sf_dir).take(n),
        "user_info": user_info(spark, sf_dir).take(n),
        "product_info": product_info(spark, sf_dir).take(n),
    }


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register the three fixture views under the original table names."""
    user_visit_action(spark, sf_dir).createOrReplaceTempView("user_visit_action")
    user_info(spark, sf_dir).createOrReplaceTempView("user_info")
    product_info(spark, sf_dir).createOrReplaceTempView("product_info")
