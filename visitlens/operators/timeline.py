"""Per-action time keys and position of each action inside its session.

Output per action: the hour key as written (``getDateHour``), the hour padded
to two digits (``fulfuill``), date and minute keys (``formatDateKey``,
``formatTimeMinute``) and the key's date read back (``parseDateKey``), the
formatted date and time (``formatDate``, ``formatTime``), the whole seconds since
the latest *earlier* action time of the session (``minus``; NULL at the
session's first instant), whether the action lies strictly after the session's
first / strictly before its last action time (``after`` / ``before``), and its
place against a fixed run time: ``before``, ``after``, ``minus`` (0 for a text that
does not parse), today and yesterday of that run.

Plan: one scan and one shuffle of the actions, by session and ten minutes. The
shuffled rows are read twice: each ten minutes leave one row with their first and
last instant, which a window over a session's rows turns into the instant carried
over from the ten minutes before and the session's ends; and a window over ten
minutes of a session finds the earlier instant inside. The two meet on the key by
which the actions lie already. So no window group is larger than one session's
actions of ten minutes, however long the session is; the NULL session is a
session too. (A range shuffle by session and time with a carry-over from
partition to partition would scan twice, once for its sample.) Actions whose time
does not parse are dealt out evenly, as they have no neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timekeys import (
    date_hour_sql, date_key, format_date, format_time, fulfill_sql, hour_text_sql, minute_key, parse_date_key, parse_time_sql, today, yesterday,
)
from ..session import sql_literal

BUCKET_SECONDS = 600
AS_OF = "2024-01-15 12:00:00"
_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
_KEY = ["session_key", "bucket"]


def bucketed_actions(actions: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """(session_key, bucket, at, action_time) dealt out by session and bucket:
    ``at`` is the second inside the bucket, NULL for a time that does not parse."""
    spread = "pmod(monotonically_increasing_id(), 997) - 9000000000000000"
    rows = actions.selectExpr(
        "coalesce(concat('_', session_id), '') AS session_key",  # never NULL: nothing is filtered on one side only
        "action_time",
        f"timestampdiff(SECOND, {_EPOCH}, {parse_time_sql('action_time')}) AS s",
    )
    rows = rows.selectExpr(
        "session_key", f"coalesce(floor(s / {bucket_seconds}), {spread}) AS bucket", f"pmod(s, {bucket_seconds}) AS at", "action_time"
    )
    return rows.repartition(*_KEY)


def action_time_keys(actions: DataFrame, as_of: str = AS_OF, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    rows = bucketed_actions(actions, bucket_seconds)
    second = f"bucket * {bucket_seconds} + at"
    inside = "max(at) OVER (PARTITION BY session_key, bucket ORDER BY at RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    # all four columns are read here too, so that the shuffle is the same one
    ends = rows.groupBy(*_KEY).agg(F.expr(f"min({second}) AS low"), F.expr(f"max({second}) AS high"), F.expr("count(action_time) AS texts"))
    rows = rows.selectExpr(*_KEY, "action_time", f"{second} AS s", f"bucket * {bucket_seconds} + {inside} AS near")
    ends = ends.where("low IS NOT NULL AND texts > 0").selectExpr(
        *_KEY,
        "lag(high) OVER (PARTITION BY session_key ORDER BY bucket) AS carried",
        "min(low) OVER (PARTITION BY session_key) AS first_s",
        "max(high) OVER (PARTITION BY session_key) AS last_s",
    )
    now = f"timestampdiff(SECOND, {_EPOCH}, {parse_time_sql(sql_literal(as_of))})"
    met = rows.join(ends, _KEY, "left").selectExpr(
        "CASE WHEN session_key <> '' THEN substring(session_key, 2) END AS session_id",
        "action_time",
        f"timestampadd(SECOND, s, {_EPOCH}) AS t",
        f"{date_hour_sql('action_time')} AS date_hour",
        f"{fulfill_sql(hour_text_sql('action_time'))} AS hour_padded",
        "s - coalesce(near, carried) AS seconds_since_prev",
        "coalesce(s > first_s, false) AS after_session_start",
        "coalesce(s < last_s, false) AS before_session_end",
        f"coalesce(s < {now}, false) AS before_run",
        f"coalesce(s > {now}, false) AS after_run",
        f"coalesce(s - {now}, 0L) AS seconds_after_run",
    )
    day = as_of.split(" ")[0]
    return met.withColumns({
        "date_key": date_key(F.col("t")), "minute_key": minute_key(F.col("t")),
        "date_text": format_date(F.col("t")), "time_text": format_time(F.col("t")),
        "date_of_key": format_date(parse_date_key(date_key(F.col("t")))),
        "run_date": today(day), "day_before_run": yesterday(day),
    }).drop("t")
