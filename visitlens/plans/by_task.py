"""Many analysis tasks in one Spark job (one result row per task).

The original job answers one task per submission. Here every step is a lazy
join or aggregation, whatever the number of tasks:

1. the distinct (start, end) windows of the tasks are turned into (window,
   date) rows by their places in the sorted list of dates, windows' starts and
   ends (no range join);
2. actions of those dates only are reduced to one fixed-width row per
   (session, date), and re-aggregated once per distinct *window* and session.
   On a table partitioned by date only the windows' partitions are read;
3. sessions join their user once and are counted into *attribute cells*: window,
   age, profession, city, sex, duration bucket, step bucket. Their number is
   bounded by the attributes' values, not by sessions or tasks;
4. a task with keywords or categories looks at the sessions that have one of
   them. Tasks of one window with the same two lists share a *list set*; the
   (set, session) pairs are found by joining each action's values with the sets'
   values, and counted into cells of the set. All sessions are the empty set;
5. tasks join the cells of their set, never sessions. The conditions of a task
   are one predicate over a cell, the counts one ``groupBy``.

No join carries a hint: AQE measures the sides at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.params import task_param_columns
from ..functions.timekeys import parse_time_sql
from ..operators.stats import bucket_number_sql, bucket_sum_columns, with_ratios

WINDOW = ["start_date", "end_date"]


def window_dates(dates: DataFrame, windows: DataFrame) -> DataFrame:
    """(start_date, end_date, date): each distinct ``date`` inside each window
    (string compare, both ends included).

    Starts, dates and ends are sorted together; the running number of dates
    gives each window a first and a last place, and places are joined by
    equality. The sorted list has a row per distinct date and window."""
    # at equal text a start sorts before the date and an end after it
    ends = "inline(array(struct(start_date AS text, 0 AS kind), struct(end_date AS text, 2 AS kind)))"
    marks = windows.where("start_date IS NOT NULL AND end_date IS NOT NULL").selectExpr(*WINDOW, ends)
    marks = marks.unionByName(dates.selectExpr("date AS text", "1 AS kind"), allowMissingColumns=True)
    placed = marks.selectExpr("*", "count_if(kind = 1) OVER (ORDER BY text, kind) AS place")
    at = placed.where("kind = 1").selectExpr("text AS date", "place")
    places = placed.where("kind <> 1").groupBy(*WINDOW).agg(
        F.expr("min(CASE WHEN kind = 0 THEN place + 1 END) AS lo"), F.expr("min(CASE WHEN kind = 2 THEN place END) AS hi")
    )
    places = places.where("lo <= hi").selectExpr(*WINDOW, "explode(sequence(lo, hi)) AS place")
    return places.join(at, "place").select(*WINDOW, "date")


def date_intervals(windows: DataFrame) -> DataFrame:
    """One row (lo, hi, intervals): the outermost bounds, and the windows merged
    into intervals apart from each other, no more than the distinct windows or
    dates are. One sort of the distinct windows."""
    order = "ORDER BY start_date, end_date"
    rows = windows.where("start_date <= end_date").selectExpr(
        *WINDOW,
        f"max(end_date) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier",
        f"max(end_date) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi",
        f"lead(start_date) OVER ({order}) AS next_start",
    )
    first = "CASE WHEN earlier IS NULL OR start_date > earlier THEN start_date END"
    lo = f"last_value({first}) IGNORE NULLS OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lo"
    apart = rows.selectExpr("hi", "next_start", lo).where("next_start IS NULL OR next_start > hi")
    found = apart.agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("intervals"))
    return found.selectExpr("get(intervals, 0).lo AS lo", "try_element_at(intervals, -1).hi AS hi", "intervals")


def inside_windows(actions: DataFrame, windows: DataFrame) -> DataFrame:
    """``actions`` without those whose date lies in no window. The test is made of
    one-row subqueries that run before the scan: partitions of a table partitioned
    by date are chosen by it, and the reader skips row groups by the outermost
    bounds. (Dynamic pruning by a join needs the dates broadcast, whatever their
    number.)"""
    found = date_intervals(windows)
    lo, hi, intervals = (found.select(c).scalar() for c in ("lo", "hi", "intervals"))
    # a lambda may not hold a subquery, but a column of one
    within = F.exists("_intervals", lambda w: F.col("date").between(w["lo"], w["hi"]))
    return actions.where(F.col("date").between(lo, hi)).withColumn("_intervals", intervals).where(within).drop("_intervals")


#: The session as a text that is never NULL, for groups and joins; the NULL
#: session is a session too.
_SESSION_KEY = "coalesce(concat('_', session_id), '') AS session_key"


def session_days(actions: DataFrame) -> DataFrame:
    """One fixed-width row per (session, date). A task's window selects whole
    dates, so its sessions are the re-aggregation of these rows."""
    rows = actions.selectExpr(_SESSION_KEY, "date", "CASE WHEN user_id <> 0 THEN user_id END AS user", f"{parse_time_sql('action_time')} AS t")
    return rows.groupBy("session_key", "date").agg(
        F.expr("max(user) AS user_max"), F.expr("min(t) AS t_min"), F.expr("max(t) AS t_max"), F.expr("count(1) AS steps")
    )


_SESSION_AGGS = (
    "coalesce(max(user_max), 0L) AS user_id",
    "min(t_min) AS _start",
    "max(t_max) AS _end",
    "sum(steps) AS step_length",
)

USER_ATTRIBUTES = ("age", "professional", "city", "user_sex")
CELL = (*USER_ATTRIBUTES, "visit_bucket", "step_bucket")

# A task's user filters as one predicate over a joined (cell, task) row.
_KEEP = (
    "NOT age_bad"
    " AND (age_lo IS NULL OR age BETWEEN age_lo AND age_hi)"
    " AND (professionals IS NULL OR arrays_overlap(professionals, split(professional, ',', -1)))"
    " AND (cities IS NULL OR arrays_overlap(cities, split(city, ',', -1)))"
    " AND (sex IS NULL OR sex = user_sex)"
)

#: List parameter of a task: the values of an action as an array. A list is
#: known by its number here.
_VALUES = {
    "keywords": "split(search_keyword, ',', -1)",
    "category_ids": "CASE WHEN click_category_id <> 0 THEN array(CAST(click_category_id AS STRING)) END",
}


def window_sessions(actions: DataFrame, dates: DataFrame) -> DataFrame:
    """(start_date, end_date, session_key, user_id, visit_bucket, step_bucket)."""
    return (
        session_days(actions)
        .join(dates, "date")
        .groupBy(*WINDOW, "session_key")
        .agg(*[F.expr(a) for a in _SESSION_AGGS])
        .selectExpr(*WINDOW, "session_key", "user_id", "step_length", "timestampdiff(SECOND, _start, _end) AS visit_length")
        .selectExpr(
            *WINDOW, "session_key", "user_id",
            f"{bucket_number_sql('visit_length', C.VISIT_LENGTH_BUCKETS)} AS visit_bucket",
            f"{bucket_number_sql('step_length', C.STEP_LENGTH_BUCKETS)} AS step_bucket",
        )
    )


def set_hits(actions: DataFrame, dates: DataFrame, sets: DataFrame) -> DataFrame:
    """(start_date, end_date, session_key, set_key, nth): the sessions whose
    actions in the window have a value of each list that the set has; ``nth``
    numbers a session's sets."""
    values = [f"transform({sql}, x -> struct({kind} AS kind, x AS value))" for kind, sql in enumerate(_VALUES.values())]
    found = actions.selectExpr(_SESSION_KEY, "date", f"explode(concat({', '.join(f'coalesce({v}, array())' for v in values)})) AS v")
    found = found.select("session_key", "date", "v.kind", "v.value").distinct()
    pairs = ", ".join(f"transform(coalesce({k}, array()), x -> struct({kind} AS kind, x AS value))" for kind, k in enumerate(_VALUES))
    lists = " + ".join(f"CAST({k} IS NOT NULL AS INT)" for k in _VALUES)
    wanted = sets.where("set_key IS NOT NULL").selectExpr(*WINDOW, "set_key", f"{lists} AS lists", f"inline(concat({pairs}))")
    on_date = wanted.join(dates, WINDOW)  # the dates on which a set has a value
    by_set = found.join(on_date, ["date", "kind", "value"]).groupBy(*WINDOW, "session_key", "set_key", "lists")
    both = by_set.agg(F.expr("min(kind)").alias("a"), F.expr("max(kind)").alias("b")).where("lists = 1 OR a <> b")
    nth = f"row_number() OVER (PARTITION BY {', '.join(WINDOW)}, session_key ORDER BY set_key) AS nth"
    return both.selectExpr(*WINDOW, "session_key", "set_key", nth)


def attribute_cells(sessions: DataFrame, hits: DataFrame, users: DataFrame) -> DataFrame:
    """(start_date, end_date, set_key, CELL, n): how many sessions of each list
    set share attributes; the empty set (NULL) has all sessions."""
    of_user = users.selectExpr("user_id", "age", "professional", "city", "sex AS user_sex")
    rows = sessions.join(hits, [*WINDOW, "session_key"], "left").join(of_user, "user_id")
    counts = rows.groupBy(*WINDOW, "set_key", *CELL).agg(F.expr("count(1) AS n"), F.expr("count_if(coalesce(nth, 1) = 1) AS once"))
    # a session's rows are its sets; the first of them counts it for the empty set
    both = "inline(array(struct(set_key, CASE WHEN set_key IS NOT NULL THEN n ELSE 0L END AS n), struct(CAST(NULL AS BIGINT) AS set_key, once AS n)))"
    return counts.selectExpr(*WINDOW, *CELL, both).where("n > 0")


def session_aggr_stat_by_task(actions: DataFrame, users: DataFrame, tasks: DataFrame) -> DataFrame:
    """17-column stat rows, one per row of ``tasks`` (task_id, task_param)."""
    every = task_param_columns(tasks).withColumn("task_key", F.xxhash64("task_id", "start_date", "end_date", *_PARAMS))
    asked = every.drop("task_id").distinct()
    none = " AND ".join(f"{k} IS NULL" for k in _VALUES)
    asked = asked.withColumn("set_key", F.expr(f"CASE WHEN NOT ({none}) THEN xxhash64({', '.join(f'to_json(struct({k}))' for k in _VALUES)}) END"))
    windows = asked.select(*WINDOW).distinct()
    near = inside_windows(actions, windows)
    dates = window_dates(near.select("date").distinct(), windows)

    hits = set_hits(near, dates, asked.select(*WINDOW, *_VALUES, "set_key").distinct())
    cells = attribute_cells(window_sessions(near, dates), hits, users)
    # the empty set is NULL on both sides
    set_of = cells.withColumnsRenamed({c: f"cell_{c}" for c in (*WINDOW, "set_key")})
    same = [*[F.col(c) == F.col(f"cell_{c}") for c in WINDOW], F.col("set_key").eqNullSafe(F.col("cell_set_key"))]
    kept = asked.join(set_of, same).where(_KEEP)
    counts = kept.groupBy("task_key").agg(*bucket_sum_columns("n", "visit_bucket", "step_bucket"))

    # Every task gets a row, even when it selected nothing.
    filled = every.select("task_id", "task_key").join(counts, "task_key", "left").selectExpr(
        "task_id", *[f"coalesce({c}, 0L) AS {c}" for c in counts.columns if c != "task_key"]
    )
    return with_ratios(filled, "task_id")


_PARAMS = ("age_lo", "age_hi", "age_bad", "professionals", "cities", "sex", "keywords", "category_ids")
