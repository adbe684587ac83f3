"""Independent DuckDB SQL for every registered query (the correctness oracle).

Only the raw driver tables are registered as views in DuckDB, so each
statement inlines the fixture views as CTEs. The SQL states the semantics
directly (CASE, GROUP BY, window functions). It shares with the Spark plans the
parameter values and their parsing (``TaskParams``) and the fixed names and
bucket bounds of ``constants``; ``tests/`` checks those by hand-made rows.
"""

from __future__ import annotations

from .. import constants as C
from ..functions.params import TaskParams
from . import params_catalog as P

TWO_61 = 2305843009213693952
TWO_62 = 4611686018427387904


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def sql_list(items: list[str]) -> str:
    return ", ".join(q(x) for x in items)


def sql_half_up(d: str) -> str:
    """Half-up at 2 decimals of the exact binary value of the double ``d``."""
    return (
        f"(CAST(CAST(floor({d}) AS BIGINT) * 100 + "
        f"((CAST(trunc(({d} - floor({d})) * {TWO_61}) AS HUGEINT) * 200 + {TWO_61}) // {TWO_62}) "
        f"AS DOUBLE) / 100)"
    )


def sql_ratio(num: str, den: str) -> str:
    return sql_half_up(f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))")


_WORDS = "[" + ", ".join(q(w) for w in C.SEARCH_WORDS) + "]"

ACTIONS_CTE = f"""
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         (hour(ts) * 3600 + minute(ts) * 60 + second(ts))
           // (CASE user_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN 100 WHEN 3 THEN 1000 WHEN 4 THEN 10000 END)
           AS sq
  FROM events
),
uva AS (
  SELECT
    strftime(ts, '%Y-%m-%d') AS date,
    CASE WHEN event_id % 97 = 5 THEN CAST(0 AS BIGINT) ELSE user_id END AS user_id,
    CASE WHEN user_id % 10 = 0 THEN 'm' || CAST(user_id AS VARCHAR)
         WHEN user_id % 10 = 1 THEN 'h' || CAST(user_id AS VARCHAR) || '-' || (CASE WHEN day(ts) <= 15 THEN '1' ELSE '2' END)
         ELSE 'd' || CAST(user_id AS VARCHAR) || '-' || CAST(day(ts) AS VARCHAR) END AS session_id,
    CAST(event_id % 10 AS BIGINT) AS page_id,
    strftime(ts, '%Y-%m-%d') || ' ' || CAST(sq // 3600 AS VARCHAR) || ':'
      || lpad(CAST((sq % 3600) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(sq % 60 AS VARCHAR), 2, '0') AS action_time,
    CASE WHEN event_type = 'view' THEN {_WORDS}[k % 10 + 1] END AS search_keyword,
    CASE WHEN event_type = 'click' THEN CAST(k AS BIGINT) END AS click_category_id,
    CASE WHEN event_type = 'click' THEN CAST((k * 7) % 100 AS BIGINT) END AS click_product_id,
    CASE WHEN event_type = 'purchase' AND k % 2 = 0 THEN CAST((k * 3) % 100 AS VARCHAR) END AS order_category_ids,
    CASE WHEN event_type = 'purchase' AND k % 2 = 0 THEN CAST(k AS VARCHAR) END AS order_product_ids,
    CASE WHEN event_type = 'purchase' AND k % 2 = 1 THEN CAST((k * 3) % 100 AS VARCHAR) END AS pay_category_ids,
    CASE WHEN event_type = 'purchase' AND k % 2 = 1 THEN CAST(k AS VARCHAR) END AS pay_product_ids,
    CAST(user_id % 10 AS BIGINT) AS city_id
  FROM ev
)"""

USERS_CTE = """
ui AS (
  SELECT CAST(c_custkey AS BIGINT) AS user_id, 'user' || CAST(c_custkey AS VARCHAR) AS username, c_name AS name,
         CAST((c_custkey * 7) % 60 AS INTEGER) AS age, c_mktsegment AS professional, n_name AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE c_custkey % 17 <> 3
)"""

PRODUCTS_CTE = """
pi AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS product_name,
         '{"product_status": ' || CAST(p_partkey % 2 AS VARCHAR) || '}' AS extend_info
  FROM part
)"""

PARSED_TIME = "try_strptime(action_time, '%Y-%m-%d %H:%M:%S')"


def _date_where(params: TaskParams) -> str:
    return f"date >= {q(params.start_date)} AND date <= {q(params.end_date)}"


def _kw_hit(params: TaskParams) -> str:
    items = params.keyword_list()
    if items is None:
        return "TRUE"
    if not items:
        return "FALSE"
    return f"COALESCE(bool_or(COALESCE(list_has_any(string_split(search_keyword, ','), [{sql_list(items)}]), FALSE)), FALSE)"


def _cat_hit(params: TaskParams) -> str:
    items = params.category_list()
    if items is None:
        return "TRUE"
    if not items:
        return "FALSE"
    return (
        "COALESCE(bool_or(COALESCE(click_category_id <> 0 AND "
        f"CAST(click_category_id AS VARCHAR) IN ({sql_list(items)}), FALSE)), FALSE)"
    )


def sessions_cte(params: TaskParams, name: str = "sess") -> str:
    return f"""
{name} AS (
  SELECT session_id,
         COALESCE(MAX(CASE WHEN user_id <> 0 THEN user_id END), 0) AS user_id,
         COALESCE(array_to_string(list_sort(list(DISTINCT search_keyword)
             FILTER (WHERE search_keyword IS NOT NULL AND search_keyword <> '')), ','), '') AS search_keywords,
         COALESCE(array_to_string(list_sort(list(DISTINCT click_category_id)
             FILTER (WHERE click_category_id IS NOT NULL AND click_category_id <> 0)), ','), '') AS click_category_ids,
         CAST(date_sub('second', MIN({PARSED_TIME}), MAX({PARSED_TIME})) AS BIGINT) AS visit_length,
         CAST(COUNT(*) AS BIGINT) AS step_length,
         {_kw_hit(params)} AS kw_hit,
         {_cat_hit(params)} AS cat_hit
  FROM uva
  WHERE {_date_where(params)}
  GROUP BY session_id
)"""


def user_filter_sql(params: TaskParams) -> str:
    tests = []
    ages = params.age_range()
    if ages is not None:
        tests.append(f"age BETWEEN {ages[0]} AND {ages[1]}")
    for column, items in (("professional", params.professional_list()), ("city", params.city_list())):
        if items is not None:
            tests.append(f"list_has_any(string_split({column}, ','), [{sql_list(items)}])" if items else "FALSE")
    sex = params.sex_value()
    if sex is not None:
        tests.append(f"sex = {q(sex)}")
    tests += ["kw_hit", "cat_hit"]
    return "COALESCE(" + " AND ".join(tests) + ", FALSE)"


SESSION_USER_COLUMNS = (
    "s.session_id, s.user_id, s.search_keywords, s.click_category_ids, s.visit_length, s.step_length, "
    "u.age, u.professional, u.city, u.sex"
)


def kept_sessions_cte(params: TaskParams, filtered: bool = True) -> str:
    where = user_filter_sql(params) if filtered else "TRUE"
    return f"""{sessions_cte(params)},
kept AS (
  SELECT {SESSION_USER_COLUMNS}
  FROM sess s JOIN ui u ON s.user_id = u.user_id
  WHERE {where}
)"""


def _bucket_test(col: str, lo: int, hi: int | None) -> str:
    return f"{col} >= {lo}" if hi is None else f"{col} BETWEEN {lo} AND {hi}"


def counts_cte() -> str:
    cols = ["CAST(COUNT(*) AS BIGINT) AS session_count"]
    cols += [
        f"CAST(COUNT(*) FILTER (WHERE {_bucket_test('visit_length', lo, hi)}) AS BIGINT) AS visit_{n}"
        for n, lo, hi in C.VISIT_LENGTH_BUCKETS
    ]
    cols += [
        f"CAST(COUNT(*) FILTER (WHERE {_bucket_test('step_length', lo, hi)}) AS BIGINT) AS step_{n}"
        for n, lo, hi in C.STEP_LENGTH_BUCKETS
    ]
    return "counts AS (SELECT " + ", ".join(cols) + " FROM kept)"


def stat_select(taskid: str) -> str:
    cols = [f"CAST({taskid} AS BIGINT) AS taskid", "session_count"]
    cols += [
        f"{sql_ratio(f'visit_{n}', 'session_count')} AS {C.visit_ratio_column(n)}" for n, _, _ in C.VISIT_LENGTH_BUCKETS
    ]
    cols += [
        f"{sql_ratio(f'step_{n}', 'session_count')} AS {C.step_ratio_column(n)}" for n, _, _ in C.STEP_LENGTH_BUCKETS
    ]
    return "SELECT " + ", ".join(cols) + " FROM counts"


def session_aggr_stat_sql(params: TaskParams, taskid: int = C.LOCAL_SESSION_TASK_ID) -> str:
    return f"WITH {ACTIONS_CTE},{USERS_CTE},{kept_sessions_cte(params)},\n{counts_cte()}\n{stat_select(str(taskid))}"


def histogram_sql(params: TaskParams, kind: str) -> str:
    buckets = C.VISIT_LENGTH_BUCKETS if kind == "visit" else C.STEP_LENGTH_BUCKETS
    parts = ["SELECT 'session_count' AS bucket, session_count AS sessions FROM counts"]
    parts += [f"SELECT {q(n)} AS bucket, {kind}_{n} AS sessions FROM counts" for n, _, _ in buckets]
    body = "\nUNION ALL\n".join(parts)
    return f"WITH {ACTIONS_CTE},{USERS_CTE},{kept_sessions_cte(params, filtered=False)},\n{counts_cte()}\n{body}"


def action_date_range_sql(params: TaskParams) -> str:
    return f"WITH {ACTIONS_CTE}\nSELECT * FROM uva WHERE {_date_where(params)}"


def session_aggregate_sql(params: TaskParams) -> str:
    return (
        f"WITH {ACTIONS_CTE},{sessions_cte(params)}\n"
        "SELECT session_id, user_id, search_keywords, click_category_ids, visit_length, step_length FROM sess"
    )


def session_filter_sql(params: TaskParams, filtered: bool = True) -> str:
    return f"WITH {ACTIONS_CTE},{USERS_CTE},{kept_sessions_cte(params, filtered)}\nSELECT * FROM kept"


def by_task_sql(task_rows) -> str:
    """One single-task statement per task, glued with UNION ALL; tasks without
    both dates yield the empty-selection row."""
    parts = []
    for task_id, _name, text in task_rows:
        params = TaskParams.from_json(text)
        if params.start_date is None or params.end_date is None:
            empty = TaskParams(start_date="1", end_date="0")  # selects nothing
            parts.append(f"({session_aggr_stat_sql(empty, task_id)})")
        else:
            parts.append(f"({session_aggr_stat_sql(params, task_id)})")
    return "\nUNION ALL\n".join(parts)


def ratio_half_up_sql() -> str:
    return f"""WITH {ACTIONS_CTE}
SELECT user_id, CAST(COUNT(click_category_id) AS BIGINT) AS clicks, CAST(COUNT(*) AS BIGINT) AS actions,
       {sql_ratio('COUNT(click_category_id)', 'COUNT(*)')} AS click_ratio
FROM uva GROUP BY user_id"""


def product_status_sql() -> str:
    return f"""WITH {PRODUCTS_CTE}
SELECT product_id, product_name, CAST(json_extract_string(extend_info, '$.product_status') AS INTEGER) AS product_status
FROM pi"""


def action_time_keys_sql() -> str:
    return f"""WITH {ACTIONS_CTE},
a AS (SELECT session_id, action_time, {PARSED_TIME} AS t FROM uva),
d AS (
  SELECT session_id, t,
         lag(t) OVER (PARTITION BY session_id ORDER BY t) AS prev_t,
         min(t) OVER (PARTITION BY session_id) AS first_t,
         max(t) OVER (PARTITION BY session_id) AS last_t
  FROM (SELECT DISTINCT session_id, t FROM a WHERE t IS NOT NULL) x
)
SELECT a.session_id, a.action_time,
       split_part(a.action_time, ' ', 1) || '_' || split_part(split_part(a.action_time, ' ', 2), ':', 1) AS date_hour,
       CASE WHEN length(split_part(split_part(a.action_time, ' ', 2), ':', 1)) = 2
            THEN split_part(split_part(a.action_time, ' ', 2), ':', 1)
            ELSE '0' || split_part(split_part(a.action_time, ' ', 2), ':', 1) END AS hour_padded,
       strftime(a.t, '%Y%m%d') AS date_key,
       strftime(a.t, '%Y%m%d%H%M') AS minute_key,
       CAST(date_sub('second', d.prev_t, a.t) AS BIGINT) AS seconds_since_prev,
       COALESCE(a.t > d.first_t, FALSE) AS after_session_start,
       COALESCE(a.t < d.last_t, FALSE) AS before_session_end,
       COALESCE(a.t < run.at, FALSE) AS before_run,
       COALESCE(a.t > run.at, FALSE) AS after_run,
       COALESCE(CAST(date_diff('second', run.at, a.t) AS BIGINT), 0) AS seconds_after_run,
       strftime(a.t, '%Y-%m-%d') AS date_text,
       strftime(a.t, '%Y-%m-%d %H:%M:%S') AS time_text,
       strftime(strptime(strftime(a.t, '%Y%m%d'), '%Y%m%d'), '%Y-%m-%d') AS date_of_key,
       '2024-01-15' AS run_date,
       '2024-01-14' AS day_before_run
FROM (SELECT TIMESTAMP '2024-01-15 12:00:00' AS at) run CROSS JOIN a LEFT JOIN d ON a.session_id IS NOT DISTINCT FROM d.session_id AND a.t = d.t"""


def _kv_get(record: str, field: str) -> str:
    """First piece that is the name, ``=``, a value and nothing but ``=`` after it."""
    value = "split_part(p, '=', 2)"
    valid = f"{value} <> '' AND rtrim(p, '=') = {q(field + '=')} || {value}"
    return f"split_part(list_filter(string_split({record}, '|'), lambda p: {valid})[1], '=', 2)"


def _trim_comma(x: str) -> str:
    return f"regexp_replace({x}, '^,|,$', '', 'g')"


def kv_record_roundtrip_sql(params: TaskParams) -> str:
    fields = [
        (C.FIELD_SESSION_ID, "session_id"), (C.FIELD_SEARCH_KEYWORDS, "search_keywords"),
        (C.FIELD_CLICK_CATEGORY_IDS, "click_category_ids"), (C.FIELD_VISIT_LENGTH, "visit_length"),
        (C.FIELD_STEP_LENGTH, "step_length"), (C.FIELD_AGE, "age"), (C.FIELD_PROFESSIONAL, "professional"),
        (C.FIELD_CITY, "city"), (C.FIELD_SEX, "sex"),
    ]
    record = "concat_ws('|', " + ", ".join(f"{q(n + '=')} || CAST({c} AS VARCHAR)" for n, c in fields) + ")"
    step = C.FIELD_STEP_LENGTH
    pieces = r"string_split(regexp_replace(record, '\|+$', ''), '|')"
    bumped = (
        f"array_to_string(list_transform({pieces}, lambda p, i: CASE WHEN i = "
        f"list_position(list_transform({pieces}, lambda x: split_part(x, '=', 1)), {q(step)}) "
        f"THEN {q(step + '=')} || CAST(step_length + 1 AS VARCHAR) ELSE p END), '|')"
    )
    r = "bumped_record"
    return f"""WITH {ACTIONS_CTE},{USERS_CTE},{kept_sessions_cte(params, filtered=False)},
enc AS (SELECT session_id, step_length, {record} AS record FROM kept),
bump AS (SELECT session_id, record, {bumped} AS bumped_record FROM enc)
SELECT session_id, record, bumped_record,
       {_trim_comma(_kv_get(r, C.FIELD_SEARCH_KEYWORDS))} AS search_keywords,
       {_trim_comma(_kv_get(r, C.FIELD_CLICK_CATEGORY_IDS))} AS click_category_ids,
       CAST({_kv_get(r, C.FIELD_VISIT_LENGTH)} AS BIGINT) AS visit_length,
       CAST({_kv_get(r, C.FIELD_STEP_LENGTH)} AS BIGINT) AS step_length,
       CAST({_kv_get(r, C.FIELD_AGE)} AS INTEGER) AS age,
       {_kv_get(r, C.FIELD_PROFESSIONAL)} AS professional,
       {_kv_get(r, C.FIELD_CITY)} AS city,
       {_kv_get(r, C.FIELD_SEX)} AS sex
FROM bump"""


def _category_ctes(params: TaskParams) -> str:
    return f"""{ACTIONS_CTE},{USERS_CTE},{kept_sessions_cte(params)},
act AS (SELECT * FROM uva WHERE {_date_where(params)} AND EXISTS (SELECT 1 FROM kept k WHERE k.session_id IS NOT DISTINCT FROM uva.session_id)),
cev AS (
  SELECT session_id, click_category_id AS cid, 1 AS c, 0 AS o, 0 AS p FROM act WHERE click_category_id IS NOT NULL
  UNION ALL
  SELECT session_id, TRY_CAST(x AS BIGINT), 0, 1, 0
  FROM (SELECT session_id, unnest(string_split(order_category_ids, ',')) AS x FROM act WHERE order_category_ids IS NOT NULL) o
  UNION ALL
  SELECT session_id, TRY_CAST(x AS BIGINT), 0, 0, 1
  FROM (SELECT session_id, unnest(string_split(pay_category_ids, ',')) AS x FROM act WHERE pay_category_ids IS NOT NULL) y
),
tot AS (
  SELECT cid, SUM(c) AS clicks, SUM(o) AS orders, SUM(p) AS pays FROM cev
  WHERE cid IS NOT NULL AND cid <> 0 GROUP BY cid
),
topc AS (
  SELECT * FROM tot ORDER BY clicks DESC, orders DESC, pays DESC, cid ASC LIMIT {10}
)"""


def top10_category_sql(params: TaskParams, taskid: int) -> str:
    return f"""WITH {_category_ctes(params)}
SELECT CAST({taskid} AS BIGINT) AS taskid, cid AS categoryid, CAST(clicks AS BIGINT) AS clickCount,
       CAST(orders AS BIGINT) AS orderCount, CAST(pays AS BIGINT) AS payCount
FROM topc"""


def top10_session_sql(params: TaskParams, taskid: int) -> str:
    return f"""WITH {_category_ctes(params)},
per AS (
  SELECT session_id, click_category_id AS cid, COUNT(*) AS clicks FROM act
  WHERE click_category_id IS NOT NULL AND click_category_id <> 0 GROUP BY session_id, click_category_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cid ORDER BY clicks DESC, session_id ASC) AS rn
  FROM per WHERE cid IN (SELECT cid FROM topc)
)
SELECT CAST({taskid} AS BIGINT) AS taskid, cid AS categoryid, session_id AS sessionid, CAST(clicks AS BIGINT) AS clickCount
FROM ranked WHERE rn <= 10"""


def page_convert_sql(params: TaskParams) -> str:
    flow = params.page_flow()
    hops = ", ".join(f"({i + 1}, {flow[i]}, {flow[i + 1]})" for i in range(len(flow) - 1))
    return f"""WITH {ACTIONS_CTE},
a AS (SELECT session_id, page_id, {PARSED_TIME} AS t FROM uva WHERE {_date_where(params)}),
s AS (
  SELECT page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY t, page_id) AS next_page
  FROM a WHERE t IS NOT NULL
),
hops AS (SELECT * FROM (VALUES {hops}) h(hop_index, from_page, to_page)),
cnt AS (
  SELECT h.hop_index, CAST(h.from_page AS BIGINT) AS from_page, CAST(h.to_page AS BIGINT) AS to_page,
         CAST((SELECT COUNT(*) FROM s WHERE s.page_id = h.from_page AND s.next_page = h.to_page) AS BIGINT) AS hop_count
  FROM hops h
),
chain AS (
  SELECT 0 AS hop_index, CAST(NULL AS BIGINT) AS from_page, CAST({flow[0]} AS BIGINT) AS to_page,
         CAST(COUNT(*) AS BIGINT) AS hop_count
  FROM a WHERE t IS NOT NULL AND page_id = {flow[0]}
  UNION ALL SELECT * FROM cnt
),
rated AS (SELECT *, lag(hop_count) OVER (ORDER BY hop_index) AS prev FROM chain)
SELECT CAST(hop_index AS INTEGER) AS hop_index, from_page, to_page, hop_count, {sql_ratio('hop_count', 'prev')} AS rate
FROM rated WHERE hop_index >= 1"""


def oracle_queries() -> dict[str, str]:
    out = {
        "action_date_range": action_date_range_sql(P.FLAGSHIP),
        "session_aggregate": session_aggregate_sql(P.FLAGSHIP),
        "session_user_join": session_filter_sql(P.FLAGSHIP, filtered=False),
        "visit_length_histogram": histogram_sql(P.FLAGSHIP, "visit"),
        "step_length_histogram": histogram_sql(P.FLAGSHIP, "step"),
        "session_aggr_stat": session_aggr_stat_sql(P.FLAGSHIP),
        "session_aggr_stat_filtered": session_aggr_stat_sql(P.FILTERS["all"]),
        "session_aggr_stat_empty": session_aggr_stat_sql(P.EMPTY),
        "session_aggr_stat_by_task": by_task_sql(P.TASK_ROWS),
        "ratio_half_up": ratio_half_up_sql(),
        "product_status": product_status_sql(),
        "action_time_keys": action_time_keys_sql(),
        "kv_record_roundtrip": kv_record_roundtrip_sql(P.FLAGSHIP),
        "top10_category": top10_category_sql(P.FLAGSHIP, P.TASK_ID),
        "top10_session": top10_session_sql(P.FLAGSHIP, P.TASK_ID),
        "top10_category_filtered": top10_category_sql(P.FILTERS["keyword"], P.TASK_ID),
        "top10_session_filtered": top10_session_sql(P.FILTERS["keyword"], P.TASK_ID),
        "page_one_step_convert_rate": page_convert_sql(P.TOP_PAGE_FLOW),
    }
    for name, params in P.FILTERS.items():
        out[f"session_filter_{name}"] = session_filter_sql(params)
    return out

