"""Fixed values that must equal the original job's for results to agree.

Everything below is a value, not logic: names of task parameters, names of
the key=value record fields, the duration / step buckets, the words used by
the action fixture and the task id the original job runs locally.
"""

from __future__ import annotations

# --- fixed values: task parameter names (JSON keys of task_param) ----------
PARAM_START_DATE = "startDate"
PARAM_END_DATE = "endDate"
PARAM_START_AGE = "startAge"
PARAM_END_AGE = "endAge"
PARAM_PROFESSIONALS = "professionals"
PARAM_CITIES = "cities"
PARAM_SEX = "sex"
PARAM_KEYWORDS = "keywords"
PARAM_CATEGORY_IDS = "categoryIds"
PARAM_TARGET_PAGE_FLOW = "targetPageFlow"

# --- fixed values: field names of the key=value session record -------------
FIELD_SESSION_ID = "sessionid"
FIELD_SEARCH_KEYWORDS = "searchKeywords"
FIELD_CLICK_CATEGORY_IDS = "clickCategoryIds"
FIELD_AGE = "age"
FIELD_PROFESSIONAL = "professional"
FIELD_CITY = "city"
FIELD_SEX = "sex"
FIELD_VISIT_LENGTH = "visitLength"
FIELD_STEP_LENGTH = "stepLength"

# --- fixed values: task id of the local session job -------------------------
LOCAL_SESSION_TASK_ID = 2

# --- fixed values: visit-length buckets (seconds), inclusive bounds ---------
# (name, lowest value, highest value); None = unbounded above.
# A 0-second session falls in none of them.
VISIT_LENGTH_BUCKETS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)

# --- fixed values: step-length buckets (actions per session), inclusive -----
STEP_LENGTH_BUCKETS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)

# --- fixed values: the ten search words of the action fixture, in order -----
SEARCH_WORDS = (
    "火锅", "蛋糕", "重庆辣子鸡", "重庆小面", "呷哺呷哺",
    "新辣道鱼火锅", "国贸大厦", "太古商场", "日本料理", "温泉",
)

SESSION_COUNT = "session_count"


def visit_ratio_column(bucket: str) -> str:
    return f"visit_length_{bucket}_ratio"


def step_ratio_column(bucket: str) -> str:
    return f"step_length_{bucket}_ratio"


# Column order of the session_aggr_stat result row.
STAT_COLUMNS = (
    ("taskid", SESSION_COUNT)
    + tuple(visit_ratio_column(b) for b, _, _ in VISIT_LENGTH_BUCKETS)
    + tuple(step_ratio_column(b) for b, _, _ in STEP_LENGTH_BUCKETS)
)
