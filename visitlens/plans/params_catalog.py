"""Parameters of the registered queries (shared by the Spark plans and the SQL oracle).

Filter values come from the value domains of the derived fixture tables:
professions are TPC-H market segments, cities are nation names.
"""

from __future__ import annotations

from ..constants import LOCAL_SESSION_TASK_ID
from ..functions.params import TaskParams

START, END = "2024-01-05", "2024-01-20"
TASK_ID = LOCAL_SESSION_TASK_ID

FLAGSHIP = TaskParams(start_date=START, end_date=END)

FILTERS = {
    "age": TaskParams(start_date=START, end_date=END, start_age="20", end_age="40"),
    "professional": TaskParams(start_date=START, end_date=END, professionals="BUILDING,MACHINERY"),
    "city": TaskParams(start_date=START, end_date=END, cities="NATION_2,NATION_7,NATION_11,NATION_20"),
    "sex": TaskParams(start_date=START, end_date=END, sex="female"),
    "keyword": TaskParams(start_date=START, end_date=END, keywords="火锅,新辣道鱼火锅"),
    "category": TaskParams(start_date=START, end_date=END, category_ids="3,17,42,5,64,88"),
    "all": TaskParams(
        start_date=START, end_date=END, start_age="5", end_age="55",
        professionals="AUTOMOBILE,BUILDING,FURNITURE,HOUSEHOLD",
        cities=",".join(f"NATION_{i}" for i in range(0, 25, 2)),
        sex="male", keywords="火锅,蛋糕,重庆小面,温泉,日本料理",
        category_ids=",".join(str(i) for i in range(0, 100, 3)),
    ),
}

# Ages end at 59, which only the data tell: the scans are not folded away.
EMPTY = TaskParams(start_date=START, end_date=END, start_age="60", end_age="99")

TOP_PAGE_FLOW = TaskParams(start_date=START, end_date=END, target_page_flow="1,2,3,4,5,6")

# The task table of the by-task job: (task_id, task_name, task_param JSON).
# Covers no filter, each filter alone, all filters, a one-sided age range, an
# empty array, an empty string, a multi-value list, a two-element array (only
# element 0 counts), a list of commas only (matches nothing) and a task
# without dates (matches nothing).
TASK_ROWS = (
    (1, "no filter", '{"startDate":["2024-01-05"],"endDate":["2024-01-20"]}'),
    (2, "local session task", '{"startDate":["2024-01-01"],"endDate":["2024-01-31"]}'),
    (3, "age", '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"startAge":["20"],"endAge":["40"]}'),
    (4, "professional", '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"professionals":["BUILDING,MACHINERY"]}'),
    (5, "city", '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"cities":["NATION_2,NATION_7"]}'),
    (6, "sex", '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"sex":["female"]}'),
    (7, "keyword", '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"keywords":["火锅,温泉"]}'),
    (8, "category", '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"categoryIds":["3,17,42"]}'),
    (9, "all filters",
     '{"startDate":["2024-01-03"],"endDate":["2024-01-25"],"startAge":["10"],"endAge":["50"],'
     '"professionals":["AUTOMOBILE,BUILDING,FURNITURE"],"sex":["male"],"keywords":["火锅,蛋糕,温泉"],'
     '"categoryIds":["1,2,3,4,5,6,7,8,9,10,20,30,40,50,60,70,80,90"]}'),
    (10, "one-sided age", '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"startAge":["30"]}'),
    (11, "empty array", '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"keywords":[]}'),
    (12, "empty string", '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"sex":[""]}'),
    (13, "multi-value", '{"startDate":["2024-01-10"],"endDate":["2024-01-12"],"cities":["NATION_1,NATION_3,NATION_5,NATION_9"]}'),
    (14, "two-element array", '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"sex":["male","female"]}'),
    (15, "only commas", '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"categoryIds":[",,"]}'),
    (16, "no dates", '{"sex":["male"]}'),
)
