from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from visitlens.session import build_session

    s = build_session("local[4]", app_name="visitlens-tests", shuffle_partitions=8)
    yield s
    s.stop()


ACTION_SCHEMA = (
    "date string, user_id bigint, session_id string, page_id bigint, action_time string, search_keyword string, "
    "click_category_id bigint, click_product_id bigint, order_category_ids string, order_product_ids string, "
    "pay_category_ids string, pay_product_ids string, city_id bigint"
)
USER_SCHEMA = "user_id bigint, username string, name string, age int, professional string, city string, sex string"


def action_rows(rows):
    """(session, user, time, keyword, category[, page, order_ids, pay_ids]) -> 13-column rows."""
    out = []
    for r in rows:
        sid, user, time, kw, cat = r[:5]
        page = r[5] if len(r) > 5 else 0
        order_ids = r[6] if len(r) > 6 else None
        pay_ids = r[7] if len(r) > 7 else None
        date = time.split(" ")[0]
        out.append((date, user, sid, page, time, kw, cat, None, order_ids, None, pay_ids, None, 0))
    return out


@pytest.fixture(scope="session")
def golden(spark):
    """The hand-made sessions of FIXTURES.md §5."""
    d = "2024-01-01"
    rows = [
        ("s1", 1, f"{d} 10:00:00", "火锅", None),
        ("s1", 1, f"{d} 10:00:02", None, 5),
        ("s2", 2, f"{d} 9:00:00", "蛋糕", None),
        ("s3", 1, f"{d} 7:05:09", "新辣道鱼火锅", None),
        ("s3", 1, f"{d} 7:30:00", "火锅", None),
        ("s3", 1, f"{d} 8:00:00", None, 15),
        ("s3", 1, f"{d} 8:00:00", None, 5),
        ("s4", 9, f"{d} 1:00:00", "火锅", None),
        ("s5", 0, f"{d} 0:00:00", None, 0),
        ("s5", 3, f"{d} 0:00:10", "温泉", None),
    ]
    actions = spark.createDataFrame(action_rows(rows), ACTION_SCHEMA)
    users = spark.createDataFrame(
        [
            (1, "user1", "n1", 30, "teacher", "cityA", "male"),
            (2, "user2", "n2", 20, "doctor", "cityB", "female"),
            (3, "user3", "n3", 40, "teacher", "cityB", "male"),
        ],
        USER_SCHEMA,
    )
    return actions, users
