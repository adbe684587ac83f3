"""Hand-made golden sessions (FIXTURES.md §5), worked out from the original rules."""

from __future__ import annotations

import pytest

from visitlens.functions.params import TaskParams
from visitlens.operators.sessions import aggregate_sessions, scan_actions
from visitlens.plans.session_stat import session_aggr_stat, sessions_for_task

WINDOW = dict(start_date="2024-01-01", end_date="2024-01-01")


def test_session_aggregate(golden):
    actions, _ = golden
    got = {r["session_id"]: r.asDict() for r in aggregate_sessions(actions, with_lists=True).collect()}
    assert got["s1"] == dict(session_id="s1", user_id=1, search_keywords="火锅", click_category_ids="5",
                             visit_length=2, step_length=2)
    assert got["s2"]["search_keywords"] == "蛋糕" and got["s2"]["click_category_ids"] == ""
    assert got["s2"]["visit_length"] == 0
    # exact membership: 火锅 is kept next to 新辣道鱼火锅, 5 next to 15
    assert got["s3"]["search_keywords"] == "新辣道鱼火锅,火锅"
    assert got["s3"]["click_category_ids"] == "5,15"
    assert (got["s3"]["visit_length"], got["s3"]["step_length"]) == (3291, 4)
    # user 0 is not a user; category 0 is not a category
    assert (got["s5"]["user_id"], got["s5"]["click_category_ids"], got["s5"]["visit_length"]) == (3, "", 10)
    assert got["s4"]["user_id"] == 9


def test_join_drops_sessions_without_user(golden):
    actions, users = golden
    kept = sessions_for_task(actions, users, TaskParams(**WINDOW), apply_filters=False)
    assert sorted(r.session_id for r in kept.collect()) == ["s1", "s2", "s3", "s5"]


def test_unfiltered_stat_row(golden):
    actions, users = golden
    row = session_aggr_stat(actions, users, TaskParams(**WINDOW)).first().asDict()
    assert row["taskid"] == 2 and row["session_count"] == 4
    assert row["visit_length_1s_3s_ratio"] == 0.25
    assert row["visit_length_10s_30s_ratio"] == 0.25
    assert row["visit_length_30m_ratio"] == 0.25
    # s2 lasts 0 s: in no duration bucket, so the duration ratios sum to 0.75
    for b in ("4s_6s", "7s_9s", "30s_60s", "1m_3m", "3m_10m", "10m_30m"):
        assert row[f"visit_length_{b}_ratio"] == 0.0
    assert row["step_length_1_3_ratio"] == 0.75 and row["step_length_4_6_ratio"] == 0.25
    for b in ("7_9", "10_30", "30_60", "60"):
        assert row[f"step_length_{b}_ratio"] == 0.0


@pytest.mark.parametrize(
    "params, expected",
    [
        (dict(keywords="火锅"), ["s1", "s3"]),
        (dict(category_ids="5"), ["s1", "s3"]),
        (dict(keywords="蛋糕,温泉"), ["s2", "s5"]),
        (dict(sex="male"), ["s1", "s3", "s5"]),
        (dict(start_age="25", end_age="35"), ["s1", "s3"]),
        (dict(start_age="25"), ["s1", "s2", "s3", "s5"]),  # one-sided age range: no filter
        (dict(cities="cityB"), ["s2", "s5"]),
        (dict(professionals="teacher,doctor"), ["s1", "s2", "s3", "s5"]),
        (dict(sex="x"), []),
        (dict(keywords=""), ["s1", "s2", "s3", "s5"]),  # empty string: no filter
        (dict(keywords=",,"), []),  # only commas: matches nothing
        (dict(category_ids="0"), []),  # category 0 never counts as clicked
        (dict(category_ids="05"), []),  # ids compare as text
        (dict(sex="male", keywords="火锅", category_ids="15"), ["s3"]),
    ],
)
def test_filters(golden, params, expected):
    actions, users = golden
    kept = sessions_for_task(actions, users, TaskParams(**WINDOW, **params))
    assert sorted(r.session_id for r in kept.collect()) == expected


def test_empty_selection_gives_null_ratios(golden):
    actions, users = golden
    row = session_aggr_stat(actions, users, TaskParams(**WINDOW, sex="x")).first().asDict()
    assert row["session_count"] == 0
    assert all(v is None for k, v in row.items() if k.endswith("_ratio"))


def test_date_range_is_inclusive_string_compare(golden):
    actions, _ = golden
    assert scan_actions(actions, "2024-01-01", "2024-01-01").count() == 10
    assert scan_actions(actions, "2024-01-02", "2024-01-09").count() == 0
    assert scan_actions(actions, "", "2024-01-01").count() == 10  # '' sorts before every date


def test_missing_dates_raise(golden):
    from visitlens.functions.params import TaskError

    actions, users = golden
    with pytest.raises(TaskError):
        session_aggr_stat(actions, users, TaskParams(sex="male"))


def test_unparseable_time_counts_as_step_only(spark):
    from conftest import ACTION_SCHEMA, action_rows

    rows = [("s", 1, "2024-01-01 10:00:00", None, None), ("s", 1, "2024-01-01 xx", None, None),
            ("s", 1, "2024-01-01 10:00:05", None, None)]
    df = spark.createDataFrame(action_rows(rows), ACTION_SCHEMA)
    r = aggregate_sessions(df).first()
    assert (r.visit_length, r.step_length) == (5, 3)
