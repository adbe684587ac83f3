"""Physical-plan properties the scale design relies on, and a hot-session input."""

from __future__ import annotations

import re

import pandas as pd
import pytest

from conftest import ACTION_SCHEMA, SF_SMALL, action_rows
from visitlens.operators.timeline import action_time_keys
from visitlens.plans import catalog

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_text(q(spark, SF_SMALL)) for name, q in catalog.queries().items()}


def test_every_query_scans_the_driver_tables(spark):
    """The executed plan of each query scans parquet: nothing is proved empty
    or read from literal rows alone."""
    for name, query in catalog.queries().items():
        df = query(spark, SF_SMALL)
        df.collect()
        assert "FileScan parquet" in plan_text(df), name


def test_user_filters_reach_the_user_scan(spark):
    text = plan_text(catalog.queries()["session_filter_professional"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*In\(c_mktsegment, \[BUILDING,MACHINERY\]\)", text)
    text = plan_text(catalog.queries()["session_aggr_stat_filtered"](spark, SF_SMALL))
    joins = [line for line in text.splitlines() if "Join" in line]
    assert joins and not any(x in line for line in joins for x in ("age#", "sex#", "kw_hit", "CASE WHEN"))


def test_by_task_is_lazy_and_without_range_joins(spark):
    catalog.queries()["session_aggr_stat_by_task"](spark, SF_SMALL)  # the tables' footers are read once
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    df = catalog.queries()["session_aggr_stat_by_task"](spark, SF_SMALL)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    df.collect()
    assert "NestedLoop" not in plan_text(df) and "Cartesian" not in plan_text(df)


def test_no_python_in_any_plan(plans):
    for name, text in plans.items():
        assert not any(n in text for n in PYTHON_NODES), name


def test_no_cartesian_products(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text, name
        # the by-task range predicate runs only on distinct dates x tasks, in
        # its bounded pairs job; the query plans themselves hash-join
        assert "BroadcastNestedLoopJoin" not in text, name


def test_no_sort_based_aggregation(plans):
    for name, text in plans.items():
        assert "SortAggregate" not in text, name


def test_flagship_prunes_columns_and_pushes_dates(plans):
    text = plans["session_aggr_stat"]
    # only the three columns of events that the session statistics need are read ...
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>", text)
    # ... and the task's dates reach the reader as a range of ts
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2024-01-05T00:00\), LessThan\(ts,2024-01-21T00:00\)", text)
    # fixed-width per-session aggregates only: no object (list) aggregation
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text


def test_sessions_aggregate_partially_before_shuffle(plans):
    text = plans["session_aggr_stat"]
    assert "partial_max" in text and "partial_count" in text


def test_hot_session_time_keys_match_brute_force(spark):
    """One session holds most rows (with repeated instants) across several days."""
    rows = []
    for i in range(600):
        day = 1 + i % 3
        rows.append(("hot", 1, f"2024-01-0{day} {i % 5}:{(i // 7) % 60:02d}:{(i * 13) % 60:02d}", None, None))
    for i in range(40):
        rows.append((f"s{i % 7}", 2, f"2024-01-01 1:00:{i % 60:02d}", None, None))
    df = spark.createDataFrame(action_rows(rows), ACTION_SCHEMA)
    got = sorted(
        (r.session_id, r.action_time, r.seconds_since_prev, r.after_session_start, r.before_session_end)
        for r in action_time_keys(df).collect()
    )

    pdf = pd.DataFrame([(r[0], r[2]) for r in rows], columns=["session_id", "action_time"])
    pdf["t"] = pd.to_datetime(pdf.action_time, format="%Y-%m-%d %H:%M:%S")
    expected = []
    for sid, g in pdf.groupby("session_id"):
        instants = sorted(set(g.t))
        first, last = instants[0], instants[-1]
        for at, t in zip(g.action_time, g.t):
            earlier = [x for x in instants if x < t]
            gap = int((t - earlier[-1]).total_seconds()) if earlier else None
            expected.append((sid, at, gap, bool(t > first), bool(t < last)))
    assert got == sorted(expected)


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_user_join_is_split_by_aqe(spark):
    """One user owns 80% of the sessions: AQE splits that join partition."""
    from visitlens.functions.params import TaskParams
    from visitlens.plans.session_stat import session_aggr_stat

    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        actions = spark.range(0, 40000, numPartitions=8).selectExpr(
            "'2024-01-01' AS date",
            "CASE WHEN id % 10 < 8 THEN 7L ELSE id % 500 END AS user_id",
            "concat('s', CAST(id % 20000 AS STRING)) AS session_id",
            "0L AS page_id",
            "concat('2024-01-01 1:', lpad(CAST(id % 60 AS STRING), 2, '0'), ':00') AS action_time",
            "CAST(NULL AS STRING) AS search_keyword",
            "CAST(NULL AS BIGINT) AS click_category_id",
        )
        users = spark.range(0, 500).selectExpr(
            "id AS user_id", "CAST(id % 60 AS INT) AS age", "'p' AS professional", "'c' AS city", "'male' AS sex"
        )
        df = session_aggr_stat(actions, users, TaskParams(start_date="2024-01-01", end_date="2024-01-01"))
        row = df.collect()[0]  # collect on df itself, so its adaptive plan is the final one
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "skew=true" in plan
        assert row.session_count == 20000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shape(spark, name):
    """(scans of the events, shuffles, reused shuffles) of a query's executed plan."""
    df = catalog.queries()[name](spark, SF_SMALL)
    df.collect()
    text = plan_text(df).split("+- == Initial Plan ==")[0]
    nodes = [line for line in text.splitlines() if "Exchange" in line and "ReusedExchange" not in line and "BroadcastExchange" not in line]
    return len(re.findall(r"FileScan parquet[^\n]*events\.parquet", text)), len(nodes), text.count("ReusedExchange")


def test_top_categories_and_sessions_scan_the_actions_once(spark):
    for name in ("top10_category", "top10_category_filtered"):
        assert shape(spark, name)[0] == 1, name
    for name in ("top10_session", "top10_session_filtered"):
        scans, _, reused = shape(spark, name)
        assert scans == 1 and reused >= 1, name


def test_time_keys_scan_and_shuffle_the_actions_once(spark):
    scans, shuffles, reused = shape(spark, "action_time_keys")
    assert scans == 1 and reused >= 1 and shuffles <= 3


def test_hot_session_time_keys_are_spread_over_tasks(spark):
    from visitlens.operators.timeline import bucketed_actions
    from pyspark.sql import functions as F

    actions = spark.range(0, 30_000, numPartitions=8).selectExpr(
        "CAST(NULL AS STRING) AS session_id",
        "CASE WHEN id % 10 = 0 THEN 'never' ELSE concat('2024-01-01 ', CAST(id % 6 AS STRING), ':', lpad(CAST(id % 60 AS STRING), 2, '0'), ':00') END AS action_time",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [r[1] for r in bucketed_actions(actions).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(rows) == 30_000 and max(rows) < 10_000
    got = action_time_keys(actions)
    assert got.where("action_time = 'never'").groupBy("seconds_after_run", "after_run", "before_run", "time_text").count().collect()[0][:] == (0, False, False, None, 3000)
    assert got.count() == 30_000


def test_session_lists_see_no_duplicates(spark):
    """The NULL session repeats few values very often: one row per value is shuffled."""
    from visitlens.operators.sessions import aggregate_sessions

    actions = spark.range(0, 60_000, numPartitions=6).selectExpr(
        "CASE WHEN id % 3 > 0 THEN CAST(id % 50 AS STRING) END AS session_id", "id % 5 AS user_id",
        "'2024-01-01 1:00:00' AS action_time", "CASE WHEN id % 2 = 0 THEN concat('k', CAST(id % 8 AS STRING)) ELSE '' END AS search_keyword",
        "CASE WHEN id % 4 < 2 THEN id % 12 END AS click_category_id",
    )
    df = aggregate_sessions(actions, with_lists=True, keywords=["k2"], category_ids=["9"])
    got = {r.session_id: r for r in df.collect()}
    want = {}
    for i in range(60_000):
        w = want.setdefault(str(i % 50) if i % 3 else None, [set(), set(), 0])
        w[2] += 1
        if i % 2 == 0:
            w[0].add(f"k{i % 8}")
        if i % 4 < 2 and i % 12:
            w[1].add(i % 12)
    assert {k: (r.search_keywords, r.click_category_ids, r.step_length, r.kw_hit, r.cat_hit) for k, r in got.items()} == {
        k: (",".join(sorted(a)), ",".join(map(str, sorted(b))), n, "k2" in a, 9 in b) for k, (a, b, n) in want.items()
    }
    text = plan_text(df)
    assert "collect_set" not in text and re.search(r"partial_sum\(_step", text)


def test_page_conversion_reads_the_actions_once_and_joins_nothing(spark):
    scans, shuffles, _ = shape(spark, "page_one_step_convert_rate")
    assert scans == 1 and shuffles <= 4
    text = plan_text(catalog.queries()["page_one_step_convert_rate"](spark, SF_SMALL))
    assert "Join" not in text


def scan_metrics(plan, found=None):
    """Partitions read by each file scan of an executed plan (None: not partitioned)."""
    found = [] if found is None else found
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return scan_metrics(plan.executedPlan(), found)
    if kind.endswith("QueryStageExec"):
        return scan_metrics(plan.plan(), found)
    if kind == "FileSourceScanExec":
        parts = plan.metrics().get("numPartitions")
        found.append(parts.get().value() if parts.isDefined() else None)
    children = plan.children()
    for i in range(children.size()):
        scan_metrics(children.apply(i), found)
    return found


def test_by_task_reads_the_partitions_of_its_windows_only(spark, tmp_path):
    """A table partitioned by date, three tasks in two windows of five days together."""
    from visitlens.plans.by_task import session_aggr_stat_by_task
    from visitlens.session import local_table
    from visitlens.sources import fixtures, tables

    path = str(tmp_path / "actions_by_date")
    fixtures.user_visit_action(spark, SF_SMALL).write.partitionBy("date").option("path", path).saveAsTable("actions_by_date")
    try:
        rows = [(1, '{"startDate":["2024-01-05"],"endDate":["2024-01-06"]}'), (2, '{"startDate":["2024-01-06"],"endDate":["2024-01-07"],"sex":["male"]}'),
                (3, '{"startDate":["2024-01-12"],"endDate":["2024-01-13"],"keywords":["火锅"]}'), (4, '{"startDate":["2024-01-20"],"endDate":["2024-01-02"]}')]
        tasks = local_table(spark, rows, [("task_id", "BIGINT"), ("task_param", "STRING")])
        users = fixtures.user_info(spark, SF_SMALL)
        df = session_aggr_stat_by_task(tables.action_table(spark, "actions_by_date"), users, tasks)
        got = {r.taskid: r.asDict() for r in df.collect()}
        plan = df._jdf.queryExecution().executedPlan()
        scans = [parts for parts in scan_metrics(plan) if parts is not None]
        # five of the thirty; nine lie between the first and the last
        assert len(scans) >= 2 and min(scans) == 5 and max(scans) < 9
        assert "dynamicpruning" in plan.toString()
        plain = session_aggr_stat_by_task(fixtures.user_visit_action(spark, SF_SMALL), users, tasks)
        assert got == {r.taskid: r.asDict() for r in plain.collect()}
        assert got[1]["session_count"] > 0 and got[4]["session_count"] == 0
    finally:
        spark.sql("DROP TABLE actions_by_date")
