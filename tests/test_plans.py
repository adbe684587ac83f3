"""Plan-level checks: partition invariance, by-task vs single task, top-k
and day-split adjacency against brute force, sinks."""

from __future__ import annotations

import itertools
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import ACTION_SCHEMA, SF_MID, SF_SMALL, action_rows
from visitlens.functions.params import TaskParams
from visitlens.operators.funnel import bucket_hops, hop_counts, one_step_convert_rate, page_points
from visitlens.operators.sessions import aggregate_sessions
from visitlens.operators.timeline import action_time_keys
from visitlens.operators.topn import category_counts_by_session, top_sessions
from visitlens.plans import catalog
from visitlens.plans import params_catalog as P
from visitlens.plans.by_task import session_aggr_stat_by_task
from visitlens.plans.session_stat import session_aggr_stat
from visitlens.sources import fixtures, sinks


def test_partition_invariance(spark):
    users = fixtures.user_info(spark, SF_MID)
    base = fixtures.user_visit_action(spark, SF_MID)
    rows = []
    for n in (1, 4, 32):
        rows.append(session_aggr_stat(base.repartition(n), users, P.FILTERS["age"]).first())
    assert rows[0] == rows[1] == rows[2]
    assert rows[0].session_count > 0


def test_by_task_equals_single_task(spark):
    actions = fixtures.user_visit_action(spark, SF_SMALL)
    users = fixtures.user_info(spark, SF_SMALL)
    tasks = catalog.task_table(spark)
    by_task = {r.taskid: r.asDict() for r in session_aggr_stat_by_task(actions, users, tasks).collect()}
    assert set(by_task) == {t[0] for t in P.TASK_ROWS}
    for task_id, _, text in P.TASK_ROWS:
        params = TaskParams.from_json(text)
        if params.start_date is None:
            assert by_task[task_id]["session_count"] == 0
            continue
        single = session_aggr_stat(actions, users, params, task_id).first().asDict()
        assert single == by_task[task_id], task_id


def test_windows_are_merged_into_intervals(spark):
    from visitlens.plans.by_task import date_intervals, window_dates
    from visitlens.session import local_table

    def found(windows, days=()):
        df = local_table(spark, windows, [("start_date", "STRING"), ("end_date", "STRING")])
        dates = local_table(spark, [(d,) for d in days], [("date", "STRING")])
        return date_intervals(df).first(), sorted(tuple(r) for r in window_dates(dates, df).collect())

    row, inside = found([("05", "07"), ("06", "06"), ("07", "09"), ("12", "13"), ("14", "14"), ("3", "1"), (None, "99"), ("00", None)], ["05", "08", "12", "2"])
    assert (row.lo, row.hi, [tuple(i) for i in row.intervals]) == ("05", "14", [("05", "09"), ("12", "13"), ("14", "14")])
    assert inside == [("05", "07", "05"), ("07", "09", "08"), ("12", "13", "12")]
    assert found([("3", "1")], ["2"]) == ((None, None, []), [])


def test_a_thousand_tasks_of_a_window_share_its_cells(spark):
    """The cells depend on the window's sessions and the distinct lists, not on the tasks."""
    from visitlens.plans import by_task
    from visitlens.session import local_table

    dates = '"startDate":["2024-01-05"],"endDate":["2024-01-20"]'
    actions, users = fixtures.user_visit_action(spark, SF_SMALL), fixtures.user_info(spark, SF_SMALL)
    texts = {}
    for i in range(1000):
        lists = ['', ',"keywords":["火锅,蛋糕"]', ',"categoryIds":["3,17,42"]', ',"keywords":["火锅"],"categoryIds":["3,17,42,5,8,9,64"]'][i % 4]
        texts[i] = "{" + dates + f',"startAge":["{i % 40}"],"endAge":["{20 + i % 41}"]' + lists + ("" if i % 3 else ',"sex":["male"]') + "}"
    columns = [("task_id", "BIGINT"), ("task_param", "STRING")]
    seen = []
    real = by_task.attribute_cells
    try:
        by_task.attribute_cells = lambda *args: seen.append(real(*args)) or seen[-1]
        got = {r.taskid: r.asDict() for r in session_aggr_stat_by_task(actions, users, local_table(spark, list(texts.items()), columns)).collect()}
        few = session_aggr_stat_by_task(actions, users, local_table(spark, [(i, texts[i]) for i in range(4)], columns))
        assert len(few.collect()) == 4
        many_cells, few_cells = (cells.count() for cells in seen)
    finally:
        by_task.attribute_cells = real
    assert many_cells == few_cells and len(got) == 1000
    for i in (0, 1, 2, 3, 7, 500, 998):
        params = TaskParams.from_json(texts[i])
        assert got[i] == session_aggr_stat(actions, users, params, i).first().asDict(), texts[i]
    assert sum(r["session_count"] > 0 for r in got.values()) > 500


def test_by_task_bad_age_bound_leaves_other_tasks(spark):
    from visitlens.session import local_table

    dates = '"startDate":["2024-01-05"],"endDate":["2024-01-20"]'
    rows = [(1, "{" + dates + ',"startAge":["99999999999999999999"],"endAge":["9"]}'), (2, "{" + dates + ',"startAge":["1"],"endAge":["99999999999"]}'), (2, "{" + dates + "}"), (3, "{" + dates + "}")]
    tasks = local_table(spark, rows, [("task_id", "BIGINT"), ("task_param", "STRING")])
    actions, users = fixtures.user_visit_action(spark, SF_SMALL), fixtures.user_info(spark, SF_SMALL)
    got = [(r.taskid, r.session_count) for r in session_aggr_stat_by_task(actions, users, tasks).collect()]
    whole = session_aggr_stat(actions, users, TaskParams.from_json(rows[3][1]), 3).first().session_count
    old = session_aggr_stat(actions, users, TaskParams.from_json(rows[1][1]), 2).first().session_count
    assert sorted(got) == sorted([(1, 0), (2, old), (2, whole), (3, whole)])  # one row per task row


def test_null_session_is_a_session(spark):
    d = "2024-01-01"
    rows = [(None, 1, f"{d} 10:00:00", None, 7), (None, 1, f"{d} 10:00:09.0", None, 7), ("a", 1, f"{d} 9:0:00", None, 8)]
    actions = spark.createDataFrame(action_rows(rows), ACTION_SCHEMA)
    keys = {(r.session_id, r.action_time): r for r in action_time_keys(actions).collect()}
    assert keys[None, f"{d} 10:00:09.0"].seconds_since_prev == 9 and keys[None, f"{d} 10:00:09.0"].after_session_start
    counts = category_counts_by_session(actions)
    kept = aggregate_sessions(actions).select("session_id")
    assert counts.join(kept, counts["session_id"].eqNullSafe(kept["session_id"]), "left_semi").count() == 2


def test_keyword_filter_tests_each_piece_of_the_data(spark):
    d = "2024-01-01"
    rows = [("a", 1, f"{d} 10:00:00", "x,y", None), ("b", 1, f"{d} 10:00:00", "xy", None), ("c", 1, f"{d} 10:00:00", None, 3)]
    actions = spark.createDataFrame(action_rows(rows), ACTION_SCHEMA)
    got = {r.session_id: r.kw_hit for r in aggregate_sessions(actions, keywords=["x"]).collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_profession_and_city_filters_test_each_piece_of_the_data(spark):
    from visitlens.plans.session_stat import sessions_for_task
    from visitlens.session import local_table

    d = "2024-01-01"
    jobs = ["teacher", "teacher,doctor", "doctor", "doctors,x", ",teacher,", None, ""]
    actions = spark.createDataFrame(action_rows([(f"s{i}", i + 1, f"{d} 10:00:00", None, None) for i in range(len(jobs))]), ACTION_SCHEMA)
    users = spark.createDataFrame(
        [(i + 1, "u", "n", 30, job, "b,a" if i % 2 else "c", "male") for i, job in enumerate(jobs)],
        "user_id bigint, username string, name string, age int, professional string, city string, sex string",
    )
    dates = f'"startDate":["{d}"],"endDate":["{d}"]'
    for extra, want in (
        (',"professionals":["teacher"]', {"s0", "s1", "s4"}), (',"professionals":["x,doctor"]', {"s1", "s2", "s3"}), (',"cities":["a"]', {"s1", "s3", "s5"}),
        (',"professionals":["teacher"],"cities":["a,z"]', {"s1"}), (',"cities":[","]', set()),
    ):
        text = "{" + dates + extra + "}"
        kept = sessions_for_task(actions, users, TaskParams.from_json(text))
        assert {r.session_id for r in kept.collect()} == want, extra
        tasks = local_table(spark, [(1, text)], [("task_id", "BIGINT"), ("task_param", "STRING")])
        assert session_aggr_stat_by_task(actions, users, tasks).first().session_count == len(want), extra


def _brute_pairs(rows):
    df = pd.DataFrame(rows, columns=["session_id", "page_id", "t"]).sort_values(["session_id", "t", "page_id"])
    out = {}
    for _, g in df.groupby("session_id"):
        pages = list(g.page_id)
        for a, b in zip(pages, pages[1:]):
            out[(a, b)] = out.get((a, b), 0) + 1
    return out


def _pairs(df, pages, **sizes):
    """(from, to) -> pairs over all of ``pages``, zeros left out."""
    hops = list(itertools.product(pages, pages))
    row = hop_counts(df, hops, pages[0], **sizes).first()
    return {hop: row[f"hop_{i}"] for i, hop in enumerate(hops) if row[f"hop_{i}"]}


def test_adjacent_pairs_across_days_and_ties(spark):
    raw = [
        ("s1", "2024-01-01 23:59:58", 1), ("s1", "2024-01-01 23:59:59", 2), ("s1", "2024-01-02 0:00:00", 3),
        ("s1", "2024-01-02 0:00:00", 3), ("s1", "2024-01-02 0:00:00", 1), ("s1", "2024-01-04 5:00:00", 2),
        ("s2", "2024-01-01 1:00:00", 2), ("s2", "2024-01-01 1:00:00", 2), ("s2", "2024-01-01 1:00:00", 2),
        ("s2", "2024-01-03 1:00:00", 3), ("s3", "2024-01-05 1:00:00", 1),
    ]
    df = spark.createDataFrame(action_rows([(s, 1, t, None, None, p) for s, t, p in raw]), ACTION_SCHEMA)
    got = _pairs(df, [1, 2, 3])
    expected = _brute_pairs([(s, p, pd.Timestamp(t.replace(" 0:", " 00:").replace(" 5:", " 05:").replace(" 1:", " 01:")))
                             for s, t, p in raw])
    assert got == expected


def test_convert_rate_chain(spark):
    raw = [("s", f"2024-01-01 1:00:0{i}", p) for i, p in enumerate([1, 2, 3, 1, 2, 9, 1])]
    df = spark.createDataFrame(action_rows([(s, 1, t, None, None, p) for s, t, p in raw]), ACTION_SCHEMA)
    rows = one_step_convert_rate(spark, df, [1, 2, 3, 4]).orderBy("hop_index").collect()
    assert [(r.hop_count, r.rate) for r in rows] == [(2, 0.67), (1, 0.5), (0, 0.0)]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_top_sessions_equal_plain_ranking(spark, partitions):
    per = [(f"s{i:03d}", c, (i * 7 + c) % 5 + 1, 0, 0) for i, c in itertools.product(range(60), range(1, 4))]
    df = spark.createDataFrame(
        per, "session_id string, category_id bigint, click_count bigint, order_count bigint, pay_count bigint"
    ).repartition(partitions)
    cats = spark.createDataFrame([(1,), (2,), (3,)], "categoryid bigint")
    result = top_sessions(df, cats, 2, k=10)
    assert "WindowGroupLimit" in result._jdf.queryExecution().executedPlan().toString()
    got = sorted(tuple(r) for r in result.collect())
    pdf = pd.DataFrame(per, columns=["session_id", "category_id", "click_count", "o", "p"])
    expected = []
    for c, g in pdf.groupby("category_id"):
        g = g.sort_values(["click_count", "session_id"], ascending=[False, True]).head(10)
        expected += [(2, int(c), s, int(n)) for s, n in zip(g.session_id, g.click_count)]
    assert got == sorted(expected)


def test_parquet_sink_appends(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="visitlens-sink-"), "stat")
    row = sinks.stat_columns_in_order(catalog.queries()["session_aggr_stat"](spark, SF_SMALL))
    sinks.append_files(row, out)
    sinks.append_files(row, out)
    back = spark.read.parquet(out)
    assert back.count() == 2 and tuple(back.columns) == tuple(row.columns)


def test_scale_conf_sizes_partitions():
    from visitlens.session import MB, scale_conf

    small = scale_conf(total_cores=16, input_bytes=100 * MB)
    assert int(small["spark.sql.shuffle.partitions"]) == 32  # at least two per core
    big = scale_conf(total_cores=8000, input_bytes=20 * (1 << 40))  # 20 TB of scanned columns
    parts = int(big["spark.sql.shuffle.partitions"])
    assert 20 * (1 << 40) * 0.25 / parts <= 128 * MB  # <= 128 MB of shuffle data per partition
    assert big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == str(parts)


def test_job_cli_writes_stat_rows(spark):
    from visitlens import job

    out = os.path.join(tempfile.mkdtemp(prefix="visitlens-job-"), "stat")
    task = '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"sex":["female"]}'
    assert job.main(["--fixture-dir", SF_SMALL, "--task-json", task, "--task-id", "7", "--out-path", out]) == 0
    rows = spark.read.parquet(out).collect()
    expected = session_aggr_stat(
        fixtures.user_visit_action(spark, SF_SMALL), fixtures.user_info(spark, SF_SMALL), TaskParams.from_json(task), 7
    ).first()
    assert len(rows) == 1 and rows[0].asDict() == expected.asDict()


def test_by_task_without_list_filters_uses_fixed_width_aggregation(spark):
    from visitlens.session import local_table

    rows = [(1, '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"sex":["male"]}'),
            (2, '{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"startAge":["10"],"endAge":["40"]}')]
    tasks = local_table(spark, rows, [("task_id", "BIGINT"), ("task_param", "STRING")])
    actions = fixtures.user_visit_action(spark, SF_SMALL)
    users = fixtures.user_info(spark, SF_SMALL)
    df = session_aggr_stat_by_task(actions, users, tasks)
    got = {r.taskid: r.asDict() for r in df.collect()}
    # but for the one-row subquery of the tasks' date intervals
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    assert all("collect_list(struct(lo, " in line for line in lines if "ObjectHashAggregate" in line)
    for task_id, text in rows:
        assert got[task_id] == session_aggr_stat(actions, users, TaskParams.from_json(text), task_id).first().asDict()


def test_adjacent_pairs_random_against_brute_force(spark):
    """2,000 random actions: 25 sessions over days 1, 2, 4 and 7, times drawn from
    few values so instants tie often; compared with a plain sort per session."""
    import random

    rng = random.Random(5)
    raw = []
    for _ in range(2000):
        day = rng.choice([1, 2, 4, 7])
        hour, minute = rng.choice([0, 9, 23]), rng.choice([0, 59])
        raw.append((f"s{rng.randint(0, 24)}", f"2024-01-0{day} {hour}:{minute:02d}:{rng.choice([0, 30]):02d}",
                    rng.randint(0, 4)))
    df = spark.createDataFrame(action_rows([(s, 1, t, None, None, p) for s, t, p in raw]), ACTION_SCHEMA)
    expected = _brute_pairs([(s, p, pd.to_datetime(t, format="%Y-%m-%d %H:%M:%S")) for s, t, p in raw])
    assert _pairs(df, range(5)) == expected
    # pages outside the flow only part the others, whatever they sort between
    assert _pairs(df, [1, 3]) == {k: n for k, n in expected.items() if set(k) <= {1, 3}}
    assert _pairs(df, range(5), bucket_seconds=1) == _pairs(df, range(5), bucket_seconds=1 << 30) == expected


def test_page_flow_edge_cases(spark):
    d = "2024-01-01"
    raw = [(None, f"{d} 1:00:00", 1), (None, f"{d} 1:00:01", 2), ("a", f"{d} 1:00:00", 1), ("a", f"{d} 1:00:00", None), ("a", f"{d} 1:00:01", 2),
           ("b", f"{d} 1:00:00", 1), ("b", f"{d} 1:00:01", None), ("b", f"{d} 1:00:02", 2), ("c", "1969-12-31 23:59:59", 1),
           ("c", "1970-01-01 0:00:00", 2), ("d", f"{d} never", 1)]
    df = spark.createDataFrame(action_rows([(s, 1, t, None, None, p) for s, t, p in raw]), ACTION_SCHEMA)
    # the NULL page parts b's actions and stands before a's first one
    assert one_step_convert_rate(spark, df, [1, 2]).first()[:] == (1, 1, 2, 3, 0.75)
    none = df.where("false")
    assert [r[3:] for r in one_step_convert_rate(spark, none, [1, 2, 1]).collect()] == [(0, None), (0, None)]
    assert one_step_convert_rate(spark, df, [1]).collect() == [] == one_step_convert_rate(spark, df, []).collect()


def test_hot_session_day_is_spread_over_tasks(spark):
    """One session, one day: its hours are window groups of their own."""
    actions = spark.range(0, 50_000, numPartitions=8).selectExpr(
        "'hot' AS session_id", "id % 7 AS page_id",
        "concat('2024-01-01 ', CAST(id % 24 AS STRING), ':', lpad(CAST(id % 60 AS STRING), 2, '0'), ':', lpad(CAST(id % 59 AS STRING), 2, '0')) AS action_time",
    )
    pages, hops = [1, 2, 3], [(1, 2), (2, 3)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = bucket_hops(page_points(actions, pages), pages, hops, 1)
        tasks = rows.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r[1] for r in tasks) == 24 and len(tasks) >= 5
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    points = page_points(actions, pages)
    assert points.groupBy("session_id", "bucket").count().agg({"count": "max"}).first()[0] <= 3600 * 7


def test_job_cli_applies_partition_sizing(spark):
    from visitlens import job
    from visitlens.session import MB

    out = os.path.join(tempfile.mkdtemp(prefix="visitlens-job-"), "stat")
    task = '{"startDate":["2024-01-05"],"endDate":["2024-01-20"]}'
    # 4 cores and a small input: 8 shuffle partitions, the test session's own value
    args = ["--fixture-dir", SF_SMALL, "--task-json", task, "--out-path", out,
            "--cluster-cores", "4", "--input-bytes", str(64 * MB)]
    assert job.main(args) == 0
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") in (str(256 * MB), "256m", f"{256 * MB}b")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert spark.read.parquet(out).count() == 1


@pytest.mark.parametrize("name, query", [
    ("top10-category", "top10_category"), ("top10-session", "top10_session"), ("page", "page_one_step_convert_rate"),
])
def test_job_cli_runs_each_job(spark, name, query):
    from visitlens import job
    from visitlens.plans import catalog

    out = os.path.join(tempfile.mkdtemp(prefix="visitlens-job-"), "rows")
    task = '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"targetPageFlow":["1,2,3,4,5,6"]}'
    assert job.main(["--job", name, "--fixture-dir", SF_SMALL, "--task-json", task, "--out-path", out]) == 0
    expected = catalog.queries()[query](spark, SF_SMALL)
    got = spark.read.parquet(out)
    assert got.columns == expected.columns and got.count() > 0
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_job_cli_passes_jdbc_properties(spark, monkeypatch):
    """Reader and writer get the properties and the job's table; no database is involved."""
    from visitlens import job
    from visitlens.session import local_table

    task = '{"startDate":["2024-01-05"],"endDate":["2024-01-20"],"targetPageFlow":["1,2"]}'
    tasks = local_table(spark, [(3, task)], [("task_id", "BIGINT"), ("task_param", "STRING")])
    seen = []
    monkeypatch.setattr(job.tables, "jdbc_task_table", lambda spark, *args: seen.append(args) or tasks)
    monkeypatch.setattr(job.sinks, "append_jdbc", lambda df, *args: seen.append(args))
    properties = {"user": "u", "password": "a=b"}
    args = ["--job", "page", "--task-id", "3", "--fixture-dir", SF_SMALL, "--task-jdbc-url", "jdbc:x", "--out-jdbc-url", "jdbc:y"]
    assert job.main([*args, "--jdbc-property", "user=u", "--jdbc-property", "password=a=b"]) == 0
    assert seen == [("jdbc:x", "task", properties), ("jdbc:y", "page_one_step_convert_rate", properties)]


@pytest.mark.parametrize("args", [
    ["--cluster-cores", "4"], ["--input-bytes", "1"], ["--all-tasks", "--job", "page"], ["--jdbc-property", "user"],
])
def test_job_cli_rejects_half_given_options(args):
    from visitlens import job

    with pytest.raises(SystemExit):
        job.parse_args(args)
