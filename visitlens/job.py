"""Command line: run one of the jobs for one task, or the session statistics for all tasks.

    spark-submit visitlens/job.py --task-id 2 \\
        --task-jdbc-url jdbc:mysql://db/app --out-jdbc-url jdbc:mysql://db/app
    python -m visitlens.job --fixture-dir /root/testdata/sf0.1 \\
        --task-json '{"startDate":["2024-01-05"],"endDate":["2024-01-20"]}' --show

Inputs: catalog tables ``user_visit_action`` / ``user_info`` (Hive with
``--hive``), or the fixture views over a directory of driver tables
(``--fixture-dir``). The task comes from a JDBC task table, from literal
JSON, or (``--all-tasks``) every row of the task table runs in one job.
``--job`` chooses the session statistics, the top-10 categories, the top-10
sessions of those categories, or the conversion along the task's page flow.
User, password and driver of the databases are given as ``--jdbc-property``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame

from .constants import LOCAL_SESSION_TASK_ID
from .functions.params import TaskError, TaskParams
from .operators.funnel import one_step_convert_rate
from .operators.sessions import scan_actions
from .operators.topn import top_categories, top_sessions
from .plans.by_task import session_aggr_stat_by_task
from .plans.session_stat import category_counts_for_task, session_aggr_stat
from .session import build_session, scale_conf
from .sources import fixtures, sinks, tables

#: --job and the table that its result is appended to over JDBC.
JOBS = {
    "session": "session_aggr_stat",
    "top10-category": "top10_category",
    "top10-session": "top10_session",
    "page": "page_one_step_convert_rate",
}


def key_value(text: str) -> tuple[str, str]:
    key, eq, value = text.partition("=")
    if not (key and eq):
        raise argparse.ArgumentTypeError(f"not key=value: {text!r}")
    return key, value


def id_range(text: str) -> tables.KeyRange:
    try:
        low, high, parts = map(int, text.split(":"))
        return tables.KeyRange("task_id", low, high, parts)
    except ValueError as bad:
        raise argparse.ArgumentTypeError(f"not LOW:HIGH:PARTS: {text!r}") from bad


def parse_args(argv: list[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="visitlens.job")
    ap.add_argument("--job", choices=list(JOBS), default="session")
    ap.add_argument("--task-id", type=int, default=LOCAL_SESSION_TASK_ID)
    ap.add_argument("--task-json", help="task_param JSON instead of a task table")
    ap.add_argument("--task-jdbc-url", help="JDBC URL of the database holding the task table")
    ap.add_argument("--task-table", default="task")
    ap.add_argument("--all-tasks", action="store_true", help="run every task of the task table in one job")
    ap.add_argument("--fixture-dir", help="derive the input tables from driver parquet tables in this folder")
    ap.add_argument("--hive", action="store_true", help="read catalog tables from the Hive metastore")
    ap.add_argument("--out-jdbc-url", help="append the result to the job's table over JDBC")
    ap.add_argument("--out-table", help="that table's name, if it is another one")
    ap.add_argument("--jdbc-property", action="append", type=key_value, default=[], metavar="KEY=VALUE",
                    help="connection property of both databases (user, password, driver); may be repeated")
    ap.add_argument("--out-path", help="append the result to a parquet table at this path")
    ap.add_argument("--replace", action="store_true", help="the rows of a task at --out-path are replaced (a table partitioned by taskid)")
    ap.add_argument("--task-ids", type=id_range, metavar="LOW:HIGH:PARTS", help="read the task table by ranges of its id over PARTS connections")
    ap.add_argument("--cluster-cores", type=int, help="total executor cores (sizes partitions with --input-bytes)")
    ap.add_argument("--input-bytes", type=int, help="bytes of the action columns the job scans")
    ap.add_argument("--show", action="store_true")
    ap.add_argument("--master")
    args = ap.parse_args(argv)
    if (args.cluster_cores is None) != (args.input_bytes is None):
        ap.error("--cluster-cores and --input-bytes go together")
    if args.all_tasks and args.job != "session":
        ap.error("--all-tasks runs the session statistics only")
    if args.replace and not args.out_path:
        ap.error("--replace needs --out-path")
    if args.replace and args.job == "page":
        ap.error("the page job's rows have no taskid to be replaced by")
    return args


def job_result(job: str, actions: DataFrame, users: DataFrame, params: TaskParams, task_id: int) -> DataFrame:
    """The rows of one job for one task, as a lazy plan."""
    if job == "session":
        return sinks.stat_columns_in_order(session_aggr_stat(actions, users, params, task_id))
    if job == "page":
        flow = params.page_flow()
        if len(flow) < 2:
            raise TaskError("the page job needs a targetPageFlow of two pages or more")
        return one_step_convert_rate(actions.sparkSession, scan_actions(actions, *params.date_range()), flow)
    counts = category_counts_for_task(actions, users, params)
    top = top_categories(counts, task_id)
    return top if job == "top10-category" else top_sessions(counts, top, task_id)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    extra = scale_conf(args.cluster_cores, args.input_bytes) if args.cluster_cores else None
    spark = build_session(args.master, app_name="visitlens-session-job", hive=args.hive, extra_conf=extra)
    properties = dict(args.jdbc_property)
    if args.fixture_dir:
        actions = fixtures.user_visit_action(spark, args.fixture_dir)
        users = fixtures.user_info(spark, args.fixture_dir)
    else:
        actions = tables.action_table(spark)
        users = tables.user_table(spark)

    if args.all_tasks:
        if not args.task_jdbc_url:
            raise SystemExit("--all-tasks needs --task-jdbc-url")
        task_df = tables.jdbc_task_table(spark, args.task_jdbc_url, args.task_table, properties, args.task_ids)
        result = sinks.stat_columns_in_order(session_aggr_stat_by_task(actions, users, task_df))
    else:
        if args.task_json is not None:
            params = TaskParams.from_json(args.task_json)
        elif args.task_jdbc_url:
            task_df = tables.jdbc_task_table(spark, args.task_jdbc_url, args.task_table, properties)
            params = tables.load_task_params(task_df, args.task_id)
        else:
            raise SystemExit("give --task-json or --task-jdbc-url")
        if args.fixture_dir:
            actions = fixtures.user_visit_action(spark, args.fixture_dir, params.start_date, params.end_date)
        result = job_result(args.job, actions, users, params, args.task_id)

    if args.out_jdbc_url:
        sinks.append_jdbc(result, args.out_jdbc_url, args.out_table or JOBS[args.job], properties)
    if args.out_path:
        (sinks.replace_files if args.replace else sinks.append_files)(result, args.out_path)
    if args.show or not (args.out_jdbc_url or args.out_path):
        result.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
