"""Sinks that can be run again, and the options of JDBC reads (no database is started)."""

from __future__ import annotations

import argparse
import re

import pytest

from conftest import SF_SMALL
from visitlens import job
from visitlens.session import local_table
from visitlens.sources import sinks, tables
from visitlens.sources.tables import KeyRange


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "stat")
    columns = [("taskid", "BIGINT"), ("session_count", "BIGINT")]
    sinks.replace_files(local_table(spark, [(1, 10), (2, 20)], columns), path)
    sinks.replace_files(local_table(spark, [(2, 21)], columns), path)
    sinks.replace_files(local_table(spark, [(2, 21), (3, 30), (3, 31)], columns), path)
    sinks.replace_files(local_table(spark, [], columns), path)  # no rows, nothing to replace
    got = sorted((r.taskid, r.session_count) for r in spark.read.parquet(path).collect())
    assert got == [(1, 10), (2, 21), (3, 30), (3, 31)]
    with pytest.raises(ValueError):
        sinks.replace_files(local_table(spark, [(1,)], [("hop_index", "BIGINT")]), path)


def test_job_replaces_its_task(spark, tmp_path):
    out = str(tmp_path / "rows")
    task = '{"startDate":["2024-01-05"],"endDate":["2024-01-20"]}'
    args = ["--fixture-dir", SF_SMALL, "--task-json", task, "--out-path", out, "--replace"]
    for task_id in ("7", "7", "8", "7"):
        assert job.main([*args, "--task-id", task_id]) == 0
    rows = spark.read.parquet(out).collect()
    assert sorted(r.taskid for r in rows) == [7, 8]
    assert len({r.session_count for r in rows}) == 1


@pytest.mark.parametrize("args", [["--replace"], ["--replace", "--out-path", "x", "--job", "page"], ["--task-ids", "9:1:2"], ["--task-ids", "1:2"]])
def test_job_rejects_what_cannot_be(args):
    with pytest.raises(SystemExit):
        job.parse_args(args)


def test_key_range_options():
    keys = KeyRange("task_id", 1, 1000, 8)
    assert keys.options() == {"partitionColumn": "task_id", "lowerBound": "1", "upperBound": "1001", "numPartitions": "8"}
    assert KeyRange("k", 5, 6, 100).options()["numPartitions"] == "2"
    options = tables.jdbc_options("jdbc:x", {"user": "u"}, 50, keys)
    assert options["url"] == "jdbc:x" and options["user"] == "u" and options["fetchsize"] == "50" and options["partitionColumn"] == "task_id"
    assert "partitionColumn" not in tables.jdbc_options("jdbc:x")
    for bad in (("k", 2, 1, 3), ("k", 1, 2, 0)):
        with pytest.raises(ValueError):
            KeyRange(*bad)


@pytest.mark.parametrize("keys, quantiles", [
    (KeyRange("k", 1, 100, 7), None), (KeyRange("k", -5, 5, 50), None), (KeyRange("k", 3, 3, 4), None), (KeyRange("k", 1, 9, 3), [2, 2, 8, 5]),
])
def test_predicates_take_every_row_once(spark, keys, quantiles):
    rows = local_table(spark, [(None,), *((k,) for k in range(-20, 121))], [("k", "BIGINT")])
    predicates = keys.predicates(quantiles)
    taken = [r.k for p in predicates for r in rows.where(p).collect()]
    assert sorted(taken, key=str) == sorted((r.k for r in rows.collect()), key=str)
    assert len(predicates) == (len(set(quantiles)) + 1 if quantiles else int(keys.options()["numPartitions"]))


def test_parameterised_queries(spark):
    text = tables.parameterised("SELECT * FROM t WHERE a = ? AND b = '?' AND \"c?\" < ? AND d IN (?, ?, ?)", ("it's", 5, None, True, 0.5))
    assert text == "SELECT * FROM t WHERE a = 'it''s' AND b = '?' AND \"c?\" < 5 AND d IN (NULL, TRUE, 0.5)"
    for params in ((), (1, 2)):
        with pytest.raises(ValueError):
            tables.parameterised("SELECT ?", params)
    quoted = tables.parameterised("SELECT ? AS a, ? AS b", ("x'; DROP TABLE t --", "?"))
    assert re.fullmatch(r"SELECT 'x''; DROP TABLE t --' AS a, '\?' AS b", quoted)


class Reader:
    """Stands for spark.read: notes the options."""

    def __init__(self):
        self.seen = {}

    @property
    def read(self):
        return self

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen |= options
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def load(self):
        return self.seen


def test_jdbc_reads_are_split_by_their_key():
    keys = KeyRange("task_id", 1, 99, 4)
    whole = tables.jdbc_query(Reader(), "jdbc:x", "SELECT * FROM task WHERE task_type = ?", ("session",), {"user": "u"})
    assert whole["query"] == "SELECT * FROM task WHERE task_type = 'session'" and "dbtable" not in whole and whole["user"] == "u"
    split = tables.jdbc_query(Reader(), "jdbc:x", "SELECT * FROM task", keys=keys)
    assert split["dbtable"] == "(SELECT * FROM task) q" and "query" not in split and split["numPartitions"] == "4"
    task = tables.jdbc_task_table(Reader(), "jdbc:x", "task", {"password": "p"}, keys)
    assert task["format"] == "jdbc" and task["dbtable"] == "task" and task["partitionColumn"] == "task_id" and task["password"] == "p"
    assert job.id_range("1:99:4") == keys
    with pytest.raises(argparse.ArgumentTypeError):
        job.id_range("1:x:4")
