"""Production inputs: catalog tables and the task table.

``spark.table`` reads from the Hive metastore when the session was built
with Hive support and from temp views otherwise (the original chose between
a Hive and a plain SQL context the same way). The task table usually lives
in a relational database and is read over JDBC with the id predicate pushed
into the database query.
"""

from __future__ import annotations

import dataclasses
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.params import TaskError, TaskParams
from .fixtures import ACTION_COLUMNS, USER_COLUMNS

TASK_COLUMNS = (
    "task_id", "task_name", "create_time", "start_time", "finish_time", "task_type", "task_status", "task_param",
)


def action_table(spark: SparkSession, name: str = "user_visit_action") -> DataFrame:
    """The action table; partitioned by ``date`` in production, so the date
    predicate of a task prunes partitions."""
    return spark.table(name).select(*ACTION_COLUMNS)


def user_table(spark: SparkSession, name: str = "user_info") -> DataFrame:
    return spark.table(name).select(*USER_COLUMNS)


@dataclasses.dataclass(frozen=True)
class KeyRange:
    """An integer key column whose values lie between ``low`` and ``high`` (both
    included; rows beyond them are read too), read over ``parts`` connections."""

    column: str
    low: int
    high: int
    parts: int

    def __post_init__(self) -> None:
        if self.parts < 1 or self.low > self.high:
            raise ValueError(f"not a range of keys: {self}")

    def options(self) -> dict[str, str]:
        """Reader options that split the range evenly. The upper bound of Spark's
        splits is exclusive."""
        return {
            "partitionColumn": self.column, "lowerBound": str(self.low), "upperBound": str(self.high + 1),
            "numPartitions": str(min(self.parts, self.high - self.low + 1)),
        }

    def predicates(self, quantiles: list[int] | None = None) -> list[str]:
        """One condition for each connection, which together take every row once:
        NULL keys and those below go to the first, those above to the last.
        ``quantiles`` are keys to split at instead of even ones, where keys are
        dense in places (they may come from a ``percentile_approx`` of the key)."""
        if quantiles is None:
            n = min(self.parts, self.high - self.low + 1)
            quantiles = [self.low + (self.high + 1 - self.low) * i // n for i in range(1, n)]
        cuts = sorted(set(quantiles))
        if not cuts:
            return ["1 = 1"]
        first = f"{self.column} < {cuts[0]} OR {self.column} IS NULL"
        between = [f"{self.column} >= {a} AND {self.column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
        return [first, *between, f"{self.column} >= {cuts[-1]}"]


def jdbc_options(url: str, properties: dict[str, str] | None = None, fetchsize: int = 1000, keys: KeyRange | None = None) -> dict[str, str]:
    """Options of a JDBC read; those of ``keys`` split it over connections."""
    return {**(properties or {}), "url": url, "fetchsize": str(fetchsize), **(keys.options() if keys else {})}


def jdbc_task_table(
    spark: SparkSession, url: str, table: str = "task", properties: dict[str, str] | None = None, keys: KeyRange | None = None
) -> DataFrame:
    """The task table over JDBC (lazy; filters on it are pushed to the database),
    by ranges of its id where ``keys`` are given, else over one connection."""
    return spark.read.format("jdbc").options(**jdbc_options(url, properties, keys=keys)).option("dbtable", table).load()


def parameterised(query: str, params: tuple = ()) -> str:
    """``query`` with its ``?`` marks replaced by ``params`` as SQL literals, in
    order; marks inside quotes stay. Texts are quoted by doubling their quotes."""
    marks = re.split(r"""('(?:[^']|'')*'|"(?:[^"]|"")*")""", query)
    left = list(params)

    def literal(_: re.Match) -> str:
        if not left:
            raise ValueError("more marks than parameters")
        value = left.pop(0)
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return "TRUE" if value else "FALSE"
        if isinstance(value, (int, float)):
            return repr(value)
        return "'" + str(value).replace("'", "''") + "'"

    out = "".join(part if i % 2 else re.sub(r"\?", literal, part) for i, part in enumerate(marks))
    if left:
        raise ValueError("more parameters than marks")
    return out


def jdbc_query(
    spark: SparkSession, url: str, query: str, params: tuple = (), properties: dict[str, str] | None = None, fetchsize: int = 1000,
    keys: KeyRange | None = None,
) -> DataFrame:
    """Any SELECT run by the database, as a lazy DataFrame (the original's
    parameterised query with a row callback): rows stream in ``fetchsize`` batches,
    further filters are pushed into the query, and ``keys`` split it over
    connections. A split query is read as a derived table, as Spark wants it."""
    text = parameterised(query, params)
    reader = spark.read.format("jdbc").options(**jdbc_options(url, properties, fetchsize, keys))
    reader = reader.option("dbtable", f"({text}) q") if keys else reader.option("query", text)
    return reader.load()


def task_by_id(tasks: DataFrame, task_id: int) -> DataFrame:
    return tasks.where(F.col("task_id") == F.lit(task_id))


def load_task_params(tasks: DataFrame, task_id: int) -> TaskParams:
    """Parameters of one task. Brings one parameter row (a few hundred bytes)
    to the driver; raises when the task does not exist."""
    rows = task_by_id(tasks, task_id).select("task_param").limit(2).collect()
    if not rows:
        raise TaskError(f"task {task_id} not found")
    if len(rows) > 1:
        raise TaskError(f"task id {task_id} is not unique")
    return TaskParams.from_json(rows[0]["task_param"])
