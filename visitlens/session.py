"""SparkSession construction and cluster-level settings.

On a cluster the session comes from ``spark-submit``; the helpers here only
fill in settings the job relies on when they are unset (tests, local runs).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the plans are written for. AQE re-plans joins from the real
# shuffle sizes (broadcast only what turned out small), coalesces small
# partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Python call-site capture for error messages costs ~2 ms per Column call.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "visitlens",
    shuffle_partitions: int | None = None,
    hive: bool = False,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session.

    ``hive=True`` reads tables from the Hive metastore (production catalog);
    otherwise the in-memory catalog holds temp views.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


MB = 1 << 20


def scale_conf(total_cores: int, input_bytes: int, shuffle_fraction: float = 0.25) -> dict[str, str]:
    """Partition sizing for a cluster run, so that no task outgrows memory.

    * scan splits of 256 MB: 100 TB of actions become ~400k scan tasks, a few
      dozen waves on a 1000-executor cluster, each split well inside memory;
    * initial shuffle partitions sized for ~128 MB of shuffle data each, with
      the shuffled bytes estimated as ``shuffle_fraction`` of the input (the
      session aggregation combines map-side, so its shuffle is a fraction of
      the scanned columns); AQE then coalesces toward the 128 MB advisory size
      and splits partitions more than 5× the median and above 256 MB (skew);
    * at least 2 partitions per core so every core has work in every stage.
    """
    shuffle_bytes = int(input_bytes * shuffle_fraction)
    partitions = max(2 * total_cores, -(-shuffle_bytes // (128 * MB)))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * MB),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * MB),
    }


def sql_literal(value) -> str:
    """A Python value as a Spark SQL literal (strings escaped)."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return repr(value) + "D"
    if isinstance(value, (list, tuple)):
        return "array(" + ", ".join(sql_literal(v) for v in value) + ")"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def local_table(spark, rows, columns: list[tuple[str, str]]):
    """A small parameter table (task rows, a page flow) as a JVM-side local
    relation: no Python worker and no RDD behind it. ``columns`` are
    (name, SQL type) pairs."""
    names = [n for n, _ in columns]
    typed = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in columns)
    if not rows:
        nulls = ", ".join(f"CAST(NULL AS {t}) AS {n}" for n, t in columns)
        return spark.sql(f"SELECT {nulls}").where("FALSE")
    values = ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT {typed} FROM VALUES {values} AS t({', '.join(names)})")
