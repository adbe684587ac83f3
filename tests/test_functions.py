"""Record codec and time helpers against the original's rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from visitlens.functions import kv, timekeys


def _java_split(text, sep):
    """Java String.split: trailing empty strings are dropped."""
    parts = text.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts if parts or text != "" else [""]


def java_get_field(record, field):
    for piece in _java_split(record, "|"):
        kv_ = _java_split(piece, "=")
        if len(kv_) == 2 and kv_[0] == field:
            return kv_[1]
    return None


RECORDS = [
    "a=1|b=2|c=3", "a=|b=2", "a=x=y|a=5", "a=v=", "=v|a=1", "b=1|a=2|a=3", "", "a", "a=1|", "|a=1", "x=1|y=2",
    "a===|a=4", "k=火锅,温泉|a=0",
]


@pytest.mark.parametrize("record", RECORDS)
def test_get_field_matches_java(spark, record):
    df = spark.createDataFrame([(record,)], "r string")
    for field in ("a", "b", "k", ""):
        got = df.select(kv.get_field(F.col("r"), field)).first()[0]
        assert got == java_get_field(record, field), (record, field)


def java_set_field(record, field, value):
    pieces = _java_split(record, "|")
    for i, p in enumerate(pieces):
        if p.split("=")[0] == field:
            pieces[i] = f"{field}={value}"
            break
    return "|".join(pieces)


@pytest.mark.parametrize("record", ["a=1|b=2|a=3", "b=2", "a=1|b=2|", "a|b=1", "", "x=1|a="])
def test_set_field_matches_java(spark, record):
    df = spark.createDataFrame([(record,)], "r string")
    got = df.select(kv.set_field(F.col("r"), "a", F.lit(9))).first()[0]
    assert got == java_set_field(record, "a", 9)


def test_trim_comma(spark):
    cases = {",a,b,": "a,b", "a,,": "a,", ",": "", ",,": "", "a": "a"}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = [r[0] for r in df.select(kv.trim_comma(F.col("s"))).collect()]
    assert got == list(cases.values())


def test_time_helpers(spark):
    df = spark.createDataFrame(
        [("2024-01-01 7:05:09", "2024-01-01 17:05:09"), ("2024-01-02 0:00:01", "bad")], "a string, b string"
    )
    rows = df.select(
        timekeys.minus(F.col("b"), F.col("a")).alias("m"),
        timekeys.before(F.col("a"), F.col("b")).alias("bf"),
        timekeys.after(F.col("a"), F.col("b")).alias("af"),
        timekeys.date_hour(F.col("a")).alias("dh"),
        timekeys.fulfill(timekeys.hour_text(F.col("a"))).alias("hh"),
        timekeys.date_key(timekeys.parse_time(F.col("a"))).alias("dk"),
        timekeys.minute_key(timekeys.parse_time(F.col("a"))).alias("mk"),
        timekeys.format_time(timekeys.parse_time(F.col("a"))).alias("ft"),
    ).collect()
    assert rows[0].m == 36000 and rows[0].bf is True and rows[0].af is False
    assert (rows[0].dh, rows[0].hh, rows[0].dk, rows[0].mk) == ("2024-01-01_7", "07", "20240101", "202401010705")
    assert rows[0].ft == "2024-01-01 07:05:09"
    assert rows[1].m == 0 and rows[1].bf is False and rows[1].af is False  # parse error


def test_today_yesterday(spark):
    r = spark.range(1).select(timekeys.today("2024-03-01").alias("t"), timekeys.yesterday("2024-03-01").alias("y")).first()
    assert (r.t, r.y) == ("2024-03-01", "2024-02-29")


def test_date_key_roundtrip_and_formats(spark):
    df = spark.createDataFrame([("20240229",), ("20240230",)], "k string")
    rows = df.select(
        timekeys.parse_date_key(F.col("k")).alias("d"),
        timekeys.format_date(timekeys.parse_date_key(F.col("k"))).alias("f"),
    ).collect()
    assert str(rows[0].d) == "2024-02-29" and rows[0].f == "2024-02-29"
    assert rows[1].d is None  # not a date


def test_is_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "s string")
    assert [r[0] for r in df.select(kv.is_empty(F.col("s"))).collect()] == [True, True, False]


def test_set_field_inserts_value_literally(spark):
    df = spark.createDataFrame([("b=2|a=1",)], "r string")
    value = "x$1\\y"
    got = df.select(kv.set_field(F.col("r"), "a", F.lit(value))).first()[0]
    assert got == java_set_field("b=2|a=1", "a", value) == "b=2|a=x$1\\y"


@pytest.mark.parametrize("record", RECORDS + ["a=1|b=2|a=3", "a|b=1", "x=1|a="])
def test_sql_text_codec_equals_column_codec(spark, record):
    df = spark.createDataFrame([(record, 7)], "r string, v bigint")
    cols = df.select(
        kv.get_field(F.col("r"), "a").alias("g"), kv.set_field(F.col("r"), "a", F.col("v") + 1).alias("s"),
        kv.trim_comma(F.col("r")).alias("t"),
    ).first()
    sql = df.selectExpr(
        f"{kv.get_field_sql('r', 'a')} AS g", f"{kv.set_field_sql('r', 'a', 'v + 1')} AS s", f"{kv.trim_comma_sql('r')} AS t"
    ).first()
    assert cols == sql
    assert sql.s == java_set_field(record, "a", 8) and sql.g == java_get_field(record, "a")


def test_time_sql_text_equals_columns(spark):
    df = spark.createDataFrame([("2024-01-01 7:05:09",), ("2024-01-01 17:05:09",), ("nospace",), (None,), ("2024-1-1 7:5:9",)], "a string")
    cols = df.select(
        timekeys.date_hour(F.col("a")), timekeys.fulfill(timekeys.hour_text(F.col("a"))), timekeys.parse_time(F.col("a"))
    ).collect()
    sql = df.selectExpr(
        timekeys.date_hour_sql("a"), timekeys.fulfill_sql(timekeys.hour_text_sql("a")), timekeys.parse_time_sql("a")
    ).collect()
    assert [tuple(r) for r in cols] == [tuple(r) for r in sql]


def test_codec_on_random_records_matches_java_rules(spark):
    """3,000 random records over a tiny alphabet (so '=', '|', empty pieces and
    repeated names are common), checked against the Java split rules."""
    import random

    rng = random.Random(11)
    records = ["".join(rng.choice("ab=|x") for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, r string")
    rows = df.selectExpr(
        "i", f"{kv.get_field_sql('r', 'a')} AS g_sql", f"{kv.set_field_sql('r', 'a', '9')} AS s_sql"
    ).collect()
    cols = df.select("i", kv.get_field(F.col("r"), "a").alias("g"), kv.set_field(F.col("r"), "a", F.lit(9)).alias("s")).collect()
    by_i = {r.i: r for r in cols}
    for r in rows:
        record = records[r.i]
        if any(p != "" and set(p) == {"="} for p in record.split("|")):
            continue  # pieces made only of '=' make the original throw
        assert r.g_sql == by_i[r.i].g == java_get_field(record, "a"), record
        assert r.s_sql == by_i[r.i].s == java_set_field(record, "a", 9), record


def test_lenient_action_times(spark):
    """Texts that the original's lenient parser reads too."""
    want = {
        "2024-01-01 10:00:00.0": "2024-01-01 10:00:00", "2024-1-1 7:5:9": "2024-01-01 07:05:09",
        "2024-02-30 10:00:00": "2024-03-01 10:00:00", "2024-01-01 10:00:00 ": "2024-01-01 10:00:00",
        "2024-01-01 25:61:61": "2024-01-02 02:02:01", "no time": None, "": None, "99999999-1-1 1:1:1": None,
    }
    df = spark.createDataFrame([(t,) for t in want], "a string")
    got = {r.a: r.t for r in df.selectExpr("a", f"CAST({timekeys.parse_time_sql('a')} AS STRING) AS t").collect()}
    assert got == want
