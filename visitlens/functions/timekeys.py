"""Time helpers of the original job, as column expressions.

Action times are strings ``yyyy-MM-dd H:mm:ss`` whose hour may be written
without a leading zero. A text that is not of that form is read by its leading
numbers (``LENIENT``); one without them gives NULL instead of failing the job. Parsed values are ``timestamp_ntz`` so differences are wall-clock
seconds whatever the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ACTION_TIME_PATTERN = "yyyy-MM-dd H:mm:ss"


def parse_time(text: Column) -> Column:
    """``parseTime``: string -> timestamp_ntz, NULL when it does not parse."""
    strict = F.try_to_timestamp(text, F.lit(ACTION_TIME_PATTERN)).cast("timestamp_ntz")
    y, mo, d, h, mi, s = (F.regexp_extract(text, LENIENT, i).try_cast("int") for i in range(1, 7))
    one, none = F.lit(1), F.lit(0)
    found = F.try_make_timestamp_ntz(y, one, one, none, none, none)
    for unit, n in (("MONTH", mo - 1), ("DAY", d - 1), ("HOUR", h), ("MINUTE", mi), ("SECOND", s)):
        found = F.timestamp_add(unit, n, found)
    return F.coalesce(strict, found)


def parse_time_sql(text: str) -> str:
    """:func:`parse_time` as SQL text over the SQL expression ``text``."""
    strict = f"CAST(try_to_timestamp({text}, '{ACTION_TIME_PATTERN}') AS TIMESTAMP_NTZ)"
    return f"coalesce({strict}, {_lenient_sql(text)})"


LENIENT = "^([0-9]{1,4})-([0-9]{1,4})-([0-9]{1,5}) +([0-9]{1,5}):([0-9]{1,5}):([0-9]{1,7})"


def _lenient_sql(text: str) -> str:
    """The leading ``y-M-d H:m:s`` of a text that is not canonical: what follows
    is ignored, and a field beyond its range runs over into the next one
    (February 30 is March 1 or 2), as the original's lenient parser does."""
    y, mo, d, h, mi, s = (f"TRY_CAST(regexp_extract({text}, '{LENIENT}', {i}) AS INT)" for i in range(1, 7))
    day = f"timestampadd(DAY, {d} - 1, timestampadd(MONTH, {mo} - 1, try_make_timestamp_ntz({y}, 1, 1, 0, 0, 0)))"
    return f"timestampadd(SECOND, {s}, timestampadd(MINUTE, {mi}, timestampadd(HOUR, {h}, {day})))"


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds ``later - earlier`` of two timestamp_ntz values (complete
    seconds, like integer division of milliseconds by 1000); NULL if either is NULL."""
    return F.timestamp_diff("SECOND", earlier, later)


def minus(time1: Column, time2: Column) -> Column:
    """``minus(t1, t2)``: whole seconds t1 - t2 of two texts; 0 when one does not parse."""
    return F.coalesce(seconds_between(parse_time(time1), parse_time(time2)), F.lit(0).cast("bigint"))


def before(time1: Column, time2: Column) -> Column:
    """``before``: t1 strictly earlier than t2; false when one does not parse."""
    return F.coalesce(parse_time(time1) < parse_time(time2), F.lit(False))


def after(time1: Column, time2: Column) -> Column:
    """``after``: t1 strictly later than t2; false when one does not parse."""
    return F.coalesce(parse_time(time1) > parse_time(time2), F.lit(False))


def date_hour(text: Column) -> Column:
    """``getDateHour``: ``yyyy-MM-dd_H`` by text split; the hour is kept as written."""
    return F.concat(_part(text, " ", 1), F.lit("_"), hour_text(text))


def hour_text(text: Column) -> Column:
    """The hour digits of ``yyyy-MM-dd H:mm:ss`` exactly as written."""
    return _part(_part(text, " ", 2), ":", 1)


def _part(text: Column, sep: str, index: int) -> Column:
    return F.try_element_at(F.split(text, sep, -1), F.lit(index))


def fulfill(text: Column) -> Column:
    """``fulfuill``: a 2-character text as is, any other text with one '0' in front."""
    return F.when(F.length(text) == 2, text).otherwise(F.concat(F.lit("0"), text))


def date_key(ts: Column) -> Column:
    """``formatDateKey``: ``yyyyMMdd``."""
    return F.date_format(ts, "yyyyMMdd")


def minute_key(ts: Column) -> Column:
    """``formatTimeMinute``: ``yyyyMMddHHmm``."""
    return F.date_format(ts, "yyyyMMddHHmm")


def format_time(ts: Column) -> Column:
    """``formatTime``: ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def format_date(ts: Column) -> Column:
    """``formatDate``: ``yyyy-MM-dd``."""
    return F.date_format(ts, "yyyy-MM-dd")


def parse_date_key(text: Column) -> Column:
    """``parseDateKey``: ``yyyyMMdd`` -> date, NULL when it does not parse."""
    return F.try_to_date(text, "yyyyMMdd")


def today(as_of: str) -> Column:
    """``getTodayDate`` for a fixed run date (repeatable), ``yyyy-MM-dd``."""
    return F.date_format(F.to_date(F.lit(as_of)), "yyyy-MM-dd")


def yesterday(as_of: str) -> Column:
    """``getYesterdayDate`` for a fixed run date, ``yyyy-MM-dd``."""
    return F.date_format(F.date_sub(F.to_date(F.lit(as_of)), 1), "yyyy-MM-dd")


# --- the same rules as SQL text (used where a plan is built from SQL) -------


def hour_text_sql(text: str) -> str:
    return f"try_element_at(split(try_element_at(split({text}, ' ', -1), 2), ':', -1), 1)"


def date_hour_sql(text: str) -> str:
    return f"concat(try_element_at(split({text}, ' ', -1), 1), '_', {hour_text_sql(text)})"


def fulfill_sql(expr: str) -> str:
    return f"CASE WHEN length({expr}) = 2 THEN {expr} ELSE concat('0', {expr}) END"
