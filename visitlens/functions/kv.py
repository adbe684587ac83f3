"""The ``k=v|k=v`` record format of the original job, as column expressions.

The original passed session data between stages as such strings and read
fields back with a split loop. Here they are column functions over whole
tables (``operators.kvrecord``); the typed plans never need them.

Reading rules kept from the original:

* a piece counts only if it has exactly one ``=`` once trailing ``=`` are
  dropped (a Java ``split`` drops trailing empty strings), so ``k=`` (empty
  value) and ``k=a=b`` read as absent, while ``k=v=`` reads ``v``;
* the first valid piece with the wanted name wins.

Writing rule: the first piece whose name (text before the first ``=``)
equals the field is replaced; an unknown field leaves the record unchanged.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import sql_literal


def trim_comma(text: Column) -> Column:
    """``trimComma``: drop one leading and one trailing comma."""
    return F.regexp_replace(text, r"^,|,$", "")


def is_empty(text: Column) -> Column:
    """``isEmpty``: NULL or ''."""
    return F.coalesce(text, F.lit("")) == ""


def field_pattern(field: str) -> str:
    """Regex matching a valid piece named ``field``; group 1 is its value."""
    return r"(?:^|\|)" + re.escape(field) + r"=([^|=]+)=*(?:\||$)"


def get_field(record: Column, field: str) -> Column:
    """``getFieldFromConcatString(record, "|", field)``; NULL when absent."""
    return F.nullif(F.regexp_extract(record, field_pattern(field), 1), F.lit(""))


def set_field(record: Column, field: str, value: Column) -> Column:
    """``setFieldInConcatString(record, "|", field, value)``.

    One anchored regex: the lazy prefix skips as few whole pieces as possible,
    so only the first piece whose name (text before its first ``=``) is
    ``field`` is replaced. Trailing ``|`` are dropped first, as the original's
    split dropped trailing empty pieces."""
    trimmed = F.regexp_replace(record, r"\|+$", "")
    pattern = r"^((?:[^|]*\|)*?)" + re.escape(field) + r"(?:=[^|]*)?(?=\||$)"
    literal = F.regexp_replace(value.cast("string"), r"([\\$])", r"\\$1")  # no group references in the value
    return F.regexp_replace(trimmed, F.lit(pattern), F.concat(F.lit("$1" + field + "="), literal))


def encode(fields: list[tuple[str, Column]]) -> Column:
    """``name=value`` pieces joined by ``|`` (a NULL value drops its piece)."""
    return F.concat_ws("|", *[F.concat(F.lit(name + "="), col.cast("string")) for name, col in fields])



# --- the same rules as SQL text (one parse per projection instead of one
# --- JVM call per function when a plan is built) ------------------------------


def trim_comma_sql(expr: str) -> str:
    return f"regexp_replace({expr}, {sql_literal('^,|,$')}, '')"


def get_field_sql(expr: str, field: str) -> str:
    return f"nullif(regexp_extract({expr}, {sql_literal(field_pattern(field))}, 1), '')"


def set_field_sql(expr: str, field: str, value_expr: str) -> str:
    trimmed = f"regexp_replace({expr}, {sql_literal(r'\|+$')}, '')"
    pattern = sql_literal(r"^((?:[^|]*\|)*?)" + re.escape(field) + r"(?:=[^|]*)?(?=\||$)")
    literal = f"regexp_replace(CAST({value_expr} AS STRING), {sql_literal(r'([\\$])')}, {sql_literal(r'\\$1')})"
    return f"regexp_replace({trimmed}, {pattern}, concat({sql_literal('$1' + field + '=')}, {literal}))"


def encode_sql(fields: list[tuple[str, str]]) -> str:
    return "concat_ws('|', " + ", ".join(f"concat({sql_literal(n + '=')}, CAST({c} AS STRING))" for n, c in fields) + ")"
