"""Analysis-task parameters: the JSON in ``task.task_param``.

Every parameter is a JSON array of which only element 0 counts; a missing
key, a non-array value, an empty array or a null element means "not given".
An empty string also means "no filter" for the session filters. A list
parameter is one comma-joined string inside element 0, e.g.
``{"cities": ["city1,city2"]}``.

Two readers with the same rules:

* :class:`TaskParams` parses one task on the driver (a few hundred bytes) so
  the predicates become literals Catalyst can push into the scan;
* :func:`task_param_columns` reads a whole task table as columns, so that
  many tasks can run in one Spark job (``plans.by_task``).
"""

from __future__ import annotations

import dataclasses
import json
import re

from pyspark.sql import DataFrame

from .. import constants as C

_INT = re.compile(r"^[+-]?\d+$")

# Python attribute name -> JSON key
_FIELDS = {
    "start_date": C.PARAM_START_DATE,
    "end_date": C.PARAM_END_DATE,
    "start_age": C.PARAM_START_AGE,
    "end_age": C.PARAM_END_AGE,
    "professionals": C.PARAM_PROFESSIONALS,
    "cities": C.PARAM_CITIES,
    "sex": C.PARAM_SEX,
    "keywords": C.PARAM_KEYWORDS,
    "category_ids": C.PARAM_CATEGORY_IDS,
    "target_page_flow": C.PARAM_TARGET_PAGE_FLOW,
}


class TaskError(ValueError):
    """A task that cannot be run (not found, missing dates, bad age)."""


def _scalar_text(value) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (dict, list)):
        return json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    return str(value)


def first_param(obj: dict, field: str) -> str | None:
    """Element 0 of the array under ``field`` as text; None when not given."""
    value = obj.get(field)
    if not isinstance(value, list) or not value:
        return None
    return _scalar_text(value[0])


def split_list(value: str | None) -> list[str] | None:
    """A list parameter: None = no filter; [] = matches nothing (only commas).

    Items are split on ``,`` without trimming; empty items are dropped.
    """
    if value is None or value == "":
        return None
    return [item for item in value.split(",") if item != ""]


@dataclasses.dataclass(frozen=True)
class TaskParams:
    start_date: str | None = None
    end_date: str | None = None
    start_age: str | None = None
    end_age: str | None = None
    professionals: str | None = None
    cities: str | None = None
    sex: str | None = None
    keywords: str | None = None
    category_ids: str | None = None
    target_page_flow: str | None = None

    @classmethod
    def from_json(cls, text: str | None) -> "TaskParams":
        obj = json.loads(text) if text else {}
        if not isinstance(obj, dict):
            raise TaskError("task_param is not a JSON object")
        return cls(**{attr: first_param(obj, key) for attr, key in _FIELDS.items()})

    @classmethod
    def of(cls, **values: str | None) -> "TaskParams":
        return cls(**values)

    def to_json(self) -> str:
        """JSON in the task-table format (each given value as a one-element array)."""
        out = {}
        for attr, key in _FIELDS.items():
            value = getattr(self, attr)
            if value is not None:
                out[key] = [value]
        return json.dumps(out, ensure_ascii=False)

    # --- derived, typed views of the parameters ---------------------------
    def date_range(self) -> tuple[str, str]:
        if self.start_date is None or self.end_date is None:
            raise TaskError("task has no startDate/endDate; refusing to scan an undefined range")
        return self.start_date, self.end_date

    def age_range(self) -> tuple[int, int] | None:
        """Both bounds or nothing: a one-sided age range is no filter."""
        if not self.start_age or not self.end_age:
            return None
        if not (_INT.match(self.start_age) and _INT.match(self.end_age)):
            raise TaskError(f"age bounds are not integers: {self.start_age!r}, {self.end_age!r}")
        return int(self.start_age), int(self.end_age)

    def professional_list(self) -> list[str] | None:
        return split_list(self.professionals)

    def city_list(self) -> list[str] | None:
        return split_list(self.cities)

    def sex_value(self) -> str | None:
        return self.sex if self.sex else None

    def keyword_list(self) -> list[str] | None:
        return split_list(self.keywords)

    def category_list(self) -> list[str] | None:
        return split_list(self.category_ids)

    def page_flow(self) -> list[int]:
        items = split_list(self.target_page_flow) or []
        if any(not _INT.match(x) for x in items):
            raise TaskError(f"targetPageFlow is not a list of page ids: {self.target_page_flow!r}")
        return [int(x) for x in items]


def _param_sql(param_col: str, key: str) -> str:
    return f"get_json_object({param_col}, '$.{key}[0]')"


def _list_sql(text: str) -> str:
    """SQL of :func:`split_list`: NULL = no filter, [] = match nothing."""
    return f"CASE WHEN coalesce({text}, '') = '' THEN NULL ELSE filter(split({text}, ',', -1), x -> x <> '') END"


def task_param_columns(tasks: DataFrame, param_col: str = "task_param") -> DataFrame:
    """One row per task with the parameters as typed columns.

    Columns: task_id, start_date, end_date, age_lo, age_hi (both NULL when the
    range is absent or one-sided), age_bad (a bound that is not an integer:
    the task matches nothing), professionals, cities, keywords, category_ids
    (array<string> or NULL), sex (NULL = no filter).
    """
    def p(key: str) -> str:
        return _param_sql(param_col, key)

    both = f"(coalesce({p(C.PARAM_START_AGE)}, '') <> '' AND coalesce({p(C.PARAM_END_AGE)}, '') <> '')"
    integer = "'^[+-]?[0-9]+$'"  # same rule as _INT, written without backslashes for SQL text
    good = " AND ".join(
        f"{p(key)} RLIKE {integer} AND TRY_CAST({p(key)} AS BIGINT) IS NOT NULL" for key in (C.PARAM_START_AGE, C.PARAM_END_AGE)
    )
    good = f"({good})"
    return tasks.selectExpr(
        "task_id",
        f"{p(C.PARAM_START_DATE)} AS start_date",
        f"{p(C.PARAM_END_DATE)} AS end_date",
        f"CASE WHEN {both} AND {good} THEN TRY_CAST({p(C.PARAM_START_AGE)} AS BIGINT) END AS age_lo",
        f"CASE WHEN {both} AND {good} THEN TRY_CAST({p(C.PARAM_END_AGE)} AS BIGINT) END AS age_hi",
        f"coalesce({both} AND NOT {good}, false) AS age_bad",
        f"{_list_sql(p(C.PARAM_PROFESSIONALS))} AS professionals",
        f"{_list_sql(p(C.PARAM_CITIES))} AS cities",
        f"CASE WHEN {p(C.PARAM_SEX)} <> '' THEN {p(C.PARAM_SEX)} END AS sex",
        f"{_list_sql(p(C.PARAM_KEYWORDS))} AS keywords",
        f"{_list_sql(p(C.PARAM_CATEGORY_IDS))} AS category_ids",
    )
