"""Session filters of an analysis task, folded into one predicate.

A parameter that is not given is no filter; a given one must hold. NULL data
never passes a given filter (the original turned NULL into the text "null").
Keyword and category tests are computed per session during aggregation
(``kw_hit`` / ``cat_hit``), so no list has to be built to filter on them.
"""

from __future__ import annotations

from ..functions.params import TaskParams
from ..session import sql_literal


def age_between(lo: int, hi: int) -> str:
    return f"age BETWEEN {int(lo)} AND {int(hi)}"


def value_in(column: str, items: list[str]) -> str:
    """Whether a comma-separated piece of the value is one of ``items``. The first
    half is what a reader can test; the second decides on values that hold a comma."""
    if not items:
        return "false"
    whole = f"{column} IN ({', '.join(sql_literal(x) for x in items)})"
    piece = f"arrays_overlap(split({column}, ',', -1), {sql_literal(items)})"
    return f"({whole} OR contains({column}, ',')) AND (NOT contains({column}, ',') OR {piece})"


def value_equals(column: str, value: str) -> str:
    return f"{column} = {sql_literal(value)}"


def _all(tests: list[str]) -> str | None:
    return " AND ".join(f"({t})" for t in tests) or None


def _user_tests(params: TaskParams) -> list[str]:
    tests: list[str] = []
    ages = params.age_range()
    if ages is not None:
        tests.append(age_between(*ages))
    professionals = params.professional_list()
    if professionals is not None:
        tests.append(value_in("professional", professionals))
    cities = params.city_list()
    if cities is not None:
        tests.append(value_in("city", cities))
    sex = params.sex_value()
    if sex is not None:
        tests.append(value_equals("sex", sex))
    return tests


def _hit_tests(params: TaskParams) -> list[str]:
    given = {"kw_hit": params.keyword_list(), "cat_hit": params.category_list()}
    return [flag for flag, items in given.items() if items is not None]


def user_predicate(params: TaskParams) -> str | None:
    """The filters on the user's fields alone."""
    return _all(_user_tests(params))


def hit_predicate(params: TaskParams) -> str | None:
    """The filters on a session's keywords and categories alone."""
    return _all(_hit_tests(params))


def session_predicate(params: TaskParams) -> str | None:
    """SQL of the AND of every given filter; None when the task filters nothing.

    A bare conjunction, so that Catalyst can push each test to its side; WHERE
    takes a NULL test as not passed."""
    return _all(_user_tests(params) + _hit_tests(params))
