"""Round trip of the session record format over a whole session table.

Encodes each joined session the way the original passed it between stages
(``sessionid=…|searchKeywords=…|…|sex=…``), bumps ``stepLength`` in place,
and decodes every field back. A narrow projection: no shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import constants as C
from ..functions.kv import encode_sql, get_field_sql, set_field_sql, trim_comma_sql

RECORD_FIELDS = (
    (C.FIELD_SESSION_ID, "session_id"),
    (C.FIELD_SEARCH_KEYWORDS, "search_keywords"),
    (C.FIELD_CLICK_CATEGORY_IDS, "click_category_ids"),
    (C.FIELD_VISIT_LENGTH, "visit_length"),
    (C.FIELD_STEP_LENGTH, "step_length"),
    (C.FIELD_AGE, "age"),
    (C.FIELD_PROFESSIONAL, "professional"),
    (C.FIELD_CITY, "city"),
    (C.FIELD_SEX, "sex"),
)


def record_roundtrip(sessions: DataFrame) -> DataFrame:
    """Columns: session_id, record, bumped_record and the decoded fields of the
    bumped record (search_keywords, click_category_ids, visit_length,
    step_length, age, professional, city, sex; NULL where the record has an
    empty value)."""
    bumped = sessions.selectExpr("session_id", "step_length", f"{encode_sql(list(RECORD_FIELDS))} AS record").selectExpr(
        "session_id",
        "record",
        f"{set_field_sql('record', C.FIELD_STEP_LENGTH, 'step_length + 1')} AS bumped_record",
    )
    r = "bumped_record"
    return bumped.selectExpr(
        "session_id",
        "record",
        "bumped_record",
        f"{trim_comma_sql(get_field_sql(r, C.FIELD_SEARCH_KEYWORDS))} AS search_keywords",
        f"{trim_comma_sql(get_field_sql(r, C.FIELD_CLICK_CATEGORY_IDS))} AS click_category_ids",
        f"CAST({get_field_sql(r, C.FIELD_VISIT_LENGTH)} AS BIGINT) AS visit_length",
        f"CAST({get_field_sql(r, C.FIELD_STEP_LENGTH)} AS BIGINT) AS step_length",
        f"CAST({get_field_sql(r, C.FIELD_AGE)} AS INT) AS age",
        f"{get_field_sql(r, C.FIELD_PROFESSIONAL)} AS professional",
        f"{get_field_sql(r, C.FIELD_CITY)} AS city",
        f"{get_field_sql(r, C.FIELD_SEX)} AS sex",
    )
