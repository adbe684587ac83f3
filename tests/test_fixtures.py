"""The fixture views reproduce the coverage counts published in FIXTURES.md §4
(measured there independently, without a date filter)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from visitlens.functions.params import TaskParams
from visitlens.operators.sessions import aggregate_sessions
from visitlens.operators.stats import bucket_counts
from visitlens.plans.session_stat import sessions_for_task
from visitlens.sources import fixtures

ALL_DATES = TaskParams(start_date="2024-01-01", end_date="2024-01-31")

# size -> (sessions before join, of which user 0, after join, visit 0 s,
#          visit buckets 1s_3s .. 30m, step buckets 1_3 .. 60)
COVERAGE = {
    "0.001": (299, 1, 272, 66, (25, 27, 15, 10, 21, 14, 38, 19, 37), (211, 51, 4, 2, 3, 1)),
    "0.01": (3259, 14, 3067, 870, (211, 242, 109, 143, 246, 184, 365, 148, 549), (2386, 613, 25, 13, 21, 9)),
}


@pytest.mark.parametrize("sf", sorted(COVERAGE))
def test_coverage_counts(spark, sf):
    d = f"/root/testdata/sf{sf}"
    before, user0, after, zero, visits, steps = COVERAGE[sf]
    sessions = aggregate_sessions(fixtures.user_visit_action(spark, d))
    assert sessions.count() == before
    assert sessions.where(F.col("user_id") == 0).count() == user0
    kept = sessions_for_task(fixtures.user_visit_action(spark, d), fixtures.user_info(spark, d), ALL_DATES)
    counts = bucket_counts(kept.select("visit_length", "step_length")).first().asDict()
    assert counts["session_count"] == after
    assert kept.where(F.col("visit_length") == 0).count() == zero
    assert tuple(counts[k] for k in counts if k.startswith("visit_")) == visits
    assert tuple(counts[k] for k in counts if k.startswith("step_")) == steps


def test_user_view_size(spark):
    assert fixtures.user_info(spark, "/root/testdata/sf0.01").count() == 1411


def test_preview_and_views(spark):
    d = "/root/testdata/sf0.001"
    rows = fixtures.preview(spark, d)
    assert {k: len(v) for k, v in rows.items()} == {"user_visit_action": 1, "user_info": 1, "product_info": 1}
    fixtures.register_views(spark, d)
    assert spark.sql("SELECT count(*) FROM user_visit_action").first()[0] == 1000
    assert spark.table("product_info").columns == ["product_id", "product_name", "extend_info"]
