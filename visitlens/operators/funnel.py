"""Page one-step conversion rate along a target page flow.

Only the job name and the ``targetPageFlow`` parameter are fixed by the
original; the rule is ours. For a flow ``p1,…,pn`` and the actions of the
task's date range, ordered inside each session by parsed time and then page
id (actions whose time does not parse are left out):

* hop i (pi -> pi+1) counts adjacent action pairs with pages (pi, pi+1);
* the rate of hop 1 is its count over the number of views of p1, the rate of
  hop i > 1 its count over the count of hop i-1 (half-up, 2 decimals; NULL
  when that denominator is 0).

Plan, one scan and no join. Before anything is shuffled, pages become places in
the flow: a page of the flow its own place, any other one the gap between two
places that it sorts into, where it only parts what stands beside it. Actions
collapse to distinct (session, time, place) rows with a multiplicity. Adjacency
is found by a window over one hour of one session, and each hour leaves one row:
its counts of the hops, its first and its last place. A window over a session's
hours adds the pairs across them, and the sums are one row. So a session that
holds a third of all actions is spread over its hours, and none of its window
groups has more than 3,600 times the places' number of rows. A run of m identical
(time, page) rows adds m-1 self pairs (page, page).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rounding import ratio_sql
from ..functions.timekeys import parse_time_sql

BUCKET_SECONDS = 3600


def place_sql(pages: list[int], column: str = "page_id") -> str:
    """The place of a page among the sorted ``pages``: 2i + 1 for the i-th one,
    2i for one between them; NULL sorts first, as in a window's order."""
    gaps = " ".join(f"WHEN {column} = {p} THEN {2 * i + 1} WHEN {column} < {p} THEN {2 * i}" for i, p in enumerate(pages))
    return f"CASE WHEN {column} IS NULL THEN 0 {gaps} ELSE {2 * len(pages)} END"


def page_points(actions: DataFrame, pages: list[int], bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """One row per distinct (session, time, place) with its multiplicity ``m``;
    the time is a bucket and the second ``at`` in it. Actions whose time does not
    parse are left out. Partial aggregation combines a hot session map-side."""
    second = f"timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {parse_time_sql('action_time')})"
    timed = actions.selectExpr("session_id", f"{second} AS s", f"{place_sql(pages)} AS place").where("s IS NOT NULL")
    timed = timed.selectExpr("session_id", "place", f"pmod(s, {bucket_seconds}) AS at", f"floor(s / {bucket_seconds}) AS bucket")
    return timed.groupBy("session_id", "bucket", "at", "place").agg(F.expr("count(1) AS m"))


def bucket_hops(points: DataFrame, pages: list[int], hops: list[tuple[int, int]], first: int) -> DataFrame:
    """One row per (session, bucket): hop_0, hop_1, ... pairs inside it, the views
    of ``first``, and the first and last place."""
    place = {p: 2 * i + 1 for i, p in enumerate(pages)}
    width = 2 * len(pages) + 1
    beside = points.selectExpr("*", "lag(place) OVER (PARTITION BY session_id, bucket ORDER BY at, place) AS prev")
    counts = [f"count_if(prev = {place[a]} AND place = {place[b]})" for a, b in hops]
    runs = [f" + sum(CASE WHEN place = {place[a]} THEN m - 1 ELSE 0L END)" if a == b else "" for a, b in hops]
    aggs = [f"{count}{run} AS hop_{i}" for i, (count, run) in enumerate(zip(counts, runs, strict=True))]
    # the first and last point by one number each, so that aggregation stays hashed
    aggs += [
        f"sum(CASE WHEN place = {place[first]} THEN m ELSE 0L END) AS views",
        f"min(at * {width} + place) AS low", f"max(at * {width} + place) AS high",
    ]
    ends = [f"low % {width} AS first_place", f"high % {width} AS last_place"]
    return beside.groupBy("session_id", "bucket").agg(*map(F.expr, aggs)).selectExpr("*", *ends).drop("low", "high")


def hop_counts(
    actions: DataFrame, hops: list[tuple[int, int]], first: int, bucket_seconds: int = BUCKET_SECONDS
) -> DataFrame:
    """One row: hop_0, hop_1, ... the adjacent pairs of each of ``hops``, and the
    views of page ``first``."""
    pages = sorted({first, *(p for hop in hops for p in hop)})
    place = {p: 2 * i + 1 for i, p in enumerate(pages)}
    buckets = bucket_hops(page_points(actions, pages, bucket_seconds), pages, hops, first)
    stitched = buckets.selectExpr("*", "lag(last_place) OVER (PARTITION BY session_id ORDER BY bucket) AS before")
    sums = [
        f"coalesce(sum(hop_{i}), 0L) + count_if(before = {place[a]} AND first_place = {place[b]}) AS hop_{i}"
        for i, (a, b) in enumerate(hops)
    ]
    return stitched.agg(*map(F.expr, [*sums, "coalesce(sum(views), 0L) AS views"]))


def one_step_convert_rate(spark: SparkSession, actions: DataFrame, flow: list[int]) -> DataFrame:
    """hop_index, from_page, to_page, hop_count, rate for each hop of ``flow``
    (none for a flow of fewer than two pages)."""
    flow = [int(p) for p in flow]
    hops = list(zip(flow, flow[1:], strict=False))
    if not hops:
        return spark.sql(
            "SELECT CAST(NULL AS INT) AS hop_index, CAST(NULL AS BIGINT) AS from_page, CAST(NULL AS BIGINT) AS to_page, "
            "CAST(NULL AS BIGINT) AS hop_count, CAST(NULL AS DOUBLE) AS rate"
        ).where("false")
    rows = ", ".join(
        f"named_struct('hop_index', {i + 1}, 'from_page', {a}L, 'to_page', {b}L, 'hop_count', hop_{i}, "
        f"'prev', {'views' if i == 0 else f'hop_{i - 1}'})"
        for i, (a, b) in enumerate(hops)
    )
    chain = hop_counts(actions, hops, flow[0]).selectExpr(f"inline(array({rows}))")
    return chain.selectExpr("hop_index", "from_page", "to_page", "hop_count", f"{ratio_sql('hop_count', 'prev')} AS rate")
