"""Product table with its JSON status parsed, and per-user click shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import ratio


def product_status(products: DataFrame) -> DataFrame:
    """product_id, product_name, product_status (int from ``extend_info``)."""
    return products.select(
        "product_id",
        "product_name",
        F.get_json_object("extend_info", "$.product_status").cast("int").alias("product_status"),
    )


def click_share_by_user(actions: DataFrame) -> DataFrame:
    """Per user: click actions, all actions and the click share rounded half-up
    at 2 decimals. Counts are aggregated map-side, so a hot user id (0 for
    anonymous actions) costs one partial row per task before the shuffle."""
    counts = actions.groupBy("user_id").agg(
        F.count("click_category_id").alias("clicks"),
        F.count(F.lit(1)).alias("actions"),
    )
    return counts.select("user_id", "clicks", "actions", ratio(F.col("clicks"), F.col("actions")).alias("click_ratio"))
