"""Thin staging over silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the category the measures are about, unless another is given.
FOCUS_CATEGORY = "Pizza"

_SALES = (
    "transaction_id", "transaction_timestamp", "transaction_date", "store_id",
    "customer_pseudonym", "loyalty_pseudonym", "customer_postcode_district",
    "product_sku", "product_name", "category", "quantity", "unit_price_gbp", "line_total_gbp",
    "channel",
)
_LINEAGE = ("source_file", "run_id", "ingested_at")
_EVENTS = (
    "event_id", "event_name", "sport", "league_id", "league_name", "season", "home_team",
    "away_team", "venue", "city", "country", "event_date", "kickoff_utc",
)


def stg_sales(raw_sales: DataFrame, focus: str = FOCUS_CATEGORY) -> DataFrame:
    """Line items with the focus flag, which is defined here and nowhere else. No row is dropped."""
    is_focus = F.coalesce(F.col("category") == focus, F.lit(False))
    return raw_sales.select(*_SALES, is_focus.alias("is_pizza_line"), *_LINEAGE)


def latest_events(raw_events: DataFrame) -> DataFrame:
    """The latest copy of each event, with the columns it has.

    Ties go to the alphabetically first source, then to a fixed order of the lineage columns, so the
    result does not depend on partitioning. The rank filter becomes a group limit ahead of the
    shuffle (see ``collapse_sources``).
    """
    latest = Window.partitionBy("event_id").orderBy(
        F.col("ingested_at").desc_nulls_last(),
        F.col("source_name").asc_nulls_last(),
        F.col("source_file").asc_nulls_last(),
        F.col("run_id").desc_nulls_last(),
        F.col("event_date").desc_nulls_last(),
        F.col("kickoff_utc").desc_nulls_last(),
    )
    return raw_events.withColumn("_recency", F.row_number().over(latest)).filter("_recency = 1").drop("_recency")


def stg_events(raw_events: DataFrame) -> DataFrame:
    """The latest copy of each event, with its UTC kickoff hour."""
    return latest_events(raw_events).select(
        *_EVENTS,
        F.hour("kickoff_utc").alias("kickoff_hour"),
        "status", "is_postponed", "source_name", *_LINEAGE,
    )
