"""Store, event and date dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.moments import is_weekend, iso_day_of_week

_STORE = ("store_id", "store_name", "city", "region", "nation", "postcode_district")
_EVENT = (
    "event_id", "event_name", "sport", "league_id", "league_name", "season", "home_team",
    "away_team", "venue", "city", "country", "event_date", "kickoff_utc", "kickoff_hour",
    "status", "is_postponed",
)


def dim_store(stores: DataFrame) -> DataFrame:
    return stores.select(*_STORE)


def dim_event(staged_events: DataFrame) -> DataFrame:
    """Every staged event, postponed ones included."""
    return staged_events.select(*_EVENT)


def calendar_columns(day: Column) -> list[Column]:
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_day_of_week(day).alias("iso_day_of_week"),
        is_weekend(day).alias("is_weekend"),
    ]


def days(sales: DataFrame, staged_events: DataFrame, sales_day: str = "transaction_date") -> DataFrame:
    """Distinct days with sales or events. ``sales`` may be line items or the daily fact."""
    both = sales.select(F.col(sales_day).alias("date_day")).union(
        staged_events.select(F.col("event_date").alias("date_day"))
    )
    return both.distinct()


def dim_date(
    sales: DataFrame,
    staged_events: DataFrame,
    sales_day: str = "transaction_date",
    dense: bool = False,
) -> DataFrame:
    """The calendar: days that hold data, or with ``dense`` every day between first and last."""
    present = days(sales, staged_events, sales_day)
    if dense:
        present = present.agg(
            F.sequence(F.min("date_day"), F.max("date_day"), F.expr("interval 1 day")).alias("all")
        ).select(F.explode("all").alias("date_day"))
    return present.select("date_day", *calendar_columns(F.col("date_day")))
