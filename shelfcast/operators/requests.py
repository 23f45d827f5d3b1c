"""What a pull of the event feeds should have asked for, and what is missing from it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.contracts import DEFAULT_SPORTS, EVENT_SOURCES, WATCHLIST_LEAGUES

BY_DAY, BY_LEAGUE = EVENT_SOURCES
# The daily window looks back for corrections and ahead for planning.
DAYS_BACK, DAYS_FORWARD = 7, 21


@dataclass(frozen=True)
class FetchWindow:
    """Inclusive dates, sports and leagues of one pull."""

    start: date
    end: date
    sports: Sequence[str] = DEFAULT_SPORTS
    league_ids: Sequence[int] = field(default_factory=lambda: tuple(WATCHLIST_LEAGUES))

    def __post_init__(self) -> None:
        if self.end < self.start:
            raise ValueError(f"window ends ({self.end}) before it starts ({self.start})")

    @classmethod
    def around(
        cls, today: date, days_back: int = DAYS_BACK, days_forward: int = DAYS_FORWARD, **kw
    ) -> FetchWindow:
        return cls(today - timedelta(days_back), today + timedelta(days_forward), **kw)


def windows_around(
    runs: DataFrame, days_back: int = DAYS_BACK, days_forward: int = DAYS_FORWARD
) -> DataFrame:
    """The daily window of each ``run_date``: ``(run_date, start_date, end_date)``."""
    return runs.select(
        "run_date",
        F.date_sub("run_date", days_back).alias("start_date"),
        F.date_add("run_date", days_forward).alias("end_date"),
    )


def request_plan(
    windows: DataFrame,
    sports: Sequence[str] = DEFAULT_SPORTS,
    league_ids: Sequence[int] = tuple(WATCHLIST_LEAGUES),
) -> DataFrame:
    """Every request of every window: ``(run_date, source_name, label)``.

    One feed fans out over days and sports, the other over the watchlist.
    """
    day_labels = F.transform(
        F.sequence("start_date", "end_date", F.expr("interval 1 day")),
        lambda day: F.transform(
            F.lit(list(sports)),
            lambda sport: F.concat_ws("__", F.date_format(day, "yyyy-MM-dd"), F.lower(sport)),
        ),
    )
    league_labels = F.lit([f"league_{i}" for i in league_ids])
    requests = F.array(
        F.struct(F.lit(BY_DAY).alias("source_name"), F.flatten(day_labels).alias("labels")),
        F.struct(F.lit(BY_LEAGUE).alias("source_name"), league_labels.alias("labels")),
    )
    return windows.select("run_date", F.inline(requests)).select(
        "run_date", "source_name", F.explode("labels").alias("label")
    )


def window_plan(spark: SparkSession, window: FetchWindow) -> DataFrame:
    """The request plan of one window."""
    row = spark.createDataFrame(
        [(window.start, window.start, window.end)], "run_date date, start_date date, end_date date"
    )
    return request_plan(row, window.sports, window.league_ids)


def request_count(plan: DataFrame) -> DataFrame:
    """Requests per run and feed, known before any is spent."""
    return plan.groupBy("run_date", "source_name").agg(F.count("*").alias("requests"))


def coverage_gaps(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """Planned requests that left nothing in bronze. ``landed`` has the plan's columns."""
    key = ["run_date", "source_name", "label"]
    return plan.join(landed.select(key), key, "left_anti")


def silent_sources(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """Feeds that answered none of a run's requests: a broken query rather than a quiet month."""
    key = ["run_date", "source_name"]
    return request_count(plan).join(landed.select(key).distinct(), key, "left_anti")
