"""Silver -> gold: the dimensions, the fact, the bridge and the combined table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators import quality
from shelfcast.operators.demand import demand_daily, spine
from shelfcast.operators.dimensions import dim_date, dim_event, dim_store
from shelfcast.operators.facts import fct_sales_daily
from shelfcast.operators.relevance import event_features, event_store_relevance
from shelfcast.operators.staging import FOCUS_CATEGORY, stg_events, stg_sales
from shelfcast.plans.publish import BY_DAY, Location, Segment, counts_folder, read_table, segments
from shelfcast.session import materialise
from shelfcast.sources.folders import read_folder, subfolders, write_partitions

GOLD = "gold"
FACT, BRIDGE, MART = "fct_sales_daily", "event_store_relevance", "mart_pizza_demand_daily"


@dataclass(frozen=True)
class Inputs:
    """What gold is built from. ``focus`` is the category the measures are about."""

    raw_sales: DataFrame
    raw_events: DataFrame
    stores: DataFrame
    rules: DataFrame
    focus: str = FOCUS_CATEGORY
    dense: bool = False

    def tables(self) -> dict[str, DataFrame]:
        return {
            "raw_sales": self.raw_sales,
            "raw_sports_events": self.raw_events,
            "stg_sales": stg_sales(self.raw_sales, self.focus),
            "stg_sports_events": stg_events(self.raw_events),
            "seed_stores": self.stores,
            "seed_event_relevance_rules": self.rules,
        }


def gold(inputs: Inputs) -> dict[str, DataFrame]:
    """Every gold table, for a session that does not want to keep a build.

    The daily fact and the deduplicated events feed several tables each. They are staged in the
    shared folder, so the line items are scanned once however many tables are used; the rest is lazy.
    """
    staged = inputs.tables()
    events = materialise(staged["stg_sports_events"], "stg_sports_events")
    stores = dim_store(inputs.stores)
    fact = materialise(fct_sales_daily(staged["stg_sales"]), FACT)
    dates = dim_date(fact, events, "date_day", inputs.dense)
    features = event_features(events, inputs.rules, stores)
    return {
        "stg_sports_events": events,
        "dim_store": stores,
        "dim_date": dates,
        "dim_event": dim_event(events),
        FACT: fact,
        BRIDGE: event_store_relevance(events, inputs.rules, stores),
        MART: demand_daily(spine(stores, dates), fact, features),
    }


def _write(df: DataFrame, path: str, name: str) -> DataFrame:
    """Write a whole table and return it as read back."""
    by = BY_DAY.get(name)
    if by:
        write_partitions(df, path, (by,), ("store_id",), whole=True)
        if not subfolders(df.sparkSession, path):  # no rows, no files: keep the schema at least
            df.sparkSession.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite").parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    written = read_folder(df.sparkSession, path, df.schema)
    if by:
        # What checks need of this segment is counted once, and then read by every run that serves it.
        quality.measures(written, name, by).write.mode("overwrite").parquet(counts_folder(path))
    return written


def _observed(sales: DataFrame) -> tuple[DataFrame, Observation]:
    """Line items whose row-level checks are counted while they are read for the fact.

    A stage that is run again after a lost executor may count its violations twice; none stay none.
    """
    seen = Observation()
    return sales.observe(seen, *quality.row_checks(("raw_sales", "stg_sales"))), seen


def build(lake: str, build_id: str, inputs: Inputs, seen: dict[str, int] | None = None) -> dict[str, str]:
    """Write every gold table under a folder of this build; returns table -> path.

    ``seen`` gets the violation counts of the line items' row-level checks.

    The calendar and the combined table read the written fact, so line items are scanned once. The
    folder is not served until it is published.
    """
    staged = inputs.tables()
    sales, events = staged["stg_sales"], staged["stg_sports_events"]
    paths = {name: f"{lake}/{GOLD}/build={build_id}/{name}" for name in quality.PUBLISHED}

    def write(name: str, df: DataFrame) -> DataFrame:
        return _write(df, paths[name], name)

    stores = write("dim_store", dim_store(inputs.stores))
    dim_events = write("dim_event", dim_event(events))
    sales, counts = _observed(sales)
    fact = write(FACT, fct_sales_daily(sales))
    if seen is not None:
        seen.update(counts.get)
    dates = write("dim_date", dim_date(fact, dim_events, "date_day", inputs.dense))
    write(BRIDGE, event_store_relevance(dim_events, inputs.rules, stores))
    features = event_features(dim_events, inputs.rules, stores)
    write(MART, demand_daily(spine(stores, dates), fact, features))
    return paths


def touched_event_days(raw_events: DataFrame, since: str) -> DataFrame:
    """Days whose events may have changed: ``date_day``.

    Every day any version of an event was ever planned for, for the events seen in snapshots from
    ``since`` on: a moved fixture changes the day it left as well as the day it went to.
    """
    recent = raw_events.filter(F.col("ingest_date") >= F.lit(since).cast("date")).select("event_id")
    return (
        raw_events.join(recent.distinct(), "event_id", "left_semi")
        .select(F.col("event_date").alias("date_day")).distinct()
    )


def refresh_days(
    spark: SparkSession,
    lake: str,
    refresh_id: str,
    inputs: Inputs,
    current: Mapping[str, Location],
    days: Iterable[date],
    seen: dict[str, int] | None = None,
) -> dict[str, Location]:
    """Rebuild only the given days of the published tables; returns table -> location.

    Everything is written under this refresh's own folder: the dimensions as a whole, since any day can
    change them, and of the tables by day just the given days. What is served stays as it is until the
    result is checked and published. The day list prunes the line-item scan to those partitions. A day
    that lost its last sale and event is named without rows and so leaves the tables. A changed store or
    rule table affects every day and calls for ``build``.
    """
    wanted = sorted(set(days))
    if not wanted:
        return dict(current)
    staged = inputs.tables()
    events = staged["stg_sports_events"]
    folder = {name: f"{lake}/{GOLD}/build={refresh_id}/{name}" for name in quality.PUBLISHED}
    stores = _write(dim_store(inputs.stores), folder["dim_store"], "dim_store")
    dim_events = _write(dim_event(events), folder["dim_event"], "dim_event")

    sales, counts = _observed(staged["stg_sales"].filter(F.col("transaction_date").isin(wanted)))
    fact = _write(fct_sales_daily(sales), folder[FACT], FACT)
    if seen is not None:
        seen.update(counts.get)
    held = read_table(spark, FACT, current[FACT]).filter(~F.col("date_day").isin(wanted))
    dates = dim_date(
        held.select("date_day").union(fact.select("date_day")), dim_events, "date_day", inputs.dense
    )
    dates = _write(dates, folder["dim_date"], "dim_date")

    slice_events = dim_events.filter(F.col("event_date").isin(wanted))
    _write(event_store_relevance(slice_events, inputs.rules, stores), folder[BRIDGE], BRIDGE)
    slice_dates = dates.filter(F.col("date_day").isin(wanted))
    features = event_features(slice_events, inputs.rules, stores)
    _write(demand_daily(spine(stores, slice_dates), fact, features), folder[MART], MART)
    return {
        name: (*segments(current[name]), Segment(path, tuple(wanted))) if name in BY_DAY else path
        for name, path in folder.items()
    }
