"""The combined table: one row per store and day, future days included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.contracts import MART_COLUMNS
from shelfcast.operators.dimensions import calendar_columns

_STORE = ("store_id", "store_name", "city", "region", "nation")


def spine(stores: DataFrame, dates: DataFrame, tasks: int | None = None) -> DataFrame:
    """Every store on every day of the calendar, with the attributes of both.

    The calendar is folded to one row a year, each with the list of its days (366 at most), and each
    store meets each year by its position: stores unroll the sequence of years between the first and
    the last, years join in equality, and the days unroll last. Neither side is gathered in a task or
    on the driver; only two years travel there. Day attributes are recomputed from the day.
    ``tasks`` spreads the unrolling; the default is the session's shuffle parallelism.
    """
    spark = stores.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    year = F.year("date_day")
    first, last = dates.agg(F.min(year), F.max(year)).first()
    years = dates.groupBy(year.alias("_year")).agg(F.collect_set("date_day").alias("_days"))
    span = F.sequence(F.lit(first).cast("int"), F.lit(last).cast("int"))
    return (
        stores.select(*_STORE)
        .repartition(tasks, "store_id")
        .withColumn("_year", F.explode(span))
        .join(years, "_year")
        .withColumn("date_day", F.explode("_days"))
        .select(*_STORE, "date_day", *calendar_columns(F.col("date_day")))
    )


def demand_daily(spine_rows: DataFrame, sales: DataFrame, features: DataFrame) -> DataFrame:
    """Attach the sales fact and the event features to the spine.

    Both sides are already one row per store and day, so no join can multiply rows. Event measures
    default to zero; sales measures stay NULL, because an unknown day is not a day without demand.
    """
    sold = sales.drop("line_items").withColumn("_sold", F.lit(True))
    keyed = features.withColumnRenamed("event_date", "date_day")
    key = ["store_id", "date_day"]
    joined = spine_rows.join(sold, key, "left").join(keyed, key, "left")
    zero = {
        "relevant_event_count": F.coalesce("relevant_event_count", F.lit(0)).cast("long"),
        "max_event_weight": F.coalesce(F.col("max_event_weight").cast("double"), F.lit(0.0)),
        "total_event_weight": F.coalesce(F.col("total_event_weight").cast("double"), F.lit(0.0)),
        "has_national_broadcast_event": F.coalesce("has_national_broadcast_event", F.lit(False)),
        "has_sales_data": F.col("_sold").isNotNull(),
    }
    return joined.select(*[zero.get(c, F.col(c)).alias(c) for c in MART_COLUMNS])


def future_rows(mart: DataFrame, as_of: str) -> DataFrame:
    """Rows to be predicted: days after the logical date."""
    return mart.filter(F.col("date_day") > F.lit(as_of).cast("date"))
