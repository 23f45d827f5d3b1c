"""Contracts as columns: every row gets the reason it is rejected for, and none is dropped.

The reason names every offending field (``"store_id: blank; quantity: ..."``) and is empty for a
valid row. It is one ``concat_ws`` over ``when`` expressions, which skips NULLs and compiles.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.contracts import EVENT_SCHEMA, EVENT_YEARS, SALES_SCHEMA
from shelfcast.functions.moments import iso_timestamp
from shelfcast.functions.text import blank

REASON = "reason"
RECORD = "record"
RAGGED = "ragged"

# At most two decimals, apart from trailing zeros.
AMOUNT = r"^\s*[+-]?(?:\d+\.?|\d*\.\d{1,2}0*)\s*$"


def problem(field: str, why: str, bad: Column) -> Column:
    """``"field: why"`` when ``bad`` holds, else NULL."""
    return F.when(bad, F.lit(f"{field}: {why}"))


def reasons(*problems: Column) -> Column:
    return F.concat_ws("; ", *problems)


def to_quantity(c: Column) -> Column:
    """A whole number; NULL for anything else, including ``2.0``."""
    return c.try_cast("int")


def to_money(c: Column) -> Column:
    """An amount with at most two decimals; NULL for anything else instead of rounding it."""
    return F.when(c.rlike(AMOUNT), c).try_cast("decimal(12,2)")


def is_valid() -> Column:
    return F.col(REASON) == ""


def json_record(df: DataFrame, *columns: str) -> Column:
    """The named columns as JSON text with keys in sorted order and NULLs spelled out."""
    return F.to_json(
        F.struct(*[F.col(c) for c in sorted(columns or df.columns)]), {"ignoreNullFields": "false"}
    )


def check_sales(safe: DataFrame, run_id: str, ingested_at: datetime) -> DataFrame:
    """Coerce pseudonymised rows into the silver schema, with ``reason`` and ``record`` beside it.

    ``safe`` is the policy's output plus ``source_file`` and, from the export reader, ``ragged``. The
    record kept for the quarantine holds policy outputs only, and only rejected rows get one. A
    ragged row keeps no record at all: its values may sit under the wrong names, personal ones
    included.
    """
    ragged = F.col(RAGGED) if RAGGED in safe.columns else F.lit(False)
    fields = [c for c in safe.columns if c not in (RAGGED, "source_file")]
    # Parsed in a projection of their own: everything below refers to the parsed values more than
    # once, and a filter on the problems must not parse the texts a second time.
    # The generator keeps the optimizer from copying the parsing into filters and join conditions.
    parsed = safe.select("*", F.inline(F.array(F.struct(
        iso_timestamp(F.col("transaction_timestamp")).alias("_moment"),
        to_quantity(F.col("quantity")).alias("_quantity"),
        to_money(F.col("unit_price_gbp")).alias("_price"),
        to_money(F.col("line_total_gbp")).alias("_total"),
    ))))
    count = F.col("_quantity")

    def money_problem(name: str, amount: Column) -> Column:
        bad = ~blank(F.col(name)) & (amount.isNull() | (amount < 0))
        return problem(name, "not an amount of at least 0", bad)

    found = reasons(
        problem("transaction_timestamp", "missing or not ISO-8601", F.col("_moment").isNull()),
        problem("transaction_id", "blank", blank(F.col("transaction_id"))),
        problem("store_id", "blank", blank(F.col("store_id"))),
        problem("product_sku", "blank", blank(F.col("product_sku"))),
        problem("quantity", "not a whole number above 0", count.isNull() | (count <= 0)),
        money_problem("unit_price_gbp", F.col("_price")),
        money_problem("line_total_gbp", F.col("_total")),
    )
    typed = {
        "transaction_timestamp": F.col("_moment"),
        "transaction_date": F.to_date("_moment"),
        "quantity": count,
        "unit_price_gbp": F.col("_price"),
        "line_total_gbp": F.col("_total"),
        "run_id": F.lit(run_id),
        "ingested_at": F.lit(ingested_at).cast("timestamp"),
    }
    judged = parsed.withColumn(REASON, F.when(ragged, "row: ragged").otherwise(found))
    return judged.select(
        *[typed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in SALES_SCHEMA],
        REASON,
        F.when(~ragged & ~is_valid(), json_record(safe, *fields)).alias(RECORD),
    )


def check_events(normalised: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Add ``reason`` to normalised events. The raw text travels in ``record`` as the evidence."""
    first, last = EVENT_YEARS
    date = F.col("event_date")
    malformed = F.col("malformed") if "malformed" in normalised.columns else F.lit(False)
    found = reasons(
        problem("event_id", "blank", blank(F.col("event_id"))),
        F.when(date.isNull(), "event_date: missing or unreadable").when(
            ~F.year(date).between(first, last), f"event_date: not within {first}..{last}"
        ),
    )
    return normalised.select(
        *[F.col(f.name) for f in EVENT_SCHEMA],
        F.when(malformed, "record: not JSON").otherwise(found).alias(REASON),
        F.col(RECORD),
        *carry,
    )


def valid(checked: DataFrame) -> DataFrame:
    """Rows without problems, in the contract's columns."""
    return checked.filter(is_valid()).drop(REASON, RECORD)


def quarantined(checked: DataFrame) -> DataFrame:
    """Rejected rows: reason, lineage and the record to diagnose them by."""
    lineage = [c for c in ("source_name", "source_file", "run_id") if c in checked.columns]
    return checked.filter(~is_valid()).select(
        REASON,
        *lineage,
        F.col("ingested_at").alias("quarantined_at"),
        RECORD,
    )


def quarantine_rate(checked: DataFrame, *by: str) -> DataFrame:
    """``(rows_total, rows_quarantined, quarantine_rate)``; the rate of an empty batch is 0."""
    return _rate(checked, by, F.count("*"), F.count_if(~is_valid()))


def rate_of_counts(counts: DataFrame) -> DataFrame:
    """``quarantine_rate`` of all rows from ``file_counts``."""
    read, written = (F.coalesce(F.sum(c), F.lit(0).cast("long")) for c in ("rows_read", "rows_written"))
    return _rate(counts, (), read, read - written)


def _rate(rows: DataFrame, by: Sequence[str], total: Column, bad: Column) -> DataFrame:
    rate = F.coalesce(F.try_divide(bad.cast("double"), total.cast("double")), F.lit(0.0))
    return rows.groupBy(*by).agg(
        total.alias("rows_total"), bad.alias("rows_quarantined"), rate.alias("quarantine_rate")
    )


def rate_alerts(rates: DataFrame, threshold: float) -> DataFrame:
    """Rate rows above ``threshold``: upstream noise stays below, a changed schema does not."""
    return rates.filter(F.col("quarantine_rate") > threshold)


def file_results(checked: DataFrame) -> DataFrame:
    """What became of each file: rows read, written, quarantined, and the dates it held."""
    ok = is_valid()
    date = F.when(ok, F.col("transaction_date"))
    return results_by_file(checked.groupBy("source_file", date.alias("transaction_date")).agg(
        F.count("*").alias("rows_read"), F.count_if(ok).alias("rows_written")
    ))


def results_by_file(counts: DataFrame) -> DataFrame:
    """``file_results`` from rows by file and date, as ``file_counts`` has them of one run."""
    return counts.groupBy("source_file").agg(
        F.sum("rows_read").alias("rows_read"),
        F.sum("rows_written").alias("rows_written"),
        (F.sum("rows_read") - F.sum("rows_written")).alias("rows_quarantined"),
        F.count("transaction_date").alias("dates_seen"),
        F.min("transaction_date").alias("first_date"),
        F.max("transaction_date").alias("last_date"),
    )


def file_counts(checked: DataFrame) -> DataFrame:
    """Rows read and written by file and date: ``(source_file, run_id, transaction_date, rows_written, rows_read)``.

    Every file appears; its rejected rows are read on a NULL date.
    """
    ok = is_valid()
    return checked.groupBy(
        "source_file", "run_id", F.when(ok, F.col("transaction_date")).alias("transaction_date")
    ).agg(F.count_if(ok).alias("rows_written"), F.count("*").alias("rows_read"))


def file_dates(checked: DataFrame) -> DataFrame:
    """The dates each file wrote to: ``(source_file, run_id, transaction_date, rows_written)``.

    Every file appears, also one whose rows were all rejected (with a NULL date).
    """
    return file_counts(checked).drop("rows_read")


def row_cap_breaches(rows: DataFrame, cap: int) -> DataFrame:
    """Files longer than the export promises: ``(source_file, rows_read)``."""
    return _breaches(rows, F.count("*"), cap)


def breaches_of_counts(counts: DataFrame, cap: int) -> DataFrame:
    """``row_cap_breaches`` from ``file_counts``."""
    return _breaches(counts, F.sum("rows_read"), cap)


def _breaches(rows: DataFrame, read: Column, cap: int) -> DataFrame:
    return rows.groupBy("source_file").agg(read.alias("rows_read")).filter(F.col("rows_read") > cap)
