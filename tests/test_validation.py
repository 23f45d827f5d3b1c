from __future__ import annotations

import json
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from shelfcast.contracts import EXPORT_COLUMNS, SALES_SCHEMA
from shelfcast.operators import privacy
from shelfcast.operators import validation as v

STAMP = datetime(2026, 8, 2, 7, 15, tzinfo=timezone.utc)
GOOD = {
    "transaction_id": "T1", "transaction_timestamp": "2026-08-01T23:30:00", "store_id": "STO-1",
    "customer_id": "C1", "customer_email": "jo@mail.example", "loyalty_id": "", "card_last4": "4711",
    "customer_postcode": "N1 9GU", "product_sku": "S1", "product_name": "Margherita",
    "category": "Pizza", "quantity": "2", "unit_price_gbp": "0.10", "line_total_gbp": "0.20",
    "channel": "online",
}


def check(spark, digest, *changes, **extra):
    data = [tuple((GOOD | c)[n] for n in EXPORT_COLUMNS) for c in changes]
    df = spark.createDataFrame(data, ", ".join(f"{n} string" for n in EXPORT_COLUMNS))
    df = df.withColumn("source_file", F.lit("a.csv"))
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    safe = privacy.apply_policy(df, digest, carry=("source_file", *extra))
    return v.check_sales(safe, "run-1", STAMP)


def test_output_matches_the_contract(spark, digest):
    good = v.valid(check(spark, digest, {}))
    assert [(f.name, f.dataType) for f in good.schema] == [(f.name, f.dataType) for f in SALES_SCHEMA]
    row = good.first()
    assert row.transaction_date == date(2026, 8, 1)
    assert row.line_total_gbp == Decimal("0.20") and row.quantity == 2
    assert row.source_file == "a.csv" and row.run_id == "run-1"


@pytest.mark.parametrize("change, field", [
    ({"store_id": "  "}, "store_id"), ({"store_id": None}, "store_id"),
    ({"transaction_id": ""}, "transaction_id"), ({"product_sku": " "}, "product_sku"),
    ({"quantity": "-1"}, "quantity"), ({"quantity": "0"}, "quantity"), ({"quantity": "2.0"}, "quantity"),
    ({"quantity": ""}, "quantity"), ({"quantity": "99999999999"}, "quantity"),
    ({"transaction_timestamp": "01/08/2026"}, "transaction_timestamp"),
    ({"transaction_timestamp": "2026"}, "transaction_timestamp"),
    ({"transaction_timestamp": ""}, "transaction_timestamp"),
    ({"unit_price_gbp": "abc"}, "unit_price_gbp"), ({"unit_price_gbp": "-0.01"}, "unit_price_gbp"),
    ({"line_total_gbp": "1.239"}, "line_total_gbp"), ({"line_total_gbp": "99999999999.00"}, "line_total_gbp"),
    ({"line_total_gbp": "1e3"}, "line_total_gbp"), ({"line_total_gbp": "."}, "line_total_gbp"),
])
def test_each_fault_is_named(spark, digest, change, field):
    checked = check(spark, digest, change)
    assert v.valid(checked).count() == 0
    assert [r.reason.split(":")[0] for r in v.quarantined(checked).collect()] == [field]


@pytest.mark.parametrize("change, column, value", [
    ({"unit_price_gbp": ""}, "unit_price_gbp", None),
    ({"unit_price_gbp": None}, "unit_price_gbp", None),
    ({"unit_price_gbp": " 1.500 "}, "unit_price_gbp", Decimal("1.50")),
    ({"unit_price_gbp": "3"}, "unit_price_gbp", Decimal("3.00")),
    ({"unit_price_gbp": "0"}, "unit_price_gbp", Decimal("0.00")),
    ({"quantity": " 3 "}, "quantity", 3),
    ({"transaction_timestamp": "2026-08-02T00:30:00+01:00"}, "transaction_date", date(2026, 8, 1)),
    ({"category": None}, "category", None),
])
def test_tolerated_values(spark, digest, change, column, value):
    assert [r[column] for r in v.valid(check(spark, digest, change)).collect()] == [value]


def test_all_faults_of_a_row_are_listed(spark, digest):
    checked = check(spark, digest, {"store_id": "", "quantity": "x"})
    assert v.quarantined(checked).first().reason == "store_id: blank; quantity: not a whole number above 0"


def test_one_bad_row_does_not_cost_the_good_ones(spark, digest):
    checked = check(spark, digest, {}, {"quantity": "-1"}, {"transaction_id": "T2"})
    assert v.valid(checked).count() == 2
    (total, bad, rate), = rows(v.quarantine_rate(checked))
    assert (total, bad) == (3, 1) and rate == pytest.approx(1 / 3)


def test_rate_of_an_empty_batch_is_zero(spark, digest):
    assert rows(v.quarantine_rate(check(spark, digest, {}).limit(0))) == [(0, 0, 0.0)]


def test_rate_alert(spark, digest):
    rates = v.quarantine_rate(check(spark, digest, {}, {"quantity": "x"}))
    assert v.rate_alerts(rates, 0.4).count() == 1 and v.rate_alerts(rates, 0.5).count() == 0


def test_quarantined_sales_hold_no_personal_data_but_stay_diagnosable(spark, digest):
    row = v.quarantined(check(spark, digest, {"quantity": "minus one"})).first()
    for secret in ("jo@mail.example", "4711", "N1 9GU", '"C1"'):
        assert secret not in json.dumps(row.asDict(), default=str)
    record = json.loads(row.record)
    assert record["quantity"] == "minus one" and record["transaction_id"] == "T1"
    assert list(record) == sorted(record) and record["loyalty_pseudonym"] is None
    assert (row.source_file, row.run_id) == ("a.csv", "run-1")


def test_ragged_rows_keep_no_record(spark, digest):
    row = v.quarantined(check(spark, digest, {}, ragged=True)).first()
    assert row.reason == "row: ragged" and row.record is None


def test_valid_rows_carry_no_record(spark, digest):
    assert [r.record for r in check(spark, digest, {}).collect()] == [None]


def test_file_results_and_dates(spark, digest):
    checked = check(
        spark, digest, {}, {"transaction_timestamp": "2026-08-02T00:10:00"}, {"quantity": "x"}
    )
    assert rows(v.file_results(checked)) == [
        ("a.csv", 3, 2, 1, 2, date(2026, 8, 1), date(2026, 8, 2))
    ]
    assert rows(v.file_dates(checked), "transaction_date") == [
        ("a.csv", "run-1", None, 0), ("a.csv", "run-1", date(2026, 8, 1), 1),
        ("a.csv", "run-1", date(2026, 8, 2), 1),
    ]


def test_row_cap(spark):
    df = spark.range(10_001).select(F.lit("big.csv").alias("source_file")).union(
        spark.range(10_000).select(F.lit("full.csv").alias("source_file")))
    assert rows(v.row_cap_breaches(df, 10_000)) == [("big.csv", 10_001)]


def test_each_text_is_parsed_once(spark, digest, tmp_path):
    """A filter on the problems does not copy the parsing."""
    rows_ = spark.createDataFrame([tuple("x" for _ in EXPORT_COLUMNS)], list(EXPORT_COLUMNS)).withColumn("source_file", F.lit("a.csv"))
    rows_.write.parquet(str(tmp_path / "e"))
    safe = privacy.apply_policy(spark.read.parquet(str(tmp_path / "e")), digest, carry=("source_file",))
    checked = v.check_sales(safe, "r1", STAMP)
    counts = {plan_of(df).count("RLIKE") for df in (checked, v.valid(checked), v.quarantined(checked))}
    assert len(counts) == 1
