from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import plan_of, rows
from shelfcast.contracts import EXPORT_COLUMNS
from shelfcast.functions.digest import PrivacyError
from shelfcast.operators import leaks, privacy

PERSON = {
    "customer_id": "CUST-77", "customer_email": "jo@mail.example", "loyalty_id": "LOY-5",
    "card_last4": "4711", "customer_postcode": "N1 9GU",
}


@pytest.fixture
def landed(spark):
    row = {c: f"{c} value" for c in EXPORT_COLUMNS} | PERSON
    return spark.createDataFrame([tuple(row[c] for c in EXPORT_COLUMNS)], list(EXPORT_COLUMNS))


def test_policy_covers_the_export_columns():
    assert {p.field for p in privacy.SALES_POLICY} == set(EXPORT_COLUMNS)


def test_unknown_action_is_rejected():
    with pytest.raises(PrivacyError):
        privacy.FieldPolicy("x", "mask")


def test_generalise_without_a_function_is_rejected():
    with pytest.raises(PrivacyError):
        privacy.FieldPolicy("x", privacy.GENERALISE)


def test_hash_needs_a_pseudonymiser(landed):
    with pytest.raises(PrivacyError):
        privacy.apply_policy(landed, None)


def test_projection(landed, digest):
    out = privacy.apply_policy(landed, digest).first().asDict()
    assert list(out) == [p.output_name for p in privacy.SALES_POLICY if p.action != privacy.DROP]
    assert out["customer_postcode_district"] == "N1"
    assert out["store_id"] == "store_id value"
    assert len(out["customer_pseudonym"]) == 32


def test_unknown_fields_are_dropped_and_reported(spark, landed, digest):
    wider = landed.withColumn("customer_phone", F.lit("0123"))
    assert "customer_phone" not in privacy.apply_policy(wider, digest).columns
    headers = spark.createDataFrame([("a.csv", wider.columns), ("b.csv", landed.columns)],
                                    "source_file string, header array<string>")
    assert rows(privacy.unexpected_columns(headers)) == [("a.csv", "customer_phone")]


def test_absent_field_gives_null_and_the_same_schema(landed, digest):
    whole = privacy.apply_policy(landed, digest)
    partial = privacy.apply_policy(landed.drop("loyalty_id"), digest)
    assert partial.columns == whole.columns and partial.dtypes == whole.dtypes
    assert partial.first().loyalty_pseudonym is None


def test_register_and_summary(spark):
    table = rows(privacy.policy_register(spark))
    assert len(table) == 15 and ("card_last4", "drop", "payment data without a use", None) in table
    text = privacy.policy_summary()
    assert text.count("\n") == 16 and "| customer_id | hash | customer_pseudonym |" in text


def personal(spark):
    return spark.createDataFrame([(v,) for v in PERSON.values()], "value string")


def test_no_personal_value_survives(spark, landed, digest):
    safe = privacy.apply_policy(landed, digest)
    assert rows(leaks.leak_scan(safe, personal(spark))) == []
    assert not set(safe.columns) & set(PERSON)


@pytest.mark.parametrize("field", list(PERSON))
def test_the_scan_notices_a_weakened_policy(spark, landed, digest, field):
    weak = [privacy.FieldPolicy(p.field, privacy.KEEP) if p.field == field else p for p in privacy.SALES_POLICY]
    found = rows(leaks.leak_scan(privacy.apply_policy(landed, digest, weak), personal(spark)))
    assert found == [(field, PERSON[field], 1)]


def test_the_scan_finds_embedded_values_and_counts_cells(spark):
    out = spark.createDataFrame([("for jo@mail.example!",)] * 3 + [("jo@mail",), (None,)], "note string")
    assert rows(leaks.leak_scan(out, personal(spark))) == [("note", "jo@mail.example", 3)]


@pytest.mark.parametrize("values", [["ab", "bc", "abcabc", "zz", "a"], ["abc", "xbcx", "bcab", "zyx"]])
def test_scan_equals_brute_force(spark, values):
    cells = ["abcabc", "xbcx", "", "aaa", "zy", "abcabc"]
    out = spark.createDataFrame([(c,) for c in cells], "t string")
    want = sorted(
        ("t", v, sum(v in c for c in cells)) for v in values if any(v in c for c in cells)
    )
    found = leaks.leak_scan(out, spark.createDataFrame([(v,) for v in values], "value string"))
    assert sorted(rows(found)) == want


def test_a_short_value_leaves_the_candidates_of_the_others_alone(spark):
    names = [f"customer-{i:04}" for i in range(40)] + ["abc", "q-17", "zz"]
    cells = spark.createDataFrame(
        [(i, f"note {i} for customer-{i:04} and a plain text {'abc' if i % 7 == 0 else ''}") for i in range(60)], "cell long, text string"
    )

    def met(values):
        parts = leaks.rarest_parts(spark.createDataFrame([(v,) for v in values], "value string"))
        return sorted(rows(leaks.candidates(cells, parts).select("cell", "value")))

    before, after = met(names), met([*names, "a", "1", "ab"])
    assert [r for r in after if r[1] in names] == before
    assert len(before) == 40 + 9  # a value meets the texts that hold it, not every text like it
    assert {r[1] for r in after} - {r[1] for r in before} == {"a", "1", "ab"}


def test_scan_without_values_or_text(spark):
    none = spark.createDataFrame([("",), (None,)], "value string")
    assert rows(leaks.leak_scan(spark.createDataFrame([("a",)], "t string"), none)) == []
    assert rows(leaks.leak_scan(spark.createDataFrame([(None,)], "t string"), personal(spark))) == []


def test_policy_scan_equals_the_scan_of_the_output(spark, landed, digest):
    others = [
        {"customer_id": "cust-2", "product_name": "for cust-2", "channel": " ", "customer_postcode": None},
        {"customer_id": " cust-2", "product_name": "card 1-URGENT", "channel": "cust-2", "customer_postcode": "n1 9gu"},
    ]
    row = landed.first().asDict()
    rows_in = spark.createDataFrame([row, row, *[{**row, **o} for o in others]], landed.schema).withColumn("file", F.lit("of cust-2.csv"))
    policy = [
        privacy.FieldPolicy(p.field, privacy.GENERALISE, "", lambda c: F.coalesce(F.upper(c), F.lit("no cust-2")), "area")
        if p.field == "customer_postcode" else privacy.FieldPolicy(p.field, privacy.KEEP, "", None, "mail")
        if p.field == "customer_email" else p
        for p in privacy.SALES_POLICY
    ]
    fields = ["customer_id", "customer_email", "loyalty_id"]
    more = spark.createDataFrame([("1-URGENT",), ("N1 9GU",)], "value string")
    values = rows_in.select(F.explode(F.array(*fields)).alias("value")).union(more)
    want = sorted(rows(leaks.leak_scan(privacy.apply_policy(rows_in, digest, policy, ("file",)), values)))
    found = leaks.policy_leak_scan(rows_in, digest, policy, fields, ("file",), more)
    assert sorted(rows(found)) == want
    assert {("area", "cust-2", 1), ("file", "cust-2", 4), ("product_name", "1-URGENT", 1), ("area", "N1 9GU", 3)} <= set(want)


def test_policy_scan_reads_the_rows_once(spark, landed, digest):
    read = Observation("landed")
    many = landed.crossJoin(spark.range(500)).drop("id").observe(read, F.count(F.lit(1)).alias("n"))
    weak = [privacy.FieldPolicy(p.field, privacy.KEEP) if p.field == "customer_email" else p for p in privacy.SALES_POLICY]
    found = leaks.policy_leak_scan(many, digest, weak, ["customer_id", "customer_email"])
    assert "Range" not in plan_of(found)  # only counted texts are read from here on
    assert rows(found) == [("customer_email", "jo@mail.example", 500)] and read.get["n"] == 500


def test_few_parts_of_texts_without_values_are_shuffled(spark):
    values = spark.createDataFrame([(f"customer-{i:05}",) for i in range(300)], "value string")
    parts = leaks.rarest_parts(values)
    assert {len(r.part) == r.width == 8 and r.part in r.value for r in parts.collect()} == {True}
    texts = spark.range(2000).selectExpr("id as cell", "sha2(cast(id as string), 256) as text")
    wanted = parts.select("value", "width", F.xxhash64("part").alias("hash"))
    cut = texts.select("cell", F.explode(leaks._hashes(F.col("text"), F.lit(8))).alias("hash"))
    assert cut.count() > 100_000 and leaks._filtered(cut, wanted).count() < 100
    held = values.select(F.monotonically_increasing_id().alias("cell"), F.concat(F.lit("a "), "value").alias("text"))
    assert leaks.candidates(held, parts).select("value").distinct().count() == 300  # none is lost


def test_row_leaks(spark):
    df = spark.createDataFrame(
        [("mail a@b", "a@b", "s"), ("mail", "c@d", "s"), ("x", " ", "s"), ("x", None, "s")],
        "note string, email string, store string",
    )
    assert rows(leaks.row_leaks(df, ["note", "store"], ["email"]), "column_name") == [
        ("note", "email", 1), ("store", "email", 0),
    ]
