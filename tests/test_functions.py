from __future__ import annotations

import hashlib
import hmac
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from shelfcast.functions import text
from shelfcast.functions.digest import PrivacyError, Pseudonymiser
from shelfcast.functions.moments import is_weekend, iso_date, iso_day_of_week, iso_timestamp


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_strip_equals_python(spark):
    every = [chr(c) for c in range(1, 0x3100) if chr(c).isspace()]
    values = [f"{c}a b{c}" for c in every] + ["".join(every) + "x", "​x​"]
    assert apply(spark, text.strip, values) == [v.strip() for v in values]


def test_clean_maps_every_spelling_of_nothing_to_null(spark):
    values = ["", "  ", "\t", "null", "NULL ", "None", "n/a", "N/A", "-", None, " Hall ", "--", "no"]
    assert apply(spark, text.clean, values) == [None] * 10 + ["Hall", "--", "no"]


def test_blank_and_empty_are_never_null(spark):
    assert apply(spark, text.blank, [None, "", " \n", "a"]) == [True, True, True, False]
    assert apply(spark, text.null_or_empty, [None, "", " ", "a"]) == [True, True, False, False]


@pytest.mark.parametrize("value, expected", [
    ("N1 9GU", "N1"), ("nw11aa", "NW1"), (" SW1A 1AA ", "SW1A"), ("CF101BH", "CF10"),
    ("not a postcode", None), ("N1", None), ("N1 9GU extra", None), ("", None), (None, None),
    ("N19GU9GU", None),
])
def test_postcode(spark, value, expected):
    assert apply(spark, text.outward_code, [value]) == [expected]


def test_a_whole_postcode_never_survives(spark):
    codes = [f"{a}{d} {e}{b}" for a in ("N", "SW", "CF") for d in ("1", "10", "1A") for e in "09" for b in ("AA", "ZZ")]
    for code, out in zip(codes, apply(spark, text.outward_code, codes)):
        assert out is not None and len(out) <= 4 and not code.replace(" ", "").endswith(out)


def test_stem(spark):
    values = ["/a/b/x.csv", "x.parquet", "x.csv.gz", "csv", "a.csv.parquet"]
    assert apply(spark, text.stem, values) == ["x", "x", "x.csv.gz", "csv", "a.csv"]


def test_mask_url_key(spark):
    values = ["/json/SECRETKEY/x", "https://h/api/v1/json/k/eventsday.php?d=1", "https://h/json"]
    assert apply(spark, text.mask_url_key, values) == [
        "/json/***/x", "https://h/api/v1/json/***/eventsday.php?d=1", "https://h/json",
    ]


@pytest.mark.parametrize("value, expected", [
    ("2026-08-21T19:00:00", datetime(2026, 8, 21, 19)),
    ("2026-08-21 19:00", datetime(2026, 8, 21, 19)),
    ("2026-08-21T19:00:00Z", datetime(2026, 8, 21, 19)),
    ("2026-08-21t19:00:00z", datetime(2026, 8, 21, 19)),
    ("2026-08-21T19:00:00.25+02:00", datetime(2026, 8, 21, 17, 0, 0, 250000)),
    ("2026-08-21T19:00:00+0200", datetime(2026, 8, 21, 17)),
    ("2026-08-21T01:00:00-0530", datetime(2026, 8, 21, 6, 30)),
    ("1969-12-31T23:59:59.999999+00:00", datetime(1969, 12, 31, 23, 59, 59, 999999)),
    ("2026-08-21", None), ("2026", None), ("21/08/2026 19:00", None), ("2026-02-30T10:00:00", None),
    ("2026-08-21T25:00:00", None), ("", None), (None, None), ("tbc", None),
])
def test_iso_timestamp(spark, value, expected):
    assert apply(spark, iso_timestamp, [value]) == [expected]


def test_iso_timestamp_does_not_depend_on_the_session_zone(spark):
    values = ["2026-03-29T01:30:00", "2026-10-25T01:30:00+01:00", "2026-08-21T19:00:00Z"]
    here = apply(spark, iso_timestamp, values)
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        assert apply(spark, iso_timestamp, values) == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_iso_date(spark):
    values = ["2026-08-21", " 2026-08-21 ", "2026-8-21", "0000-00-00", "2026-02-30", "1970-01-01", None]
    assert apply(spark, iso_date, values) == [
        date(2026, 8, 21), date(2026, 8, 21), None, None, None, date(1970, 1, 1), None,
    ]


def test_iso_weekday(spark):
    monday = [date(2026, 8, 3 + i) for i in range(7)]
    assert apply(spark, iso_day_of_week, monday, "date") == [1, 2, 3, 4, 5, 6, 7]
    assert apply(spark, is_weekend, monday, "date") == [False] * 5 + [True] * 2


def reference_digest(key: str, value: str) -> str:
    return hmac.new(key.encode(), value.strip().encode(), hashlib.sha256).hexdigest()[:32]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\0"), min_size=1), max_size=20))
def test_pseudonyms_are_hmac(spark, values):
    for key in ("k", "long key " * 20, "clé"):
        out = apply(spark, Pseudonymiser(spark, key).column, [*values, "x"])
        assert out == [reference_digest(key, v) if v.strip() else None for v in [*values, "x"]]


def test_blank_identifiers_have_no_pseudonym(spark, digest):
    assert apply(spark, digest.column, ["", "  ", None]) == [None] * 3


def test_pseudonyms_ignore_padding_and_type(spark, digest):
    a, b = apply(spark, digest.column, [" CUST-1 ", "CUST-1"])
    assert a == b and len(a) == 32
    assert apply(spark, digest.column, [17], "int") == apply(spark, digest.column, ["17"])


def test_the_key_matters(spark):
    one, two = (apply(spark, Pseudonymiser(spark, k).column, ["CUST-1"]) for k in ("a", "b"))
    assert one != two


def test_a_key_is_required(spark):
    with pytest.raises(PrivacyError):
        Pseudonymiser(spark, "")


def test_the_key_is_not_in_the_plan(spark):
    key = "unmistakable-key"
    df = spark.createDataFrame([("a",)], "v string").select(Pseudonymiser(spark, key).column(F.col("v")))
    df.collect()
    execution = df._jdf.queryExecution().toString()
    pad = bytes(b ^ 0x36 for b in key.encode().ljust(64, b"\0"))
    for secret in (key, pad.hex(), pad.hex().upper(), " ".join(f"{b:02X}" for b in pad)):
        assert secret not in execution
    assert "NestedLoop" not in plan_of(df) and "Cartesian" not in plan_of(df)
