from __future__ import annotations

import re
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from shelfcast.contracts import EVENT_SCHEMA, MART_COLUMNS, RULE_SCHEMA, SALES_SCHEMA, STORE_SCHEMA
from shelfcast.operators import demand, dimensions, facts, quality, relevance, staging
from shelfcast.operators.dimensions import dim_store
from shelfcast.plans.build import BY_DAY, Inputs, build, gold, refresh_days, touched_event_days
from shelfcast.plans.publish import ChecksFailed, publish, published, read_table, segments
from shelfcast.sources.silver import EVENT_SNAPSHOT_SCHEMA

STAMP = datetime(2026, 8, 2, 7, 15, tzinfo=timezone.utc)
D1, D2, D3 = date(2026, 8, 1), date(2026, 8, 2), date(2026, 8, 3)
STORES = [("S1", "One", "London", "London", "England", "N1"), ("S2", "Two", "Glasgow", "Scotland", "Scotland", "G1")]
RULES = [
    ("Premier", "national", None, "1.00"), ("Cup", "national", "", "0.85"),
    ("Scots", "national", "Scotland", "0.60"), ("Irish", "local", "Northern Ireland", "0.35"),
    ("Adrift", "local", None, "0.20"),
]


def sale(tid="T1", day=D1, store="S1", customer="c1", category="Pizza", quantity=2, total="5.00"):
    stamp = datetime(day.year, day.month, day.day, 12)
    money = None if total is None else Decimal(total)
    return (tid, stamp, day, store, customer, None, None, "sku", "name", category, quantity, money,
            money, "online", "a.csv", "r1", STAMP)


def event(eid="E1", league="Premier", day=D1, hour=19, postponed=False, source="events_by_day", at=STAMP, pull=D1):
    kickoff = None if hour is None else datetime(day.year, day.month, day.day, hour)
    return (eid, f"name {eid}", "Soccer", None, league, None, None, None, None, None, None, day, kickoff,
            None, postponed, source, "f", "r1", at, pull)


@pytest.fixture
def make(spark):
    def inputs(sales=(), events=(), stores=STORES, rules=RULES):
        priced = [(n, s, a, Decimal(w), "because") for n, s, a, w in rules]
        return Inputs(
            spark.createDataFrame(list(sales), SALES_SCHEMA),
            spark.createDataFrame(list(events), EVENT_SNAPSHOT_SCHEMA),
            spark.createDataFrame(list(stores), STORE_SCHEMA),
            spark.createDataFrame(priced, RULE_SCHEMA),
        )

    return inputs


def test_staging_flags_and_keeps_every_row(make):
    sales = [sale(category=c) for c in ("Pizza", "pizza", None, "Bread")]
    staged = staging.stg_sales(make(sales).raw_sales)
    assert [r.is_pizza_line for r in staged.collect()] == [True, False, False, False]


def test_latest_copy_of_an_event(make):
    later = datetime(2026, 8, 3, tzinfo=timezone.utc)
    df = make(events=[
        event("E1", day=D1), event("E1", day=D2, at=later),
        event("E2", source="events_next_by_league", hour=20), event("E2", source="events_by_day", hour=18),
        event("E3", hour=None),
    ]).raw_events
    got = staging.stg_events(df)
    assert rows(got.select("event_id", "event_date", "kickoff_hour"), "event_id") == [
        ("E1", D2, 19), ("E2", D1, 18), ("E3", D1, None),
    ]


def test_a_hot_event_is_reduced_before_the_shuffle(spark, make, tmp_path):
    make(events=[event("hot", source=f"s{i:03}") for i in range(200)]).raw_events.write.parquet(str(tmp_path / "e"))
    plan = plan_of(staging.stg_events(spark.read.parquet(str(tmp_path / "e"))))
    assert plan.rindex("Partial") > plan.index("Exchange hashpartitioning(event_id")


def test_calendar(make):
    i = make([sale(day=D1), sale(day=D1)], [event(day=D3, postponed=True), event("E2", "No rule", day=D1)])
    staged = staging.stg_events(i.raw_events)
    got = dimensions.dim_date(staging.stg_sales(i.raw_sales), staged)
    assert rows(got, "date_day") == [(D1, 2026, 8, 1, 6, True), (D3, 2026, 8, 3, 1, False)]
    dense = dimensions.dim_date(staging.stg_sales(i.raw_sales), staged, dense=True)
    assert [r.date_day for r in dense.orderBy("date_day").collect()] == [D1, D2, D3]


SALES = [
    sale("T1"), sale("T1", category="Bread", quantity=1, total="1.10"), sale("T1", quantity=1, total=None),
    sale("T2", customer=None, category=None), sale("T3", customer="c1", category="Bread"),
    # A basket split over two customers, as only faulty data has it.
    sale("T4", customer="c2"), sale("T4", customer="c3"),
    sale("T1", store="S2", category="Bread", total=None),
    sale("T1", day=D2),
]


@pytest.mark.parametrize("shape", ["direct", "baskets"])
def test_daily_fact(make, shape):
    lines = staging.stg_sales(make(SALES).raw_sales)
    fact = facts.fct_sales_daily(lines) if shape == "direct" else \
        facts.fct_sales_daily_from_baskets(facts.basket_totals(lines))
    got = {(r.store_id, r.date_day): r for r in fact.collect()}
    a = got["S1", D1]
    assert (a.baskets, a.line_items, a.pizza_units, a.pizza_baskets, a.distinct_customers) == (4, 7, 7, 2, 3)
    assert a.pizza_revenue_gbp == Decimal("15.00") and a.total_revenue_gbp == Decimal("26.10")
    b = got["S2", D1]
    assert (b.baskets, b.pizza_units, b.pizza_baskets) == (1, 0, 0)
    assert b.pizza_revenue_gbp == 0 and b.total_revenue_gbp is None
    assert len(got) == 3


def test_daily_fact_equals_count_distinct(spark):
    """Against the literal definition, with one store-day holding most rows and NULLs in the keys."""
    lines = spark.range(20_000).selectExpr(
        "case when id % 3 < 2 then 'S1' else concat('S', id % 7) end as store_id",
        "date_add(date'2026-08-01', cast(case when id % 3 < 2 then 0 else id % 5 end as int)) as transaction_date",
        "case when id % 41 = 0 then null else cast(id * 7 % 901 as string) end as transaction_id",
        "case when id % 11 = 0 then null else cast(id * 13 % 501 as string) end as customer_pseudonym",
        "id % 4 = 0 as is_pizza_line", "cast(id % 5 as int) as quantity",
        "case when id % 17 = 0 then null else cast(id % 1000 / 100 as decimal(12,2)) end as line_total_gbp",
    )
    focus = F.col("is_pizza_line")
    literal = lines.groupBy("store_id", F.col("transaction_date").alias("date_day")).agg(
        F.count_distinct("transaction_id").alias("baskets"), F.count("*").alias("line_items"),
        F.sum(F.when(focus, F.col("quantity")).otherwise(0)).alias("pizza_units"),
        F.count_distinct(F.when(focus, F.col("transaction_id"))).alias("pizza_baskets"),
        F.sum(F.when(focus, F.col("line_total_gbp")).otherwise(0)).alias("pizza_revenue_gbp"),
        F.sum("line_total_gbp").alias("total_revenue_gbp"),
        F.count_distinct("customer_pseudonym").alias("distinct_customers"),
    )
    want = rows(literal, "store_id", "date_day")
    key = literal.columns
    assert rows(facts.fct_sales_daily(lines).select(key), "store_id", "date_day") == want
    baskets = facts.fct_sales_daily_from_baskets(facts.basket_totals(lines)).select(key)
    assert rows(baskets, "store_id", "date_day") == want


def test_a_hot_store_day_spreads_over_its_baskets(make, spark, tmp_path):
    make(SALES).raw_sales.write.parquet(str(tmp_path / "s"))
    lines = staging.stg_sales(spark.read.parquet(str(tmp_path / "s")))
    plan = plan_of(facts.fct_sales_daily(lines))
    first = plan[plan.rindex("Exchange hashpartitioning"):]
    keys = first[: first.index(")")]
    assert "transaction_id" in keys and "customer_pseudonym" in keys
    # Folded before that exchange, from two copies of a line.
    assert "partial_sum" in first and first.count("Expand") == 1
    expand = first[first.index("Expand [["):]
    assert expand[: expand.index("]]")].count("[") == 3


def test_bridge(make):
    i = make(events=[
        event("E1", "Premier"), event("E2", "Cup"), event("E3", "Scots"), event("E4", "Irish"),
        event("E5", "Adrift"), event("E6", "No rule"), event("E7", "Premier", postponed=True),
    ], stores=[*STORES, ("S3", "Three", "?", "?", None, None), ("S4", "Four", "?", "?", "", None)])
    bridge = relevance.event_store_relevance(staging.stg_events(i.raw_events), i.rules, i.stores)
    got = rows(bridge.select("event_id", "store_id"), "event_id", "store_id")
    everywhere = ["S1", "S2", "S3", "S4"]
    assert got == [("E1", s) for s in everywhere] + [("E2", s) for s in everywhere] + [("E3", "S2")]
    plan = plan_of(bridge)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_features_equal_the_collapsed_bridge(make):
    leagues = ["Premier", "Cup", "Scots", "Irish", "Adrift", "No rule"]
    i = make(events=[
        event(f"E{n}", leagues[n % 6], [D1, D2, D3][n % 7 % 3], None if n % 5 == 0 else n % 24, n % 11 == 0)
        for n in range(300)
    ], stores=[*STORES, ("S3", "Three", "Belfast", "NI", "Northern Ireland", None)])
    staged = staging.stg_events(i.raw_events)
    bridge = relevance.event_store_relevance(staged, i.rules, i.stores)
    want = rows(relevance.bridge_features(bridge), "store_id", "event_date")
    got = rows(relevance.event_features(staged, i.rules, i.stores), "store_id", "event_date")
    assert got == want and len(got) == 9


def test_coverage_of_the_rules(make):
    i = make(events=[event("E1", "Premier"), event("E2", "No rule"), event("E3", "No rule"), event("E4", None)])
    staged = staging.stg_events(i.raw_events)
    assert {r[0] for r in relevance.rules_without_events(i.rules, staged).collect()} == {"Cup", "Scots", "Irish", "Adrift"}
    assert rows(relevance.leagues_without_rules(i.rules, staged)) == [("No rule", 2)]


def mart_of(i):
    return gold(i)["mart_pizza_demand_daily"]


def test_three_events_one_row(make):
    mart = mart_of(make([sale(), sale("T2")], [event("E1"), event("E2", "Cup", hour=15), event("E3", "Cup", hour=None)]))
    assert tuple(mart.columns) == MART_COLUMNS
    row = mart.filter("store_id = 'S1'").collect()
    assert len(row) == 1
    row = row[0]
    assert (row.relevant_event_count, row.max_event_weight) == (3, 1.0)
    assert row.total_event_weight == pytest.approx(2.70)
    assert (row.earliest_kickoff_hour, row.latest_kickoff_hour, row.has_national_broadcast_event) == (15, 19, True)
    assert (row.baskets, row.pizza_units, row.has_sales_data) == (2, 4, True)


def test_future_days_have_events_and_no_target(make):
    mart = mart_of(make([sale()], [event(day=D3)]))
    row = mart.filter("store_id = 'S2' and date_day = '2026-08-03'").first()
    assert row.relevant_event_count == 1 and row.pizza_units is None and row.has_sales_data is False
    quiet = mart.filter("store_id = 'S2' and date_day = '2026-08-01'").first()
    assert (quiet.relevant_event_count, quiet.total_event_weight, quiet.has_national_broadcast_event) == (0, 0.0, False)
    assert quiet.earliest_kickoff_hour is None
    assert demand.future_rows(mart, "2026-08-01").count() == 2


def test_size_of_the_spine(make):
    stores = [(f"S{n}", "n", "c", "r", "England", "x") for n in range(12)]
    days = [date(2026, 8, d) for d in range(1, 32)]
    mart = mart_of(make(
        [sale(store=f"S{n}", day=d) for n in range(12) for d in days[:14]], [event(str(d), day=d) for d in days],
        stores,
    ))
    assert mart.count() == 372 and mart.filter("has_sales_data").count() == 168
    plan = plan_of(mart)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_sales_of_unknown_stores_are_caught_by_a_check(make, spark):
    i = make([sale(store="S9")], [event()])
    tables = gold(i)
    assert tables["mart_pizza_demand_daily"].filter("has_sales_data").count() == 0
    assert rows(quality.relationships(tables["fct_sales_daily"], "store_id", tables["dim_store"], "store_id")) == [("S9", 1)]


# --- checks, each able to go red ----------------------------------------------------------------


def test_check_results(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, n int")
    assert rows(quality.not_null(df, "t", ["k", "n"])) == [("t", "k", 1)]
    assert rows(quality.unique(df, "k")) == [("a", 2)]
    assert rows(quality.unique(df, "n")) == []
    assert rows(quality.accepted_values(df, "n", [1, 2])) == [(3, 1)]
    assert rows(quality.accepted_values(df, "k", ["a"])) == []
    assert rows(quality.grain(df, "k")) == [("a", 2)]
    assert rows(quality.relationships(df, "k", df, "k")) == []


def test_future_and_plausibility(spark):
    fact = spark.createDataFrame([("S1", D1, 1, 1, 1), ("S1", D3, -1, 2, 1), ("S2", D1, 0, 1, 1), ("S3", D1, None, None, None)],
                                 "store_id string, date_day date, pizza_units int, pizza_baskets int, baskets int")
    assert rows(quality.future_dated(fact, "2026-08-02")) == [("S1", D3, -1)]
    assert {r.store_id + str(r.date_day) for r in quality.plausibility(fact).collect()} == {"S12026-08-03", "S22026-08-01"}


def test_personal_columns(spark):
    clean = spark.createDataFrame([("a",)], "store_id string")
    dirty = spark.createDataFrame([("a", None, ("x",))], "Customer_Email string, customer_pseudonym string, n struct<email: string>")
    assert quality.personal_columns({"dim": clean}) == []
    assert quality.personal_columns({"mart": dirty}) == [("mart", "Customer_Email"), ("mart", "email")]
    assert len(quality.personal_columns({"mart": dirty}, pseudonyms=True)) == 3
    exposed = quality.personal_column_exposure({"mart": dirty, "dim": clean}, pseudonyms=True)
    assert rows(exposed, "column_name") == [("mart", "Customer_Email", 1), ("mart", "customer_pseudonym", 0), ("mart", "email", 1)]
    deep = spark.createDataFrame([({"k": ("a",)}, [("b",)]), (None, None)], "m map<string,struct<email:string>>, a array<struct<loyalty_id:string>>")
    assert quality.personal_columns({"t": deep}) == [("t", "email"), ("t", "loyalty_id")]
    assert rows(quality.personal_column_exposure({"t": deep}), "column_name") == [("t", "email", 1), ("t", "loyalty_id", 1)]
    assert rows(quality.personal_column_exposure({"dim": clean})) == []


@pytest.mark.parametrize("few", [100_000, 0])
def test_events_are_never_built_nor_dealt_by_league_alone(spark, make, monkeypatch, few):
    i = make(SALES, [event(f"E{n}", day=D1 if n % 3 else D2) for n in range(30)])
    events, stores = staging.stg_events(i.raw_events), dim_store(i.stores)
    want = sorted(map(repr, relevance.event_store_relevance(events, i.rules, stores).collect()))
    features = sorted(map(repr, relevance.event_features(events, i.rules, stores).collect()))
    monkeypatch.setattr(relevance, "FEW_ROWS", few)
    bridge = relevance.event_store_relevance(events, i.rules, stores)
    plan = plan_of(bridge)
    if few:  # the counted side is broadcast; events stay where they are
        assert "BuildRight" in plan and "hashpartitioning(league_name" not in plan
    else:
        assert re.search(r"hashpartitioning\(league_name#\d+, _salt#\d+", plan) and "ShuffledHashJoin" in plan
        assert not re.search(r"hashpartitioning\(league_name#\d+, \d+\)", plan) and "BuildLeft" not in plan.split("ShuffledHashJoin")[1][:300]
    assert sorted(map(repr, bridge.collect())) == want and len(want) > 0
    assert sorted(map(repr, relevance.event_features(events, i.rules, stores).collect())) == features


def test_suite_has_fifty_checks_and_is_green(spark, make):
    i = make(SALES, [event(), event("E2", "Scots", day=D3)])
    kinds = [c.kind for c in quality.SUITE]
    assert len(kinds) == 50
    assert [kinds.count(k) for k in ("not_null", "unique", "accepted_values", "relationships")] == [32, 6, 4, 4]
    result = quality.run_suite(spark, {**i.tables(), **gold(i)}, "2026-08-31").collect()
    assert len(result) == 50 and len({r.check_name for r in result}) == 50
    assert [r for r in result if r.violations] == []


def test_suite_goes_red(spark, make):
    i = make([sale(store="S9", quantity=-3), sale("T2", day=D3)], [event()],
             stores=[*STORES, STORES[0], ("S5", "Five", "c", "r", "France", "x")])
    result = quality.run_suite(spark, {**i.tables(), **gold(i)}, "2026-08-02").collect()
    red = {r.check_name: r.violations for r in result if r.violations}
    assert red["unique_seed_stores_store_id"] == 1 and red["unique_dim_store_store_id"] == 1
    assert red["accepted_values_seed_stores_nation"] == 1
    assert red["relationships_fct_sales_daily_store_id"] == 1
    assert red["future_dated_fct_sales_daily"] == 1
    assert red["grain_mart_pizza_demand_daily"] == 2


def test_uplift_and_manifest(spark, make):
    mart = mart_of(make([sale(quantity=6), sale("T2", day=D2, quantity=2)], [event(), event("E9", day=D3)]))
    row = quality.uplift(mart).first()
    assert (row.rows_total, row.rows_with_sales, row.rows_with_both) == (6, 2, 1)
    assert (row.units_on_event_days, row.units_on_quiet_days) == (6.0, 2.0)


def test_manifest_is_held_against_demand(spark, make):
    # Four Saturdays: three quiet ones, one of them busier than the others, and a listed one.
    days = [date(2026, 8, d) for d in (1, 8, 15, 22)]
    units = {days[0]: 10, days[1]: 10, days[2]: 16, days[3]: 13}
    mart = mart_of(make([sale(f"T{d}", day=d, quantity=n) for d, n in units.items()], []))
    listed = spark.createDataFrame([(days[3],)], "date_day date")
    # Quiet Saturdays sell 12 on average: 13 is not 15 % more, 16 is.
    assert rows(quality.manifest_mismatches(mart, listed), "date_day") == [(days[2], True, False), (days[3], False, True)]
    assert rows(quality.manifest_mismatches(mart, listed, least=0.05), "date_day") == [(days[2], True, False)]
    lost = spark.createDataFrame([(days[2],), (date(2026, 8, 2),)], "date_day date")
    assert rows(quality.manifest_mismatches(mart, lost), "date_day") == [(date(2026, 8, 2), False, True), (days[3], True, False)]


# --- building, publishing, refreshing -----------------------------------------------------------


def written(spark, paths, name):
    return read_table(spark, name, paths[name])


def same(a, b):
    key = sorted(a.columns)
    return sorted(map(repr, a.select(key).collect())) == sorted(map(repr, b.select(key).collect()))


def test_written_tables_equal_the_lazy_ones(spark, make, lake):
    i = make(SALES, [event(), event("E2", "Scots", day=D3)])
    paths = build(lake, "b1", i)
    tables = gold(i)
    for name in paths:
        assert same(written(spark, paths, name), tables[name]), name
    again = build(lake, "b1", make(SALES[:1], []))
    assert written(spark, again, "fct_sales_daily").count() == 1


def test_a_failed_check_keeps_the_previous_build_serving(spark, make, lake):
    good = build(lake, "good", make([sale()], [event()]))
    tables = {n: written(spark, good, n) for n in good}
    publish(spark, lake, "good", good, quality.run_suite(spark, tables, "2026-08-31"))
    assert spark.table("mart_pizza_demand_daily").count() == 2
    bad = build(lake, "bad", make([sale(store="S9")], [event()]))
    tables = {n: written(spark, bad, n) for n in bad}
    with pytest.raises(ChecksFailed, match="relationships_fct_sales_daily_store_id: 1"):
        publish(spark, lake, "bad", bad, quality.run_suite(spark, tables, "2026-08-31"))
    assert published(spark, lake) == good


def test_refresh_equals_a_full_build(spark, make, lake):
    before = make(SALES, [event("E1", day=D1), event("E2", "Scots", day=D3, pull=D1)])
    paths = build(lake, "b1", before)
    later = datetime(2026, 8, 3, tzinfo=timezone.utc)
    after = make(
        [*SALES, sale("T9", day=D2, store="S2", customer="c9")],
        [event("E1", day=D1), event("E2", "Scots", day=D3, pull=D1),
         # moved: its old day loses its only event
         event("E2", "Scots", day=date(2026, 8, 9), at=later, pull=D3), event("E3", "Cup", day=D2, at=later, pull=D3)],
    )
    moved = {r.date_day for r in touched_event_days(after.raw_events, "2026-08-03").collect()}
    assert moved == {D2, D3, date(2026, 8, 9)}
    new = refresh_days(spark, lake, "b2", after, paths, moved | {D2})
    for name in new:  # the served folder stays the first segment, as it was
        assert segments(new[name])[0].path == paths[name] or name not in BY_DAY
    tables = gold(after)
    for name in new:
        assert same(written(spark, new, name), tables[name]), name
    # A second refresh of some of the same days on top.
    last = refresh_days(spark, lake, "b3", before, new, {D2, date(2026, 8, 9)})
    assert [len(segments(last[n])) for n in BY_DAY] == [3, 3, 3]
    mixed = {(r.store_id, r.date_day) for r in written(spark, last, "fct_sales_daily").collect()}
    assert ("S2", D2) not in mixed


@pytest.mark.parametrize("kind", ["raw", "staging", "seed", "slice"])
def test_a_refresh_with_violations_changes_nothing_that_is_served(spark, make, lake, kind):
    i = make(SALES, [event()])
    paths = build(lake, "b1", i)
    tables = {**i.tables(), **{n: written(spark, paths, n) for n in paths}}
    publish(spark, lake, "b1", paths, quality.run_suite(spark, tables, "2026-08-31"))
    before = {n: sorted(map(repr, spark.table(n).collect())) for n in paths}
    bad = {
        "raw": make([*SALES, sale("T9", quantity=None)], [event()]),
        "staging": make(SALES, [event(), event("E5", postponed=None)]),
        "seed": make(SALES, [event()], stores=[*STORES, ("S5", "Five", "c", "r", "France", "x")]),
        "slice": make([*SALES, sale(store="S9")], [event()]),
    }[kind]
    new = refresh_days(spark, lake, "b2", bad, published(spark, lake), {D1})
    tables = {**bad.tables(), **{n: written(spark, new, n) for n in new}}
    with pytest.raises(ChecksFailed):
        publish(spark, lake, "b2", new, quality.run_suite(spark, tables, "2026-08-31"))
    assert published(spark, lake) == paths
    assert {n: sorted(map(repr, written(spark, paths, n).collect())) for n in paths} == before


def test_refresh_scans_only_the_days_asked_for(spark, make, tmp_path):
    path = str(tmp_path / "sales")
    make([sale(), sale(day=D2)]).raw_sales.write.partitionBy("transaction_date").parquet(path)
    lines = staging.stg_sales(spark.read.schema(SALES_SCHEMA).parquet(path)).filter(F.col("transaction_date").isin([D2]))
    plan = plan_of(facts.fct_sales_daily(lines))
    assert "PartitionFilters: [(transaction_date" in plan or "PartitionFilters: [isnotnull(transaction_date" in plan
