"""The star-schema tables presented in the shapes the operators expect.

A customer's nation plays the store, an order the basket, a line item the sale line, and an event
type the league. Event times move back by 9131 days so that they fall among the order dates. Faults,
blank fields and layout changes are a function of the row's own values, so they grow with the data.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.contracts import EXPORT_COLUMNS, RULE_SCHEMA
from shelfcast.functions.digest import Pseudonymiser

KEY = "a key for public test data"
FOCUS = "PROMO"
SHIFT_DAYS = 9131
AS_OF = "1999-01-20"
CHECKED_UNTIL = "1998-06-30"

RULES = (
    ("purchase", "national", None, "1.00", "everywhere, no nation"),
    ("signup", "national", "EUROPE", "0.60", "national, one nation"),
    ("error", "local", "ASIA", "0.35", "local"),
    ("view", "national", "", "0.45", "everywhere, blank nation"),
    ("webinar", "local", None, "0.20", "local without a nation, never seen"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rules(spark: SparkSession) -> DataFrame:
    rows = [(name, scope, nation, Decimal(w), why) for name, scope, nation, w, why in RULES]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def stores(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "cast(n_nationkey as string) as store_id", "n_name as store_name", "n_name as city",
        "r_name as region", "r_name as nation",
        "concat('ZZ', cast(n_nationkey as string)) as postcode_district",
    )


def _lines(spark: SparkSession, folder: str, customer: DataFrame) -> DataFrame:
    item = table(spark, folder, "lineitem")
    order = table(spark, folder, "orders")
    part = table(spark, folder, "part")
    return (
        item.join(order, item.l_orderkey == order.o_orderkey)
        .join(customer, order.o_custkey == customer.c_custkey)
        .join(part, item.l_partkey == part.p_partkey)
    )


_SOURCE_FILE = "concat('sales_part-', lpad(cast(l_orderkey % 31 as string), 3, '0'), '.csv')"


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Line items in the silver shape. Customers are pseudonymised before the join fans them out."""
    customer = table(spark, folder, "customer").withColumn(
        "pseudonym", Pseudonymiser(spark, KEY).column(F.col("c_name"))
    )
    return _lines(spark, folder, customer).selectExpr(
        "cast(o_orderkey as string) as transaction_id",
        "o_orderdate as transaction_timestamp",
        "cast(o_orderdate as date) as transaction_date",
        "cast(c_nationkey as string) as store_id",
        "pseudonym as customer_pseudonym",
        "cast(null as string) as loyalty_pseudonym",
        "cast(null as string) as customer_postcode_district",
        "cast(p_partkey as string) as product_sku",
        "p_name as product_name",
        "p_type as category",
        "cast(l_quantity as int) as quantity",
        "cast(p_retailprice as decimal(12,2)) as unit_price_gbp",
        "cast(l_extendedprice as decimal(12,2)) as line_total_gbp",
        "o_orderpriority as channel",
        f"{_SOURCE_FILE} as source_file",
        "'r1' as run_id",
        "cast(timestamp '2001-09-01 00:00:00 UTC' as timestamp) as ingested_at",
    )


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as fixture snapshots: a user's events of one type are versions of one fixture."""
    return table(spark, folder, "events").selectExpr(
        "concat_ws('-', event_type, cast(user_id as string)) as event_id",
        "concat(event_type, ' of ', cast(user_id as string)) as event_name",
        "'stream' as sport",
        "cast(null as string) as league_id",
        "event_type as league_name",
        "cast(null as string) as season",
        "cast(user_id as string) as home_team",
        "cast(null as string) as away_team",
        "cast(null as string) as venue",
        "cast(null as string) as city",
        "cast(null as string) as country",
        f"cast(ts - interval {SHIFT_DAYS} days as date) as event_date",
        f"ts - interval {SHIFT_DAYS} days as kickoff_utc",
        "cast(null as string) as status",
        "value < 5 as is_postponed",
        "'events' as source_name",
        "lpad(cast(event_id as string), 12, '0') as source_file",
        "'r1' as run_id",
        "ts as ingested_at",
        "cast(ts as date) as ingest_date",
    )


# Nations that the declared checks accept, for the regions that play nations here.
NATIONS = {
    "AFRICA": "England", "AMERICA": "Scotland", "ASIA": "Wales", "EUROPE": "Northern Ireland", "MIDDLE EAST": "England",
}

# Texts of an export row, valid in Spark SQL and DuckDB alike apart from the marked formats.
EXPORT_TEXT = {
    "transaction_id": (
        "case when l_linenumber = 7 and l_tax = 0.03 then '' else cast(o_orderkey as string) end"
    ),
    "transaction_timestamp": (
        "case when l_linenumber = 5 and l_tax = 0.02 then '21/08/2026 19:00'"
        " when l_linenumber = 4 then concat({day}, ' 09:30:00Z')"
        " when l_linenumber = 3 then concat({day}, 'T01:15:00.250+02:00')"
        " else concat({day}, 'T18:45') end"
    ),
    "store_id": (
        "case when l_linenumber = 6 and l_tax = 0.01 then '  ' else cast(c_nationkey as string) end"
    ),
    "customer_id": "case when c_custkey % 10 = 0 then '' else concat(' ', c_name) end",
    "customer_email": "concat('c', cast(c_custkey as string), '@mail.example')",
    "loyalty_id": (
        "case when c_custkey % 3 = 0 then concat('LOY-', cast(c_custkey as string)) else '' end"
    ),
    "card_last4": "lpad(cast(c_custkey * 7 % 10000 as string), 4, '0')",
    "customer_postcode": (
        "case c_custkey % 5"
        " when 0 then concat(chr(cast(65 + c_custkey % 26 as int)), cast(1 + c_custkey % 9 as string),"
        " ' ', cast(c_custkey % 10 as string), 'GU')"
        " when 1 then concat('nw', cast(1 + c_custkey % 9 as string), '1ab ')"
        " when 2 then 'not a postcode'"
        " when 3 then ''"
        " else concat(' SW1', chr(cast(65 + c_custkey % 26 as int)), ' ',"
        " cast(c_custkey % 10 as string), 'AA') end"
    ),
    "product_sku": (
        "case when l_linenumber = 1 and l_tax = 0.04 then ' ' else cast(p_partkey as string) end"
    ),
    "product_name": "concat(p_name, ', \"', p_brand, '\"')",
    "category": "p_type",
    "quantity": (
        "case when l_discount = 0.1 and l_tax = 0.08 then '-1'"
        " when l_discount = 0.1 and l_tax = 0.07 then '2.0'"
        " else cast(cast(l_quantity as int) as string) end"
    ),
    "unit_price_gbp": (
        "case when l_linenumber = 2 and l_tax = 0.05 then 'abc'"
        " when l_linenumber = 1 and l_tax = 0.06 then ''"
        " else cast(cast(p_retailprice as decimal(12,2)) as string) end"
    ),
    "line_total_gbp": (
        "case when l_linenumber = 2 and l_tax = 0.06 then '1.239'"
        " when l_linenumber = 2 and l_tax = 0.07 then '-5.00'"
        " else cast(cast(l_extendedprice as decimal(12,2)) as string) end"
    ),
    "channel": "o_orderpriority",
}
SPARK_DAY = "date_format(o_orderdate, 'yyyy-MM-dd')"


def exports(spark: SparkSession, folder: str) -> DataFrame:
    """Export rows as landed: fifteen texts, some faulty, with the file they sit in.

    Orders meet their customers before the lines, so that the lines are shuffled once less.
    """
    customer, order = table(spark, folder, "customer"), table(spark, folder, "orders")
    item, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    order = order.join(customer, order.o_custkey == customer.c_custkey)
    rows = item.join(order, item.l_orderkey == order.o_orderkey).join(part, item.l_partkey == part.p_partkey)
    return rows.selectExpr(
        *[f"{EXPORT_TEXT[c].format(day=SPARK_DAY)} as {c}" for c in EXPORT_COLUMNS],
        f"{_SOURCE_FILE} as source_file",
    )


# JSON text of a provider record, valid in Spark SQL and DuckDB alike apart from the marked formats.
PROVIDER_JSON = (
    "concat('{{\"idEvent\": ', case when value < 2 then '\" \"' else concat('\"', event_type, '-',"
    " cast(user_id as string), '\"') end,"
    " ', \"strEvent\": \" ', event_type, ' night \", \"strLeague\": \"', event_type,"
    " '\", \"strVenue\": \"', case when value < 10 then 'N/A' when value < 20 then ' - ' else 'Hall' end,"
    " '\", \"dateEvent\": ', case when value < 4 then '\"0000-00-00\"' when value < 30 then 'null'"
    " when value < 32 then '\"1970-01-01\"' else concat('\"', {day}, '\"') end,"
    " ', \"strTimestamp\": \"', case when value < 6 then '21/08/2026 19:00'"
    " when value > 95 then 'tbc' else concat({minute}, case when value < 50 then 'Z' else '' end) end,"
    " '\", \"strPostponed\": ', case when value < 40 then '\"yes\"' when value < 60 then '\"no\"'"
    " else 'null' end, ', \"extra\": ', props, '}}')"
)
SPARK_EVENT = {
    "day": "date_format(ts, 'yyyy-MM-dd')",
    "minute": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:00\")",
}


def provider_records(spark: SparkSession, folder: str, moved: bool = False) -> DataFrame:
    """Provider records as landed in two overlapping feeds, as JSON text; ``moved``, half of the fixtures a day later."""
    events = table(spark, folder, "events")
    if moved:
        events = events.withColumn("ts", F.expr("if(user_id % 2 = 0, ts + interval 1 day, ts)"))
    return events.selectExpr(
        "concat_ws('-', event_type, cast(user_id as string)) as fixture",
        "user_id",
        "event_id as landed_id",
        "case when event_id % 2 = 0 or user_id % 3 = 0 then 'events_by_day' else 'events_next_by_league' end as source_name",
        "concat('pull-', cast(event_id % 97 as string)) as source_file",
        "event_id as position",
        f"{PROVIDER_JSON.format(**SPARK_EVENT)} as record",
    )


def envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Provider responses as landed: events in envelopes, empty answers, and web pages by mistake."""
    record = PROVIDER_JSON.format(**SPARK_EVENT)
    answers = table(spark, folder, "events").selectExpr(
        "concat('event-', cast(event_id as string)) as source_file",
        "case when value < 15 then '{\"events\": null}' when value < 25 then '{\"events\": []}'"
        f" when value < 60 then concat('{{\"events\": [', {record}, ']}}')"
        f" else concat('{{\"events\": [', {record}, ', ', {record}, ']}}') end as record",
    )
    pages = table(spark, folder, "pages").selectExpr(
        "concat('page-', cast(page_id as string)) as source_file", "html as record"
    )
    return answers.unionByName(pages)
