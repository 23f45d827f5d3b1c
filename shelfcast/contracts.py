"""Declared schemas and fixed names. Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "array<date>": T.ArrayType(T.DateType()),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(12,2)": T.DecimalType(12, 2),
    "decimal(10,4)": T.DecimalType(10, 4),
}


def struct(columns: str) -> T.StructType:
    """A schema from ``"name type, name type"``, without needing a running session."""
    pairs = (column.split(" ") for column in columns.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])

# The columns of a sales export, in the order the shop platform writes them.
EXPORT_COLUMNS = (
    "transaction_id", "transaction_timestamp", "store_id",
    "customer_id", "customer_email", "loyalty_id", "card_last4", "customer_postcode",
    "product_sku", "product_name", "category",
    "quantity", "unit_price_gbp", "line_total_gbp", "channel",
)

# Rows per export promised by the platform.
EXPORT_ROW_CAP = 10_000

# Names and types of the sales line items kept in silver.
SALES_SCHEMA = struct(
    "transaction_id string, transaction_timestamp timestamp_ntz, transaction_date date, "
    "store_id string, customer_pseudonym string, loyalty_pseudonym string, "
    "customer_postcode_district string, product_sku string, product_name string, "
    "category string, quantity int, unit_price_gbp decimal(12,2), line_total_gbp decimal(12,2), "
    "channel string, source_file string, run_id string, ingested_at timestamp"
)
# Silver also says under which version of the key a row's pseudonyms were made.
KEY_VERSION = "key_version"
SILVER_SCHEMA = T.StructType([*SALES_SCHEMA.fields, T.StructField(KEY_VERSION, T.StringType())])
SALES_REQUIRED = (
    "transaction_id", "transaction_timestamp", "transaction_date", "store_id", "product_sku",
    "quantity", "source_file", "ingested_at",
)

# Names and types of the canonical event kept in silver.
EVENT_SCHEMA = struct(
    "event_id string, event_name string, sport string, league_id string, league_name string, "
    "season string, home_team string, away_team string, venue string, city string, "
    "country string, event_date date, kickoff_utc timestamp_ntz, status string, "
    "is_postponed boolean, source_name string, source_file string, run_id string, "
    "ingested_at timestamp"
)
EVENT_REQUIRED = ("event_id", "event_date", "is_postponed", "source_name", "ingested_at")
EVENT_PARTITION = T.StructField("ingest_date", T.DateType())

# Plausible years of an event.
EVENT_YEARS = (1990, 2100)

# The columns of the two seeds.
STORE_SCHEMA = struct(
    "store_id string, store_name string, city string, region string, nation string, "
    "postcode_district string"
)
RULE_SCHEMA = struct(
    "league_name string, scope string, applies_to_nation string, weight decimal(10,4), "
    "rationale string"
)

# Competitions fetched by id.
WATCHLIST_LEAGUES = {
    4328: "English Premier League",
    4329: "English League Championship",
    4480: "UEFA Champions League",
    4482: "FA Cup",
    4391: "NFL",
    4443: "UFC",
}
# Fixed value: the sports asked for when a pull names none.
DEFAULT_SPORTS = ("Soccer",)

# Event feeds in reading order; for one event a later feed wins over an earlier one.
EVENT_SOURCES = ("events_by_day", "events_next_by_league")

# Provider field of each canonical event field.
PROVIDER_FIELDS = {
    "event_id": "idEvent",
    "event_name": "strEvent",
    "sport": "strSport",
    "league_id": "idLeague",
    "league_name": "strLeague",
    "season": "strSeason",
    "home_team": "strHomeTeam",
    "away_team": "strAwayTeam",
    "venue": "strVenue",
    "city": "strCity",
    "country": "strCountry",
    "event_date": "dateEvent",
    "kickoff_utc": "strTimestamp",
    "status": "strStatus",
    "is_postponed": "strPostponed",
}

# The combined table's columns, in order.
MART_COLUMNS = (
    "store_id", "date_day", "store_name", "city", "region", "nation", "iso_day_of_week",
    "is_weekend", "month", "relevant_event_count", "max_event_weight", "total_event_weight",
    "has_national_broadcast_event", "earliest_kickoff_hour", "latest_kickoff_hour", "pizza_units",
    "pizza_baskets", "pizza_revenue_gbp", "baskets", "total_revenue_gbp", "distinct_customers",
    "has_sales_data",
)

# Column names that may not appear in a published table.
PERSONAL_COLUMNS = (
    "customer_id", "customer_email", "email", "loyalty_id", "card_last4", "customer_postcode",
    "postcode", "customer_name", "customer_phone", "date_of_birth",
)
# Pseudonyms are line-item level too; published tables are aggregated past them.
PSEUDONYM_COLUMNS = ("customer_pseudonym", "loyalty_pseudonym")
