"""One named query per operator over the star-schema tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.catalog import feeds
from shelfcast.contracts import EVENT_SOURCES, EXPORT_COLUMNS, EXPORT_ROW_CAP
from shelfcast.functions.digest import Pseudonymiser
from shelfcast.functions.text import blank, clean, mask_url_key, outward_code
from shelfcast.operators import demand, dimensions, events, facts, leaks, privacy, quality
from shelfcast.operators import relevance, requests, staging, validation
from shelfcast.plans.build import MART, Inputs, build, gold, refresh_days
from shelfcast.plans.daily import run_daily
from shelfcast.plans.ingest import ingest_events, ingest_sales
from shelfcast.plans.publish import ChecksFailed, publish, published, read_table, segments
from shelfcast.session import end_shuffles, materialise, work_folder
from shelfcast.sources import bronze, latest, ledger, silver
from shelfcast.sources.exports import (
    count_exports, list_exports, read_exports, read_headers, union_all,
)
from shelfcast.sources.quarantine import SALES as SALES_REJECTS, read_quarantine
from shelfcast.sources.seeds import read_rules, read_stores
from shelfcast.streaming.arrivals import pick_up_exports, pick_up_to_publication

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STAMP = datetime(2001, 9, 1, tzinfo=timezone.utc)
FAR = "2100-01-01"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def edge(df: DataFrame) -> DataFrame:
    """Render types that engines print differently: dates and times as text, decimals as doubles."""

    def shown(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            return c.cast("string").alias(f.name)
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        return c

    return df.select(*[shown(f) for f in df.schema.fields])


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stg_sales(feeds.raw_sales(spark, folder), feeds.FOCUS)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stg_events(feeds.raw_events(spark, folder))


def _inputs(spark: SparkSession, folder: str) -> Inputs:
    return Inputs(
        feeds.raw_sales(spark, folder), feeds.raw_events(spark, folder),
        feeds.stores(spark, folder), feeds.rules(spark), feeds.FOCUS,
    )


def _mart(spark: SparkSession, folder: str) -> DataFrame:
    return gold(_inputs(spark, folder))["mart_pizza_demand_daily"]


# --- staging, dimensions, facts -----------------------------------------------------------------


@query
def stg_sales_flag(spark, folder):
    return edge(_lines(spark, folder).select(
        "transaction_id", "transaction_timestamp", "transaction_date", "store_id", "product_sku",
        "product_name", "category", "quantity", "unit_price_gbp", "line_total_gbp", "channel",
        "is_pizza_line", "source_file", "run_id",
    ))


@query
def stg_events_latest(spark, folder):
    return edge(_events(spark, folder).select(
        "event_id", "event_name", "league_name", "event_date", "kickoff_utc", "kickoff_hour",
        "is_postponed", "source_file",
    ))


@query
def dim_store(spark, folder):
    return dimensions.dim_store(feeds.stores(spark, folder))


@query
def dim_date(spark, folder):
    return edge(dimensions.dim_date(_lines(spark, folder), _events(spark, folder)))


@query
def dim_date_dense(spark, folder):
    return edge(dimensions.dim_date(_lines(spark, folder), _events(spark, folder), dense=True))


@query
def dim_event(spark, folder):
    return edge(dimensions.dim_event(_events(spark, folder)).select(
        "event_id", "event_name", "sport", "league_name", "home_team", "event_date", "kickoff_utc",
        "kickoff_hour", "is_postponed",
    ))


@query
def fct_sales_daily(spark, folder):
    return edge(facts.fct_sales_daily(_lines(spark, folder)))


@query
def basket_totals(spark, folder):
    return edge(facts.basket_totals(_lines(spark, folder)).drop("customer_pseudonym"))


@query
def fct_sales_daily_preagg(spark, folder):
    return edge(facts.fct_sales_daily_from_baskets(facts.basket_totals(_lines(spark, folder))))


# --- relevance and the combined table -----------------------------------------------------------


@query
def relevance_bridge(spark, folder):
    return edge(relevance.event_store_relevance(
        _events(spark, folder), feeds.rules(spark), feeds.stores(spark, folder)
    ))


@query
def rules_without_events(spark, folder):
    return relevance.rules_without_events(feeds.rules(spark), _events(spark, folder))


@query
def leagues_without_rules(spark, folder):
    return relevance.leagues_without_rules(feeds.rules(spark), _events(spark, folder))


@query
def event_features(spark, folder):
    bridge = relevance.event_store_relevance(
        _events(spark, folder), feeds.rules(spark), feeds.stores(spark, folder)
    )
    return edge(relevance.bridge_features(bridge))


@query
def event_features_decomposed(spark, folder):
    return edge(relevance.event_features(
        _events(spark, folder), feeds.rules(spark), feeds.stores(spark, folder)
    ))


@query
def spine(spark, folder):
    dates = dimensions.dim_date(_lines(spark, folder), _events(spark, folder))
    return edge(demand.spine(feeds.stores(spark, folder), dates).select(
        "store_id", "date_day", "store_name", "nation"
    ))


@query
def mart_daily(spark, folder):
    return edge(_mart(spark, folder))


@query
def mart_future_rows(spark, folder):
    return edge(demand.future_rows(_mart(spark, folder), feeds.AS_OF))


# --- privacy ------------------------------------------------------------------------------------


@query
def pseudonymise_customers(spark, folder):
    digest = Pseudonymiser(spark, feeds.KEY)
    return feeds.table(spark, folder, "customer").select(
        "c_custkey",
        digest.column(F.col("c_custkey")).alias("key_pseudonym"),
        digest.column(F.concat(F.lit(" \t"), "c_name", F.lit("\n"))).alias("name_pseudonym"),
        digest.column(F.when(F.col("c_custkey") % 2 == 0, "  ")).alias("blank_pseudonym"),
    )


def _safe(spark, folder, policy=privacy.SALES_POLICY):
    return privacy.apply_policy(
        feeds.exports(spark, folder), Pseudonymiser(spark, feeds.KEY), policy, ("source_file",)
    )


@query
def policy_projection(spark, folder):
    return _safe(spark, folder)


@query
def policy_register(spark, folder):
    """The policy beside what actually arrives: filled cells of each field."""
    rows = feeds.exports(spark, folder)
    filled = rows.agg(*[F.count_if(~blank(F.col(c))).alias(c) for c in EXPORT_COLUMNS]).select(
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in EXPORT_COLUMNS
        ]))
    )
    return filled.join(privacy.policy_register(spark).drop("note"), "field")


@query
def policy_absent_field(spark, folder):
    """An export without loyalty ids and with a column nobody has heard of."""
    rows = feeds.exports(spark, folder).drop("loyalty_id").withColumn("customer_phone", F.lit("0"))
    safe = privacy.apply_policy(rows, Pseudonymiser(spark, feeds.KEY), carry=("source_file",))
    return safe.groupBy("source_file").agg(
        F.count("*").alias("row_count"),
        F.count("loyalty_pseudonym").alias("loyalty_pseudonyms"),
        F.count("customer_postcode_district").alias("districts"),
        F.max(F.lit(len(safe.columns))).alias("column_count"),
    )


@query
def policy_drift(spark, folder):
    part = F.regexp_extract("source_file", r"(\d+)", 1).cast("int")
    known = F.lit(list(EXPORT_COLUMNS))
    header = F.when(part % 4 == 0, F.concat(known, F.array(F.lit("customer_phone")))).when(
        part % 4 == 1, F.concat(F.array(F.lit("till_no")), known, F.array(F.lit("Store_Id")))
    ).otherwise(known)
    headers = feeds.exports(spark, folder).select("source_file").distinct().withColumn("header", header)
    return privacy.unexpected_columns(headers)


@query
def postcode_generalise(spark, folder):
    postcode = F.expr(feeds.EXPORT_TEXT["customer_postcode"])
    return feeds.table(spark, folder, "customer").select(
        "c_custkey", outward_code(postcode).alias("district")
    )


_SPELLINGS = (
    "case o_orderkey % 9 when 0 then '' when 1 then ' NULL ' when 2 then 'None' when 3 then 'n/a'"
    " when 4 then '-' when 5 then '   ' when 6 then concat('  ', o_orderpriority, ' ')"
    " when 7 then cast(null as string) else o_orderpriority end"
)


@query
def null_tokens(spark, folder):
    return feeds.table(spark, folder, "orders").select(
        "o_orderkey", clean(F.expr(_SPELLINGS)).alias("cleaned")
    )


@query
def leak_scan(spark, folder):
    """The policy as shipped: the only hit is the customer whose name is that of a sales channel."""
    return _scan(spark, folder, privacy.SALES_POLICY)


@query
def leak_scan_weakened(spark, folder):
    """The red case: the policy keeps the e-mail address."""
    weak = [
        privacy.FieldPolicy(p.field, privacy.KEEP) if p.field == "customer_email" else p
        for p in privacy.SALES_POLICY
    ]
    return _scan(spark, folder, weak)


def _scan(spark, folder, policy):
    return leaks.policy_leak_scan(
        feeds.exports(spark, folder), Pseudonymiser(spark, feeds.KEY), policy,
        personal=("customer_id", "customer_email", "loyalty_id"), carry=("source_file",),
        more=spark.createDataFrame([("1-URGENT",)], "value string"),
    )


@query
def row_leaks(spark, folder):
    personal = ["customer_id", "customer_email", "loyalty_id", "customer_postcode"]
    rows = feeds.exports(spark, folder)
    safe = privacy.apply_policy(
        rows.withColumn("product_name", F.concat("product_name", F.lit(" for "), "customer_email")),
        Pseudonymiser(spark, feeds.KEY),
        carry=personal,
    )
    outputs = ["customer_pseudonym", "loyalty_pseudonym", "customer_postcode_district", "product_name"]
    return leaks.row_leaks(safe, outputs, personal)


# --- validation and quarantine ------------------------------------------------------------------


def _checked_sales(spark, folder):
    return validation.check_sales(_safe(spark, folder), "r1", STAMP)


@query
def validate_sales_valid(spark, folder):
    return edge(validation.valid(_checked_sales(spark, folder)).drop("ingested_at"))


@query
def validate_sales_quarantined(spark, folder):
    rejected = validation.quarantined(_checked_sales(spark, folder))
    record = F.from_json("record", "transaction_id string, quantity string, line_total_gbp string")
    return rejected.select(
        "reason", "source_file", "run_id",
        record.transaction_id.alias("transaction_id"), record.quantity.alias("quantity"),
        record.line_total_gbp.alias("line_total_gbp"),
        F.size(F.json_object_keys("record")).alias("record_fields"),
    )


@query
def quarantine_rate(spark, folder):
    return validation.quarantine_rate(_checked_sales(spark, folder), "source_file")


@query
def quarantine_rate_alerts(spark, folder):
    rates = validation.quarantine_rate(_checked_sales(spark, folder), "transaction_date")
    return edge(validation.rate_alerts(rates, 0.25))


@query
def file_ledger(spark, folder):
    return edge(validation.file_results(_checked_sales(spark, folder)))


@query
def file_dates(spark, folder):
    return edge(validation.file_dates(_checked_sales(spark, folder)))


@query
def rowcap_breaches(spark, folder):
    average = feeds.table(spark, folder, "lineitem").count() // 31
    return validation.row_cap_breaches(feeds.raw_sales(spark, folder), average)


def _normalised(spark, folder):
    return events.normalise_events(feeds.provider_records(spark, folder), "r1", STAMP)


@query
def normalise_events(spark, folder):
    return edge(_normalised(spark, folder).select(
        "position", "event_id", "event_name", "league_name", "venue", "event_date", "kickoff_utc",
        "is_postponed", "kickoff_unparsed", "malformed", "source_name", "source_file",
    ))


@query
def validate_events_valid(spark, folder):
    checked = validation.check_events(_normalised(spark, folder))
    return edge(validation.valid(checked).select(
        "event_id", "event_date", "kickoff_utc", "is_postponed", "source_name", "source_file", "run_id"
    ))


@query
def validate_events_quarantined(spark, folder):
    rejected = validation.quarantined(validation.check_events(_normalised(spark, folder)))
    return rejected.select("reason", "source_name", "source_file", "run_id", "record")


@query
def cross_source_dedup(spark, folder):
    checked = validation.check_events(_normalised(spark, folder), ("position",))
    good = checked.filter(validation.is_valid())
    return edge(events.collapse_sources(good, position="position").select(
        "event_id", "event_date", "source_name", "source_file", "position"
    ))


@query
def json_envelope_explode(spark, folder):
    rows = events.unnest_envelope(feeds.envelopes(spark, folder))
    return rows.select(
        "source_file", "malformed", "position",
        F.get_json_object("record", "$.idEvent").alias("id"),
        F.when(F.col("malformed"), F.md5("record")).alias("evidence"),
    )


# --- requests, files, URLs ----------------------------------------------------------------------


def _plan(spark, folder):
    runs = feeds.table(spark, folder, "events").select(F.to_date("ts").alias("run_date")).distinct()
    return requests.request_plan(requests.windows_around(runs))


def _landed(spark, folder):
    by_day, by_league = EVENT_SOURCES
    # Every event stands for one answered request: rare errors on weekdays for a league's, any other
    # for a day's.
    league = "event_type = 'error' and value > 97 and weekday(ts) < 5"
    return feeds.table(spark, folder, "events").selectExpr(
        "cast(ts as date) as run_date", f"if({league}, '{by_league}', '{by_day}') as source_name",
        f"if({league}, concat('league_', case user_id % 3 when 0 then '4328' when 1 then '4480' else '4443' end),"
        " concat(cast(date_add(cast(ts as date), cast(user_id % 29 as int) - 7) as string), '__soccer')) as label",
    ).distinct()


@query
def request_plan(spark, folder):
    return edge(_plan(spark, folder))


@query
def request_count(spark, folder):
    return edge(requests.request_count(_plan(spark, folder)))


@query
def request_coverage_gaps(spark, folder):
    return edge(requests.coverage_gaps(_plan(spark, folder), _landed(spark, folder)))


@query
def silent_sources(spark, folder):
    return edge(requests.silent_sources(_plan(spark, folder), _landed(spark, folder)))


@query
def reconcile_missing(spark, folder):
    files = feeds.raw_sales(spark, folder).groupBy("source_file").agg(F.count("*").alias("row_count"))
    part = F.regexp_extract("source_file", r"(\d+)", 1).cast("int")
    loads = files.select(
        F.regexp_replace("source_file", "csv$", "parquet").alias("source_file"),
        F.when(part % 3 == 0, ledger.PLANNED).otherwise(ledger.DONE).alias("state"),
    )
    return ledger.unprocessed(files, loads)


@query
def url_redact(spark, folder):
    url = F.regexp_replace("url", r"^(https?://[^/]+)/", "$1/api/json/k3y/")
    return feeds.table(spark, folder, "pages").select("page_id", mask_url_key(url).alias("url"))


# --- the lake -----------------------------------------------------------------------------------


_CSV = {
    "header": True, "escape": '"', "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def _land(rows: DataFrame, landing: str, columns=EXPORT_COLUMNS) -> None:
    """Write export rows as CSV files with a header, each at most as long as an export may be."""
    rows.select(*columns).write.mode("append").option("maxRecordsPerFile", EXPORT_ROW_CAP).csv(landing, **_CSV)
    end_shuffles(rows.sparkSession)


_SILVER = (
    "transaction_id", "transaction_timestamp", "transaction_date", "store_id", "customer_pseudonym",
    "loyalty_pseudonym", "customer_postcode_district", "product_sku", "product_name", "category",
    "quantity", "unit_price_gbp", "line_total_gbp", "channel",
)


@query
def seed_stores(spark, folder):
    """The store list written as a CSV seed and read under its contract."""
    path = f"{work_folder(spark, 'seed')}/stores.csv"
    feeds.stores(spark, folder).write.csv(path, header=True, escape='"')
    return read_stores(spark, path)


@query
def exports_two_layouts(spark, folder):
    """Exports in two column orders, one with an unknown column; every value under its own name."""
    landing = f"{work_folder(spark, 'lake')}/landing"
    rows = feeds.exports(spark, folder)
    turned = F.regexp_extract("source_file", r"(\d+)", 1).cast("int") > 15
    _land(rows.filter(~turned), landing)
    other = rows.filter(turned).withColumn("customer_phone", F.lit("0123 456"))
    turned_columns = [c for c in reversed(EXPORT_COLUMNS) if c != "customer_email"]
    _land(other, landing, ("customer_email", "customer_phone", *turned_columns))
    headers = read_headers(spark, landing)
    digest = Pseudonymiser(spark, feeds.KEY)
    return union_all([
        privacy.apply_policy(layout, digest) for layout in read_exports(spark, landing, headers)
    ])


@query
def exports_listed(spark, folder):
    """Landed files are listed, counted and read exactly once."""
    landing = f"{work_folder(spark, 'lake')}/landing"
    _land(feeds.exports(spark, folder), landing)
    listed = list_exports(spark, landing)
    lines = union_all(read_exports(spark, landing, read_headers(spark, landing)))
    per_file = lines.groupBy("source_file").agg(F.count("*").alias("row_count"))
    return listed.join(per_file, "source_file").agg(
        (F.count("*") == count_exports(spark, landing)).alias("all_files_read"),
        F.sum("row_count").alias("row_count"),
        F.count_if(F.col("row_count") > EXPORT_ROW_CAP).alias("files_over_cap"),
        F.count_if(F.col("length") <= 0).alias("files_without_length"),
    )


@query
def silver_roundtrip_replace(spark, folder):
    """Exports written as CSV and loaded three times, twice under one run and once under another."""
    lake = work_folder(spark, "lake")
    _land(feeds.exports(spark, folder), f"{lake}/landing")
    digest = Pseudonymiser(spark, feeds.KEY)
    for run in ("r1", "r1", "r2"):
        ingest_sales(spark, lake, f"{lake}/landing", digest, run, STAMP)
    silver.register(spark, lake)
    return edge(spark.table("raw_sales").select(*_SILVER, "run_id"))


@query
def event_snapshot_roundtrip(spark, folder):
    """Provider records normalised, checked, collapsed and written twice as one snapshot."""
    lake = work_folder(spark, "lake")
    checked = validation.check_events(_normalised(spark, folder), ("position",))
    good = checked.filter(validation.is_valid())
    for _ in range(2):
        silver.write_event_snapshot(
            events.collapse_sources(good, position="position"), lake, feeds.AS_OF
        )
    silver.register(spark, lake)
    return edge(spark.table("raw_sports_events").select(
        "event_id", "event_date", "kickoff_utc", "is_postponed", "source_name", "source_file", "ingest_date"
    ))


@query
def bronze_to_snapshot(spark, folder):
    """Provider records landed as gzipped lines in two feeds, then ingested twice."""
    lake = work_folder(spark, "lake")
    records = feeds.provider_records(spark, folder)
    for source in EVENT_SOURCES:
        records.filter(F.col("source_name") == source).select("record").write.text(
            f"{lake}/bronze/sports_events/{source}/ingest_date={feeds.AS_OF}", compression="gzip"
        )
    for run in ("r1", "r2"):
        counts = ingest_events(spark, lake, feeds.AS_OF, run, STAMP)
    kept = silver.read_events(spark, lake).groupBy("source_name", "ingest_date", "run_id").agg(
        F.count("*").alias("events")
    )
    return edge(counts.join(kept, "source_name", "left").select(
        "source_name", F.lit(feeds.AS_OF).alias("ingest_date"), F.lit("r2").alias("run_id"), "events",
        "rows_total", "rows_quarantined", "kickoffs_unparsed",
    ))


@query
def incremental_pickup(spark, folder):
    """Two landings taken by the stream one after the other."""
    lake = work_folder(spark, "lake")
    digest = Pseudonymiser(spark, feeds.KEY)
    rows = feeds.exports(spark, folder)
    late = F.regexp_extract("source_file", r"(\d+)", 1).cast("int") > 20
    for name, part in (("first", rows.filter(~late)), ("second", rows.filter(late))):
        _land(part, f"{lake}/landing")
        pick_up_exports(
            spark, f"{lake}/landing", f"{lake}/seen",
            lambda paths, batch, name=name: ingest_sales(spark, lake, paths, digest, f"{name}-{batch}", STAMP),
        ).awaitTermination()
    return edge(silver.read_sales(spark, lake).select(*_SILVER))


@query
def compaction(spark, folder):
    """Silver written in small pieces, then compacted; read back as an external table."""
    lake = work_folder(spark, "lake")
    rows = materialise(validation.valid(_checked_sales(spark, folder)), "valid")
    even = F.pmod(F.xxhash64("source_file"), F.lit(2)) == 0
    for part in (rows.filter(even), rows.filter(~even)):
        silver.replace_sales(spark, lake, part, part.select("source_file"), file_bytes=32 * 1024)
    days = [r[0] for r in rows.select("transaction_date").distinct().toLocalIterator()]
    silver.compact_sales(spark, lake, days)
    database = lake.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"create database {database} location '{lake}/database'")
    silver.register_tables(spark, lake, database)
    return edge(spark.table(f"{database}.raw_sales").select(*_SILVER))


@query
def incremental_mart(spark, folder):
    """Built without the last two years of sales, then refreshed for just those days."""
    lake = work_folder(spark, "lake")
    whole = _inputs(spark, folder)
    cut = F.col("transaction_date") < "2000-01-01"
    early = Inputs(
        whole.raw_sales.filter(cut), whole.raw_events, whole.stores, whole.rules, whole.focus
    )
    paths = build(lake, "b1", early)
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    publish(spark, lake, "b1", paths, quality.run_suite(spark, tables, FAR))
    days = whole.raw_sales.filter(~cut).select("transaction_date").distinct()
    paths = refresh_days(
        spark, lake, "b2", whole, published(spark, lake),
        [r[0] for r in days.toLocalIterator()],
    )
    return edge(read_table(spark, MART, paths[MART]))


@query
def incremental_gate(spark, folder):
    """A clean build is served; a refresh that a check rejects (a rule twice) changes nothing of it."""
    lake, seen = work_folder(spark, "lake"), {}
    inputs = _inputs(spark, folder)
    paths = build(lake, "b1", inputs, seen)
    tables = {**inputs.tables(), **{n: read_table(spark, n, p) for n, p in paths.items()}}
    tables.pop("seed_stores")  # its nations are not the accepted ones
    # The build has counted the violations of all line items, which the refresh does not change.
    publish(spark, lake, "b1", paths, quality.run_suite(spark, tables, FAR, known=seen))
    twice = Inputs(
        inputs.raw_sales, inputs.raw_events, inputs.stores, inputs.rules.union(inputs.rules), inputs.focus
    )
    days = inputs.raw_sales.filter("month(transaction_date) = 6").select("transaction_date").distinct()
    new = refresh_days(
        spark, lake, "b2", twice, published(spark, lake), [r[0] for r in days.toLocalIterator()]
    )
    tables |= {**twice.tables(), **{n: read_table(spark, n, p) for n, p in new.items()}}
    tables.pop("seed_stores")
    try:
        publish(spark, lake, "b2", new, quality.run_suite(spark, tables, FAR, known=seen))
    except ChecksFailed:
        return edge(read_table(spark, MART, published(spark, lake)[MART]))
    raise AssertionError("a refresh with a rule twice was published")


@query
def bronze_envelopes(spark, folder):
    """Provider responses landed as files, one envelope a line, and unnested from there."""
    lake = work_folder(spark, "lake")
    lines = feeds.envelopes(spark, folder).select(F.regexp_replace("record", r"[\r\n]", " ").alias("value"))
    lines.write.text(f"{lake}/{bronze.PREFIX}/{EVENT_SOURCES[0]}/ingest_date={feeds.AS_OF}", compression="gzip")
    return bronze.read_bronze(spark, lake, feeds.AS_OF, envelope=True).select(
        "source_name", "malformed", F.col("position.position").alias("position"),
        F.get_json_object("record", "$.idEvent").alias("id"), F.when(F.col("malformed"), F.md5("record")).alias("evidence"),
    )


@query
def landed_requests(spark, folder):
    """Answers landed as files, and which requests of the runs asked for left one."""
    lake = work_folder(spark, "lake")
    landed = _landed(spark, folder).withColumn("ingest_date", F.col("run_date")).withColumn("value", F.lit("{}"))
    for source in EVENT_SOURCES:
        answers = landed.filter(F.col("source_name") == source).select("ingest_date", "label", "value")
        answers.repartition("ingest_date").write.partitionBy("ingest_date", "label").text(f"{lake}/{bronze.PREFIX}/{source}")
    runs = feeds.table(spark, folder, "events").select(F.to_date("ts")).distinct()
    return edge(bronze.landed_requests(spark, lake, [r[0] for r in runs.toLocalIterator()]))


@query
def daily_run(spark, folder):
    """Two daily runs, the second incremental: late exports, new events, and half of the fixtures moved by a day."""
    lake = work_folder(spark, "lake")
    rows, digest = feeds.exports(spark, folder), Pseudonymiser(spark, feeds.KEY)
    late = F.col("transaction_timestamp") >= "1998-01-01"
    stores = feeds.stores(spark, folder).replace(feeds.NATIONS, subset=["nation"])
    rules = feeds.rules(spark).replace(feeds.NATIONS, subset=["applies_to_nation"])
    newest = Window.partitionBy("fixture", "source_name").orderBy(F.desc("landed_id"))
    days = (("2030-01-01", ~late, False, F.col("user_id") % 2 == 0), ("2030-01-02", late, True, F.lit(True)))
    for n, (day, part, moved, answered) in enumerate(days):
        _land(rows.filter(part), f"{lake}/landing")
        records = feeds.provider_records(spark, folder, moved).filter(answered)
        records = records.withColumn("n", F.row_number().over(newest)).filter("n = 1")
        for source in EVENT_SOURCES:
            records.filter(F.col("source_name") == source).select("record").write.text(
                f"{lake}/{bronze.PREFIX}/{source}/ingest_date={day}", compression="gzip"
            )
        run = run_daily(
            spark, lake, f"{lake}/landing", stores, rules, digest, day, f"run-{n}", STAMP + timedelta(n), feeds.FOCUS,
            incremental=True,
        )
    assert len(segments(run.paths[MART])) == 2  # the second run refreshed days, it did not build anew
    return edge(read_table(spark, MART, published(spark, lake)[MART]))


@query
def pickup_to_mart(spark, folder):
    """Exports landed in two steps, taken by the stream, which ends in the published tables; read by name in the catalog."""
    lake = work_folder(spark, "lake")
    rows, digest, day = feeds.exports(spark, folder), Pseudonymiser(spark, feeds.KEY), "2030-01-02"
    late = F.col("transaction_timestamp") >= "1998-01-01"
    stores = feeds.stores(spark, folder).replace(feeds.NATIONS, subset=["nation"])
    rules = feeds.rules(spark).replace(feeds.NATIONS, subset=["applies_to_nation"])
    newest = Window.partitionBy("fixture", "source_name").orderBy(F.desc("landed_id"))
    records = feeds.provider_records(spark, folder, moved=True).withColumn("n", F.row_number().over(newest)).filter("n = 1")
    for source in EVENT_SOURCES:
        records.filter(F.col("source_name") == source).select("record").write.text(
            f"{lake}/{bronze.PREFIX}/{source}/ingest_date={day}", compression="gzip"
        )
    ingest_events(spark, lake, day, "events", STAMP)
    latest.merge_snapshot(spark, lake, day)
    database = lake.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"create database {database} location '{lake}/database'")
    for part in (~late, late):
        _land(rows.filter(part), f"{lake}/landing")
        pick_up_to_publication(
            spark, lake, f"{lake}/landing", f"{lake}/seen", stores, rules, digest, day, feeds.FOCUS,
            archive=f"{lake}/archive", database=database,
        ).awaitTermination()
    return edge(spark.newSession().table(f"{database}.{MART}"))


@query
def quarantine_readback(spark, folder):
    """The rejected rows as a load wrote them, by reason and whether they kept their record."""
    lake = work_folder(spark, "lake")
    _land(feeds.exports(spark, folder), f"{lake}/landing")
    ingest_sales(spark, lake, f"{lake}/landing", Pseudonymiser(spark, feeds.KEY), "r1", STAMP)
    held = read_quarantine(spark, lake, SALES_REJECTS)
    return held.groupBy("reason", "run_id").agg(
        F.count("*").alias("row_count"), F.count("record").alias("records"),
        F.count(F.get_json_object("record", "$.store_id")).alias("store_ids"),
    )


@query
def key_version_stamp(spark, folder):
    """Two loads under two versions of the key; silver says which made a row's pseudonyms."""
    lake = work_folder(spark, "lake")
    rows = feeds.exports(spark, folder)
    late = F.regexp_extract("source_file", r"(\d+)", 1).cast("int") > 20
    for version, part in (("v1", rows.filter(~late)), ("v2", rows.filter(late))):
        _land(part, f"{lake}/landing-{version}")
        digest = Pseudonymiser(spark, feeds.KEY, version)
        ingest_sales(spark, lake, f"{lake}/landing-{version}", digest, f"load-{version}", STAMP)
    return silver.read_sales(spark, lake).groupBy("key_version", "run_id").agg(
        F.count("*").alias("row_count"), F.count_distinct("customer_pseudonym").alias("customers")
    )


@query
def seed_rules(spark, folder):
    """The relevance rules written as a CSV seed, read under their contract and joined to the events."""
    path = f"{work_folder(spark, 'seed')}/rules.csv"
    feeds.rules(spark).write.csv(path, header=True, escape='"')
    counts = _events(spark, folder).groupBy("league_name").agg(F.count("*").alias("events"))
    return edge(read_rules(spark, path).join(counts, "league_name", "left"))


# --- data checks --------------------------------------------------------------------------------


def _planted(spark, folder):
    """The combined table with faults that follow from its own values."""
    return _with_faults(_mart(spark, folder))


def _with_faults(mart):
    fault = F.col("baskets") >= 3
    return mart.withColumns({
        "nation": F.when(F.col("month") != 2, F.col("nation")),
        "region": F.when(F.col("iso_day_of_week") == 7, "ATLANTIS").otherwise(F.col("region")),
        "pizza_units": F.when(fault, -F.col("pizza_units") - 1).otherwise(F.col("pizza_units")),
        "pizza_baskets": F.when(
            F.col("baskets") == 2, F.col("baskets") + 1
        ).otherwise(F.col("pizza_baskets")),
    })


@query
def dq_not_null(spark, folder):
    return quality.not_null(
        _planted(spark, folder), "mart", ["store_id", "date_day", "nation", "pizza_units", "has_sales_data"]
    )


@query
def dq_unique(spark, folder):
    raw = feeds.raw_events(spark, folder)
    return quality.unique(raw, "event_id")


@query
def dq_accepted_values(spark, folder):
    known = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    return quality.accepted_values(_planted(spark, folder), "region", known)


@query
def dq_relationships(spark, folder):
    estate = feeds.stores(spark, folder).filter("nation != 'ASIA'")
    fact = facts.fct_sales_daily(_lines(spark, folder))
    return quality.relationships(fact, "store_id", estate, "store_id")


@query
def dq_grain(spark, folder):
    """What the combined table would look like had the bridge not been collapsed first."""
    bridge = relevance.event_store_relevance(
        _events(spark, folder), feeds.rules(spark), feeds.stores(spark, folder)
    )
    dates = dimensions.dim_date(_lines(spark, folder), _events(spark, folder))
    fanned = demand.spine(feeds.stores(spark, folder), dates).join(
        bridge.withColumnRenamed("event_date", "date_day"), ["store_id", "date_day"], "left"
    )
    return edge(quality.grain(fanned, "store_id", "date_day"))


@query
def dq_future_dated(spark, folder):
    return edge(quality.future_dated(facts.fct_sales_daily(_lines(spark, folder)), feeds.AS_OF))


@query
def dq_plausibility(spark, folder):
    return edge(quality.plausibility(_planted(spark, folder)))


@query
def dq_pii_columns(spark, folder):
    weak = [
        privacy.FieldPolicy(p.field, privacy.KEEP)
        if p.field in ("customer_email", "loyalty_id", "card_last4") else p
        for p in privacy.SALES_POLICY
    ]
    blank_is_null = {
        c: F.nullif(F.col(c), F.lit("")) for c in ("customer_email", "loyalty_id", "card_last4")
    }
    lines = _safe(spark, folder, weak).withColumns(blank_is_null)
    return quality.personal_column_exposure(
        {"mart_lines": lines, "dim_store": feeds.stores(spark, folder)}, pseudonyms=True
    )


@query
def dq_suite(spark, folder):
    """All declared checks on the tables built here, with a fault planted for each kind of check."""
    inputs = _inputs(spark, folder)
    tables = {**inputs.tables(), **gold(inputs)}
    mart = _with_faults(tables[MART])
    # Three of the checks read the combined table.
    tables[MART] = materialise(mart.union(mart.filter("baskets = 2")), "mart")
    tables["raw_sales"] = inputs.raw_sales.withColumn("quantity", F.expr("if(quantity % 50 != 0, quantity, null)"))
    tables["seed_event_relevance_rules"] = inputs.rules.union(inputs.rules.filter("scope = 'local'"))
    tables["dim_store"] = tables["dim_store"].withColumn("customer_email", F.lit(None).cast("string"))
    fact = tables["fct_sales_daily"]
    tables["fct_sales_daily"] = fact.withColumn("store_id", F.expr("if(baskets >= 3, 'X', store_id)"))
    return quality.run_suite(spark, tables, feeds.CHECKED_UNTIL)


@query
def uplift_report(spark, folder):
    return quality.uplift(_mart(spark, folder))


@query
def ground_truth_alignment(spark, folder):
    """A manifest that is a day late: it misses the first day and lists one too many."""
    manifest = _events(spark, folder).filter("not is_postponed and league_name = 'purchase'")
    return edge(quality.manifest_mismatches(
        _mart(spark, folder), manifest.select(F.date_add("event_date", 1).alias("date_day"))
    ))


@query
def published_mart(spark, folder):
    """The gate: a clean build is served, a later one with violations is not."""
    lake = work_folder(spark, "lake")
    inputs = _inputs(spark, folder)
    paths = build(lake, "good", inputs)
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    publish(spark, lake, "good", paths, quality.run_suite(spark, tables, FAR))
    bad = build(lake, "bad", Inputs(
        inputs.raw_sales, inputs.raw_events, inputs.stores.filter("nation != 'ASIA'"), inputs.rules,
        inputs.focus,
    ))
    tables = {name: spark.read.parquet(path) for name, path in bad.items()}
    try:
        publish(spark, lake, "bad", bad, quality.run_suite(spark, tables, FAR))
    except ChecksFailed:
        pass
    return edge(read_table(spark, MART, published(spark, lake)[MART]))
