"""The SQL text equivalent to each query, for DuckDB over the same tables."""

from __future__ import annotations

import hashlib

from shelfcast.catalog import feeds
from shelfcast.contracts import EXPORT_COLUMNS, WATCHLIST_LEAGUES

_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
_EVENT = {"day": "strftime(ts, '%Y-%m-%d')", "minute": "strftime(ts, '%Y-%m-%dT%H:%M:00')"}
_PROVIDER = feeds.PROVIDER_JSON.format(**_EVENT)


def _hmac(value: str, key: str = feeds.KEY) -> str:
    """HMAC-SHA256 of a text expression, its first 32 hex characters."""
    secret = key.encode()
    if len(secret) > 64:
        secret = hashlib.sha256(secret).digest()
    secret = secret.ljust(64, b"\0")
    inner, outer = (bytes(b ^ p for b in secret).hex() for p in (0x36, 0x5C))
    text = f"trim({value}, ' ' || chr(9) || chr(10) || chr(13))"
    digest = f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({text}))))"
    return f"case when {value} is not null and {text} <> '' then left({digest}, 32) end"


def _rules() -> str:
    def text(value: str | None) -> str:
        return "cast(null as varchar)" if value is None else f"'{value}'"

    rows = ", ".join(
        f"({text(name)}, {text(scope)}, {text(nation)}, cast({weight} as decimal(10,4)), {text(why)})"
        for name, scope, nation, weight, why in feeds.RULES
    )
    return f"select * from (values {rows}) t(league_name, scope, applies_to_nation, weight, rationale)"


_JOINED = (
    "lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey"
    " join part on l_partkey = p_partkey"
)
_SOURCE_FILE = "concat('sales_part-', lpad(cast(l_orderkey % 31 as varchar), 3, '0'), '.csv')"
_POSTCODE = r"^\s*([A-Z]{1,2}\d[A-Z\d]?)\s*(\d[A-Z]{2})\s*$"


def _district(c: str) -> str:
    return f"nullif(regexp_extract(upper({c}), '{_POSTCODE}', 1), '')"


_BLANK = "trim({0}, ' ') = ''"
_MONEY = r"^[+-]?(\d+\.?\d*|\.\d+)$"
_FINE = r"\.\d{2}\d*[1-9]"


def _money(c: str) -> str:
    return (
        f"case when regexp_matches({c}, '{_MONEY}') and not regexp_matches({c}, '{_FINE}')"
        f" then try_cast({c} as decimal(12,2)) end"
    )


def _bad_money(c: str) -> str:
    return f"(trim({c}) <> '' and coalesce({_money(c)} < 0, true))"


_SALES_PROBLEMS = ", ".join(
    f"case when {bad} then '{name}: {why}' end"
    for name, why, bad in (
        ("transaction_timestamp", "missing or not ISO-8601", "moment is null"),
        ("transaction_id", "blank", _BLANK.format("transaction_id")),
        ("store_id", "blank", _BLANK.format("store_id")),
        ("product_sku", "blank", _BLANK.format("product_sku")),
        ("quantity", "not a whole number above 0",
         "coalesce(case when regexp_matches(quantity, '^-?\\d+$') then cast(quantity as int) end, 0) <= 0"),
        ("unit_price_gbp", "not an amount of at least 0", _bad_money("unit_price_gbp")),
        ("line_total_gbp", "not an amount of at least 0", _bad_money("line_total_gbp")),
    )
)

_CTE = {
    "rules": _rules(),
    "stores": (
        "select cast(n_nationkey as varchar) store_id, n_name store_name, n_name city, r_name region,"
        " r_name nation, concat('ZZ', cast(n_nationkey as varchar)) postcode_district"
        " from nation join region on n_regionkey = r_regionkey"
    ),
    "sales": (
        "select cast(o_orderkey as varchar) transaction_id, o_orderdate transaction_timestamp,"
        " cast(o_orderdate as date) transaction_date, cast(c_nationkey as varchar) store_id,"
        " c_name customer, cast(p_partkey as varchar) product_sku, p_name product_name,"
        " p_type category, cast(l_quantity as int) quantity,"
        " cast(p_retailprice as decimal(12,2)) unit_price_gbp,"
        " cast(l_extendedprice as decimal(12,2)) line_total_gbp, o_orderpriority channel,"
        f" coalesce(p_type = 'PROMO', false) is_pizza_line, {_SOURCE_FILE} source_file"
        f" from {_JOINED}"
    ),
    "versions": (
        "select concat(event_type, '-', cast(user_id as varchar)) event_id,"
        " concat(event_type, ' of ', cast(user_id as varchar)) event_name,"
        " 'stream' sport, event_type league_name, cast(user_id as varchar) home_team,"
        f" cast(ts - interval {feeds.SHIFT_DAYS} day as date) event_date,"
        f" ts - interval {feeds.SHIFT_DAYS} day kickoff_utc, value < 5 is_postponed,"
        " lpad(cast(event_id as varchar), 12, '0') source_file, ts ingested_at from events"
    ),
    "fixtures": (
        "select *, cast(extract(hour from kickoff_utc) as int) kickoff_hour from"
        " (select *, row_number() over (partition by event_id order by ingested_at desc, source_file)"
        " recency from versions) where recency = 1"
    ),
    "dates": (
        "select date_day, cast(extract(year from date_day) as int) as year,"
        " cast(extract(month from date_day) as int) as month,"
        " cast(extract(day from date_day) as int) as day_of_month,"
        " cast(extract(isodow from date_day) as int) iso_day_of_week,"
        " extract(isodow from date_day) in (6, 7) is_weekend from"
        " (select transaction_date date_day from sales union select event_date from fixtures)"
    ),
    "lines": (
        "select store_id, transaction_date date_day, count(*) line_items,"
        " cast(sum(if(is_pizza_line, quantity, 0)) as bigint) pizza_units,"
        " cast(sum(if(is_pizza_line, line_total_gbp, 0)) as double) pizza_revenue_gbp,"
        " cast(sum(line_total_gbp) as double) total_revenue_gbp from sales group by all"
    ),
    "receipts": (
        "select store_id, date_day, count(*) baskets, count(*) filter (where has_focus) pizza_baskets from"
        " (select store_id, transaction_date date_day, transaction_id, bool_or(is_pizza_line) has_focus"
        " from sales group by all) group by all"
    ),
    "shoppers": (
        "select store_id, date_day, count(customer) distinct_customers from"
        " (select distinct store_id, transaction_date date_day, customer from sales) group by all"
    ),
    "fact": (
        "select store_id, date_day, baskets, line_items, pizza_units, pizza_baskets, pizza_revenue_gbp,"
        " total_revenue_gbp, distinct_customers from lines join receipts using (store_id, date_day)"
        " join shoppers using (store_id, date_day)"
    ),
    "reach": (
        "select league_name, scope, weight, rationale, store_id from rules, stores"
        " where scope = 'national' and (applies_to_nation is null or applies_to_nation = '')"
        " union all select league_name, scope, weight, rationale, store_id"
        " from rules join stores on nation = applies_to_nation"
    ),
    "bridge": (
        "select event_id, event_date, league_name, event_name, kickoff_hour, store_id, scope, weight, rationale"
        " from reach join (select * from fixtures where is_postponed = false) using (league_name)"
    ),
    "features": (
        "select store_id, event_date, count(*) relevant_event_count,"
        " max(cast(weight as double)) max_event_weight, cast(sum(weight) as double) total_event_weight,"
        " bool_or(scope = 'national') has_national_broadcast_event,"
        " min(kickoff_hour) earliest_kickoff_hour, max(kickoff_hour) latest_kickoff_hour"
        " from bridge group by all"
    ),
    "mart": (
        "select store_id, date_day, store_name, city, region, nation, iso_day_of_week, is_weekend, month,"
        " ifnull(relevant_event_count, 0) relevant_event_count, ifnull(max_event_weight, 0) max_event_weight,"
        " ifnull(total_event_weight, 0) total_event_weight,"
        " ifnull(has_national_broadcast_event, false) has_national_broadcast_event,"
        " earliest_kickoff_hour, latest_kickoff_hour, pizza_units, pizza_baskets, pizza_revenue_gbp, baskets,"
        " total_revenue_gbp, distinct_customers, baskets is not null has_sales_data"
        " from (select * from stores, dates) left join fact using (store_id, date_day)"
        " left join (select * rename (event_date as date_day) from features) using (store_id, date_day)"
    ),
    "planted": (
        "select * replace (case when month <> 2 then nation end as nation,"
        " case when iso_day_of_week = 7 then 'ATLANTIS' else region end as region,"
        " case when baskets >= 3 then -pizza_units - 1 else pizza_units end as pizza_units,"
        " case when baskets = 2 then baskets + 1 else pizza_baskets end as pizza_baskets) from mart"
    ),
    "exports": (
        "select "
        + ", ".join(f"{feeds.EXPORT_TEXT[c].format(day=_DAY)} as {c}" for c in EXPORT_COLUMNS)
        + f", {_SOURCE_FILE} source_file, cast(o_orderdate as date) order_day from {_JOINED}"
    ),
    "safe": (
        "select transaction_id, transaction_timestamp, store_id,"
        f" {_hmac('customer_id')} customer_pseudonym, {_hmac('loyalty_id')} loyalty_pseudonym,"
        f" {_district('customer_postcode')} customer_postcode_district, product_sku, product_name,"
        " category, quantity, unit_price_gbp, line_total_gbp, channel, source_file from exports"
    ),
    "checked": (
        f"select *, [p for p in [{_SALES_PROBLEMS}] if p is not null] problems from"
        " (select *, case when transaction_timestamp like '%+02:00' then"
        " cast(left(replace(transaction_timestamp, 'T', ' '), 23) as timestamp) - interval 2 hour"
        " when regexp_matches(transaction_timestamp, '^\\d{4}-') then"
        " try_cast(replace(replace(transaction_timestamp, 'T', ' '), 'Z', '')"
        " || case when length(transaction_timestamp) = 16 then ':00' else '' end as timestamp)"
        " end moment from safe)"
    ),
    "good": "select *, cast(moment as date) transaction_date from checked where len(problems) = 0",
    "provider": (
        "select event_id as position, case when event_id % 2 = 0 or user_id % 3 = 0 then 'events_by_day'"
        " else 'events_next_by_league' end source_name,"
        " concat('pull-', cast(event_id % 97 as varchar)) source_file,"
        f" {_PROVIDER} record, * exclude (event_id) from events"
    ),
    "normalised": (
        "select *, coalesce(day_given, cast(kickoff_utc as date)) event_date from (select position,"
        " case when value >= 2 then concat(event_type, '-', cast(user_id as varchar)) end event_id,"
        " concat(event_type, ' night') event_name, event_type league_name,"
        " case when value >= 20 then 'Hall' end venue,"
        " case when value < 30 then null when value < 32 then date '1970-01-01'"
        " else cast(ts as date) end day_given,"
        " case when value >= 6 and value <= 95 then date_trunc('minute', ts) end kickoff_utc,"
        " value < 40 is_postponed, value < 6 or value > 95 kickoff_unparsed, source_name,"
        " source_file, record from provider)"
    ),
    "events_checked": (
        "select *, [p for p in [case when event_id is null then 'event_id: blank' end,"
        " case when event_date is null then 'event_date: missing or unreadable' end,"
        " case when extract(year from event_date) not between 1990 and 2100 then"
        " 'event_date: not within 1990..2100' end] if p is not null] problems from normalised"
    ),
    "one_copy": (
        "select * from (select *, row_number() over (partition by event_id order by"
        " case source_name when 'events_by_day' then 1 else 2 end desc, source_file desc,"
        " position desc) copy from events_checked where len(problems) = 0) where copy = 1"
    ),
    "runs": "select distinct cast(ts as date) run_date from events",
    "planned": (
        "select run_date, 'events_by_day' source_name,"
        " concat(strftime(run_date + cast(n as int), '%Y-%m-%d'), '__soccer') as label"
        " from runs, generate_series(-7, 21) g(n) union all"
        " select run_date, 'events_next_by_league', concat('league_', cast(id as varchar)) from runs, (values "
        + ", ".join(f"({i})" for i in WATCHLIST_LEAGUES) + ") w(id)"
    ),
    "landed": (
        "select distinct cast(ts as date) run_date, 'events_by_day' source_name,"
        " concat(strftime(cast(ts as date) + cast(user_id % 29 - 7 as int), '%Y-%m-%d'), '__soccer') as label"
        " from events where not (event_type = 'error' and value > 97 and extract(isodow from ts) < 6)"
        " union select distinct cast(ts as date),"
        " 'events_next_by_league', concat('league_', case user_id % 3 when 0 then '4328' when 1 then '4480'"
        " else '4443' end) from events where event_type = 'error' and value > 97 and extract(isodow from ts) < 6"
    ),
    "responses": (
        "select concat('event-', cast(event_id as varchar)) source_file,"
        " case when value < 15 then 0 when value < 25 then 0 when value < 60 then 1 else 2 end n,"
        " case when value < 2 then ' ' else concat(event_type, '-', cast(user_id as varchar)) end id"
        " from events"
    ),
    "personal": (
        "select distinct trim(v) as value from (select customer_id v from exports union all"
        " select customer_email from exports union all select loyalty_id from exports"
        " union all select '1-URGENT') where trim(v) <> ''"
    ),
}


def _sql(body: str) -> str:
    return "with " + ", ".join(f"{name} as ({text})" for name, text in _CTE.items()) + " " + body


def _stamp(c: str, name: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') as {name or c}"


def _date(c: str, name: str | None = None) -> str:
    return f"cast({c} as varchar) as {name or c}"


_MART = (
    f"select * replace ({_date('date_day')}, cast(max_event_weight as double) as max_event_weight,"
    " cast(total_event_weight as double) as total_event_weight) from mart"
)
_FACT = f"select * replace ({_date('date_day')}) from fact"
_FEATURES = f"select * replace ({_date('event_date')}) from features"
_SILVER = (
    f"select transaction_id, {_stamp('moment', 'transaction_timestamp')}, {_date('transaction_date')},"
    " store_id, customer_pseudonym, loyalty_pseudonym, customer_postcode_district, product_sku,"
    " product_name, category, cast(quantity as int) quantity,"
    f" cast({_money('unit_price_gbp')} as double) unit_price_gbp,"
    f" cast({_money('line_total_gbp')} as double) line_total_gbp, channel"
)
_OUT_COLUMNS = (
    "transaction_id", "transaction_timestamp", "store_id", "customer_pseudonym", "loyalty_pseudonym",
    "customer_postcode_district", "product_sku", "product_name", "category", "quantity",
    "unit_price_gbp", "line_total_gbp", "channel", "source_file",
)


def _scan(table: str, columns: tuple[str, ...]) -> str:
    cells = " union all ".join(
        f"select '{c}' column_name, {c} as text, count(*) cells from {table} where {c} is not null group by 2"
        for c in columns
    )
    return (
        f"select column_name, value, cast(sum(cells) as bigint) cells from ({cells}) join personal"
        " on contains(text, value) group by 1, 2"
    )


def _row_leaks() -> str:
    outputs = {
        "customer_pseudonym": _hmac("customer_id"),
        "loyalty_pseudonym": _hmac("loyalty_id"),
        "customer_postcode_district": _district("customer_postcode"),
        "product_name": "concat(product_name, ' for ', customer_email)",
    }
    fields = ("customer_id", "customer_email", "loyalty_id", "customer_postcode")
    return " union all ".join(
        f"select '{out}' column_name, '{field}' personal_field, count(*) filter"
        f" (where trim({field}) <> '' and contains({text}, trim({field}))) leaks from exports"
        for out, text in outputs.items() for field in fields
    )


def _register() -> str:
    renamed = {
        "customer_id": ("hash", "'customer_pseudonym'"),
        "loyalty_id": ("hash", "'loyalty_pseudonym'"),
        "customer_email": ("drop", "null"),
        "card_last4": ("drop", "null"),
        "customer_postcode": ("generalise", "'customer_postcode_district'"),
    }
    return " union all ".join(
        f"select '{c}' field, count(*) filter (where trim({c}) <> '') filled,"
        f" '{renamed.get(c, ('keep',))[0]}' as action, {renamed.get(c, ('', repr(c)))[1]} output_name"
        " from exports"
        for c in EXPORT_COLUMNS
    )


# The checked tables, with faults that follow from their own values: one at least for each kind of check.
_CHECKED = {
    "raw_sales": "(select * replace (case when quantity % 50 <> 0 then quantity end as quantity) from sales)",
    "raw_sports_events": "versions",
    "stg_sales": "sales",
    "stg_sports_events": "fixtures",
    "seed_stores": "stores",
    "seed_event_relevance_rules": "(select * from rules union all select * from rules where scope = 'local')",
    "dim_store": "stores",
    "dim_date": "dates",
    "dim_event": "fixtures",
    "fct_sales_daily": "(select * replace (case when baskets >= 3 then 'X' else store_id end as store_id) from fact)",
    "event_store_relevance": "bridge",
    "mart_pizza_demand_daily": "(select * from planted union all select * from planted where baskets = 2)",
}


def _violations(check) -> str:
    table, column = _CHECKED.get(check.table), check.column
    if check.kind == "not_null":
        return f"select count(*) from {table} where {column} is null"
    if check.kind == "accepted_values":
        values = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in check.args)
        return f"select count(*) from {table} where {column} is not null and {column} not in ({values})"
    if check.kind == "unique":
        return (
            f"select count(*) from (select {column} from {table} where {column} is not null"
            f" group by {column} having count(*) > 1)"
        )
    if check.kind == "relationships":
        parent, key = check.args
        return (
            f"select count(distinct {column}) from {table} where {column} not in"
            f" (select {key} from {_CHECKED[parent]} where {key} is not null)"
        )
    if check.kind == "grain":
        key = ", ".join(check.args)
        return f"select count(*) from (select {key} from {table} group by {key} having count(*) > 1)"
    if check.kind == "future_dated":
        return f"select count(*) from {table} where date_day > date '{feeds.CHECKED_UNTIL}'"
    if check.kind == "plausibility":
        return (
            f"select count(*) from {table} where pizza_units < 0 or pizza_baskets > baskets"
            " or (pizza_units = 0 and pizza_baskets > 0)"
        )
    return "select 1"  # the store table was given a column for e-mail addresses


def _suite() -> str:
    from shelfcast.operators.quality import SUITE

    return " union all ".join(
        f"select '{c.name}' check_name, '{c.table or 'dim_store.customer_email'}' table_name,"
        f" cast(({_violations(c)}) as bigint) violations"
        for c in SUITE
    )


def _daily() -> str:
    """The combined table after the last of two daily runs: valid export rows, and the fixtures where they went."""
    def nation(c: str) -> str:
        return f"case {c} " + " ".join(f"when '{a}' then '{b}'" for a, b in feeds.NATIONS.items()) + f" else {c} end"

    one_answer = "row_number() over (partition by event_type, user_id, source_name order by position desc)"
    steps = {
        "events": "select * replace (case when user_id % 2 = 0 then ts + interval 1 day else ts end as ts) from main.events",
        "rules": f"select * replace ({nation('applies_to_nation')} as applies_to_nation) from ({_CTE['rules']})",
        "stores": f"select * replace ({nation('nation')} as nation) from ({_CTE['stores']})",
        **{name: _CTE[name] for name in ("exports", "safe", "checked", "good")},
        "provider": f"select * exclude (n) from (select *, {one_answer} n from ({_CTE['provider']})) where n = 1",
        **{name: _CTE[name] for name in ("normalised", "events_checked", "one_copy")},
        "sales": (
            "select * replace (cast(quantity as int) as quantity,"
            f" cast({_money('line_total_gbp')} as decimal(12,2)) as line_total_gbp), customer_pseudonym customer,"
            f" category = '{feeds.FOCUS}' is_pizza_line from good"
        ),
        "fixtures": "select *, cast(extract(hour from kickoff_utc) as int) kickoff_hour from one_copy",
        **{name: _CTE[name] for name in ("dates", "lines", "receipts", "shoppers", "fact", "reach", "bridge", "features", "mart")},
    }
    return "with " + ", ".join(f"{name} as ({text})" for name, text in steps.items()) + " " + _MART


ORACLES: dict[str, str] = {name: _sql(body) for name, body in {
    "stg_sales_flag": (
        f"select transaction_id, {_stamp('transaction_timestamp')}, {_date('transaction_date')}, store_id,"
        " product_sku, product_name, category, quantity, cast(unit_price_gbp as double) unit_price_gbp,"
        " cast(line_total_gbp as double) line_total_gbp, channel, is_pizza_line, source_file,"
        " 'r1' run_id from sales"
    ),
    "stg_events_latest": (
        f"select event_id, event_name, league_name, {_date('event_date')}, {_stamp('kickoff_utc')},"
        " kickoff_hour, is_postponed, source_file from fixtures"
    ),
    "dim_store": "select * from stores",
    "dim_date": f"select * replace ({_date('date_day')}) from dates",
    "dim_date_dense": (
        "select cast(d as varchar) date_day, cast(extract(year from d) as int) as year,"
        " cast(extract(month from d) as int) as month, cast(extract(day from d) as int) day_of_month,"
        " cast(extract(isodow from d) as int) iso_day_of_week, extract(isodow from d) in (6, 7) is_weekend"
        " from (select cast(unnest(generate_series((select min(date_day) from dates),"
        " (select max(date_day) from dates), interval 1 day)) as date) d)"
    ),
    "dim_event": (
        f"select event_id, event_name, sport, league_name, home_team, {_date('event_date')},"
        f" {_stamp('kickoff_utc')}, kickoff_hour, is_postponed from fixtures"
    ),
    "fct_sales_daily": _FACT,
    "fct_sales_daily_preagg": _FACT,
    "basket_totals": (
        f"select store_id, {_date('transaction_date', 'date_day')}, transaction_id, count(*) line_items,"
        " bool_or(is_pizza_line) has_pizza,"
        " cast(sum(case when is_pizza_line then quantity else 0 end) as bigint) pizza_units,"
        " cast(sum(case when is_pizza_line then line_total_gbp else 0 end) as double) pizza_revenue_gbp,"
        " cast(sum(line_total_gbp) as double) total_revenue_gbp"
        " from sales group by store_id, transaction_date, transaction_id, customer"
    ),
    "relevance_bridge": (
        f"select * replace ({_date('event_date')}, cast(weight as double) as weight) from bridge"
    ),
    "rules_without_events": (
        "select league_name from rules where league_name not in (select league_name from fixtures)"
    ),
    "leagues_without_rules": (
        "select league_name, count(*) as events from fixtures"
        " where league_name not in (select league_name from rules) group by 1"
    ),
    "event_features": _FEATURES,
    "event_features_decomposed": _FEATURES,
    "spine": f"select store_id, {_date('date_day')}, store_name, nation from stores cross join dates",
    "mart_daily": _MART,
    "mart_future_rows": f"{_MART} where mart.date_day > date '{feeds.AS_OF}'",
    "incremental_mart": _MART,
    "published_mart": _MART,
    "incremental_gate": _MART,
    "quarantine_readback": (
        "select array_to_string(problems, '; ') reason, 'r1' run_id, count(*) row_count, count(*) records,"
        " count(store_id) store_ids from checked where len(problems) > 0 group by 1"
    ),
    "key_version_stamp": (
        "select key_version, concat('load-', key_version) run_id, count(*) row_count,"
        " count(distinct customer_pseudonym) customers from (select *,"
        " case when cast(regexp_extract(source_file, '(\\d+)', 1) as int) > 20 then 'v2' else 'v1' end"
        " key_version from good) group by key_version"
    ),
    "seed_rules": (
        "select league_name, scope, nullif(applies_to_nation, '') applies_to_nation,"
        " cast(weight as double) weight, rationale, events from rules left join"
        " (select league_name, count(*) as events from fixtures group by 1) using (league_name)"
    ),
    "pseudonymise_customers": (
        f"select c_custkey, {_hmac('cast(c_custkey as varchar)')} key_pseudonym,"
        f" {_hmac('c_name')} name_pseudonym, cast(null as varchar) blank_pseudonym from customer"
    ),
    "policy_projection": "select * from safe",
    "policy_register": _register(),
    "seed_stores": "select * from stores",
    "exports_two_layouts": "select * exclude (source_file) from safe",
    "exports_listed": (
        "select true all_files_read, count(*) row_count, cast(0 as bigint) files_over_cap,"
        " cast(0 as bigint) files_without_length from exports"
    ),
    "policy_absent_field": (
        "select source_file, count(*) row_count, cast(0 as bigint) loyalty_pseudonyms,"
        " count(customer_postcode_district) districts, 14 column_count from safe group by 1"
    ),
    "policy_drift": (
        "select distinct source_file, unnest(case l_orderkey % 31 % 4 when 0 then ['customer_phone']"
        " when 1 then ['till_no', 'Store_Id'] else [] end) unexpected_column"
        f" from (select l_orderkey, {_SOURCE_FILE} source_file from lineitem)"
    ),
    "postcode_generalise": (
        f"select c_custkey, {_district('p')} district from"
        f" (select c_custkey, {feeds.EXPORT_TEXT['customer_postcode']} p from customer)"
    ),
    "null_tokens": (
        "select o_orderkey, case when o_orderkey % 9 in (6, 8) then o_orderpriority end cleaned from orders"
    ),
    "leak_scan": _scan("safe", _OUT_COLUMNS),
    "leak_scan_weakened": _scan(
        "(select safe.*, e.customer_email from (select *, row_number() over () n from safe) safe"
        " join (select customer_email, row_number() over () n from exports) e using (n))",
        (*_OUT_COLUMNS, "customer_email"),
    ),
    "row_leaks": _row_leaks(),
    "validate_sales_valid": f"{_SILVER}, source_file, 'r1' run_id from good",
    "validate_sales_quarantined": (
        "select array_to_string(problems, '; ') reason, source_file, 'r1' run_id, transaction_id,"
        " quantity, line_total_gbp, 13 record_fields from checked where len(problems) > 0"
    ),
    "quarantine_rate": (
        "select source_file, count(*) rows_total, count(*) filter (where len(problems) > 0)"
        " rows_quarantined, cast(count(*) filter (where len(problems) > 0) as double) / count(*)"
        " quarantine_rate from checked group by 1"
    ),
    "quarantine_rate_alerts": (
        f"select {_date('day', 'transaction_date')}, rows_total, rows_quarantined,"
        " cast(rows_quarantined as double) / rows_total quarantine_rate from"
        " (select cast(moment as date) as day, count(*) rows_total,"
        " count(*) filter (where len(problems) > 0) rows_quarantined from checked group by 1)"
        " where cast(rows_quarantined as double) / rows_total > 0.25"
    ),
    "file_ledger": (
        "select source_file, count(*) rows_read, count(*) filter (where ok) rows_written,"
        " count(*) filter (where not ok) rows_quarantined,"
        f" count(distinct day) filter (where ok) dates_seen, {_date('min(day) filter (where ok)', 'first_date')},"
        f" {_date('max(day) filter (where ok)', 'last_date')} from (select source_file,"
        " len(problems) = 0 ok, cast(moment as date) as day from checked) group by 1"
    ),
    "file_dates": (
        f"select source_file, 'r1' run_id, {_date('day', 'transaction_date')},"
        " count(*) filter (where ok) rows_written from (select source_file, len(problems) = 0 ok,"
        " case when len(problems) = 0 then cast(moment as date) end as day from checked)"
        " group by source_file, day"
    ),
    "rowcap_breaches": (
        "select source_file, count(*) rows_read from sales group by 1"
        " having count(*) > (select count(*) // 31 from lineitem)"
    ),
    "normalise_events": (
        f"select position, event_id, event_name, league_name, venue, {_date('event_date')},"
        f" {_stamp('kickoff_utc')}, is_postponed, kickoff_unparsed, false malformed, source_name,"
        " source_file from normalised"
    ),
    "validate_events_valid": (
        f"select event_id, {_date('event_date')}, {_stamp('kickoff_utc')}, is_postponed, source_name,"
        " source_file, 'r1' run_id from events_checked where len(problems) = 0"
    ),
    "validate_events_quarantined": (
        "select array_to_string(problems, '; ') reason, source_name, source_file, 'r1' run_id, record"
        " from events_checked where len(problems) > 0"
    ),
    "cross_source_dedup": (
        f"select event_id, {_date('event_date')}, source_name, source_file, position from one_copy"
    ),
    "event_snapshot_roundtrip": (
        f"select event_id, {_date('event_date')}, {_stamp('kickoff_utc')}, is_postponed, source_name,"
        f" source_file, '{feeds.AS_OF}' ingest_date from one_copy"
    ),
    "bronze_to_snapshot": (
        f"select source_name, '{feeds.AS_OF}' ingest_date, 'r2' run_id, events, rows_total,"
        " rows_quarantined, kickoffs_unparsed from (select source_name, count(*) as events from one_copy"
        " group by 1) right join (select source_name, count(*) rows_total, count(*) filter"
        " (where len(problems) > 0) rows_quarantined, count(*) filter (where kickoff_unparsed)"
        " kickoffs_unparsed from events_checked group by 1) using (source_name)"
    ),
    "json_envelope_explode": (
        "select source_file, false malformed, cast(position as int) as position, id,"
        " cast(null as varchar) evidence from responses, generate_series(0, 1) g(position)"
        " where position < n union all select concat('page-', cast(page_id as varchar)), true, 0, null,"
        " md5(html) from pages"
    ),
    "bronze_envelopes": (
        "select 'events_by_day' source_name, false malformed, cast(position as int) as position, id,"
        " cast(null as varchar) evidence from responses, generate_series(0, 1) g(position)"
        " where position < n union all select 'events_by_day', true, 0, null,"
        " md5(regexp_replace(html, '[\\r\\n]', ' ', 'g')) from pages"
    ),
    "landed_requests": f"select {_date('run_date')}, source_name, label from landed",
    "request_plan": f"select {_date('run_date')}, source_name, label from planned",
    "request_count": (
        f"select {_date('run_date')}, source_name, count(*) requests from planned"
        " group by planned.run_date, source_name"
    ),
    "request_coverage_gaps": (
        f"select {_date('run_date')}, source_name, label from (select * from planned except"
        " select * from landed)"
    ),
    "silent_sources": (
        f"select {_date('run_date')}, source_name, count(*) requests from planned p where not exists"
        " (select 1 from landed l where l.run_date = p.run_date and l.source_name = p.source_name)"
        " group by p.run_date, source_name"
    ),
    "reconcile_missing": (
        "select source_file, count(*) row_count from sales"
        " where cast(regexp_extract(source_file, '(\\d+)', 1) as int) % 3 = 0 group by 1"
    ),
    "url_redact": (
        "select page_id, regexp_replace(url, '^(https?://[^/]+)/', '\\1/api/json/***/') url from pages"
    ),
    "silver_roundtrip_replace": f"{_SILVER}, 'r2' run_id from good",
    "incremental_pickup": f"{_SILVER} from good",
    "compaction": f"{_SILVER} from good",
    "dq_not_null": (
        "select * from (select 'mart' table_name, 'nation' column_name, count(*) filter"
        " (where nation is null) violations from planted union all select 'mart', 'pizza_units',"
        " count(*) filter (where pizza_units is null) from planted union all select 'mart', 'store_id',"
        " count(*) filter (where store_id is null) from planted) where violations > 0"
    ),
    "dq_unique": (
        "select event_id as value, count(*) row_count from versions group by 1 having count(*) > 1"
    ),
    "dq_accepted_values": (
        "select region as value, count(*) row_count from planted where region not in"
        " ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST') group by 1"
    ),
    "dq_relationships": (
        "select store_id as value, count(*) row_count from fact where store_id not in"
        " (select store_id from stores where nation <> 'ASIA') group by 1"
    ),
    "dq_grain": (
        f"select b.store_id, {_date('d.date_day', 'date_day')}, count(*) row_count from bridge b"
        " join dates d on d.date_day = b.event_date group by b.store_id, d.date_day having count(*) > 1"
    ),
    "dq_future_dated": (
        f"select store_id, {_date('date_day')}, pizza_units from fact"
        f" where fact.date_day > date '{feeds.AS_OF}'"
    ),
    "dq_plausibility": (
        f"select store_id, {_date('date_day')}, pizza_units, pizza_baskets, baskets from planted"
        " where pizza_units < 0 or pizza_baskets > baskets or (pizza_units = 0 and pizza_baskets > 0)"
    ),
    "dq_pii_columns": (
        "select 'mart_lines' table_name, unnest(['customer_pseudonym', 'customer_email', 'loyalty_id',"
        " 'card_last4']) column_name, unnest([count(*) filter (where trim(customer_id) <> ''),"
        " count(*) filter (where customer_email <> ''), count(*) filter (where loyalty_id <> ''),"
        " count(*) filter (where card_last4 <> '')]) exposed_rows from exports"
    ),
    "dq_suite": _suite(),
    "uplift_report": (
        "select count(*) rows_total, count(*) filter (where has_sales_data) rows_with_sales,"
        " count(*) filter (where relevant_event_count > 0) rows_with_events,"
        " count(*) filter (where has_sales_data and relevant_event_count > 0) rows_with_both,"
        " avg(pizza_units) filter (where has_sales_data and relevant_event_count > 0) units_on_event_days,"
        " avg(pizza_units) filter (where has_sales_data and relevant_event_count = 0) units_on_quiet_days"
        " from mart"
    ),
    "ground_truth_alignment": (
        "select * from (with listed as (select distinct event_date + 1 as day from fixtures where not is_postponed and"
        " league_name = 'purchase'), sold as (select date_day, extract(isodow from date_day) weekday,"
        " sum(pizza_units) units, date_day in (select day from listed) in_manifest from mart"
        " where pizza_units is not null group by 1),"
        " quiet as (select weekday, avg(units) typical from sold where not in_manifest group by 1),"
        " judged as (select date_day, coalesce(units > typical * 1.15, false) in_mart, in_manifest"
        " from sold left join quiet using (weekday) union all"
        " select day, false, true from listed where day not in (select date_day from sold))"
        f" select {_date('date_day')}, in_mart, in_manifest from judged where in_mart <> in_manifest)"
    ),
}.items()}
ORACLES["daily_run"] = ORACLES["pickup_to_mart"] = _daily()
