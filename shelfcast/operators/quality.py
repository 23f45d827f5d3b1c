"""Data checks. Each returns the violations as a DataFrame; no rows means the check passes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.contracts import PERSONAL_COLUMNS, PSEUDONYM_COLUMNS


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULL counts of all ``columns`` in one pass: ``(table_name, column_name, violations)``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in columns
    ])
    return counts.select(F.lit(table).alias("table_name"), F.inline(cells)).filter("violations > 0")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once: ``(value, row_count)``."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value")).agg(F.count("*").alias("row_count"))
        .filter("row_count > 1")
    )


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list: ``(value, row_count)``. NULL is the business of ``not_null``."""
    return (
        df.filter(~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value")).agg(F.count("*").alias("row_count"))
    )


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child keys without a parent: ``(value, row_count)``.

    Keys are counted before they are joined, so the join sees each key once however often it occurs.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value")).agg(F.count("*").alias("row_count"))
    )
    return keys.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


def grain(df: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row, with their ``row_count``."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def future_dated(fact: DataFrame, as_of: str) -> DataFrame:
    """Sales after the logical date. For the fact: the mart holds future days by design."""
    late = F.col("date_day") > F.lit(as_of).cast("date")
    return fact.filter(late).select("store_id", "date_day", "pizza_units")


def implausible() -> Column:
    """Negative units, more focus baskets than baskets, or focus baskets without units."""
    units, focus, baskets = F.col("pizza_units"), F.col("pizza_baskets"), F.col("baskets")
    return (units < 0) | (focus > baskets) | ((units == 0) & (focus > 0))


def plausibility(mart: DataFrame) -> DataFrame:
    return mart.filter(implausible()).select(
        "store_id", "date_day", "pizza_units", "pizza_baskets", "baskets"
    )


def _fields(schema: T.StructType, held: str = "", exact: bool = True) -> Iterable[tuple[str, str]]:
    """(name, path of a column that is filled where the field is) of every field, at any depth.

    A field inside an array or map is reported at the outermost array or map that holds it.
    """
    for f in schema.fields:
        path = f"{held}.`{f.name}`" if held and exact else held or f"`{f.name}`"
        yield f.name, path
        inner, direct = f.dataType, exact
        todo = [inner]
        while todo:
            inner = todo.pop()
            if isinstance(inner, T.ArrayType):
                todo.append(inner.elementType)
                direct = False
            elif isinstance(inner, T.MapType):
                todo += [inner.keyType, inner.valueType]
                direct = False
            elif isinstance(inner, T.StructType):
                yield from _fields(inner, path, direct)


def personal_columns(
    tables: Mapping[str, DataFrame], pseudonyms: bool = False
) -> list[tuple[str, str]]:
    """(table, column) pairs that a published table may not have, nested fields included."""
    banned = set(PERSONAL_COLUMNS) | (set(PSEUDONYM_COLUMNS) if pseudonyms else set())
    return [
        (table, name)
        for table, df in tables.items()
        for name, _ in _fields(df.schema)
        if name.lower() in banned
    ]


def personal_column_exposure(tables: Mapping[str, DataFrame], pseudonyms: bool = False) -> DataFrame:
    """The banned columns and how many rows expose a value: ``(table_name, column_name, exposed_rows)``.

    A banned column is reported even when it holds no value, and at any depth; inside arrays and maps
    every row counts whose array or map is there.
    """
    spark = next(iter(tables.values())).sparkSession
    banned = {(t, n) for t, n in personal_columns(tables, pseudonyms)}
    parts = []
    for table, df in tables.items():
        names = [(n, path) for n, path in _fields(df.schema) if (table, n) in banned]
        if not names:
            continue
        counts = df.agg(*[F.count(path).alias(f"n{i}") for i, (_, path) in enumerate(names)])
        cells = [
            F.struct(F.lit(n).alias("column_name"), F.col(f"n{i}").alias("exposed_rows"))
            for i, (n, _) in enumerate(names)
        ]
        parts.append(counts.select(F.lit(table).alias("table_name"), F.inline(F.array(*cells))))
    if not parts:
        return spark.createDataFrame([], "table_name string, column_name string, exposed_rows long")
    return reduce(DataFrame.unionByName, parts)


def uplift(mart: DataFrame) -> DataFrame:
    """Does the combined table say anything? Overlap of target and events, and demand on each kind of day."""
    sold, event = F.col("has_sales_data"), F.col("relevant_event_count") > 0
    units = F.col("pizza_units")
    return mart.agg(
        F.count("*").alias("rows_total"),
        F.count_if(sold).alias("rows_with_sales"),
        F.count_if(event).alias("rows_with_events"),
        F.count_if(sold & event).alias("rows_with_both"),
        F.avg(F.when(sold & event, units)).alias("units_on_event_days"),
        F.avg(F.when(sold & ~event, units)).alias("units_on_quiet_days"),
    )


def manifest_mismatches(mart: DataFrame, manifest: DataFrame, least: float = 0.15) -> DataFrame:
    """Days of elevated demand that the manifest lacks, and listed days without elevated demand.

    ``manifest`` has one ``date_day`` per day with an injected uplift. Demand is elevated on a day when
    all stores' units together exceed the mean of the unlisted days of the same weekday by more than
    the share ``least``. A listed day without sales data is not elevated.
    """
    listed = manifest.select("date_day").distinct().withColumn("in_manifest", F.lit(True))
    sold = mart.filter(F.col("pizza_units").isNotNull()).groupBy("date_day").agg(F.sum("pizza_units").alias("units"))
    both = sold.join(listed, "date_day", "full_outer").select(
        "date_day", "units", F.coalesce("in_manifest", F.lit(False)).alias("in_manifest"),
        F.dayofweek("date_day").alias("weekday"),
    )
    quiet = both.filter(~F.col("in_manifest")).groupBy("weekday").agg(F.avg("units").alias("typical"))
    elevated = F.coalesce(F.col("units") > F.col("typical") * F.lit(1 + least), F.lit(False))
    return both.join(quiet, "weekday", "left").select(
        "date_day", elevated.alias("in_mart"), "in_manifest"
    ).filter("in_mart != in_manifest")


# --- the declared suite -------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One declared check on ``table``; ``args`` depends on ``kind``."""

    table: str
    kind: str
    column: str = ""
    args: tuple = ()

    @property
    def name(self) -> str:
        return "_".join(p for p in (self.kind, self.table, self.column) if p)


# Which columns of which tables are checked, and the accepted values.
_REQUIRED = {
    "raw_sales": ("transaction_id", "store_id", "transaction_date", "quantity"),
    "raw_sports_events": ("event_id", "event_date"),
    "stg_sales": ("transaction_id", "store_id", "is_pizza_line"),
    "stg_sports_events": ("event_id", "event_date", "is_postponed"),
    "seed_stores": ("store_id",),
    "seed_event_relevance_rules": ("league_name", "scope", "weight"),
    "dim_store": ("store_id", "nation"),
    "dim_date": ("date_day", "iso_day_of_week"),
    "dim_event": ("event_id", "event_date"),
    "fct_sales_daily": ("store_id", "date_day", "baskets"),
    "event_store_relevance": ("event_id", "store_id"),
    "mart_pizza_demand_daily": (
        "store_id", "date_day", "relevant_event_count", "has_national_broadcast_event",
        "has_sales_data",
    ),
}
_UNIQUE = {
    "stg_sports_events": "event_id",
    "seed_stores": "store_id",
    "seed_event_relevance_rules": "league_name",
    "dim_store": "store_id",
    "dim_date": "date_day",
    "dim_event": "event_id",
}
_ACCEPTED = {
    ("seed_stores", "nation"): ("England", "Scotland", "Wales", "Northern Ireland"),
    ("seed_event_relevance_rules", "scope"): ("national", "local"),
    ("dim_date", "iso_day_of_week"): (1, 2, 3, 4, 5, 6, 7),
    ("event_store_relevance", "scope"): ("national", "local"),
}
_REFERENCES = {
    ("fct_sales_daily", "store_id"): ("dim_store", "store_id"),
    ("event_store_relevance", "event_id"): ("dim_event", "event_id"),
    ("event_store_relevance", "store_id"): ("dim_store", "store_id"),
    ("mart_pizza_demand_daily", "store_id"): ("dim_store", "store_id"),
}

SUITE: tuple[Check, ...] = (
    *[Check(t, "not_null", c) for t, cs in _REQUIRED.items() for c in cs],
    *[Check(t, "unique", c) for t, c in _UNIQUE.items()],
    *[Check(t, "accepted_values", c, v) for (t, c), v in _ACCEPTED.items()],
    *[Check(t, "relationships", c, ref) for (t, c), ref in _REFERENCES.items()],
    Check("mart_pizza_demand_daily", "grain", args=("store_id", "date_day")),
    Check("fct_sales_daily", "future_dated"),
    Check("mart_pizza_demand_daily", "plausibility"),
    Check("", "personal_columns"),
)

PUBLISHED = ("dim_store", "dim_date", "dim_event", "fct_sales_daily", "event_store_relevance",
             "mart_pizza_demand_daily")


#: What the checks need to know of tables, counted: rows that violate a check (``row``), rows of a day (``day``),
#: copies of a key (``key``), keys that refer (``child``) and that are referred to (``parent``).
MEASURES = "name string, role string, day date, key string, n long"


def _row_level(check: Check) -> Column | None:
    """The violation predicate of checks that look at one row at a time."""
    if check.kind == "not_null":
        return F.col(check.column).isNull()
    if check.kind == "accepted_values":
        return ~F.col(check.column).isin(list(check.args))
    if check.kind == "plausibility":
        return implausible()
    return None


def _key(*columns: str) -> Column:
    """Columns as one text; lengths keep different keys apart, and NULL from any text."""
    def part(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.concat(*[part(c) for c in columns])


def _records(table: str, day: str | None, suite: Sequence[Check], given: Iterable[str]) -> list[Column]:
    """What one row of ``table`` adds to the measures, each a struct or NULL."""
    when = F.col(day) if day else F.lit(None).cast("date")
    known = set(given)

    def record(check: Check, role: str, key: Column | None = None, if_: Column | None = None) -> Column:
        key = F.lit(None).cast("string") if key is None else key
        made = F.struct(F.lit(check.name).alias("name"), F.lit(role).alias("role"), when.alias("day"), key.alias("key"))
        return made if if_ is None else F.when(if_, made)

    out = []
    for c in suite:
        if c.kind == "relationships" and c.args[0] in known and c.table in known:
            if c.args[0] == table:
                out.append(record(c, "parent", _key(c.args[1]), F.col(c.args[1]).isNotNull()))
            if c.table == table:
                out.append(record(c, "child", _key(c.column), F.col(c.column).isNotNull()))
        elif c.table != table:
            continue
        elif (wrong := _row_level(c)) is not None:
            out.append(record(c, "row", if_=wrong))
        elif c.kind == "unique":
            out.append(record(c, "key", _key(c.column), F.col(c.column).isNotNull()))
        elif c.kind == "grain":
            out.append(record(c, "key", _key(*c.args)))
        elif c.kind == "future_dated":
            made = F.struct(
                F.lit(c.name).alias("name"), F.lit("day").alias("role"), F.col("date_day").alias("day"),
                F.lit(None).cast("string").alias("key"),
            )
            out.append(made)
    return out


def _seen(df: DataFrame, table: str, day: str | None, suite: Sequence[Check], given: Iterable[str]) -> DataFrame | None:
    records = _records(table, day, suite, given)
    if not records:
        return None
    held = F.filter(F.array(*records), lambda r: r.isNotNull())
    return df.select(F.inline(held)).withColumn("n", F.lit(1).cast("long"))


def measures(df: DataFrame, table: str, day: str | None = None, suite: Sequence[Check] = SUITE) -> DataFrame:
    """All that the suite's checks need of a table, in one pass: exact counts by day and key.

    Measures of parts of a table add up to those of the whole, so a segment's can be kept beside it. Keys that hold the
    day cannot recur in another segment; of them only those that occur more than once are kept.
    """
    every = {c.table for c in suite} | {c.args[0] for c in suite if c.kind == "relationships"}
    seen = _seen(df, table, day, suite, every)
    if seen is None:
        return df.sparkSession.createDataFrame([], MEASURES)
    counted = seen.groupBy("name", "role", "day", "key").agg(F.sum("n").alias("n"))
    daily = [c.name for c in suite if c.table == table and c.kind == "grain" and day in c.args]
    return counted.filter(~F.col("name").isin(daily) | (F.col("n") > 1)) if daily else counted


def row_checks(tables: Iterable[str], suite: Sequence[Check] = SUITE) -> list[Column]:
    """Counts of the row-level violations of tables that share their rows, to be observed while those are read."""
    named = set(tables)
    checks = [(c, p) for c in suite if c.table in named and (p := _row_level(c)) is not None]
    return [F.count_if(p).alias(c.name) for c, p in checks]


def verdicts(
    spark: SparkSession, counted: DataFrame, checks: Sequence[Check], as_of: str | None = None,
    known: Mapping[str, int] | None = None,
) -> DataFrame:
    """Measures -> ``(check_name, table_name, violations)`` of ``checks``; ``known`` has counts taken elsewhere."""
    today = F.lit(as_of).cast("date") if as_of else F.current_date()

    def total(role: str, also: Column | None = None) -> Column:
        wanted = (F.col("role") == role) if also is None else (F.col("role") == role) & also
        return F.coalesce(F.sum(F.when(wanted, F.col("n"))), F.lit(0))

    by_key = counted.groupBy("name", "key").agg(
        total("row").alias("wrong"), total("day", F.col("day") > today).alias("late"), total("key").alias("copies"),
        total("child").alias("children"), total("parent").alias("parents"),
    )
    one = F.col("wrong") + F.col("late") + (F.col("copies") > 1).cast("long") + (
        (F.col("children") > 0) & (F.col("parents") == 0)
    ).cast("long")
    found = by_key.groupBy("name").agg(F.sum(one).alias("found"))
    listed = spark.createDataFrame(
        [(c.name, c.table, (known or {}).get(c.name, 0)) for c in checks], "check_name string, table_name string, known long"
    )
    return listed.join(found, listed.check_name == found.name, "left").select(
        "check_name", "table_name", (F.coalesce("found", F.lit(0)) + F.col("known")).alias("violations")
    )


def run_suite(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    as_of: str | None = None,
    suite: Sequence[Check] = SUITE,
    kept: Mapping[str, DataFrame] | None = None,
    known: Mapping[str, int] | None = None,
) -> DataFrame:
    """Violation counts of every check whose table is given: ``(check_name, table_name, violations)``.

    Each table is read once for all its checks, and their counts meet in one shuffle by key. ``kept`` has the measures
    of tables that were counted before (see ``measures``), which are then not read at all, and
    ``known`` the row-level counts that were observed while a table was read for something else.
    """
    kept, known = kept or {}, known or {}
    ours = [c for c in suite if c.table in tables and (c.kind != "relationships" or c.args[0] in tables)]
    parts = []
    for table, df in tables.items():
        if table in kept:
            parts.append(kept[table].select("name", "role", "day", "key", "n"))
        elif (seen := _seen(df, table, None, [c for c in ours if c.name not in known], tables)) is not None:
            parts.append(seen)
    counted = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], MEASURES)
    out = verdicts(spark, counted, ours, as_of, known)
    if any(c.kind == "personal_columns" for c in suite):
        published = {t: df for t, df in tables.items() if t in PUBLISHED}
        found = personal_columns(published, pseudonyms=True)
        out = out.unionByName(
            spark.createDataFrame(
                [("personal_columns", ",".join(f"{t}.{c}" for t, c in found), len(found))],
                "check_name string, table_name string, violations long",
            )
        )
    return out
