"""Which events matter to which stores, decided by the rule table.

The rule is a theta condition: a national rule without a nation reaches every store, any other rule
the stores of its nation. Written as an OR it plans a nested loop. Here both sides get a *reach* key
instead (``*`` for everywhere, ``=<nation>`` for one nation) and meet in equality joins. A rule has
one key and a store has each key once, so no pair can meet twice.

Rules and stores are few, events many and uneven, so the rules' side is always the one that is built (see ``_join_few``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.text import null_or_empty

EVERYWHERE = "*"
NATIONAL = "national"


#: Up to so many rows a counted side is broadcast.
FEW_ROWS = 100_000
SALTS = 64


def _join_few(many: DataFrame, few: DataFrame, key: str, spread: str) -> DataFrame:
    """``many`` and ``few`` joined on ``key`` such that only ``few`` is built, and no key gathers ``many`` in one task.

    ``few`` is counted. Up to ``FEW_ROWS`` rows it is broadcast and ``many`` stays where it is. Beyond that it is repeated for
    each salt and ``many`` is dealt by key and salt, a hash of ``spread``.
    """
    if few.count() <= FEW_ROWS:
        return many.join(F.broadcast(few), key)
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    repeated = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return many.withColumn("_salt", salt).join(repeated.hint("shuffle_hash"), [key, "_salt"]).drop("_salt")


def rules_by_reach(rules: DataFrame) -> DataFrame:
    """Rules with their reach; a local rule without a nation has none and matches nothing."""
    everywhere = (F.col("scope") == NATIONAL) & null_or_empty(F.col("applies_to_nation"))
    reach = F.when(everywhere, F.lit(EVERYWHERE)).otherwise(
        F.concat(F.lit("="), F.col("applies_to_nation"))
    )
    return rules.select("league_name", "scope", "weight", "rationale", reach.alias("reach"))


def stores_by_reach(stores: DataFrame) -> DataFrame:
    """Each store under every reach it answers to: ``(store_id, reach)``."""
    answers = F.array_compact(F.array(F.lit(EVERYWHERE), F.concat(F.lit("="), F.col("nation"))))
    return stores.select("store_id", F.explode(answers).alias("reach"))


def live_events(staged_events: DataFrame) -> DataFrame:
    """Events that go ahead; an unknown flag is not a yes to going ahead either."""
    return staged_events.filter(~F.col("is_postponed"))


def event_store_relevance(
    staged_events: DataFrame, rules: DataFrame, stores: DataFrame
) -> DataFrame:
    """The bridge: one row per event and store it reaches."""
    league_stores = rules_by_reach(rules).join(stores_by_reach(stores), "reach").drop("reach")
    return _join_few(live_events(staged_events), league_stores, "league_name", "event_id").select(
        "event_id", "event_date", "league_name", "event_name", "kickoff_hour",
        "store_id", "scope", "weight", "rationale",
    )


def bridge_features(bridge: DataFrame) -> DataFrame:
    """The bridge collapsed to store x day."""
    return bridge.groupBy("store_id", "event_date").agg(
        F.count("*").alias("relevant_event_count"),
        F.max("weight").alias("max_event_weight"),
        F.sum("weight").alias("total_event_weight"),
        F.bool_or(F.coalesce(F.col("scope") == NATIONAL, F.lit(False))).alias(
            "has_national_broadcast_event"
        ),
        F.min("kickoff_hour").alias("earliest_kickoff_hour"),
        F.max("kickoff_hour").alias("latest_kickoff_hour"),
    )


def event_features(staged_events: DataFrame, rules: DataFrame, stores: DataFrame) -> DataFrame:
    """``bridge_features`` without building the bridge.

    All five measures decompose, so events are folded to (league, day), then to (reach, day), and
    only then fanned out to stores. The work falls from events x stores to days x stores, and the
    first fold runs map-side before anything is shuffled, so a league holding a third of all events
    costs no more than another.
    """
    per_league = live_events(staged_events).groupBy("league_name", "event_date").agg(
        F.count("*").alias("events"),
        F.min("kickoff_hour").alias("first"),
        F.max("kickoff_hour").alias("last"),
    )
    per_reach = (
        _join_few(per_league, rules_by_reach(rules).filter("reach is not null"), "league_name", "event_date")
        .groupBy("reach", "event_date")
        .agg(
            F.sum("events").alias("events"),
            F.max("weight").alias("top"),
            F.sum(F.col("weight") * F.col("events")).cast("decimal(20,4)").alias("total"),
            F.bool_or(F.coalesce(F.col("scope") == NATIONAL, F.lit(False))).alias("national"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
    )
    return (
        _join_few(per_reach, stores_by_reach(stores), "reach", "event_date")
        .groupBy("store_id", "event_date")
        .agg(
            F.sum("events").alias("relevant_event_count"),
            F.max("top").alias("max_event_weight"),
            F.sum("total").cast("decimal(20,4)").alias("total_event_weight"),
            F.bool_or("national").alias("has_national_broadcast_event"),
            F.min("first").alias("earliest_kickoff_hour"),
            F.max("last").alias("latest_kickoff_hour"),
        )
    )


def rules_without_events(rules: DataFrame, staged_events: DataFrame) -> DataFrame:
    """Leagues that have a rule but never occur among the events."""
    seen = staged_events.select("league_name").distinct()
    return rules.select("league_name").join(seen, "league_name", "left_anti")


def leagues_without_rules(rules: DataFrame, staged_events: DataFrame) -> DataFrame:
    """Leagues that occur among the events but have no rule, with their number of events."""
    counted = (
        staged_events.filter(F.col("league_name").isNotNull())
        .groupBy("league_name").agg(F.count("*").alias("events"))
    )
    return counted.join(rules.select("league_name"), "league_name", "left_anti")
