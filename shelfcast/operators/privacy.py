"""The field policy: privacy decisions as data, compiled into one projection."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.digest import PrivacyError, Pseudonymiser
from shelfcast.functions.text import outward_code

KEEP, DROP, HASH, GENERALISE = "keep", "drop", "hash", "generalise"


@dataclass(frozen=True)
class FieldPolicy:
    """What happens to one incoming field. ``generaliser`` maps a column to a coarser column."""

    field: str
    action: str
    note: str = ""
    generaliser: Callable[[Column], Column] | None = None
    rename_to: str | None = None

    def __post_init__(self) -> None:
        if self.action not in (KEEP, DROP, HASH, GENERALISE):
            raise PrivacyError(f"{self.field}: unknown action {self.action!r}")
        if self.action == GENERALISE and self.generaliser is None:
            raise PrivacyError(f"{self.field}: generalise needs a function")

    @property
    def output_name(self) -> str | None:
        return None if self.action == DROP else self.rename_to or self.field


# The action on, and the output name of, every field of a sales export.
SALES_POLICY: tuple[FieldPolicy, ...] = (
    FieldPolicy("transaction_id", KEEP, "identifies a basket, not a person"),
    FieldPolicy("transaction_timestamp", KEEP, "gives the day"),
    FieldPolicy("store_id", KEEP, "identifies a place"),
    FieldPolicy("customer_id", HASH, "repeat purchases stay countable", None, "customer_pseudonym"),
    FieldPolicy("loyalty_id", HASH, "a separate identifier space", None, "loyalty_pseudonym"),
    FieldPolicy("customer_email", DROP, "identifying and unused"),
    FieldPolicy("card_last4", DROP, "payment data without a use"),
    FieldPolicy(
        "customer_postcode", GENERALISE, "catchment area only", outward_code,
        "customer_postcode_district",
    ),
    FieldPolicy("product_sku", KEEP, "product"),
    FieldPolicy("product_name", KEEP, "product"),
    FieldPolicy("category", KEEP, "tells the focus category apart"),
    FieldPolicy("quantity", KEEP, "measure"),
    FieldPolicy("unit_price_gbp", KEEP, "measure"),
    FieldPolicy("line_total_gbp", KEEP, "measure"),
    FieldPolicy("channel", KEEP, "sales channel"),
)


def apply_policy(
    df: DataFrame,
    pseudonymiser: Pseudonymiser | None,
    policy: Sequence[FieldPolicy] = SALES_POLICY,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Project ``df`` to what the policy lets through.

    An allow-list: columns the policy does not name are left out. A field the input lacks still
    yields its output column as NULL, so every file gives the same schema. ``carry`` names lineage
    columns added by the reader, which are not part of the feed.
    """
    present = set(df.columns)
    if pseudonymiser is None and any(p.action == HASH for p in policy):
        raise PrivacyError("the policy hashes fields, so a pseudonymiser is required")

    def out(rule: FieldPolicy) -> Column:
        if rule.field not in present:
            return F.lit(None).cast("string")
        value = F.col(f"`{rule.field}`")
        if rule.action == HASH:
            return pseudonymiser.column(value)
        if rule.action == GENERALISE:
            return rule.generaliser(value)
        return value

    kept = [out(rule).alias(rule.output_name) for rule in policy if rule.action != DROP]
    return df.select(*kept, *[F.col(f"`{name}`") for name in carry])


def policy_cells(
    cells: DataFrame,
    pseudonymiser: Pseudonymiser | None,
    policy: Sequence[FieldPolicy] = SALES_POLICY,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The policy's output of single landed texts ``(column_name, text, ...)``, under the output's column names.

    ``apply_policy`` sees the texts of one field at a time; those kept under their own name pass as they are. Other columns of
    ``cells`` go along. Outputs that are no text are left out, as are columns neither in the policy nor in ``carry``.
    """
    others = [c for c in cells.columns if c not in ("column_name", "text")]
    same = [p for p in policy if p.action == KEEP and p.output_name == p.field]
    passed = cells.select("column_name", "text", *others).filter(
        F.col("column_name").isin([*[p.field for p in same], *carry])
    )
    for rule in policy:
        if rule.action == DROP or rule in same:
            continue
        landed = cells.filter(F.col("column_name") == rule.field).select(
            F.col("text").alias(rule.field), F.struct(*others).alias("_others")
        )
        safe = apply_policy(landed, pseudonymiser, [rule], ("_others",))
        if safe.schema[rule.output_name].dataType.typeName() == "string":
            passed = passed.unionByName(safe.select(
                F.lit(rule.output_name).alias("column_name"), F.col(f"`{rule.output_name}`").alias("text"), "_others.*"
            ))
    return passed


def unexpected_columns(
    headers: DataFrame, policy: Sequence[FieldPolicy] = SALES_POLICY
) -> DataFrame:
    """Columns of each file that the policy does not know: ``(source_file, unexpected_column)``.

    ``headers`` has one row per file with an array column ``header``.
    """
    known = [rule.field for rule in policy]
    return (
        headers.select("source_file", F.explode(F.array_distinct("header")).alias("unexpected_column"))
        .filter(~F.col("unexpected_column").isin(known))
    )


def policy_register(
    spark: SparkSession, policy: Sequence[FieldPolicy] = SALES_POLICY
) -> DataFrame:
    """The policy as a table, one row per field."""
    return spark.createDataFrame(
        [(p.field, p.action, p.note, p.output_name) for p in policy],
        "field string, action string, note string, output_name string",
    )


def policy_summary(policy: Sequence[FieldPolicy] = SALES_POLICY) -> str:
    """The policy as a markdown table for the personal-data register."""
    lines = ["| field | action | output | note |", "|---|---|---|---|"]
    lines += [f"| {p.field} | {p.action} | {p.output_name or '-'} | {p.note} |" for p in policy]
    return "\n".join(lines)
