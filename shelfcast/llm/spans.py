"""Spans of regular-expression matches as native array expressions, in code points, end exclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MATCH = "array<struct<start:int,end:int,value:string>>"
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of ``pattern``: array of (start, end, value).

    The text between the matches comes from ``split``, so the starts are running sums of lengths.
    Texts without a match skip that work.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found,
        lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")),
    )

    def add(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + F.length(step["value"])
        item = F.struct(start.alias("start"), end.alias("end"), step["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(item)).alias("out"))

    none = F.array().cast(MATCH)
    located = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda s: s["out"])
    return F.when(text.rlike(pattern), located).otherwise(none)


def labelled(found: Column, kind: str, rank: int) -> Column:
    """Matches as spans that sort by start, then by the kind's rank."""
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    ).cast(SPAN)


def written(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def replaced(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become the first one's."""

    def add(out: Column, s: Column) -> Column:
        last = F.element_at(out, -1)
        merged = F.struct(
            last["start"].alias("start"), last["rank"].alias("rank"),
            F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"),
        )
        grown = F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(merged))
        return F.when((F.size(out) > 0) & (s["start"] < F.try_element_at(out, F.lit(-1))["end"]), grown).otherwise(
            F.concat(out, F.array(s))
        )

    apart = F.aggregate(F.array_sort(spans), F.array().cast(SPAN), add)
    nexts = F.concat(F.slice(F.transform(apart, lambda s: s["start"]), F.lit(2), F.size(apart)), F.array(F.length(text)))
    pieces = F.zip_with(
        apart, nexts,
        lambda s, until: F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"), F.substring(text, s["end"] + 1, until - s["end"])),
    )
    return F.concat(F.substring(text, F.lit(1), apart[0]["start"]), F.array_join(pieces, ""))
