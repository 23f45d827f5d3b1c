"""Search a table's text for personal values that should not have got through."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.digest import Pseudonymiser
from shelfcast.functions.text import blank, strip
from shelfcast.operators.privacy import DROP, FieldPolicy, policy_cells
from shelfcast.session import materialise


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def row_leaks(
    df: DataFrame, outputs: Sequence[str], personal: Sequence[str]
) -> DataFrame:
    """Count output cells that equal or contain a personal value of the same row.

    ``df`` holds the raw personal columns beside the policy's outputs. A map-side check without any
    join; only one counter per (output, personal) column pair is shuffled.
    """
    hits = [
        F.struct(
            F.lit(out).alias("column_name"),
            F.lit(field).alias("personal_field"),
            (
                ~blank(F.col(field)) & F.coalesce(F.col(out).contains(strip(F.col(field))), F.lit(False))
            ).cast("long").alias("hit"),
        )
        for out in outputs
        for field in personal
    ]
    return (
        df.select(F.inline(F.array(*hits)))
        .groupBy("column_name", "personal_field")
        .agg(F.sum("hit").alias("leaks"))
    )


#: Lengths of the parts that values are looked for by; a value belongs to the longest that it has.
WIDTHS = (1, 2, 4, 8)
#: Words of 64 bits in the filter of parts, at most so many rows of it are broadcast.
FILTER_WORDS = 1 << 20


def _cut(text: Column, width: Column) -> Column:
    """A text's parts of a width, in order, as an array; none if it is shorter."""
    starts = F.sequence(F.lit(1), F.length(text) - width + 1)
    return F.when(F.length(text) >= width, F.transform(starts, lambda at: text.substr(at, width))).otherwise(
        F.array().cast("array<string>")
    )


def _hashes(text: Column, *widths: Column) -> Column:
    """The distinct hashes of a text's parts of some widths, as an array."""
    return F.array_distinct(F.concat(*[F.transform(_cut(text, w), lambda p: F.xxhash64(p)) for w in widths]))


def rarest_parts(values: DataFrame) -> DataFrame:
    """The part each ``value`` is looked for by: ``(value, width, part)``.

    Values form classes by length, 1, 2 to 3, 4 to 7 and 8 on, and only parts of a class are compared: of a value's parts of
    its class's width the one that the fewest values of the class have. So a short value has no influence on how the longer
    ones are found. Parts are counted, and met with their counts, by hash; the low half of it marks the chosen one, among equally
    rare ones the smallest. Two parts that share it would only make a choice less rare.
    """
    width = F.greatest(*[F.when(F.length("value") >= w, w) for w in WIDTHS])
    numbered = values.select("value", width.alias("width"), F.monotonically_increasing_id().alias("id"))
    numbered = materialise(numbered.filter("width is not null"), "values")
    cut = numbered.select("id", F.explode(_hashes(F.col("value"), F.col("width"))).alias("hash"))
    shared = cut.groupBy("hash").agg(F.count("*").alias("values"))
    low = F.lit((1 << 32) - 1)
    mark = F.shiftleft(F.least("values", F.lit((1 << 31) - 1)), 32).bitwiseOR(F.col("hash").bitwiseAND(low))
    rarest = cut.join(shared, "hash").groupBy("id").agg(F.min(mark).alias("mark"))
    marked = F.filter(
        _cut(F.col("value"), F.col("width")),
        lambda p: F.xxhash64(p).bitwiseAND(low) == F.col("mark").bitwiseAND(low),
    )
    return numbered.join(rarest, "id").select("value", "width", F.get(marked, F.lit(0)).alias("part"))


def _filtered(cut: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``cut`` whose ``hash`` may be one of ``wanted``: all that are, few others.

    Each wanted hash sets one of 2^26 bits. The words that have any are broadcast, so most rows end where they were cut.
    """
    word = F.shiftrightunsigned("hash", 6).bitwiseAND(FILTER_WORDS - 1)
    bit = F.col("hash").bitwiseAND(63).cast("int")
    words = wanted.groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    return cut.withColumn("word", word).join(F.broadcast(words), "word").filter(F.getbit("bits", bit) == 1).drop("word", "bits")


def candidates(cells: DataFrame, parts: DataFrame) -> DataFrame:
    """Which texts (cell, text) hold the part of which value: ``(cell, value, width)``, an equality join on the parts' hashes."""
    widths = sorted(r[0] for r in parts.select("width").distinct().collect())  # four at most
    if not widths:
        return cells.sparkSession.createDataFrame([], "cell long, value string, width int")
    wanted = parts.select("value", "width", F.xxhash64("part").alias("hash"))
    cut = cells.select("cell", F.explode(_hashes(F.col("text"), *map(F.lit, widths))).alias("hash"))
    return _filtered(cut, wanted).join(wanted, "hash").select("cell", "value", "width")


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many cells of each column have which text, NULL included: ``(column_name, text, cells)``."""
    return (
        df.select(
            F.inline(F.array(*[
                F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("text")) for c in columns
            ]))
        )
        .groupBy("column_name", "text")
        .agg(F.count("*").alias("cells"))
    )


def _found(cells: DataFrame, personal: DataFrame) -> DataFrame:
    """Values in counted cells (cell, column_name, text, cells), read twice: ``(column_name, value, cells)``."""
    stripped = strip(F.col("value"))
    values = personal.select(stripped.alias("value")).filter(~blank(F.col("value"))).distinct()
    parts = materialise(rarest_parts(values), "parts")
    met = candidates(cells, parts).select("cell", "value")
    found = cells.join(met, "cell").filter(F.col("text").contains(F.col("value")))
    return found.groupBy("column_name", "value").agg(F.sum("cells").alias("cells"))


def leak_scan(output: DataFrame, personal: DataFrame) -> DataFrame:
    """Personal values found anywhere in ``output``: ``(column_name, value, cells)``.

    ``personal`` has one text column, ``value``. A value matches when it is a whole cell or a part
    of one. Every value is looked for by one of its parts (see ``rarest_parts``). Each distinct text is counted, then cut
    into its parts of the widths that values have, at most as many of each as it has characters, and parts meet in
    an equality join. Texts that hold the part are then searched for the whole value. The same plan serves any size; texts stay
    where they are until a part of a value was found in them.
    """
    cells = _cells(output, _text_columns(output)).filter(F.length("text") > 0)
    return _found(materialise(cells.withColumn("cell", F.monotonically_increasing_id()), "cells"), personal)


def policy_leak_scan(
    rows: DataFrame,
    pseudonymiser: Pseudonymiser | None,
    policy: Sequence[FieldPolicy],
    personal: Sequence[str],
    carry: Sequence[str] = (),
    more: DataFrame | None = None,
) -> DataFrame:
    """``leak_scan`` of the policy's output for the values of the landed ``personal`` columns and of ``more``.

    The landed texts are read and counted once; the personal values are among them, and as each field of the policy gives its
    output from that field alone, the policy is applied to every distinct text (see ``policy_cells``) instead of every row.
    """
    kept = [p.field for p in policy if p.action != DROP and p.field in rows.columns]
    counted = _cells(rows, list(dict.fromkeys([*kept, *carry, *personal])))
    landed = materialise(counted.withColumn("cell", F.monotonically_increasing_id()), "landed-cells")
    values = landed.filter(F.col("column_name").isin(list(personal))).select(F.col("text").alias("value"))
    cells = policy_cells(landed, pseudonymiser, policy, carry).filter(F.length("text") > 0)
    return _found(cells, values if more is None else values.union(more))
