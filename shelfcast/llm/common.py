"""Helpers shared by the operators: tables, words, staging, names that do not clash."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import materialise

#: A word is a run of anything but the blank and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the tables of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read back; a retried task re-reads, not recomputes."""
    return materialise(df, name)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with at most 8 MB and 1,000 rows of it in one Arrow batch from here on.

    Workers hold a batch, their results and both copies for the transfer; the session's defaults (64 MB,
    10,000 rows) suit numbers, not texts. Smaller settings of the session are left alone.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 1000:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 * 1024 * 1024))
    return df


def give_back() -> None:
    """Freed pages go back to the system, where the C library can do so: workers stay when their task is done, and
    there may be more of them than cores."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` (compared without case) has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


FREQUENT = 100_000
MOST_FREQUENT = 200_000


def joined_by_value(
    rows: DataFrame, facts: DataFrame, value: str, times: str, *, frequent: int = FREQUENT, most: int = MOST_FREQUENT
) -> DataFrame:
    """``rows`` with the columns of staged ``facts`` but ``times``, joined on ``value`` without a hot task.

    ``facts`` has one row for every value of ``rows`` and says how often ``rows`` holds it. Values held more
    than ``frequent`` times, or more than a ``most``-th of all rows if that is more, are broadcast (there cannot
    be more than ``most`` of them); the others are shuffled, a bounded number of rows for each.
    """
    total = facts.agg(F.sum(times)).first()[0] or 0
    bar = max(frequent, total // most)
    names = [c for c in facts.columns if c not in (value, times)]
    hot = facts.where(F.col(times) > bar).select(F.col(value).alias("_value"), *[F.col(c).alias(f"_{c}") for c in names])
    marked = rows.join(F.broadcast(hot), F.col(value) == F.col("_value"), "left")
    done = marked.where(F.col("_value").isNotNull()).select(*rows.columns, *[F.col(f"_{c}").alias(c) for c in names])
    rest = marked.where(F.col("_value").isNull()).select(*rows.columns)
    return done.unionByName(rest.join(facts.where(F.col(times) <= bar).drop(times), value).select(*rows.columns, *names))


def text_or_empty(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


#: ASCII letters and digits and bytes beyond ASCII stay (A-Z as a-z), all other bytes part words.
_TERMS = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def terms_in(raw: bytes) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII of a UTF-8 text, A-Z lower-cased."""
    return raw.translate(_TERMS).split()


def hexadecimal(value: Column) -> Column:
    """A long as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
