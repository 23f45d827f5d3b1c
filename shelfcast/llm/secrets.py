"""Secrets by corpus-wide ownership of candidate values.

Candidates are what the three base patterns accept (``assign``, ``access``, ``hex``) and bare tokens: runs
of at least ``MIN_TOKEN`` characters of ``[A-Za-z0-9+/_=-]`` with upper case, lower case and digits, and
shorter runs whose value some text of the corpus assigns to a keyword. Their values are hashed and, over the
whole corpus, counted by distinct repositories and distinct owners:

* a value that ``example_owners`` owners or ``example_repositories`` repositories or more hold is a widely
  copied *example*, be it copied between owners or within one;
* any other value is owner-specific and looks *live*.

Base spans are always reported. A bare token is added as kind ``token`` if its value looks live and no base
span overlaps it. So a live value that some text assigns to a keyword is also found where it stands bare, if
it has six characters or more and is not spelled like a word: it needs a letter and a digit, or a lower-case
letter before a capital. Dots at the ends of a value belong to the sentence and are not compared.

Counts are pre-aggregated by (value, owner, repository), then (value, owner), then value, so neither a
value in a third of all rows nor a hot owner gathers in a task. What the counts say of a value returns to its
occurrences by ``joined_by_value``: frequent values are broadcast, others shuffled. Only DataFrame functions
are used.

Null texts count as empty, null owners and repositories are values of their own. Repeated rows are rows;
ids need not be unique. Texts are searched whole, however long. An empty table gives no rows; extra columns
play no part, whatever their names. Spans sort by start, kind and end, so ties have one order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import col, joined_by_value, stored, text_or_empty
from shelfcast.llm.spans import MATCH, SPAN, matches

# The three base patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of at least 20 characters
HEX = r"[0-9a-f]{24,}"  # [0-9a-f]+ of at least 24 characters
RANK = {"assign": 0, "access": 1, "hex": 2, "token": 3}
BASE = ("assign", "access", "hex")

MIN_TOKEN = 24
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}"

# Runs that may hold an assigned value. The look-behind stops a run that fails from being tried at each letter.
_RUN = "[A-Za-z0-9+/_.=-]"
BARE = rf"(?<!{_RUN})(?={_RUN}*[A-Za-z])(?={_RUN}*[0-9]|{_RUN}*[a-z][A-Z]){_RUN}{{6,}}+"


def _assigned(text: Column) -> Column:
    """Matches of ``ASSIGN`` whose value has six characters or more; ``value`` is the assigned value."""
    found = F.transform(
        matches(text, ASSIGN),
        lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), F.regexp_extract(m["value"], ASSIGN, 1).alias("value")
        ),
    )
    return F.filter(found, lambda m: F.length(m["value"]) >= 6)


def _tokens(text: Column, base: Column) -> Column:
    """Bare tokens of mixed characters that overlap no base span."""
    mixed = F.filter(
        matches(text, TOKEN),
        lambda m: m["value"].rlike("[0-9]") & m["value"].rlike("[a-z]") & m["value"].rlike("[A-Z]"),
    )
    return _apart(mixed, base)


def _apart(found: Column, others: Column) -> Column:
    """Spans of ``found`` that overlap none of ``others``."""
    return F.filter(
        found, lambda m: ~F.exists(others, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    )


def _value(value: Column) -> Column:
    """The hash by which values are compared."""
    return F.xxhash64(F.trim(value, F.lit(".")))


def _bare(text: Column, others: Column) -> Column:
    """Runs outside ``others`` that may hold an assigned value, dots at their ends left out."""

    def within(m: Column) -> Column:
        start = m["start"] + F.length(m["value"]) - F.length(F.ltrim(m["value"], F.lit(".")))
        value = F.trim(m["value"], F.lit("."))
        return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"))

    runs = F.filter(F.transform(matches(text, BARE), within), lambda m: F.length(m["value"]) >= 6)
    return _apart(runs, others)


def candidates(docs: DataFrame, *, doc_id: str, text: str, owner: str, repository: str) -> DataFrame:
    """(id, row, owner, repository, found, bare).

    ``found`` has every candidate as (start, rank, end, kind, value), ``bare`` the runs that are candidates if
    their value is assigned anywhere.
    """
    body = text_or_empty(text)
    none = F.array().cast(MATCH)
    rows = docs.select(
        col(doc_id).alias("id"), col(owner).cast("string").alias("owner"), col(repository).cast("string").alias("repository"),
        body.alias("text"),
        F.when(body.rlike(ASSIGN), _assigned(body)).otherwise(none).alias("assign"),
        F.when(body.rlike(ACCESS), matches(body, ACCESS)).otherwise(none).alias("access"),
        F.when(body.rlike(HEX), matches(body, HEX)).otherwise(none).alias("hex"),
    )
    base = F.concat("assign", "access", "hex")
    rows = rows.withColumn("token", F.when(F.col("text").rlike(TOKEN), _tokens(F.col("text"), base)).otherwise(none))

    others = F.concat(base, "token")
    rows = rows.withColumn("bare", F.when(F.col("text").rlike(BARE), _bare(F.col("text"), others)).otherwise(none))

    def named(column: str, kind: str) -> Column:
        return F.transform(
            column,
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(RANK[kind]).alias("rank"), m["end"].alias("end"),
                F.lit(kind).alias("kind"), _value(m["value"]).alias("value"),
            ),
        )

    found = F.array_sort(F.concat(*[named(kind, kind) for kind in RANK]))
    return rows.select(
        "id", F.monotonically_increasing_id().alias("row"), "owner", "repository", found.alias("found"),
        named("bare", "token").alias("bare"),
    )


def ownership(occurrences: DataFrame) -> DataFrame:
    """(value, repositories, owners, times) of occurrences (value, owner, repository)."""
    pairs = occurrences.groupBy("value", "owner", "repository").agg(F.count("*").alias("times"))
    owners = pairs.groupBy("value", "owner").agg(F.count("*").alias("repositories"), F.sum("times").alias("times"))
    return owners.groupBy("value").agg(
        F.sum("repositories").alias("repositories"), F.count("*").alias("owners"), F.sum("times").alias("times")
    )


def occurrences(rows: DataFrame) -> DataFrame:
    """(row, owner, repository, start, rank, end, kind, value) of all candidates of ``rows``."""

    def single(name: str) -> DataFrame:
        exploded = rows.where(F.size(name) > 0).select("row", "owner", "repository", F.explode(name).alias("f"))
        return exploded.select("row", "owner", "repository", "f.*")

    found, bare = single("found"), single("bare")
    assigned = found.where(F.col("kind") == "assign").select("value").distinct().withColumn("assigned", F.lit(True))
    values = bare.groupBy("value").agg(F.count("*").alias("times")).join(assigned, "value", "left")
    bare = joined_by_value(bare, stored(values, "bare-values"), "value", "times").where("assigned").drop("assigned")
    return found.unionByName(bare)


def with_spans(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", owner: str = "source",
    repository: str = "doc_id", example_owners: int = 3, example_repositories: int = 20,
) -> DataFrame:
    """(doc_id, spans) for each row of ``docs``.

    ``spans`` is a sorted array of (start, rank, end, kind, repositories, owners, live): base spans and
    the bare tokens that look live.
    """
    rows = stored(candidates(docs, doc_id=doc_id, text=text, owner=owner, repository=repository), "secret-candidates")
    single = stored(occurrences(rows), "secret-occurrences")
    live = (F.col("owners") < example_owners) & (F.col("repositories") < example_repositories)
    held = stored(ownership(single.select("value", "owner", "repository")).withColumn("live", live), "secret-values")
    judged = joined_by_value(single, held, "value", "times").where(F.col("live") | (F.col("kind") != "token"))
    # A row's candidates are bounded by its own text.
    spans = judged.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind", "repositories", "owners", "live"))).alias("spans")
    )
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,repositories:bigint,owners:bigint,live:boolean>>")
    return rows.join(spans, "row", "left").select(F.col("id").alias("doc_id"), F.coalesce("spans", none).alias("spans"))


def plain(spans: Column, kinds=tuple(RANK)) -> Column:
    """Spans of ``kinds`` as (start, rank, end, kind)."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.transform(
        chosen, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    ).cast(SPAN)
