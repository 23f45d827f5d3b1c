"""Quality rules: counts of words, symbols and repeats, and bands of n-gram perplexity for each language.

The language model has characters as its units and ``ORDER`` of them in an n-gram. Spark counts the
n-grams of every document; modified Kneser-Ney discounts, continuation counts and interpolation are joins
and aggregations over those counts. The model is kept as sorted arrays of 64-bit n-gram hashes (16 bits a
character) with their log-probabilities and back-off weights, and looked up by binary search. An n-gram it
lacks backs off to shorter ones.

The arrays are sent to the tasks only while they have at most ``max_entries`` n-grams (12 bytes each);
beyond that documents send their distinct n-grams to the counts and meet them in a join.

A document's perplexity is exp of the mean negative log-probability of its characters. The bands of a
language are its median in log-perplexity less ``below`` and plus ``above`` robust deviations (1.4826 x the
median absolute deviation); a text of ``n`` characters is allowed ``slack / sqrt(n)`` more on either side. A
document is kept if it passes the base rules and lies inside its language's bands.

The model, medians and deviations cover every distinct text of a language once, however many copies it has
(medians to a rank error of 1/10,000); deviations count as ``least`` at least. Null texts have no
words and fail the base rules; null languages form a language of their own; texts without characters have
perplexity 1 and are not counted in the bands. Repeated rows are rows. Extra columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import col, small_batches, stored, text_or_empty

ORDER = 4
START = 2  # the symbol before a text; control characters of that code are rare and harmless
CHUNK = 1_000_000
_NO_LANGUAGE = "\x00"

_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_IN_WORD = ((np.arange(256) & 0xC0) != 0x80) & ~_BLANK
RULES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def grams(text: str) -> np.ndarray:
    """The n-gram that ends in each character, as an unsigned long."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    points = (points ^ (points >> np.uint64(16))) & np.uint64(0xFFFF)
    points = np.concatenate((np.full(ORDER - 1, START, dtype=np.uint64), points))
    out = np.zeros(len(points) - ORDER + 1, dtype=np.uint64)
    for i in range(ORDER):
        out = (out << np.uint64(16)) | points[i : i + len(out)]
    return out


def rules(raw: bytes) -> tuple[int, int, int, int, int]:
    """The five counts of ``RULES``."""
    words = raw.split()  # bytes split at blank and 9 to 13
    kinds = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    seen: set[bytes] = set()
    twice = 0
    for line in raw.split(b"\n"):
        if line in seen:
            twice += bool(line.split())
        else:
            seen.add(line)
    repeated = 0
    if len(words) > 3:
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
        n = len(number)
        # Two steps of renumbering keep the window's number below 2^63 for any length of text.
        pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
        _, which, counts = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
        again = counts[which] > 1
        covered = np.zeros(len(words), dtype=bool)
        for i in range(3):
            covered[i : i + len(again)] |= again
        repeated = int(covered.sum())
    return len(words), int(kinds[_IN_WORD].sum()), int(kinds[_SYMBOLS].sum()), twice, repeated


def _counted(batches):
    """Distinct n-grams of each language with their counts, a batch of rows at a time."""
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def flush():
        for language, parts in held.items():
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))],
                names=["language", "gram", "n"],
            )
        held.clear()

    for batch in batches:
        for language, text in zip(batch.column(0), batch.column(1)):
            got = grams(text.as_py())
            held.setdefault(language.as_py(), []).append(got)
            size += len(got)
            if size >= CHUNK:
                yield from flush()
                size = 0
    yield from flush()


def language_of(name: str):
    return F.coalesce(col(name).cast("string"), F.lit(_NO_LANGUAGE))


def gram_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """(language, gram, n) over every document."""
    rows = small_batches(docs).select(language_of(lang).alias("language"), text_or_empty(text).alias("text"))
    found = rows.mapInArrow(_counted, "language string, gram bigint, n bigint")
    return found.groupBy("language", "gram").agg(F.sum("n").alias("n"))


def estimated(counts: DataFrame) -> DataFrame:
    """(language, length, gram, logp, backoff): interpolated modified Kneser-Ney estimates.

    N-grams have ``logp``; contexts, in rows of their own, ``backoff``, the log weight they give to the
    estimate of the shorter n-gram (the uniform law, for the context of length 0).
    """
    longest = F.lit((1 << 16 * (ORDER - 1)) - 1)
    tables = {ORDER: counts}
    for length in range(ORDER - 1, 0, -1):
        # Continuation counts: how many different symbols precede the shorter n-gram.
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 16 * length) - 1) if length < ORDER - 1 else longest)
        tables[length] = tables[length + 1].groupBy("language", shorter.alias("gram")).agg(F.count("*").alias("n"))
    lower = None
    out, weights = [], []
    for length in range(1, ORDER + 1):
        table = stored(tables[length], f"grams-{length}")
        r = [F.sum((F.col("n") == i).cast("double")).alias(f"r{i}") for i in range(1, 5)]
        discounts = table.groupBy("language").agg(*r)
        y = F.coalesce(F.try_divide(F.col("r1"), F.col("r1") + 2 * F.col("r2")), F.lit(0.5))

        def discount(i: int, y=y):
            ratio = F.coalesce(F.try_divide(F.col(f"r{i + 1}"), F.col(f"r{i}")), F.lit(0.0))
            return F.least(F.greatest(i - (i + 1) * y * ratio, F.lit(0.1)), F.lit(i - 0.1)).alias(f"d{i}")

        discounts = discounts.select(F.col("language").alias("dl"), discount(1), discount(2), discount(3))
        context = F.shiftrightunsigned("gram", 16)
        stats = table.groupBy(F.col("language").alias("cl"), context.alias("cg")).agg(
            F.sum("n").alias("total"),
            *[F.sum((F.col("n") == i).cast("double")).alias(f"n{i}") for i in (1, 2)],
            F.sum((F.col("n") > 2).cast("double")).alias("n3"),
        )
        stats = stats.join(discounts, F.col("cl") == F.col("dl")).withColumn(
            "gamma", sum(F.col(f"d{i}") * F.col(f"n{i}") for i in (1, 2, 3)) / F.col("total")
        )
        joined = table.join(stats, (F.col("language") == F.col("cl")) & (context == F.col("cg")))
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        own = (F.col("n") - cut) / F.col("total")
        if lower is None:
            p = own + F.col("gamma") / 65536
            level = joined.select("language", "gram", p.alias("p"))
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * (length - 1)) - 1))
            below = lower.select(F.col("language").alias("ll"), F.col("gram").alias("lg"), F.col("p").alias("lp"))
            joined = joined.join(below, (F.col("language") == F.col("ll")) & (suffix == F.col("lg")))
            level = joined.select("language", "gram", (own + F.col("gamma") * F.col("lp")).alias("p"))
        lower = stored(level, f"estimates-{length}")
        out.append(lower.select("language", F.lit(length).alias("length"), "gram", F.log("p").alias("logp")))
        weights.append(stored(stats.select(
            F.col("cl").alias("language"), F.lit(length - 1).alias("length"), F.col("cg").alias("gram"), F.log("gamma").alias("backoff")
        ), f"weights-{length}"))
    rows = reduce(DataFrame.unionByName, out).withColumn("backoff", F.lit(None).cast("double"))
    return rows.unionByName(reduce(DataFrame.unionByName, weights).withColumn("logp", F.lit(None).cast("double")))


@dataclass
class Arrays:
    """For each language and length: sorted hashes with log-probabilities, and with back-off weights."""

    grams: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]
    contexts: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: pa.Table) -> "Arrays":
        rows = rows.combine_chunks()
        found: tuple[dict, dict] = {}, {}
        for name in pc.unique(rows.column("language")).to_pylist():
            mine = rows.filter(pc.equal(rows.column("language"), name))
            for n in range(ORDER + 1):
                part = mine.filter(pc.equal(mine.column("length"), n))
                for kind, out in zip(("logp", "backoff"), found):
                    some = part.filter(pc.is_valid(part.column(kind)))
                    gram = some.column("gram").to_numpy().view(np.uint64)
                    order = np.argsort(gram)
                    out[name, n] = gram[order], some.column(kind).to_numpy()[order].astype(np.float32)
        return cls(*found)

    def log_probabilities(self, language: str, keys: np.ndarray) -> np.ndarray:
        if (language, ORDER) not in self.grams:
            return np.full(len(keys), -np.log(65536.0))
        out = np.zeros(len(keys))
        todo = np.arange(len(keys))
        for n in range(ORDER, 0, -1):
            hashes, logp = self.grams[language, n]
            mine = keys[todo] & np.uint64((1 << 16 * n) - 1)
            at, found = _lookup(hashes, mine)
            out[todo[found]] += logp[at[found]]
            todo, mine = todo[~found], mine[~found]
            if not len(todo):
                return out
            # The context's weight, where the context is known.
            hashes, backoff = self.contexts[language, n - 1]
            at, known = _lookup(hashes, mine >> np.uint64(16))
            out[todo[known]] += backoff[at[known]]
        out[todo] -= np.log(65536.0)
        return out


def _lookup(hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(hashes):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    return at, hashes[at] == keys


def _measured(model: Arrays | None):
    """Arrow function (language, text) -> the rules' counts, characters, sum of log-probabilities."""
    fields = [*RULES.replace("bigint", "").replace(" ", "").split(","), "n_grams"]

    @F.arrow_udf(returnType=T.StructType.fromDDL(RULES + ", n_grams bigint, logp double"))
    def run(languages: pa.Array, texts: pa.Array) -> pa.Array:
        counts, sums = [], []
        for language, text in zip(languages.to_pylist(), texts):
            raw = text.as_py()
            keys = grams(raw.decode("utf-8", "replace"))
            counts.append((*rules(raw), len(keys)))
            total = 0.0
            if model is not None:
                for at in range(0, len(keys), CHUNK):
                    total += float(model.log_probabilities(language, keys[at : at + CHUNK]).sum())
            sums.append(total)
        columns = [pa.array(c, pa.int64()) for c in zip(*counts)] if counts else [pa.array([], pa.int64())] * len(fields)
        return pa.StructArray.from_arrays([*columns, pa.array(sums, pa.float64())], names=[*fields, "logp"])

    return run


def _by_join(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """(row, logp): the model stays distributed; documents send their distinct n-grams to it."""

    def distinct(batches):
        for batch in batches:
            for row, language, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                keys, counts = np.unique(grams(text.as_py()), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row.as_py()] * len(keys), pa.int64()), pa.array([language.as_py()] * len(keys), pa.string()),
                     pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))],
                    names=["row", "language", "gram", "n"],
                )

    sent = rows.select("row", "language", "text").mapInArrow(distinct, "row bigint, language string, gram bigint, n bigint")
    whole = estimates.where((F.col("length") == ORDER) & F.col("logp").isNotNull()).select("language", "gram", "logp")
    return sent.join(whole, ["language", "gram"]).groupBy("row").agg(F.sum(F.col("n") * F.col("logp")).alias("logp"))


def judged(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", below: float = 5.0,
    above: float = 4.0, slack: float = 2.0, max_entries: int = 8_000_000, least: float = 0.01,
) -> DataFrame:
    """(doc_id, the rules' counts, perplexity, lower, upper, base_failed, kept) for each row of ``docs``."""
    rows = docs.select(col(doc_id).alias("doc_id"), language_of(lang).alias("language"), text_or_empty(text).alias("text"))
    rows = rows.withColumn("copy", F.xxhash64("text"))
    apart = rows.select("language", "copy", "text").dropDuplicates(["language", "copy"])
    counts = stored(gram_counts(apart, text="text", lang="language"), "gram-counts")
    estimates = stored(estimated(counts), "kneser-ney")
    if estimates.count() <= max_entries:
        run = _measured(Arrays.of(estimates.toArrow()))
        found = rows.select("doc_id", "language", "copy", run("language", F.col("text").cast("binary")).alias("m"))
        found = found.select("doc_id", "language", "copy", "m.*")
    else:
        # Identical rows have identical sums, so a hash of the row may name it.
        rows = rows.withColumn("row", F.xxhash64("doc_id", "language", "text"))
        sums = _by_join(rows.dropDuplicates(["row"]), estimates)
        run = _measured(None)
        found = rows.select("doc_id", "language", "copy", "row", run("language", F.col("text").cast("binary")).alias("m"))
        found = found.select("doc_id", "language", "copy", "row", "m.*").drop("logp").join(sums, "row", "left").fillna(0.0, ["logp"])
    found = found.withColumn("log_perplexity", F.when(F.col("n_grams") > 0, -F.col("logp") / F.col("n_grams")).otherwise(0.0))
    found = stored(found, "perplexities")
    return banded(found, below, above, slack, least)


def banded(found: DataFrame, below: float, above: float, slack: float, least: float) -> DataFrame:
    filled = found.where("n_grams > 0").groupBy("language", "copy").agg(F.min("log_perplexity").alias("log_perplexity"))
    middle = filled.groupBy("language").agg(F.percentile_approx("log_perplexity", 0.5, F.lit(10_000)).alias("middle"))
    spread = filled.join(middle, "language").groupBy(F.col("language").alias("l"), "middle").agg(
        F.percentile_approx(F.abs(F.col("log_perplexity") - F.col("middle")), 0.5, F.lit(10_000)).alias("mad")
    )
    spread = spread.withColumn("mad", F.greatest("mad", F.lit(least)))
    out = found.join(spread, F.col("language") == F.col("l"), "left")
    room = F.lit(slack) / F.sqrt(F.greatest(F.col("n_grams"), F.lit(1)))
    lower = F.col("middle") - below * 1.4826 * F.col("mad") - room
    upper = F.col("middle") + above * 1.4826 * F.col("mad") + room
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    inside = F.coalesce(F.col("log_perplexity").between(lower, upper), F.lit(True))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.exp("log_perplexity").alias("perplexity"), F.exp(lower).alias("lower"), F.exp(upper).alias("upper"),
        failed.alias("base_failed"), (~failed & inside).alias("kept"),
    )
