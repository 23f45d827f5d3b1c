"""Importance resampling of raw documents towards a target text, reproducible to the digit.

Features are runs of 1 to ``runs`` consecutive words, counted into ``buckets`` by CRC-32. A bucket's gain is the
floored logarithm, in thousandths, of its smoothed share in the target over its share in all documents. A document's
weight is the floored mean of its features' gains; its score adds Gumbel noise named by the seed and the id. Of the documents with at least ``least_words`` words
the highest scores are drawn, ``share`` percent of them.

* **Checksums.** A batch's distinct features are grouped by their length in bytes; each group is one
  two-dimensional array of bytes, and all its checksums are updated together, column by column. Buckets are
  scattered back to the documents by the features' numbers.
* **Counts** cover all documents and all target texts: a task sends at most one row a bucket.
* **Rank.** The rows (numbers only) are sorted once by range; a row's rank is its place in its
  partition plus the sizes of the partitions before. Nothing is ranked in one task, and the driver sees sizes of partitions.

Words are runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased. Null and
empty texts have no features and weight 0 and cannot be drawn while ``least_words`` is above 0. Empty
targets or documents count as 0 everywhere; no documents give no rows. A null id is noise's empty name and comes last among equal
scores; repeated rows have equal scores and follow one another. Whole texts are read, of any length. Extra columns play no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import col, small_batches, stored, terms_in, text_or_empty

POLYNOMIAL = 0xEDB88320  # CRC-32, bits reflected


def _table() -> np.ndarray:
    """What each byte value contributes."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(POLYNOMIAL), out >> 1).astype(np.uint32)
    return out


TABLE = _table()


def checksums(features: list[bytes]) -> np.ndarray:
    """CRC-32 of each byte string: those of equal length form a matrix and advance a column at a time."""
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    out = np.zeros(len(features), dtype=np.uint32)
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for start, end in zip(edges, [*edges[1:], len(order)]):
        group = order[start:end]
        matrix = np.frombuffer(b"".join([features[i] for i in group]), np.uint8).reshape(len(group), lengths[group[0]])
        crc = np.full(len(group), 0xFFFFFFFF, dtype=np.uint32)
        for column in matrix.T:
            crc = TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
        out[group] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def features_of(raw: bytes, runs: int) -> tuple[int, list[bytes]]:
    """A text's number of words and its features, repeats included."""
    words = terms_in(raw)
    out = list(words)
    for n in range(2, runs + 1):
        out += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return len(words), out


def bucketed(texts: list[bytes], runs: int, buckets: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Numbers of words and of features of each text, and the buckets of all their features in a row."""
    number: dict[bytes, int] = {}
    words, sizes, places = [], [], []
    for raw in texts:
        n, features = features_of(raw, runs)
        words.append(n)
        sizes.append(len(features))
        places.append(np.fromiter((number.setdefault(f, len(number)) for f in features), np.int64, len(features)))
    bucket = (checksums(list(number)) % np.uint32(buckets)).astype(np.int64)
    return words, np.array(sizes, dtype=np.int64), bucket[np.concatenate(places)] if places else bucket


def counts(texts: Column, rows: DataFrame, runs: int, buckets: int) -> np.ndarray:
    """Features of all rows by bucket."""

    def run(batches):
        found = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            found += np.bincount(bucketed(batch.column(0).to_pylist(), runs, buckets)[2], minlength=buckets)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(found[some])], names=["bucket", "n"])

    sums = small_batches(rows).select(texts).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in sums.collect():  # a row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, floored."""
    n, m = float(raw.sum() + len(raw)), float(target.sum() + len(target))
    pairs = zip(raw.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1.0) * n / ((s + 1.0) * m))) for s, t in pairs], dtype=np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, floored, named by seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weighed(
    docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    runs: int = 2, buckets: int = 10_000, seed: int = 2024,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of each row of ``docs``."""
    raw = text_or_empty(text).cast("binary")
    gain = gains(
        counts(raw, docs, runs, buckets), counts(text_or_empty(target_text).cast("binary"), target, runs, buckets)
    )

    def run(batches):
        for batch in batches:
            words, sizes, bucket = bucketed(batch.column(1).to_pylist(), runs, buckets)
            edges = np.concatenate(([0], np.cumsum(gain[bucket])))[np.concatenate(([0], np.cumsum(sizes)))]
            weight = np.where(sizes > 0, np.diff(edges) // np.maximum(sizes, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(sizes), pa.array(weight, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    rows = small_batches(docs).select(col(doc_id).alias("doc_id"), raw.alias("text"))
    of = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.mapInArrow(run, f"doc_id {of}, n_words long, n_features long, weight long")
    return rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def resampled(
    docs: DataFrame, target: DataFrame, *, share: int = 10, least_words: int = 20, **how
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each row of ``docs``: ranks 1, 2, ... for those drawn, else null."""
    may = F.col("n_words") >= least_words
    order = [F.desc("may"), F.desc("score"), F.asc_nulls_last("doc_id")]
    # Equal keys would share a partition; the row's own number keeps repeats apart.
    rows = stored(weighed(docs, target, **how).withColumn("may", may), "weights")
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(*order, "row").sortWithinPartitions(*order, "row")
    # The id counts rows in a partition from partition * 2^33.
    ranged = ranged.withColumn("at", F.monotonically_increasing_id()).drop("row", "n_words")
    ranged = ranged.withColumn("part", F.shiftright("at", 33)).withColumn("place", F.col("at") % (1 << 33))
    ranged = stored(ranged.drop("at"), "ranged")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"), F.count_if("may").alias("may")).orderBy("part").collect()
    drawn = sum(r["may"] for r in sizes) * share // 100
    before = np.cumsum([0, *(r["n"] for r in sizes)]).tolist()
    starts = docs.sparkSession.createDataFrame(
        [(r["part"], b) for r, b in zip(sizes, before)], "of_part long, before long"
    )
    rank = F.col("before") + F.col("place") + 1
    # A row a partition.
    out = ranged.join(F.broadcast(starts), F.col("part") == F.col("of_part"), "left")
    return out.select("doc_id", "n_features", "weight", "score", F.when(F.col("may") & (rank <= drawn), rank).alias("rank"))
