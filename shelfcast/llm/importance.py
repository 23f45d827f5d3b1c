"""Quality by importance resampling: which documents look like a target corpus.

Words and word pairs are hashed into ``BUCKETS`` buckets. Two bag-of-buckets models are counted: the target
over the documents of ``target`` and the raw one over all documents. A document's importance is the sum of
``log(target / raw)`` over its n-grams. The ``k`` documents with the largest importance plus Gumbel noise are
a sample without replacement in proportion to the importance weights. The noise is derived from the seed and
the id, so reruns agree. ``k`` defaults to the share of the labelled documents that are targets, times
all documents.

The target model is counted over at most ``max_target`` target documents (a parameter; those of smallest id
hash), the raw one over every document; a task sends one row a non-empty bucket. The models have a fixed size. The k-th
key is found exactly by narrowing its range, 4,096 counts at a time; the driver sees counts only.

Null texts and texts without words have importance 0. Among keys that agree to 2^-20 the first rows read win. An empty target gives all documents importance 0. Extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import col, small_batches, stored, text_or_empty

BUCKETS = 10_000
LIMIT = 1 << 52
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def buckets_of(raw: bytes) -> np.ndarray:
    """Bucket of each word and of each pair of neighbouring words."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    words = np.array([digest(w) for w in raw.lower().split()], dtype=np.uint64)
    if not len(words):
        return np.empty(0, dtype=np.int64)
    pairs = words[:-1] * _PAIR + words[1:]
    pairs ^= pairs >> np.uint64(31)
    return (np.concatenate((words, pairs)) % np.uint64(BUCKETS)).astype(np.int64)


def _counts(batches):
    counts = np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in batches:
        for text, wanted in zip(batch.column(0), batch.column(1)):
            got = np.bincount(buckets_of(text.as_py()), minlength=BUCKETS)
            counts[0] += got
            if wanted.as_py():
                counts[1] += got
    used = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int64()), pa.array(counts[0][used]), pa.array(counts[1][used])], names=["bucket", "raw", "target"]
    )


def log_ratios(
    docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", max_target: int = 50_000
) -> np.ndarray:
    """log(target share / raw share) of each bucket, add-one smoothed; ``target`` has the ids of the target."""
    wanted = target.select(col(doc_id).alias("target_id")).where("target_id is not null").distinct()
    wanted = stored(wanted.orderBy(F.xxhash64("target_id"), "target_id").limit(max_target), "target-ids")
    rows = small_batches(docs).select(col(doc_id).alias("id"), text_or_empty(text).cast("binary").alias("text"))
    # At most max_target ids: a broadcast of proven size, and no text is shuffled.
    marked = rows.join(F.broadcast(wanted.withColumn("hit", F.lit(True))), F.col("id") == F.col("target_id"), "left")
    counted = marked.select("text", F.coalesce("hit", F.lit(False)).alias("wanted")).mapInArrow(
        _counts, "bucket bigint, raw bigint, target bigint"
    )
    out = np.ones((2, BUCKETS))
    for r in counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        out[:, r["bucket"]] += (r["raw"], r["target"])
    if out[1].sum() == BUCKETS:
        return np.zeros(BUCKETS)
    return np.log(out[1] / out[1].sum()) - np.log(out[0] / out[0].sum())


def importance(text: Column, ratios: np.ndarray) -> Column:
    @F.arrow_udf(returnType=T.DoubleType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([float(np.round(ratios[buckets_of(t.as_py() or b"")].sum(), 9)) for t in texts], pa.float64())

    return run(text.cast("binary"))


def gumbel(doc_id: Column, seed: int) -> Column:
    """Standard Gumbel noise named by seed and id."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id), 11) + F.lit(0.5)) / F.lit(float(2**53))
    return -F.log(-F.log(uniform))


def ordered_bits(value: Column) -> Column:
    """A 52-bit integer in the order of doubles between -2^30 and 2^30, in steps of 2^-20."""
    clipped = F.greatest(F.lit(-float(2**30)), F.least(F.lit(float(2**30)), value))
    return F.floor((clipped + float(2**30)) * float(2**20)).cast("long")


def kth_largest(keys: DataFrame, k: int) -> tuple[int, int]:
    """(bits, rest): all keys above ``bits`` and ``rest`` of those equal to it make the ``k`` largest."""
    high, rest = 0, k
    for shift in (40, 28, 16, 4, 0):
        width = 1 << (4 if shift == 0 else 12)
        inside = keys.where(F.shiftright("bits", shift + (4 if shift == 0 else 12)) == high)
        digit = F.shiftright("bits", shift) % width
        counts = {r["d"]: r["n"] for r in inside.groupBy(digit.alias("d")).agg(F.count("*").alias("n")).collect()}
        for d in sorted(counts, reverse=True):
            if counts[d] >= rest:
                high = high * width + d
                break
            rest -= counts[d]
    return high, rest


def resampled(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    k: int | None = None, seed: int = 7, max_target: int = 50_000,
) -> DataFrame:
    """(doc_id, log_weight, key, kept) for each row of ``docs``; exactly ``min(k, rows)`` rows are kept."""
    known = labels.where(col(label).isin(0, 1) & col(doc_id).isNotNull())
    good = known.where(col(label) == 1)
    ratios = log_ratios(docs, good, doc_id=doc_id, text=text, max_target=max_target)
    rows = docs.select(col(doc_id).alias("doc_id"), importance(text_or_empty(text), ratios).alias("log_weight"))
    rows = rows.withColumn("key", F.col("log_weight") + gumbel(F.col("doc_id"), seed))
    # A number in the order of partitions and rows, below LIMIT for up to 2^19 partitions.
    rows = rows.withColumn("bits", ordered_bits(F.col("key"))).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "importance")
    n = rows.count()
    if k is None:
        share = known.agg(F.avg(col(label).cast("double"))).first()[0]
        k = n if share is None else round(share * n)
    if k >= n or k <= 0:
        return rows.select("doc_id", "log_weight", "key", F.lit(k > 0).alias("kept"))
    bits, rest = kth_largest(rows.select("bits"), k)
    # Rows that share the last step of 2^-20 (identical ids do) are told apart by their number.
    number = F.lit(LIMIT - 1) - F.col("row")
    at, _ = kth_largest(rows.where(F.col("bits") == bits).select(number.alias("bits")), rest)
    kept = (F.col("bits") > bits) | ((F.col("bits") == bits) & (number >= at))
    return rows.select("doc_id", "log_weight", "key", kept.alias("kept"))
