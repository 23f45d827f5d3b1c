"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

* **Targets.** Sources share ``share`` times all words by weight; none gets more than ``epochs`` times
  its own words, what is cut goes to the others by weight until none is above.
* **Blocks.** A source's documents, in hashed order, form one stream of words that is cut into blocks of
  ``block_words``. A keyed permutation gives each block its place in each epoch (the short block at the
  stream's end stays last), and the mix takes the places below the target, the last one in part. So a
  source yields its target to the word.
* **Tree.** The sources' numbers of blocks are split among the output shards by recursive halving: a
  node's left half draws its blocks from the node's by a multivariate hypergeometric law, so each shard
  has the composition a global shuffle would give it and quotas stay exact. Upper nodes are split
  on the driver (at most ``DRIVER_NODES`` vectors of one number a source), lower ones in tasks. Every
  node draws from a generator seeded with its own name, so reruns and retried tasks agree.
* **Draw.** A shard's share of a source is a run of consecutive places of the permutation: disjoint by
  construction, without a global sort. Inside a shard blocks are ordered by hash.

Stream positions are sums over hashed buckets of about ``BUCKET_ROWS`` documents, then inside each
bucket, so a source with a third of all rows uses many tasks. Identical rows (id, source, text) are one
unit with a count. The sources themselves are a configuration: more than ``MAX_SOURCES`` raise an error.
Draws from more than 10^9 blocks use the normal limit of the law.

Null texts have no words and are never drawn, a null source is a source of its own, null ids are ids.
Without words all targets are 0. Extra columns pass through ``drawn``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import WORD, col, fresh, small_batches, stored

MAX_SOURCES = 100_000
DRIVER_NODES = 64
BUCKET_ROWS = 2_000
SEED = 20_240_501
_LARGE = 10**9
_KEYS = ["source_no", "id", "hash", "size", "copy"]


def targets(sizes: list[int], weights: list[float], share: float = 1.5, epochs: int = 2) -> list[float]:
    """Words for each source; see the module."""
    total = share * sum(sizes)
    out = [0.0] * len(sizes)
    open_ = set(range(len(sizes)))
    while open_:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        weight = sum(weights[i] for i in sorted(open_))
        for i in open_:
            out[i] = left * weights[i] / weight
        full = {i for i in open_ if out[i] > epochs * sizes[i]}
        if not full:
            break
        for i in full:
            out[i] = float(epochs * sizes[i])
        open_ -= full
    return out


def permuted(block: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed bijection of 0..n-1: four Feistel rounds on the next even power of two, walked until inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2).astype(np.float64))).astype(np.int64) + 1) // 2)
    half = half.astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = block.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    while todo.any():
        x, h, m, k = out[todo], half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = x >> h, x & m
        for r in range(4):
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(r * 0xD1B54A32D192ED03 % 2**64)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & m)
        out[todo] = (left << h) | right
        todo[todo] = out[todo] >= n[todo].astype(np.uint64)
    return out.astype(np.int64)


@F.arrow_udf(returnType=T.LongType())
def _place(block: pa.Array, n: pa.Array, key: pa.Array) -> pa.Array:
    b, n, k = (x.to_numpy(zero_copy_only=False) for x in (block, n, key))
    inside = b < n
    out = b.copy()
    if inside.any():
        out[inside] = permuted(b[inside], n[inside], k[inside].view(np.uint64))
    return pa.array(out)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    if good + bad < _LARGE:
        return int(rng.hypergeometric(good, bad, n))
    total = good + bad
    mean = n * (good / total)
    deviation = np.sqrt(mean * (bad / total) * ((total - n) / (total - 1)))
    return int(min(max(round(rng.normal(mean, deviation)), 0, n - bad), good, n))


def left_share(counts: list[int], n: int, name: list[int]) -> list[int]:
    """How many of each colour a draw of ``n`` without replacement has; the draw is named by ``name``."""
    rng = np.random.default_rng(name)
    rest, out = sum(counts), []
    for c in counts:
        rest -= c
        got = hypergeometric(rng, c, rest, n) if n and c else 0
        out.append(got)
        n -= got
    return out


def split(node: tuple, blocks: int, shards: int, seed: int) -> list[tuple]:
    """The two halves of a node (first shard, end, first places, counts)."""
    low, high, first, counts = node
    middle = (low + high) // 2
    until = lambda shard: shard * (blocks // shards) + min(shard, blocks % shards)
    left = left_share(counts, until(middle) - until(low), [seed, low, high])
    return [
        (low, middle, first, left),
        (middle, high, [a + b for a, b in zip(first, left)], [a - b for a, b in zip(counts, left)]),
    ]


def shard_ranges(spark, quotas: list[int], shards: int, seed: int) -> DataFrame:
    """(source_no, shard, first, count): the places of each source that each shard draws."""
    blocks = sum(quotas)
    nodes = [(0, shards, [0] * len(quotas), list(quotas))]
    while len(nodes) < DRIVER_NODES and any(n[1] - n[0] > 1 for n in nodes):
        nodes = [x for n in nodes for x in (split(n, blocks, shards, seed) if n[1] - n[0] > 1 else [n])]

    def leaves(frames):
        for frame in frames:
            stack = [tuple(r) for r in frame.itertuples(index=False)]
            while stack:
                node = stack.pop()
                if node[1] - node[0] > 1:
                    stack.extend(split((node[0], node[1], list(node[2]), [int(c) for c in node[3]]), blocks, shards, seed))
                    continue
                got = [(i, node[0], int(f), int(c)) for i, (f, c) in enumerate(zip(node[2], node[3])) if c]
                if got:
                    yield pd.DataFrame(got, columns=["source_no", "shard", "first", "count"])

    schema = "low long, high long, first array<long>, counts array<long>"
    tree = spark.createDataFrame(nodes, schema).repartition(min(len(nodes), DRIVER_NODES))
    return tree.mapInPandas(leaves, "source_no int, shard long, first long, count long")


@dataclass
class Mixture:
    """``documents``: one row a document row (keys, source_size, target); ``pieces``: the words drawn of it
    (keys, epoch, first and last word, last exclusive, shard, order inside the shard); ``repeated``: some
    rows are identical."""

    documents: DataFrame
    pieces: DataFrame
    repeated: bool


def row_hash(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.lit(SEED), col(doc_id), col(text))


def mixture(
    docs: DataFrame, weights, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    share: float = 1.5, epochs: int = 2, block_words: int = 2048, shard_words: int = 4_000_000, seed: int = SEED,
) -> Mixture:
    """Draw the mix. ``weights`` maps the sorted list of sources (null last) to their weights."""
    spark = docs.sparkSession
    rows = docs.select(
        col(source).cast("string").alias("source"), col(doc_id).alias("id"), row_hash(doc_id, text).alias("hash"),
        F.coalesce(F.regexp_count(col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    units = stored(rows.groupBy("source", "id", "hash", "size").agg(F.count("*").alias("copies")), "mix-units")
    found = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("words"), F.count("*").alias("rows"),
        F.max("copies").alias("copies"),
    ).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["words"] for r in found]
    wanted = targets(sizes, weights([r["source"] for r in found]), share, epochs)
    words = [min(round(t), epochs * s) for t, s in zip(wanted, sizes)]
    # Places below the quota are drawn; an epoch has one place a block.
    per_epoch = [-(-s // block_words) for s in sizes]
    quotas = [
        (w // s) * n + -(-(w % s) // block_words) if s else 0 for w, s, n in zip(words, sizes, per_epoch)
    ]
    shards = max(1, -(-sum(quotas) * block_words // shard_words))
    facts = [
        (r["source"], i, s, w, float(t), s // block_words, max(1, -(-q // shards)), 1 + r["rows"] // BUCKET_ROWS)
        for i, (r, s, w, t, q) in enumerate(zip(found, sizes, words, wanted, quotas))
    ]
    table = F.broadcast(spark.createDataFrame(
        facts, "s string, source_no int, source_size long, words long, target double, whole long, width long, buckets long"
    ))
    units = units.join(table, units["source"].eqNullSafe(table["s"])).drop("s")
    units = units.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "hash"), F.col("buckets")))
    units = units.withColumn("run", F.col("size") * F.col("copies"))

    sums = units.groupBy("source_no", "bucket").agg(F.sum("run").alias("run"))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source_no").alias("n"), F.col("bucket").alias("b"), F.coalesce(F.sum("run").over(before), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("source_no", "bucket").orderBy("hash", "id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    units = units.withColumn("offset", F.coalesce(F.sum("run").over(inside), F.lit(0)))
    units = units.join(sums, (F.col("source_no") == F.col("n")) & (F.col("bucket") == F.col("b")))
    units = units.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    units = units.withColumn("start", F.col("base") + F.col("offset") + F.col("copy") * F.col("size"))
    units = stored(units.select(*_KEYS, "source", "start", "source_size", "words", "target", "whole", "width"), "mix-rows")

    last = F.col("start") + F.col("size") - 1
    blocks = F.sequence(F.floor(F.col("start") / block_words), F.floor(last / block_words))
    pieces = units.where("size > 0 and words > 0").withColumn("block", F.explode(blocks))
    pieces = pieces.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.least(F.lit(epochs - 1), F.ceil(F.col("words") / F.col("source_size")).cast("int") - 1))))
    key = F.xxhash64(F.lit(seed), "source_no", "epoch")
    pieces = pieces.withColumn("place", _place("block", "whole", key))
    begin = F.col("block") * block_words
    # Words of the block that are still below the target, counted from the block's first word.
    open_ = F.col("words") - F.col("epoch") * F.col("source_size") - F.col("place") * block_words
    pieces = pieces.withColumn("first", F.greatest(begin, F.col("start")) - F.col("start"))
    pieces = pieces.withColumn(
        "last", F.least(begin + F.least(open_, F.lit(block_words)), F.col("start") + F.col("size")) - F.col("start")
    ).where("last > first")
    epoch_places = F.ceil(F.col("source_size") / block_words)
    pieces = pieces.withColumn("place", F.col("epoch") * epoch_places + F.col("place"))
    pieces = pieces.withColumn("cell", F.floor(F.col("place") / F.col("width")))

    ranges = shard_ranges(spark, quotas, shards, seed)
    widths = F.broadcast(table.select(F.col("source_no").alias("n"), F.col("width").alias("w")))
    ranges = ranges.join(widths, F.col("source_no") == F.col("n")).select(
        F.col("source_no").alias("range_source"), "shard", F.col("first").alias("from_place"),
        (F.col("first") + F.col("count")).alias("to_place"),
        F.explode(F.sequence(F.floor(F.col("first") / F.col("w")), F.floor((F.col("first") + F.col("count") - 1) / F.col("w")))).alias("range_cell"),
    )
    pieces = pieces.join(
        ranges,
        (F.col("source_no") == F.col("range_source")) & (F.col("cell") == F.col("range_cell"))
        & (F.col("place") >= F.col("from_place")) & (F.col("place") < F.col("to_place")),
    )
    order = F.xxhash64(F.lit(seed), "shard", "source_no", "place")
    pieces = pieces.select(*_KEYS, "epoch", "first", "last", "shard", order.alias("order"))
    repeated = any(r["copies"] > 1 for r in found)
    return Mixture(units.select(*_KEYS, "source", "source_size", "target"), pieces, repeated)


def by_rank(pattern=(5.0, 2.0, 1.0)):
    """Weights that repeat along the sorted sources."""
    return lambda sources: [pattern[i % len(pattern)] for i in range(len(sources))]


def taken(mix: Mixture) -> DataFrame:
    """(doc_id, size, source_size, target, taken): words drawn of each document row, repeats counted."""
    none = mix.documents.select(*_KEYS, "source_size", "target", F.lit(0).cast("long").alias("taken"))
    some = mix.pieces.select(
        *_KEYS, F.lit(None).cast("long").alias("source_size"), F.lit(None).cast("double").alias("target"),
        (F.col("last") - F.col("first")).alias("taken"),
    )
    out = none.unionByName(some).groupBy(*_KEYS).agg(
        F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.sum("taken").alias("taken")
    )
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def cut(text: str, ranges: list[tuple[int, int]]) -> list[str]:
    """The text from word ``first`` to before word ``last`` for each range; all words give the whole text."""
    import re

    ends = [m.span() for m in re.finditer(WORD, text)]
    return [
        text if (a, b) == (0, len(ends)) else text[ends[a][0] : ends[b - 1][1]]
        for a, b in ranges
    ]


@F.arrow_udf(returnType=T.ArrayType(T.StringType()))
def _cut(texts: pa.Array, firsts: pa.Array, lasts: pa.Array) -> pa.Array:
    rows = zip(texts.to_pylist(), firsts.to_pylist(), lasts.to_pylist())
    return pa.array([cut(t, list(zip(a, b))) for t, a, b in rows], pa.list_(pa.string()))


def drawn(
    docs: DataFrame, mix: Mixture, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    n_chars: str | None = None,
) -> DataFrame:
    """The mix itself: a row for each piece, with the columns of ``docs`` and the piece's text.

    Rows lie by shard and, inside a shard, in shuffled order. ``n_chars``, if named, is counted anew.
    """
    parts = mix.pieces.groupBy("id", "hash", "copy").agg(
        F.sort_array(F.collect_list(F.struct("epoch", "first", "last", "shard", "order"))).alias("parts")
    )  # a document's pieces: one for each block_words of its words and epoch at most
    names = {c: fresh(docs, "mix_" + c) for c in ("id", "hash", "parts", "number", "piece", "cuts", "of")}
    rows = small_batches(docs).withColumn(names["hash"], row_hash(doc_id, text))
    if mix.repeated:  # one row stands for all identical ones and meets the pieces of each copy
        same = Window.partitionBy(names["hash"], col(doc_id)).orderBy(names["hash"])
        rows = rows.withColumn(names["number"], F.row_number().over(same)).where(F.col(names["number"]) == 1)
    parts = parts.select(
        F.col("id").alias(names["id"]), F.col("hash").alias(names["of"]), F.col("parts").alias(names["parts"])
    )
    out = rows.join(
        parts, col(doc_id).eqNullSafe(F.col(names["id"])) & (F.col(names["hash"]) == F.col(names["of"]))
    )
    firsts = F.transform(F.col(names["parts"]), lambda p: p["first"])
    lasts = F.transform(F.col(names["parts"]), lambda p: p["last"])
    out = out.withColumn(names["cuts"], _cut(col(text), firsts, lasts))
    out = out.withColumn(names["piece"], F.explode(
        F.zip_with(names["cuts"], names["parts"], lambda c, p: F.struct(c.alias("0"), p["shard"].alias("1"), p["order"].alias("2")))
    ))
    piece = F.col(names["piece"])
    out = out.withColumn(text, piece["0"])
    if n_chars:
        out = out.withColumn(n_chars, F.length(col(text)).cast(docs.schema[n_chars].dataType))
    a, b = fresh(out, "mix_shard"), fresh(out, "mix_order")
    out = out.withColumn(a, piece["1"]).withColumn(b, piece["2"]).select(*[col(c) for c in docs.columns], a, b)
    return out.repartition(a).sortWithinPartitions(a, b, col(doc_id)).drop(a, b)

