"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to ``floor((a . x + b) / w)`` for ``hashes`` Gaussian vectors ``a``. A query visits,
over all ``tables``, the ``probes`` buckets most likely to hold its neighbours: its own and those reached by
moving some coordinates to the nearer slots, in order of the summed squared distances to the slots' borders.
The tables' candidates are merged and ranked by their exact distance in double precision.

* ``w`` is ``width`` times the root mean square distance to the mean in a sample of at most ``sample``
  vectors (the smallest hashes); the projections depend on the seed only. Every vector is indexed.
* Equal vectors are one point with its ``k + 1`` smallest ids, all that can enter a result; equal queries
  are searched once. A vector in a third of all rows costs one point.
* Points are dealt by hash into blocks, queries into blocks of their own, and each pair of blocks is one
  task that indexes its points, probes and returns at most ``k + 1`` ids a query: no pair of query and
  candidate is ever a row.

* A query that got fewer than ``enough`` candidates from all its probes (a vector far from the rest, a small cluster) is
  ranked exactly against every point in a second pass of the same form; so a query has ``k`` rows wherever there are ``k`` candidates.

The data these defaults were chosen on is the hard case (nearest neighbours hardly closer than any other
vector), where nine in ten neighbours take half of the points as candidates; ``probes`` trades the two.

Vectors null, empty, zero or with null or non-finite components take no part, nor do null ids; vectors of
different lengths do not meet. Identical rows count once. Ties go to the smaller id. Fewer candidates than
``k`` give fewer rows. Extra columns play no part.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import col, stored


def perturbations(hashes: int, count: int) -> np.ndarray:
    """Sets of moves in order of expected cost, as rows over the 2 x ``hashes`` moves sorted by cost.

    Moves ``j`` and ``2 hashes - 1 - j`` are the two directions of one coordinate and never go together.
    """
    m = hashes
    j = np.arange(1, 2 * m + 1)
    far = 2 * m + 1 - j
    cost = np.where(j <= m, j * (j + 1) / (4 * (m + 1) * (m + 2)), 1 - far / (m + 1) + far * (far + 1) / (4 * (m + 1) * (m + 2)))
    out = [()]
    heap = [(cost[0], (0,))]
    while heap and len(out) < count:
        total, moves = heapq.heappop(heap)
        last = moves[-1]
        if not any(2 * m - 1 - x in moves for x in moves):
            out.append(moves)
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*moves[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*moves, last + 1)))
    sets = np.zeros((len(out), 2 * m), dtype=np.uint64)
    for i, moves in enumerate(out):
        sets[i, list(moves)] = 1
    return sets


class Tables:
    """Bucket tables over the rows of ``points``."""

    def __init__(self, points: np.ndarray, w: float, tables: int, hashes: int, probes: int, seed: int):
        rng = np.random.default_rng(seed)
        self.points, self.probes, self.hashes = points, probes, hashes
        self.a = rng.normal(size=(tables, points.shape[1], hashes)) / w
        self.b = rng.uniform(size=(tables, hashes))
        self.mixer = rng.integers(1, 2**63, size=hashes, dtype=np.uint64) | np.uint64(1)
        self.sets = perturbations(hashes, max(1, 2 * probes // tables))
        self.buckets, self.order = [], []
        for a, b in zip(self.a, self.b):
            key = self.key(np.floor(points @ a + b))
            order = np.argsort(key, kind="stable")
            self.buckets.append(key[order])
            self.order.append(order)

    def key(self, slots: np.ndarray) -> np.ndarray:
        return (slots.astype(np.int64).astype(np.uint64) * self.mixer).sum(axis=-1, dtype=np.uint64)

    def candidates(self, query: np.ndarray) -> np.ndarray:
        keys, costs = [], []
        for a, b in zip(self.a, self.b):
            at = query @ a + b
            slots = np.floor(at)
            border = np.concatenate((at - slots, slots + 1 - at))
            order = np.argsort(border, kind="stable")
            move = np.where(order < self.hashes, -1, 1).astype(np.int64).astype(np.uint64) * self.mixer[order % self.hashes]
            keys.append(self.key(slots) + (self.sets * move).sum(axis=1, dtype=np.uint64))
            costs.append(self.sets @ border[order] ** 2)
        costs = np.stack(costs)
        limit = np.partition(costs.ravel(), min(self.probes, costs.size) - 1)[min(self.probes, costs.size) - 1]
        found = np.zeros(len(self.points), dtype=bool)
        for key, cost, buckets, order in zip(keys, costs, self.buckets, self.order):
            key = key[cost <= limit]
            edge = np.zeros(len(buckets) + 1, dtype=np.int64)
            np.add.at(edge, np.searchsorted(buckets, key, "left"), 1)
            np.add.at(edge, np.searchsorted(buckets, key, "right"), -1)
            found[order[np.cumsum(edge[:-1]) > 0]] = True
        return np.flatnonzero(found)


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Distinct (id, v) with ``v`` an array of doubles that may take part."""
    v = col(vector).cast("array<double>")
    rows = rows.select(col(vec_id).cast("bigint").alias("id"), v.alias("v")).where("id is not null and size(v) > 0")
    # NaN sorts above infinity, so one comparison keeps the finite components.
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.coalesce(finite, F.lit(False))).where(F.exists("v", lambda x: x != 0))
    return rows.distinct()


def spread(points: DataFrame, sample: int) -> float:
    """Root mean square distance to the mean in the ``sample`` points of smallest hash."""
    rows = points.orderBy(F.xxhash64("v"), "v").limit(sample).select("v").collect()
    lengths = [len(r["v"]) for r in rows]
    if not rows:
        return 1.0
    common = max(set(lengths), key=lengths.count)
    x = np.array([r["v"] for r in rows if len(r["v"]) == common], dtype=np.float64)
    return float(np.sqrt(((x - x.mean(axis=0)) ** 2).sum(axis=1).mean())) or 1.0


def nearest(
    rows: DataFrame, queries: Column, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = 10,
    tables: int = 12, hashes: int = 10, width: float = 2.0, probes: int = 3600, sample: int = 4096,
    block: int = 8192, query_block: int = 16_384, enough: int = 200, seed: int = 11,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows for which ``queries``, a condition on ``id``, holds."""
    rows = stored(usable(rows, vec_id, vector).withColumn("key", F.xxhash64("v")), "vectors")
    least = Window.partitionBy("key", "v").orderBy("id")
    points = rows.withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1)
    points = points.groupBy("key", "v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    points = stored(points, "points")
    asked = rows.where(queries)
    points_of_queries = asked.groupBy("key", "v").agg(F.min("id").alias("name"))
    w = width * spread(points, sample)
    blocks = 1 + points.count() // block
    query_blocks = 1 + points_of_queries.count() // query_block

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = points.withColumn("block", F.pmod("key", F.lit(blocks)).cast("int")).withColumn("query_block", every(query_blocks))
    right = points_of_queries.withColumn("query_block", F.pmod("key", F.lit(query_blocks)).cast("int")).withColumn("block", every(blocks))
    by = ["dim", "block", "query_block"]
    left, right = (side.withColumn("dim", F.size("v")) for side in (left, right))

    def search(points: pd.DataFrame, queries: pd.DataFrame, probing: bool) -> pd.DataFrame:
        """Best ids of each query; with ``probing`` also a row with how many points the probes reached."""
        out: list[tuple] = []
        if len(points) and len(queries):
            points = points.sort_values("key", kind="stable")
            x = np.stack(points["v"].to_numpy()).astype(np.float64)
            ids = points["ids"].to_numpy()
            index = Tables(x, w, tables, hashes, probes, seed) if probing else None
            for key, name, v in zip(queries["key"], queries["name"], queries["v"]):
                v = np.asarray(v, dtype=np.float64)
                found = index.candidates(v) if probing else np.arange(len(x))
                if probing:
                    out.append((key, name, None, None, len(found)))
                distance = np.sqrt(((x[found] - v) ** 2).sum(axis=1))
                if len(found) > k + 1:
                    limit = np.partition(distance, k)[k]
                    found, distance = found[distance <= limit], distance[distance <= limit]
                near = sorted((d, i) for f, d in zip(found, distance) for i in ids[f])[: k + 1]
                out.extend((key, name, int(i), float(d), None) for d, i in near)
        frame = pd.DataFrame(out, columns=["key", "name", "vec_id", "score", "seen"])
        return frame.astype({"vec_id": "Int64", "seen": "Int64"})

    def ranked(right: DataFrame, probing: bool) -> DataFrame:
        return right.groupBy(*by).cogroup(left.groupBy(*by)).applyInPandas(
            lambda q, p: search(p, q, probing), "key long, name long, vec_id long, score double, seen long"
        )

    probed = stored(ranked(right, True), "probed")
    reached = probed.groupBy("key", "name").agg(F.sum("seen").alias("reached"))
    short = right.select("key", "name").distinct().join(reached, ["key", "name"], "left")
    short = stored(short.where(F.coalesce("reached", F.lit(0)) < enough).select("key", "name"), "short")
    found = probed.where("vec_id is not null").join(short, ["key", "name"], "left_anti")
    found = found.unionByName(ranked(right.join(short, ["key", "name"], "left_semi"), False)).drop("seen")
    best = Window.partitionBy("key", "name").orderBy("score", "vec_id")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    names = points_of_queries.select(F.col("key").alias("of"), F.col("v").alias("same"), "name")
    asked = asked.join(names, (F.col("key") == F.col("of")) & (F.col("v") == F.col("same")))
    asked = asked.select("key", "name", F.col("id").alias("query_id"))
    out = asked.join(found, ["key", "name"]).where("vec_id != query_id")
    # A query that is not among its own k + 1 best loses the last of them, the others lose themselves.
    rank = F.row_number().over(Window.partitionBy("query_id", "key", "name").orderBy("score", "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
