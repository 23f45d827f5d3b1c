"""Near-duplicate vectors by product quantisation, with every link of the wanted cosine found.

Equal vectors of a label are one point with a number of copies. On unit vectors a cosine of at least ``least`` is
a distance of at most ``r = sqrt(2 - 2 least)``.

* **Coarse lists.** Centres are fitted by k-means; a point is stored in the list of its nearest centre, as the codes of
  its residual in ``SPACES`` subspaces, the length of what the codes miss, and the vector itself.
* **Sufficient probes.** A point visits every list whose cell may hold a point within ``r``: a cell lies behind
  the bisectors of its centre and any other, and the distance to such a plane is at most that to the cell. Each pair of lists is
  visited from the smaller list only.
* **Table lookup.** A visitor adds up its distances to the codes; a stored point it may be linked with
  has a sum of at most ``r`` plus what its codes miss (triangle inequality). The rest are dropped unseen.
* **Rerank.** The cosine of the others is computed from the vectors in double precision.

So no link is lost and none below ``least`` is made, whatever the sample the quantiser is fitted on (at most about ``sample``
points of the smallest hashes, on the driver); fit and parameters decide the work only. Lists of more than ``block`` points are dealt in parts, and
visitors come to each part. A task holds one part and streams its visitors. It returns numbers of links and the edges of a
spanning forest, never pairs.

Vectors null, empty, zero or with null or non-finite components, and rows with a null label, link with nothing and are
classes of their own. Vectors of different lengths do not meet. Each row is a vector of its own, repeated rows included. Rows with a null id
get a class but never name it. Empty tables give no rows. Extra columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import col, stored
from shelfcast.llm.simhash import connected

SPACES = 8
CODES = 256
STRIP = 256  # visitors compared at once
PAIRS = 100_000  # pairs reranked at once
MARGIN = 1e-6  # on distances, for rounding


def units(vectors) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that squares neither overflow nor vanish."""
    x = np.array(vectors, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def centres(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's k-means from ``k`` rows chosen by the seed; a centre without rows stays where it is."""
    out = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = nearest(x, out)
        sums = np.zeros_like(out)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(out))
        out[n > 0] = sums[n > 0] / n[n > 0, None]
    return out


def squares(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(axis=1)[:, None] - 2 * (x @ to.T) + (to * to).sum(axis=1))


def nearest(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    parts = [squares(x[a : a + 1024], to).argmin(axis=1) for a in range(0, len(x), 1024)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


@dataclass
class Quantiser:
    coarse: np.ndarray  # lists x dimensions
    books: list[np.ndarray]  # for each subspace, codes x its dimensions
    edges: list[int]

    @classmethod
    def fitted(cls, x: np.ndarray, lists: int, rounds: int, seed: int) -> "Quantiser":
        dims = x.shape[1]
        coarse = centres(x, lists, rounds, seed)
        rest = x - coarse[nearest(x, coarse)]
        spaces = min(SPACES, dims)
        edges = [dims * i // spaces for i in range(spaces + 1)]
        books = [centres(rest[:, a:b], CODES, rounds, seed + 1 + i) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
        return cls(coarse, books, edges)

    @classmethod
    def plain(cls, dims: int) -> "Quantiser":
        """One list and one code, for vectors of a length the sample does not have."""
        return cls(np.zeros((1, dims)), [np.zeros((1, dims))], [0, dims])

    def spaces(self):
        return zip(self.books, self.edges, self.edges[1:])

    def coded(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the length of what they miss."""
        rest = x - self.coarse[own]
        codes = np.stack([nearest(rest[:, a:b], book) for book, a, b in self.spaces()], axis=1).astype(np.uint8)
        missed = sum(((rest[:, a:b] - book[codes[:, i]]) ** 2).sum(axis=1) for i, (book, a, b) in enumerate(self.spaces()))
        return codes, np.sqrt(missed)

    def probes(self, x: np.ndarray, own: np.ndarray, r: float) -> list[np.ndarray]:
        """For each point the lists after its own whose cells may hold points within ``r``."""
        gaps = np.sqrt(squares(self.coarse, self.coarse))
        gaps[gaps < 1e-9] = np.inf  # coinciding centres have no plane between them
        out = []
        for start in range(0, len(x), STRIP):
            far = squares(x[start : start + STRIP], self.coarse)
            near = np.argsort(far, axis=1)[:, :8]
            for d, few, mine in zip(far, near, own[start : start + STRIP]):
                # Behind the planes of its own centre and those of the centres around the point.
                outside = ((d - d[few][:, None]) / (2 * gaps[few])).max(axis=0)
                lists = np.flatnonzero(outside <= r + MARGIN)
                out.append(lists[lists > mine])
        return out

    def lookup(self, x: np.ndarray, no: int, codes: np.ndarray) -> np.ndarray:
        """Distances from points to what the codes of list ``no`` stand for."""
        rest = x - self.coarse[no]
        total = np.zeros((len(x), len(codes)))
        for i, (book, a, b) in enumerate(self.spaces()):
            total += squares(rest[:, a:b], book)[:, codes[:, i]]
        return np.sqrt(total)


class Part:
    """The stored points of one part of a list: numbers of links, and a forest that connects what is linked."""

    def __init__(self, quantiser: Quantiser, no: int, points, copies, x, codes, missed, least: float, r: float):
        self.quantiser, self.no, self.least, self.r = quantiser, no, least, r
        self.points, self.copies, self.x, self.codes, self.missed = points, copies, x, codes, missed
        self.links = np.zeros(len(points), dtype=np.int64)
        self.tree = np.arange(len(points))  # the smallest stored point, by place, that each is connected to
        self.edges: list[tuple[int, int]] = []

    def _pairs(self, x: np.ndarray, first: int | None):
        """Linked (visitor, stored) places; ``first`` is the visitors' own place if they are stored here."""
        distance = self.quantiser.lookup(x, self.no, self.codes)
        may = distance <= self.r + self.missed + MARGIN
        if first is not None:
            may &= np.arange(len(self.points)) > first + np.arange(len(x))[:, None]
        left, right = np.nonzero(may)
        rows, columns = np.unique(left), np.unique(right)
        if len(rows) * len(columns) <= 8 * len(left):  # nearly all of them: one product
            cosine = np.full(may.shape, -2.0)
            cosine[np.ix_(rows, columns)] = x[rows] @ self.x[columns].T
            keep = cosine[left, right] >= self.least
        else:
            keep = np.concatenate([
                np.einsum("ij,ij->i", x[left[a : a + PAIRS]], self.x[right[a : a + PAIRS]]) >= self.least
                for a in range(0, len(left), PAIRS)
            ])
        return left[keep], right[keep]

    def visit(self, points: np.ndarray, copies: np.ndarray, x: np.ndarray, first: int | None = None) -> np.ndarray:
        """Numbers of links of the visitors; those of the stored points are added up."""
        found = np.zeros(len(points), dtype=np.int64)
        for start in range(0, len(points), STRIP):
            strip = slice(start, start + STRIP)
            left, right = self._pairs(x[strip], None if first is None else first + start)
            np.add.at(found, start + left, self.copies[right])
            np.add.at(self.links, right, copies[strip][left])
            for visitor in np.unique(left):
                trees = np.unique(self.tree[right[left == visitor]])
                if first is None:
                    self.edges.extend((int(points[start + visitor]), int(self.points[t])) for t in trees)
                else:
                    own = self.tree[first + start + visitor]
                    self.edges.extend((int(self.points[own]), int(self.points[t])) for t in trees if t != own)
                    trees = np.unique(np.append(trees, own))
                if len(trees) > 1:
                    self.tree[np.isin(self.tree, trees)] = trees[0]
        return found

    def among_themselves(self) -> None:
        self.links += self.visit(self.points, self.copies, self.x, first=0)


def _batch(points, links, edges):
    a = [min(e) for e in edges]
    b = [max(e) for e in edges]
    return pa.RecordBatch.from_arrays(
        [pa.array([*points, *a], pa.int64()), pa.array([*links, *[0] * len(a)], pa.int64()),
         pa.array([*[None] * len(points), *b], pa.int64())],
        names=["point", "links", "other"],
    )


def _placed(sent, r: float):
    """Points with their list, the lists they visit, codes and what these miss."""

    def run(batches):
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            found = [None] * len(vectors)
            for dims in {len(v) for v in vectors}:
                quantiser = sent.value.get(dims) or Quantiser.plain(dims)
                at = [i for i, v in enumerate(vectors) if len(v) == dims]
                x = units([vectors[i] for i in at])
                own = nearest(x, quantiser.coarse)
                codes, missed = quantiser.coded(x, own)
                for i, *rest in zip(at, own, quantiser.probes(x, own, r), codes, missed):
                    found[i] = rest
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([int(f[0]) for f in found], pa.int32()),
                 pa.array([f[1].tolist() for f in found], pa.list_(pa.int32())),
                 pa.array([f[2].tobytes() for f in found], pa.binary()),
                 pa.array([float(f[3]) for f in found], pa.float64()),
                 *[batch.column(i) for i in range(1, batch.num_columns)]],
                names=["point", "list", "probes", "codes", "missed", *batch.schema.names[1:]],
            )

    return run


def _linked(sent, least: float, r: float):
    """Rows sorted by part, stored points first -> numbers of links, and edges."""

    def run(batches):
        held: list[pa.RecordBatch] = []  # stored points of a part that may go on
        key, part = None, None

        def opened():
            rows = pa.Table.from_batches(held)
            x = units(rows.column("v").to_pylist())
            quantiser = sent.value.get(x.shape[1]) or Quantiser.plain(x.shape[1])
            codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(len(x), -1)
            out = Part(
                quantiser, key[2], rows.column("point").to_numpy(), rows.column("copies").to_numpy(), x, codes,
                rows.column("missed").to_numpy(), least, r,
            )
            out.among_themselves()
            held.clear()
            return out

        def closed(part: Part):
            some = np.flatnonzero(part.links)
            return _batch(part.points[some], part.links[some], part.edges)

        for batch in batches:
            keys = list(zip(*(batch.column(n).to_pylist() for n in ("label", "dims", "list", "part", "visits"))))
            starts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
            for a, b in zip(starts, [*starts[1:], len(keys)]):
                if keys[a][:4] != key:
                    if held:
                        part = opened()
                    if part:
                        yield closed(part)
                    key, part = keys[a][:4], None
                some = batch.slice(a, b - a)
                if not keys[a][4]:
                    held.append(some)
                    continue
                if held:
                    part = opened()
                if part:  # a list without stored points has no visitors to answer
                    points, x = some.column("point").to_numpy(), units(some.column("v").to_pylist())
                    found = part.visit(points, some.column("copies").to_numpy(), x)
                    yield _batch(points[found > 0], found[found > 0], part.edges)
                    part.edges = []
        if held:
            part = opened()
        if part:
            yield closed(part)

    return run


def may_link(vector: Column, label: Column) -> Column:
    # NaN sorts above infinity, so one comparison keeps the finite components.
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def fitted(points: DataFrame, lists: int, sample: int, rounds: int, seed: int) -> dict[int, Quantiser]:
    """A quantiser for each length of vector in the sample."""
    share = min(1.0, sample / max(1, points.count()))
    rows = points.where(F.pmod(F.xxhash64("point"), F.lit(1 << 20)) < int(share * (1 << 20))).select("v").toArrow()
    vectors = rows.column("v").to_pylist()
    out = {}
    for dims in sorted({len(v) for v in vectors}):
        x = units([v for v in vectors if len(v) == dims])
        out[dims] = Quantiser.fitted(x, max(1, min(lists, len(x) // 8)), rounds, seed)
    return out


def link_counts(
    points: DataFrame, least: float, *, list_size: int, most_lists: int, block: int, sample: int, rounds: int, seed: int,
) -> DataFrame:
    """Rows (point, links, other) of points (point, label, dims, copies, v): links to add up, and edges to ``other``."""
    r = float(np.sqrt(max(0.0, 2 - 2 * least)))
    largest = points.groupBy("label", "dims").count().agg(F.max("count")).first()[0] or 0
    lists = min(most_lists, 1 + largest // list_size)
    sent = points.sparkSession.sparkContext.broadcast(fitted(points, lists, sample, rounds, seed))
    schema = T.StructType.fromDDL("point long, list int, probes array<int>, codes binary, missed double")
    points = points.select("point", "v", "label", "dims", "copies")
    placed = points.mapInArrow(_placed(sent, r), T.StructType(schema.fields + points.schema.fields[1:]))
    placed = stored(placed, "lists")
    where = ["label", "dims", "list"]
    sizes = placed.groupBy(*where).agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    sizes = stored(sizes, "list-sizes")
    own = placed.join(sizes, where).withColumn("part", F.pmod(F.xxhash64("point"), F.col("parts")).cast("int"))
    shipped = [*where, "part", "visits", "point", "copies", "v", "codes", "missed"]
    nothing = {"codes": F.lit(None).cast("binary"), "missed": F.lit(None).cast("double"), "visits": F.lit(1)}
    stay = own.withColumn("visits", F.lit(0)).select(*shipped)
    # To the later parts of its own list, and to every part of the lists it may have links in.
    later = F.explode(F.sequence(F.col("part") + 1, F.col("parts") - 1))
    within = own.where("part < parts - 1").withColumn("part", later).withColumns(nothing).select(*shipped)
    away = placed.withColumn("list", F.explode("probes")).join(sizes, where)
    away = away.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumns(nothing).select(*shipped)
    dealt = stay.unionByName(within).unionByName(away).repartition(*where, "part")
    dealt = dealt.sortWithinPartitions(*where, "part", "visits")
    return dealt.mapInArrow(_linked(sent, least, r), "point long, links long, other long")


def classes(
    rows: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.98,
    list_size: int = 1024, most_lists: int = 512, block: int = 4096, sample: int = 16_384, rounds: int = 8, seed: int = 13,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row: links, the smallest id reachable, whether that is its own."""
    v = col(vector)
    v = v if rows.schema[vector].dataType == T.ArrayType(T.FloatType()) else v.cast("array<double>")
    rows = rows.select(
        col(vec_id).alias("vec_id"), col(label).cast("string").alias("label"), v.alias("v"), F.size(v).alias("dims")
    )
    rows = rows.withColumn("may", may_link(F.col("v"), F.col("label")))
    # Two hashes of 64 bits, of components without the sign of zero, name a vector.
    plain = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0).cast("double")).otherwise(x.cast("double")))
    rows = rows.withColumns({"one": F.xxhash64(plain), "two": F.xxhash64(F.lit(seed), plain)})
    rows = stored(rows, "vectors")
    name = ["label", "dims", "one", "two"]
    points = rows.where("may").groupBy(*name).agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("v").alias("v")
    )
    points = stored(points.withColumn("point", F.monotonically_increasing_id()), "points")
    found = link_counts(
        points, least, list_size=list_size, most_lists=most_lists, block=block, sample=sample, rounds=rounds, seed=seed
    )
    found = stored(found, "links")
    links = found.groupBy("point").agg(F.sum("links").alias("links"))
    edges = found.where("other is not null").select(F.col("point").alias("a"), F.col("other").alias("b")).distinct()
    roots = connected(edges)
    points = points.select("point", *name, "least", "copies").join(links, "point", "left")
    points = points.join(roots.select(F.col("node").alias("point"), "root"), "point", "left")
    points = points.withColumn("root", F.coalesce("root", "point"))
    of = points.groupBy("root").agg(F.min("least").alias("component_id"))
    points = points.join(of, "root").select(
        *name, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    out = rows.select("vec_id", *[F.when(F.col("may"), F.col(c)).alias(c) for c in name]).join(points, name, "left")
    # A row that may link with nothing is its own class.
    component = F.when(F.col("one").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
