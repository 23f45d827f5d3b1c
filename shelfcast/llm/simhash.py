"""Near-duplicates by SimHash fingerprints within a few differing bits.

* **Embedding.** A fingerprint's 32 two-bit segments are mapped to their numbers of ones (0 to 2). The
  Manhattan distance of two such vectors never exceeds the number of differing bits.
* **Grid join.** The segments form ``max_bits + 2`` groups. Vectors at Manhattan distance up to
  ``max_bits`` agree in at least two whole groups, so fingerprints meet in the cells given by two
  groups' counts; no link is lost. Inside a cell the exact bit distance decides.
* **Classes.** A cell reports a spanning forest of its links, never all pairs. Forests are merged by
  alternating large-star and small-star rounds, each written to the shared folder.

Copies share a fingerprint and are one point of the join, however many there are. A cell with more
than ``block`` distinct fingerprints is dealt out as pairs of blocks over many tasks. Nothing about
single documents reaches the driver.

Null texts count as empty; a text without words has fingerprint 0, linked like any other. Rows with
a null id get a class but never name it (a class of such rows only has a null ``component_id``).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import col, fresh, small_batches, stored, text_or_empty

SEED = 42


def fingerprint_of(raw: bytes, words: int = 4) -> int:
    """SimHash of the shingles' XXH64, as a signed long."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    tokens = raw.lower().split()  # bytes: lower-cases A-Z only and splits at blank and 9 to 13
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum([len(t) + 1 for t in tokens])
        starts = np.concatenate(([0], ends[:-words])).tolist()
        ends = (ends[words - 1 :] - 1).tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends)]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        part = np.array(hashes[at : at + 8192], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, words: int = 4) -> Column:
    """Fingerprint of a text column (never null)."""

    @F.arrow_udf(returnType=T.LongType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t.as_py() or b"", words) for t in texts], pa.int64())

    return run(text.cast("binary"))


def group_masks(groups: int) -> list[int]:
    """Masks over the packed two-bit counts, the 32 segments dealt into ``groups`` runs."""
    edges = [round(32 * i / groups) for i in range(groups + 1)]
    return [((1 << 2 * b) - 1) ^ ((1 << 2 * a) - 1) for a, b in zip(edges, edges[1:])]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def embedding(fp: Column) -> Column:
    """The 32 counts of ones, packed in two bits each."""
    low = F.lit(0x5555555555555555)
    even, odd = fp.bitwiseAND(low), F.shiftrightunsigned(fp, 1).bitwiseAND(low)
    return even.bitwiseXOR(odd).bitwiseOR(F.shiftleft(even.bitwiseAND(odd), 1))


def cells(points: DataFrame, max_bits: int, block: int) -> DataFrame:
    """(combo, cell, part, fp): each fingerprint in the cells of all pairs of groups."""
    masks = group_masks(max_bits + 2)
    pairs = [signed(a | b) for a, b in combinations(masks, 2)]
    grid = points.select("fp", embedding(F.col("fp")).alias("counts"))
    grid = grid.select("fp", "counts", F.posexplode(F.array(*map(F.lit, pairs))).alias("combo", "mask"))
    grid = grid.select("combo", F.col("counts").bitwiseAND(F.col("mask")).alias("cell"), "fp")
    hot = grid.groupBy("combo", "cell").count().where(F.col("count") > block)
    hot = hot.select("combo", "cell", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    grid = grid.join(hot, ["combo", "cell"], "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # Block i meets every block j: both write the pair's name with the smaller number first.
    parts = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.least(own, j) * F.col("blocks") + F.greatest(own, j),
    )
    return grid.select(
        "combo", "cell", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(parts)).alias("part"), "fp"
    )


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges that connect exactly what links of at most ``max_bits`` connect."""
    edges, left = [], np.unique(fps)
    while left.size > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and left.size:
            at = frontier.pop()
            near = np.bitwise_count(left ^ at) <= max_bits
            if near.any():
                hits = left[near].tolist()
                left = left[~near]
                edges.extend((int(at), h) for h in hits)
                frontier.extend(np.array(hits, dtype=np.uint64))
    return edges


def _forests(max_bits: int):
    """Rows sorted by (combo, cell, part) -> edges; cells may run over several batches."""

    def links(keys: np.ndarray, fps: np.ndarray) -> list[tuple[int, int]]:
        starts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
        sizes = np.diff(np.append(starts, len(fps)))
        small = np.repeat(sizes <= 32, sizes)
        number = np.repeat(np.arange(len(starts)), sizes)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        edges = []
        for shift in range(1, 32):
            if shift >= len(fps):
                break
            same = (number[shift:] == number[:-shift]) & small[shift:]
            if not same.any():
                break
            at = np.flatnonzero(same)
            at = at[np.bitwise_count(fps[at] ^ fps[at + shift]) <= max_bits]
            for a, b in zip(fps[at].tolist(), fps[at + shift].tolist()):
                if a != b and (p := root(a)) != (q := root(b)):
                    parent[p] = q
                    edges.append((a, b))
        for start, size in zip(starts[sizes > 32], sizes[sizes > 32]):
            edges += forest(fps[start : start + size], max_bits)
        return edges

    def packed(edges):
        pairs = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], names=["a", "b"]
        )

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []  # rows of the cell that is not yet complete
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
            fps = batch.column(3).to_numpy().view(np.uint64)
            if held and (keys[-1] == held[0][0][0]).all():
                held.append((keys, fps))
                continue
            last = len(keys)
            while last and (keys[last - 1] == keys[-1]).all():
                last -= 1
            done = [*held, (keys[:last], fps[:last])]
            held = [(keys[last:], fps[last:])]
            keys, fps = (np.concatenate([d[i] for d in done]) for i in range(2))
            if len(fps) > 1 and (edges := links(keys, fps)):
                yield packed(edges)
        if held:
            keys, fps = (np.concatenate([d[i] for d in held]) for i in range(2))
            if len(fps) > 1 and (edges := links(keys, fps)):
                yield packed(edges)

    return run


def linked(points: DataFrame, max_bits: int = 4, block: int = 50_000) -> DataFrame:
    """(a, b) of distinct fingerprints, a < b: links that connect what all links connect."""
    spread = cells(points, max_bits, block).repartition("combo", "cell", "part")
    spread = spread.sortWithinPartitions("combo", "cell", "part")
    return spread.mapInArrow(_forests(max_bits), "a bigint, b bigint").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that is not itself a root; root = smallest node."""
    stars = stored(edges.select("a", "b"), "edges")
    before = None
    while True:
        state = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            return stars.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = state
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        # Large star: every larger neighbour points to the smallest of the neighbourhood.
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        large = stored(large, "large-star")
        # Small star: a node and its smaller neighbours point to the smallest of them.
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b")
        small = small.select(F.col("m").alias("a"), F.col("a").alias("b")).union(small.select(F.col("m").alias("a"), "b"))
        stars = stored(small.where("a < b").distinct(), "small-star")


def classes(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 4,
    max_bits: int = 4, block: int = 50_000,
) -> DataFrame:
    """(doc_id, fingerprint as long, component_id, n_links): one row for each row of ``docs``.

    ``n_links`` counts the class's distinct fingerprints less one.
    """
    rows = small_batches(docs).select(col(doc_id).alias("doc_id"), fingerprint(text_or_empty(text), words).alias("fp"))
    rows = stored(rows, "fingerprints")
    return rows.join(fingerprint_classes(rows, max_bits, block), "fp").select(
        "doc_id", F.col("fp").alias("fingerprint"), "component_id", "n_links"
    )


def fingerprint_classes(rows: DataFrame, max_bits: int = 4, block: int = 50_000) -> DataFrame:
    """(fp, root, component_id, n_links) of staged rows (doc_id, fp); root names the class."""
    points = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    roots = connected(linked(points.select("fp"), max_bits, block))
    points = points.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
    points = points.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    component = points.groupBy("root").agg(
        F.min("least").alias("component_id"), (F.count("*") - 1).alias("n_links")
    )
    return points.join(component, "root").select("fp", "root", "component_id", "n_links")


def one_per_class(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 4,
    max_bits: int = 4, block: int = 50_000,
) -> DataFrame:
    """One document of each class, with its own columns: the one with the smallest id.

    Rows that repeat that id (or, in a class without ids, all its rows) are told apart by the hash of
    their text; the smallest stays, and of rows alike in id and text any one.
    """
    fp = fresh(docs, "fp")
    marked = small_batches(docs).withColumn(fp, fingerprint(text_or_empty(text), words))
    rows = stored(marked.select(col(doc_id).alias("doc_id"), F.col(fp).alias("fp")), "fingerprints")
    of = fingerprint_classes(rows, max_bits, block).select("fp", "root", "component_id")
    # The rows that may stay: in an ordinary class exactly one.
    may = rows.join(of, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    may = stored(may.groupBy("root", "fp", "component_id").agg(F.count("*").alias("rows")), "keepers")
    of_class = may.groupBy("root").agg(F.sum("rows").alias("rows_of_class"))
    may = may.drop("rows").join(of_class, "root")
    names = {c: fresh(marked, c + "_") for c in may.columns}
    may = may.select(*[F.col(c).alias(n) for c, n in names.items()])
    kept = marked.join(
        may, (F.col(fp) == F.col(names["fp"])) & col(doc_id).eqNullSafe(F.col(names["component_id"]))
    )
    single = kept.where(F.col(names["rows_of_class"]) == 1)
    place = fresh(kept, "place")
    window = Window.partitionBy(names["root"]).orderBy(F.xxhash64(text_or_empty(text)))
    several = kept.where(F.col(names["rows_of_class"]) > 1).withColumn(place, F.row_number().over(window))
    several = several.where(F.col(place) == 1).drop(place)
    return single.unionByName(several).select(*[col(c) for c in docs.columns])
