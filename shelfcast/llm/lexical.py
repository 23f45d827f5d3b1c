"""Ranked lexical search turned round: the documents stream through an index of the items.

``search`` returns each item's ``k`` highest-scoring documents under an integer form of BM25; all documents count
towards the statistics and all are scored.

* **Index.** Items are few beside documents, so their postings (term -> items and counts) are what is
  broadcast: at most about ``max_postings`` of them at a time. More items than that are dealt by hash into
  blocks of that size, and each block is a pass of its own.
* **First pass.** Each document's counts of the block's terms are written, with its length. The number of
  documents, the total of lengths and the document frequencies are summed over that table; a
  task sends one row a term at most.
* **Second pass.** A task streams its documents' counts through the index, several at a time, and keeps a heap of the
  ``k`` best documents of each item. No pair of item and document is ever a row.
* **Merge.** Tasks' heaps meet in rounds, ``FAN`` tasks to one, so that no merge reads more than
  ``FAN * k`` rows an item, however many tasks there were.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased. Null and
empty texts have no term: such documents count nowhere, such items get no rows. Items that share an id are one item
with all their terms (equal rows count once); repeated documents are documents of their own. Ties go to the smaller
doc_id, a null id comes last. Empty tables give no rows. Whole texts of any length are read. Extra columns play no part.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import col, small_batches, stored, terms_in, text_or_empty

FAN = 32
CELLS = 2_000_000  # scores held at once
NO_ID = 2**63  # stands for a null doc_id, behind all others


def _item_counts(batches):
    for batch in batches:
        counts = [Counter(terms_in(t.as_py())) for t in batch.column(1)]
        sizes = [len(c) for c in counts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes))),
             pa.array([t for c in counts for t in c], pa.binary()),
             pa.array([n for c in counts for n in c.values()], pa.int64())],
            names=["item", "term", "n"],
        )


class Postings:
    """Term -> number, and the terms' items and counts one after the other."""

    def __init__(self, items: np.ndarray, terms: list[bytes], counts: np.ndarray):
        self.names, item = np.unique(items, return_inverse=True)
        self.number = {t: i for i, t in enumerate(dict.fromkeys(terms))}
        of = np.fromiter((self.number[t] for t in terms), np.int64, len(terms))
        order = np.argsort(of, kind="stable")
        self.edge = np.searchsorted(of[order], np.arange(len(self.number) + 1))
        self.item, self.count = item[order], counts[order]

    def scores(self, doc: np.ndarray, term: np.ndarray, part: np.ndarray, docs: int) -> np.ndarray:
        """Sums over documents (rows) and items of ``part`` times the item's count of the term."""
        out = np.zeros(docs * len(self.names), dtype=np.int64)
        size = self.edge[term + 1] - self.edge[term]
        for at in _slices(size, CELLS):
            n = size[at]
            start = np.repeat(self.edge[term[at]] - np.concatenate(([0], np.cumsum(n[:-1]))), n)
            place = start + np.arange(len(start))
            cell = np.repeat(doc[at], n) * len(self.names) + self.item[place]
            np.add.at(out, cell, np.repeat(part[at], n) * self.count[place])
        return out.reshape(docs, len(self.names))


def _slices(sizes: np.ndarray, most: int):
    """Consecutive slices whose sizes sum to ``most`` or less, or which are single."""
    edges = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(edges, (edges[at - 1] if at else 0) + most, "right")))
        yield slice(at, end)
        at = end


def _document_counts(sent):
    def run(batches):
        number = sent.value.number
        for batch in batches:
            lengths, terms, counts = [], [], []
            for text in batch.column(1):
                words = terms_in(text.as_py())
                known = Counter(filter(None.__ne__, map(number.get, words)))
                lengths.append(len(words))
                terms.append(list(known))
                counts.append(list(known.values()))
            some = np.flatnonzero(lengths)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(some)), pa.array(lengths, pa.int64()).take(pa.array(some)),
                 pa.array(terms, pa.list_(pa.int32())).take(pa.array(some)),
                 pa.array(counts, pa.list_(pa.int32())).take(pa.array(some))],
                names=["doc_id", "n", "terms", "counts"],
            )

    return run


def _statistics(batches):
    """(term, n): documents of each term; of -1, all documents; of -2, all lengths."""
    docs = length = 0
    found = np.zeros(0, dtype=np.int64)
    for batch in batches:
        docs += batch.num_rows
        length += int(batch.column(0).to_numpy().sum())
        got = np.bincount(batch.column(1).flatten().to_numpy())
        if len(got) > len(found):
            got[: len(found)] += found
            found = got
        else:
            found[: len(got)] += got
    some = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(([-1, -2], some)), pa.int64()), pa.array(np.concatenate(([docs, length], found[some])), pa.int64())],
        names=["term", "n"],
    )


def weight(docs: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * frequency + 1)))


class Best:
    """The ``k`` best documents of each item: (score, -id) on heaps, the worst on top."""

    def __init__(self, items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(items)]
        self.least = np.zeros(items, dtype=np.int64)  # what a full heap's worst scores

    def add(self, scores: np.ndarray, ids: list[int]) -> None:
        floor = self.least
        if len(scores) > self.k:
            floor = np.maximum(floor, np.partition(scores, -self.k, axis=0)[-self.k])
        changed = set()
        for doc, item in zip(*(x.tolist() for x in np.nonzero((scores >= floor) & (scores > 0)))):
            heap, entry = self.heaps[item], (int(scores[doc, item]), -ids[doc])
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            else:
                continue
            changed.add(item)
        for item in changed:
            if len(self.heaps[item]) == self.k:
                self.least[item] = self.heaps[item][0][0]


def _heaps(sent, weights: np.ndarray, docs: int, length: int, k: int):
    def run(batches):
        index = sent.value
        best = Best(len(index.names), k)
        at_once = max(1, CELLS // max(1, len(index.names)))
        for whole in batches:
            for start in range(0, whole.num_rows, at_once):
                batch = whole.slice(start, at_once)
                ids = [NO_ID if i is None else i for i in batch.column(0).to_pylist()]
                # In Python's integers: 75 * n * N may pass 64 bits.
                m = np.array([25 + 75 * n * docs // length for n in batch.column(1).to_pylist()], dtype=np.int64)
                sizes = batch.column(2).value_lengths().to_numpy()
                doc = np.repeat(np.arange(batch.num_rows), sizes)
                term, tf = (batch.column(i).flatten().to_numpy().astype(np.int64) for i in (2, 3))
                part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
                best.add(index.scores(doc, term, part, batch.num_rows), ids)
        part = TaskContext.get().partitionId()
        rows = [(index.names[i], None if d == -NO_ID else -d, s) for i, heap in enumerate(best.heaps) for s, d in heap]
        for at in range(0, len(rows), 10_000):
            items, found, scores = zip(*rows[at : at + 10_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int64()), pa.array(found, pa.int64()), pa.array(scores, pa.int64()),
                 pa.array([part] * len(items), pa.int32())],
                names=["item", "doc_id", "score", "part"],
            )

    return run


def merged(heaps: DataFrame, parts: int, k: int) -> DataFrame:
    """The ``k`` best of each item with their rank; ``part`` is below ``parts``."""

    def ranked(*by: str) -> DataFrame:
        best = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return heaps.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    while parts > FAN:
        heaps = heaps.withColumn("part", F.floor(F.col("part") / FAN))
        heaps = ranked("item", "part").drop("rank")
        parts = -(-parts // FAN)
    return ranked("item").drop("part")


def search(
    items: DataFrame, docs: DataFrame, *, k: int = 10, item_id: str = "item_id", item_text: str = "text",
    doc_id: str = "doc_id", text: str = "text", max_postings: int = 2_000_000,
) -> DataFrame:
    """(item_id, rank from 1, doc_id, score): the documents of highest score above 0 for each item."""
    rows = items.select(col(item_id).alias("item_id"), text_or_empty(item_text).cast("binary").alias("text")).distinct()
    # Numbers stand for ids, null among them, and so the heaps do not depend on the ids' type.
    names = rows.select("item_id").distinct().withColumn("item", F.monotonically_increasing_id())
    names = stored(names, "items")
    rows = rows.join(names.withColumnRenamed("item_id", "id"), F.col("item_id").eqNullSafe(F.col("id")))
    counts = small_batches(rows).select("item", "text").mapInArrow(_item_counts, "item long, term binary, n long")
    counts = stored(counts.groupBy("item", "term").agg(F.sum("n").alias("n")), "item-terms")
    blocks = 1 + counts.count() // max_postings
    texts = small_batches(docs).select(col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).cast("binary").alias("text"))
    found = None
    for block in range(blocks):
        some = counts.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("term", "item")
        one = _block(some, texts, k)
        found = one if found is None else found.unionByName(one)
    return found.join(names, "item").select("item_id", "rank", "doc_id", "score")


def _block(counts: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Heaps of one block of items, merged."""
    rows = counts.toArrow()  # about max_postings rows at most
    index = Postings(rows.column("item").to_numpy(), rows.column("term").to_pylist(), rows.column("n").to_numpy())
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast(index)
    inside = texts.mapInArrow(_document_counts(sent), "doc_id long, n long, terms array<int>, counts array<int>")
    inside = stored(inside, "term-counts")
    sums = inside.select("n", "terms").mapInArrow(_statistics, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    known = {r["term"]: r["n"] for r in sums.collect()}  # a row a term of the block
    docs, length = known.get(-1, 0), known.get(-2, 0)
    weights = np.array([weight(docs, known.get(t, 0)) for t in range(len(index.number))], dtype=np.int64)
    some = inside.where(F.size("terms") > 0)
    heaps = some.mapInArrow(_heaps(sent, weights, docs, length, k), "item long, doc_id long, score long, part int")
    return merged(stored(heaps, "heaps"), some.rdd.getNumPartitions(), k)
