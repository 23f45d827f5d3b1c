"""Toxicity by nearest labelled examples under exact TF-IDF cosine, found with a block-max inverted index.

``fit`` learns from a bounded sample of labelled documents and counts document frequencies over the
whole corpus; ``scored`` adds a calibrated score, the decision and the evidence to any documents.

* **Terms.** All words and four-letter word beginnings of the examples, as 64-bit keys. Inflected words share
  their beginning. Words are cut and counted by array operations over the letters of many texts.
* **Index.** Spark tasks sort the examples' postings by term, ``SHARD`` examples at a time; the driver passes
  the packed shards on and never sees a text. Examples are numbered so that alike ones (same leading term, like length)
  are neighbours. A shard's frequent terms (``HEAD`` at most, held by ``LEAST`` of its examples) form a matrix, and every
  ``BLOCK`` of examples has the largest weight of each of them.
* **Search.** The lists of terms outside the matrices are added up in full. For the frequent ones, whose lists are long, a block's
  summed maxima (or the product of the two lengths, if less) bound what they can add. The shards of the highest bounds are computed first; then only
  those with a block whose bound reaches the k-th similarity so far, for many alike queries at a time. This is done in single precision; examples
  within its error of the k-th are computed again in double. What is skipped cannot be among the k nearest, so they are exact.
  Ties go to the smaller example id.
* **Score.** Neighbours vote with weight ``1 / (1 - similarity + 0.05)``; the vote is mapped to a
  probability by isotonic regression on leave-one-out votes of the examples. A text without any term
  has no neighbours and gets the rate of label 1 among such examples.

Bounds: ``max_examples`` examples and ``max_postings`` of their terms, both parameters (examples of the smallest hashes), fix
the index's size; it is the only thing sent to the tasks. ``max_terms`` and ``least_chi``, off unless given, keep only terms whose
presence goes with the label (chi-square over examples of different term vectors). Null texts count as empty, null ids and labels are not learnt
from, a document labelled twice counts as toxic if one label says so. Without usable labels every
score is 0; empty documents give no rows. Whole texts are read, of any length. Repeated rows and extra columns pass through unchanged.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from shelfcast.llm.common import col, fresh, give_back, small_batches, stored, text_or_empty

SHARD = 1024
BLOCK = 128
HEAD = 1024
LEAST = 1 / 16  # of a shard's examples hold a frequent term
BATCH = 128
BITS = 15  # of a letter in a term's key
TOGETHER = 250_000  # characters cut into words at once
FIRST = 3  # shards that say what can be skipped
BINS = 24
MARGIN = 1e-4  # on similarities, for single precision
RARE = np.dtype([("row", np.int32), ("part", np.float32)])
_STARTS = re.compile(r"(\w{1,5})\w*")
EXAMPLE = "id bigint, toxic int, terms array<bigint>, counts array<int>, signature binary, leading bigint"
KINDS = {"ids": np.int64, "labels": np.int32, "sizes": np.int64, "terms": np.int32, "rows": np.uint16, "counts": np.int32}
PACKED = tuple(KINDS)
RESULT = "score double, predicted int, evidence array<struct<doc_id: bigint, similarity: double, toxic: int>>"


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's text leaves 2 when divided by 4; such rows are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def terms_of(text: str) -> Counter:
    """Words of up to four letters and, as ``abcd*``, the first four letters of longer ones, with their counts."""
    return Counter([named(start) for start in _STARTS.findall(text.lower())])


def named(start: str) -> str:
    return start if len(start) < 5 else start[:4] + "*"


def term_key(term: str) -> int:
    """A term's letters in ``BITS`` bits each, so that no two terms share a key; with rarer letters a negative hash."""
    key = 0
    for i, letter in enumerate(term[:4]):
        if ord(letter) >> BITS:
            return xxh3_64_intdigest(term.encode("utf-8", "surrogatepass")) % (1 << 63) - (1 << 63)
        key |= ord(letter) << BITS * i
    return key | (len(term) > 4) << 4 * BITS


def term_keys(terms: Counter, known: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of terms, ascending, and their counts; ``known`` keeps keys seen before."""
    if len(known) > 200_000:
        known.clear()
    keys = np.empty(len(terms), dtype=np.int64)
    for i, t in enumerate(terms):
        key = known.get(t)
        if key is None:
            key = known[t] = term_key(t)
        keys[i] = key
    order = np.argsort(keys)
    return keys[order], np.fromiter(terms.values(), np.int32, len(terms))[order]


@cache
def _letters() -> np.ndarray:
    """Which characters a word is made of: those of ``\\w``."""
    return np.fromiter((x.isalnum() or x == "_" for x in map(chr, range(0x110000))), bool, 0x110000)


def vectors_of(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """``term_keys`` of the ``terms_of`` each text; texts of some ``TOGETHER`` characters at a time."""
    out, part, size = [], [], 0
    for text in texts:
        part.append(text.lower())
        size += len(text)
        if size >= TOGETHER:
            out += _vectors(part)
            part, size = [], 0
    return out + _vectors(part) if part else out


def _vectors(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    whole = "\n".join([*texts, "\n\n\n"])
    letters = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _letters()[letters]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        change = np.concatenate(([0], change))
    begins, ends = change[::2], change[1::2]
    keys, odd = np.zeros(len(begins), dtype=np.int64), np.zeros(len(begins), dtype=bool)
    for i in range(4):
        letter = np.where(ends - begins > i, letters[begins + i], 0).astype(np.int64)
        odd |= letter >> BITS > 0
        keys |= letter << BITS * i
    keys |= (ends - begins > 4).astype(np.int64) << 4 * BITS
    for i in np.flatnonzero(odd).tolist():
        keys[i] = term_key(named(whole[begins[i] : min(ends[i], begins[i] + 5)]))
    out = []
    edges = np.searchsorted(begins, np.cumsum([0] + [len(t) + 1 for t in texts])).tolist()
    for a, b in zip(edges, edges[1:]):
        mine = np.sort(keys[a:b])
        first = np.concatenate(([True], mine[1:] != mine[:-1])).nonzero()[0] if b > a else np.empty(0, dtype=np.int64)
        out.append((mine[first], np.diff(first, append=b - a)))
    return out


def _document_terms(batches):
    """Per example: its distinct terms and their counts."""
    for batch in batches:
        ids, labels, texts = (batch.column(i).to_pylist() for i in range(3))
        terms = [(a, b.astype(np.int32)) for a, b in vectors_of(texts)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(labels, pa.int32()),
             pa.array([a for a, _ in terms], pa.list_(pa.int64())),
             pa.array([b for _, b in terms], pa.list_(pa.int32())),
             pa.array([blake2b(a.tobytes() + b.tobytes(), digest_size=16).digest() for a, b in terms], pa.binary()),
             pa.array([int(a[b.argmax()]) if len(a) else None for a, b in terms], pa.int64())],
            names=["id", "toxic", "terms", "counts", "signature", "leading"],
        )


def places_of(terms: np.ndarray, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text the ascending places of its terms in the ascending ``terms``, and their counts."""
    out = []
    for keys, counts in vectors_of(texts):
        at, found = _places(terms, keys)
        out.append((at[found], counts[found]))
    return out


def _frequencies(vocabulary):
    """(term, n): documents of each term of the broadcast ``vocabulary``, and of the null term, all documents."""
    def run(batches):
        terms = vocabulary.value
        counts = np.zeros(len(terms), dtype=np.int64)
        n = 0
        for batch in batches:
            for found, _ in places_of(terms, batch.column(0).to_pylist()):
                counts[found] += 1
            n += batch.num_rows
        some = np.flatnonzero(counts)
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([n], pa.int64())], names=["term", "n"])
        for at in range(0, len(some), 100_000):
            part = some[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(terms[part]), pa.array(counts[part])], names=["term", "n"])

    return run


def _places(terms: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``keys`` stand in the ascending ``terms``, and whether they do."""
    if not len(terms):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(terms, keys), len(terms) - 1)
    return at, terms[at] == keys


def _packed(vocabulary):
    """The examples of a shard -> one row of packed arrays, postings by term."""
    def run(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by("row").combine_chunks()
        sizes = shard.column("terms").combine_chunks().value_lengths().to_numpy()
        keys, counts = (shard.column(c).combine_chunks().flatten().to_numpy() for c in ("terms", "counts"))
        at, found = _places(vocabulary.value, keys)
        rows = np.repeat(np.arange(len(sizes)), sizes)[found]
        at, counts = at[found], counts[found]
        order = np.argsort(at, kind="stable")
        arrays = (
            shard.column("id").to_numpy().astype(np.int64), shard.column("toxic").to_numpy().astype(np.int32),
            np.array([len(sizes)], dtype=np.int64), at[order].astype(np.int32), rows[order].astype(np.uint16),
            counts[order].astype(np.int32),
        )
        return pa.table({n: pa.array([zlib.compress(a.tobytes(), 1)], pa.binary()) for n, a in zip(PACKED, arrays)})

    return run


class Index:
    """Inverted index over the examples' unit TF-IDF vectors, with matrices and block maxima of each shard's frequent terms."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray, shards: list[dict[str, bytes]]):
        self.terms, self.idf, self.shards = terms, idf, shards

    def __getstate__(self):
        return {n: self.__dict__[n] for n in ("terms", "idf", "shards")}

    def release(self) -> None:
        """Keep only what was sent: workers stay when their task is done, and there may be more of them than cores."""
        for name in self.__dict__.keys() - {"terms", "idf", "shards"}:
            del self.__dict__[name]
        give_back()

    def __getattr__(self, name):
        """Postings are unpacked where they are first used."""
        if name.startswith("__") or "ids" in self.__dict__:
            raise AttributeError(name)
        self._unpack()
        return getattr(self, name)

    @property
    def rows(self) -> np.ndarray:
        """The places of the postings outside the matrices, by term."""
        return self.rare["row"]

    @property
    def head_terms(self) -> np.ndarray:
        """The terms of the postings in the matrices, example by example."""
        own = np.split(self.own_terms, self.own_edge[self.first[1:-1] * BLOCK])
        return np.concatenate([self.own_terms[:0], *(x[np.isin(self.number[x], head)] for x, head in zip(own, self.heads))])

    def _arrays(self, shard: dict[str, bytes], *names: str) -> list[np.ndarray]:
        return [np.frombuffer(zlib.decompress(shard[n]), KINDS[n]) for n in names]

    def _unpack(self):
        """A shard at a time, for the workers' memory."""
        frequency = np.zeros(len(self.terms), dtype=np.int64)  # postings outside the matrices
        heads, sizes, postings, most = [], [], 0, 1
        for shard in self.shards:
            terms, counts, size = self._arrays(shard, "terms", "counts", "sizes")
            here = np.bincount(terms, minlength=len(self.terms))
            most, postings = max(most, int(counts.max(initial=0))), postings + len(terms)
            best = np.sort(np.argsort(-here, kind="stable")[:HEAD])
            heads.append(best[here[best] > size[0] * LEAST])
            here[heads[-1]] = 0
            frequency += here
            sizes.append(int(size[0]))
        # Terms frequent in some shard have a number, and each shard the numbers of its own.
        numbered = np.unique(np.concatenate([np.empty(0, dtype=np.int64), *heads]))
        self.number = np.full(len(self.terms), -1, dtype=np.int32)
        self.number[numbered] = np.arange(len(numbered))
        self.heads = [self.number[x] for x in heads]
        self.edge = np.concatenate(([0], np.cumsum(frequency)))
        self.logs = np.concatenate(([0.0], 1 + np.log(np.arange(1, most + 1))))
        # A shard fills whole blocks; places without an example have id -1.
        self.first = np.concatenate(([0], np.cumsum([-(-n // BLOCK) for n in sizes], dtype=np.int64)))
        n = int(self.first[-1]) * BLOCK
        self.id_at, self.labels, self.scale = np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int32), np.zeros(n)
        # Frequent terms as matrices in single precision, and all terms example by example for double precision.
        self.head, length, full = [], np.zeros(n), np.zeros(n, dtype=bool)
        self.own_edge = np.zeros(n + 1, dtype=np.int64)
        self.own_terms = np.empty(postings, dtype=np.min_scalar_type(len(self.terms)))
        self.own_counts = np.empty(postings, dtype=np.min_scalar_type(most))
        # Rare terms' postings go straight to their places, behind those of earlier shards.
        self.rare = np.empty(self.edge[-1], dtype=RARE)
        free, so_far = self.edge[:-1].copy(), 0
        for i, shard in enumerate(self.shards):
            ids, labels, terms, rows, counts = self._arrays(shard, "ids", "labels", "terms", "rows", "counts")
            start, stop = int(self.first[i]) * BLOCK, int(self.first[i + 1]) * BLOCK
            here = slice(start, start + len(ids))
            self.id_at[here], self.labels[here], full[here] = ids, labels, True
            weight = self.logs[counts] * self.idf[terms]
            norm = np.sqrt(np.bincount(rows, weight * weight, minlength=len(ids)))
            scale = self.scale[here] = np.divide(1.0, norm, out=np.zeros(len(ids)), where=norm > 0)
            order = np.argsort(rows, kind="stable")
            self.own_terms[so_far : so_far + len(rows)], self.own_counts[so_far : so_far + len(rows)] = terms[order], counts[order]
            self.own_edge[start + 1 : stop + 1] = so_far + np.cumsum(np.bincount(rows, minlength=stop - start))
            so_far += len(rows)
            no = np.full(len(self.terms), -1, dtype=np.int32)
            no[heads[i]] = np.arange(len(heads[i]))
            no = no[terms]
            dense, rare = no >= 0, no < 0
            length[here] = np.sqrt(np.bincount(rows[dense], weight[dense] ** 2, minlength=len(ids))) * scale
            self.head.append(np.zeros((len(heads[i]), stop - start), dtype=np.float32))
            self.head[i][no[dense], rows[dense]] = self.logs[counts[dense]] * scale[rows[dense]]
            terms, rows, counts = terms[rare], rows[rare], counts[rare]
            first = np.flatnonzero(np.diff(terms, prepend=-1))
            many = np.diff(np.append(first, len(terms)))
            place = np.repeat(free[terms[first]] - first, many) + np.arange(len(terms))
            free[terms[first]] += many
            self.rare["row"][place] = rows.astype(np.int32) + np.int32(start)
            self.rare["part"][place] = self.logs[counts] * scale[rows]
        self.longest = length.reshape(-1, BLOCK).max(axis=1, initial=0.0)
        self.most = [x.reshape(len(x), -1, BLOCK).max(axis=2, initial=0.0) for x in self.head]
        self.profile = np.zeros((len(numbered), len(heads)), dtype=np.float32)
        for i, (x, head) in enumerate(zip(self.heads, self.head)):
            self.profile[x, i] = head.mean(axis=1)
        self.profile /= np.maximum(np.linalg.norm(self.profile, axis=0), 1e-9)
        self.empty, self.ids = np.flatnonzero(~full), self.id_at[full]

    def all_nearest(self, vectors, k: int, without) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each vector (ascending terms, counts) the places and similarities of the ``k`` examples of highest cosine
        above 0, best first, ties to the smaller id; ``without`` names an example to leave out, or None."""
        out: list = [(np.empty(0, dtype=np.int64), np.empty(0))] * len(vectors)
        some = [i for i, (terms, _) in enumerate(vectors) if len(terms) and len(self.id_at)]
        # Vectors nearest to the same shard's frequent terms skip the same blocks.
        alike = [self._queries([vectors[i] for i in some[at : at + BATCH]])[-2] @ self.profile for at in range(0, len(some), BATCH)]
        some = [some[i] for i in np.argsort(np.concatenate([x.argmax(axis=1) for x in alike]), kind="stable")] if some else []
        room = np.empty((min(BATCH, len(some)), len(self.id_at) if some else 0), dtype=np.float32)
        weight = np.zeros(len(self.terms))
        for at in range(0, len(some), BATCH):
            part = some[at : at + BATCH]
            found = self._batch([vectors[i] for i in part], k, [without[i] for i in part], room[: len(part)], weight)
            for i, near in zip(part, found):
                out[i] = near
        return out

    def _queries(self, vectors):
        """Terms, the vectors they are of and what they multiply; these of numbered terms as a matrix, and their part's length."""
        terms = np.concatenate([terms for terms, _ in vectors])
        of = np.repeat(np.arange(len(vectors)), [len(terms) for terms, _ in vectors])
        value = (1 + np.log(np.concatenate([counts for _, counts in vectors]))) * self.idf[terms]
        value /= np.sqrt(np.bincount(of, value * value, len(vectors)))[of]
        share, no = value * self.idf[terms], self.number[terms]
        head = np.flatnonzero(no >= 0)
        query = np.zeros((len(vectors), self.profile.shape[0]), dtype=np.float32)
        query[of[head], no[head]] = share[head]
        return terms, of, share, query, np.sqrt(np.bincount(of[head], value[head] ** 2, len(vectors)))

    def _batch(self, vectors, k: int, without, total: np.ndarray, weight: np.ndarray):
        """``total`` has room for each vector and place, ``weight`` a zero for each term."""
        terms, of, share, query, length = self._queries(vectors)
        # Terms that are rare in a shard, there in full.
        starts, many = self.edge[terms], self.edge[terms + 1] - self.edge[terms]
        some = np.flatnonzero(many)
        spans = list(map(slice, starts[some].tolist(), (starts + many)[some].tolist()))
        edges = np.searchsorted(of[some], np.arange(len(vectors) + 1)).tolist()
        packed = self.rare.view(np.int64)  # copied as one number each
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            if a == b:
                total[i] = 0
                continue
            found = np.concatenate([packed[s] for s in spans[a:b]]).view(RARE)
            total[i] = np.bincount(found["row"], found["part"] * np.repeat(share[some[a:b]], many[some[a:b]]), total.shape[1])
        total[:, self.empty] = -np.inf
        for i, left in enumerate(without):
            if left is not None:
                total[i, self.id_at == left] = -np.inf
        # Frequent terms by bounds: a block's maxima, or the product of the lengths.
        single = [query[:, x] for x in self.heads]
        bound = np.concatenate([x @ most for x, most in zip(single, self.most)], axis=1)
        bound = np.minimum(bound, length[:, None] * self.longest) + MARGIN
        bound += total.reshape(len(vectors), -1, BLOCK).max(axis=2)
        # The most promising shards first. Their similarities say which blocks of the others can be left out.
        limits, best, seen = np.zeros(len(vectors)), np.zeros((len(vectors), k), dtype=np.float32), 0
        of_shard = [slice(a, b) for a, b in zip(self.first.tolist(), self.first[1:].tolist())]
        highest = np.array([bound[:, x].max(axis=1).mean() for x in of_shard])
        for shard in np.argsort(-highest, kind="stable"):
            blocks = bound[:, of_shard[shard]]
            wanted = (blocks >= limits[:, None] - MARGIN) & (blocks > 0)
            rows, columns = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
            here = total[:, of_shard[shard].start * BLOCK : of_shard[shard].stop * BLOCK]
            if not len(rows):
                here[:] = -np.inf
                continue
            columns = slice(int(columns[0]) * BLOCK, int(columns[-1] + 1) * BLOCK)
            here[:, : columns.start] = here[:, columns.stop :] = -np.inf
            if len(rows) == len(vectors):
                here[:, columns] += single[shard] @ self.head[shard][:, columns]
            else:
                here[rows, columns] += single[shard][rows] @ self.head[shard][:, columns]
                here[~wanted.any(axis=1)] = -np.inf
            if seen < FIRST:
                seen += 1
                near = np.concatenate((best[rows], here[rows, columns]), axis=1)
                best[rows] = np.partition(near, -k, axis=1)[:, -k:]
                limits = best[:, 0].astype(np.float64)
        highest = total.reshape(len(vectors), -1, BLOCK).max(axis=2)
        edges = np.searchsorted(of, np.arange(len(vectors) + 1)).tolist()
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            blocks = np.flatnonzero(highest[i] >= limits[i] - 2 * MARGIN)
            at, place = np.nonzero(total[i].reshape(-1, BLOCK)[blocks] >= limits[i] - 2 * MARGIN)
            places = blocks[at] * BLOCK + place
            if len(places) > k:
                similarity = total[i, places]
                places = places[similarity >= np.partition(similarity, -k)[-k] - 2 * MARGIN]
            places = places[self.scale[places] > 0]  # of some term
            weight[terms[a:b]] = share[a:b]
            similarity = np.round(self._exact(places, weight), 12)
            weight[terms[a:b]] = 0
            places, similarity = places[similarity > 0], similarity[similarity > 0]
            order = np.lexsort((self.id_at[places], -similarity))[:k]
            yield places[order], np.minimum(similarity[order], 1.0)

    def _exact(self, places: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Similarities of examples to the query of these weights, in double precision."""
        starts, ends = self.own_edge[places], self.own_edge[places + 1]
        spans = list(map(slice, starts.tolist(), ends.tolist()))
        if not spans:
            return np.empty(0)
        terms, counts = (np.concatenate([x[s] for s in spans]) for x in (self.own_terms, self.own_counts))
        return np.add.reduceat(weight[terms] * self.logs[counts], np.cumsum(ends - starts) - (ends - starts)) * self.scale[places]

    def vote(self, places, similarity) -> float | None:
        if not len(places):
            return None
        weight = 1 / (1 - similarity + 0.05)
        return float((weight * self.labels[places]).sum() / weight.sum())


@dataclass
class Model:
    index: Index
    sent: Broadcast  # the index, packed
    k: int
    threshold: float
    levels: list[float]  # probability for each bin of the vote
    silent: float  # probability without neighbours

    def probability(self, vote: float | None) -> float:
        if vote is None:
            return self.silent
        at = vote * (BINS - 1)
        low = min(int(at), BINS - 2)
        return float(self.levels[low] + (at - low) * (self.levels[low + 1] - self.levels[low]))


def isotonic(weights, means) -> list[float]:
    """Pool adjacent violators: the non-decreasing values closest to ``means`` under ``weights``."""
    pools: list[list[float]] = []
    for w, m in zip(weights, means):
        pools.append([w, m, 1])
        while len(pools) > 1 and pools[-2][1] > pools[-1][1]:
            b, a = pools.pop(), pools.pop()
            pools.append([a[0] + b[0], (a[0] * a[1] + b[0] * b[1]) / (a[0] + b[0]), a[2] + b[2]])
    return [float(m) for _, m, n in pools for _ in range(n)]


def fit(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic", k: int = 15, threshold: float = 0.3, max_examples: int = 30_000,
    max_postings: int = 20_000_000, max_terms: int | None = None, least_chi: float | None = None,
) -> Model:
    """Learn from ``labels``; see the module. Rows of ``held_out`` ids are never read."""
    spark = docs.sparkSession
    usable = labels.select(col("doc_id").cast("bigint").alias("id"), col(label).cast("int").alias("toxic"))
    usable = usable.where("id is not null and toxic in (0, 1)").where(~held_out(F.col("id")))
    usable = usable.groupBy("id").agg(F.max("toxic").alias("toxic"))
    usable = usable.orderBy(F.xxhash64("id"), "id").limit(max_examples)
    texts = small_batches(docs).select(col(doc_id).cast("bigint").alias("id"), text_or_empty(text).alias("text"))
    # At most max_examples pairs of numbers: a broadcast of proven size.
    examples = texts.join(F.broadcast(stored(usable, "toxic-labels")), "id").select("id", "toxic", "text")
    examples = stored(examples.mapInArrow(_document_terms, EXAMPLE), "example-terms")
    examples = stored(_numbered(examples, max_postings), "examples")

    # Examples of equal term vectors count once where terms are chosen.
    sizes = examples.groupBy("signature").agg(F.max("toxic").alias("toxic"))
    sizes = sizes.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if not sizes["toxic"] or sizes["toxic"] == sizes["n"]:
        none = Index(np.empty(0, dtype=np.int64), np.empty(0), [])
        level = float(bool(sizes["toxic"]))
        return Model(none, spark.sparkContext.broadcast(none), k, threshold, [level] * BINS, level)
    terms = examples.select(F.explode("terms").alias("term")).distinct()
    if max_terms is not None or least_chi is not None:
        terms = _associated(examples, float(sizes["n"]), float(sizes["toxic"]), max_terms, least_chi)
    vocabulary = np.sort(terms.toArrow().column(0).to_numpy())  # hashes; max_postings at most

    known = spark.sparkContext.broadcast(vocabulary)
    found = texts.select("text").mapInArrow(_frequencies(known), "term bigint, n bigint")
    found = found.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, frequency = found.column(0), found.column(1).to_numpy()
    documents = int(frequency[term.is_null().to_numpy()].sum())
    counted = np.zeros(len(vocabulary), dtype=np.int64)
    counted[np.searchsorted(vocabulary, term.drop_null().to_numpy())] = frequency[term.is_valid().to_numpy()]
    del found, term, frequency
    shards = examples.select("id", "toxic", "terms", "counts", "row", F.floor(F.col("row") / SHARD).alias("shard"))
    shards = shards.groupBy("shard").applyInArrow(_packed(known), ", ".join(f"{n} binary" for n in PACKED))
    shards = stored(shards, "shards").toArrow().to_pylist()  # packed bytes only
    index = Index(vocabulary, np.log((1 + documents) / (1 + counted)) + 1, shards)
    return _calibrated(examples, index, k, threshold)


def _numbered(examples: DataFrame, max_postings: int) -> DataFrame:
    """The examples of smallest hash with ``max_postings`` terms in all, numbered with like ones together."""
    rows = stored(examples.dropDuplicates(["id", "signature"]), "distinct-examples")
    sizes = rows.select("id", "signature", "leading", F.size("terms").alias("n"))
    # Windows over the numbers of max_examples ids.
    so_far = Window.orderBy(F.xxhash64("id"), "id", "signature")
    sizes = sizes.withColumn("sum", F.sum("n").over(so_far)).where(F.col("sum") <= max_postings)
    sizes = sizes.withColumn("led", F.count("*").over(Window.partitionBy("leading")))
    place = F.row_number().over(Window.orderBy(F.desc("led"), F.asc_nulls_first("leading"), "n", "id", "signature")) - 1
    sizes = stored(sizes.select("id", "signature", place.alias("row")), "numbers")
    return rows.drop("leading").join(F.broadcast(sizes), ["id", "signature"])


def _associated(examples: DataFrame, n: float, positive: float, max_terms: int | None, least_chi: float | None) -> DataFrame:
    """The terms of highest chi-square among examples of different term vectors."""
    apart = examples.groupBy("signature").agg(F.max("toxic").alias("toxic"), F.first("terms").alias("terms"))
    counts = apart.select("toxic", F.explode("terms").alias("term")).groupBy("term")
    counts = counts.agg(F.sum("toxic").cast("double").alias("a"), F.count("*").cast("double").alias("df"))
    b, c = F.col("df") - F.col("a"), F.lit(positive) - F.col("a")
    d = F.lit(n - positive) - b
    chi = n * F.pow(F.col("a") * d - b * c, F.lit(2)) / (F.col("df") * (n - F.col("df")) * positive * (n - positive))
    chosen = counts.where(f"df >= 3 and df < {n}").select("term", chi.alias("chi")).where(F.col("chi") >= (least_chi or 0.0))
    chosen = chosen if max_terms is None else chosen.orderBy(F.desc("chi"), "term").limit(max_terms)
    return chosen.select("term")


def _calibrated(examples: DataFrame, index: Index, k: int, threshold: float) -> Model:
    """Map votes to probabilities by leaving each example out in turn."""
    sent = examples.sparkSession.sparkContext.broadcast(index)

    def votes(batches):
        index = sent.value
        try:
            for batch in batches:
                vectors = []
                for terms, counts in zip(batch.column(2), batch.column(3)):
                    at, found = _places(index.terms, terms.values.to_numpy())
                    vectors.append((at[found], counts.values.to_numpy()[found]))
                found = [index.vote(*near) for near in index.all_nearest(vectors, k, batch.column(0).to_pylist())]
                bins = [BINS if vote is None else round(vote * (BINS - 1)) for vote in found]
                yield pa.RecordBatch.from_arrays([pa.array(bins, pa.int32()), batch.column(1)], names=["bin", "toxic"])
        finally:
            index.release()

    seen, toxic = np.zeros(BINS + 1), np.zeros(BINS + 1)
    left_out = examples.select("id", "toxic", "terms", "counts").mapInArrow(votes, "bin int, toxic int")
    for r in left_out.groupBy("bin").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).collect():
        seen[r["bin"]], toxic[r["bin"]] = r["n"], r["toxic"]
    centres = np.arange(BINS) / (BINS - 1)
    # Two pseudo-examples hold a bin without data at its own vote share.
    means = (toxic[:BINS] + 2 * centres) / (seen[:BINS] + 2)
    levels = isotonic(list(seen[:BINS] + 2), list(means))
    return Model(index, sent, k, threshold, levels, float((toxic[BINS] + 0.05) / (seen[BINS] + 1)))


def scorer(model: Model):
    """An Arrow function text -> struct of ``RESULT``. Equal vectors are searched once per task."""
    sent, judge = model.sent, replace(model, index=None, sent=None)  # the index goes once to each worker
    result = pa.struct([
        ("score", pa.float64()), ("predicted", pa.int32()),
        ("evidence", pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))),
    ])

    def score(index: Index, known: dict[bytes, tuple], texts: list[str]) -> list[tuple]:
        vectors = places_of(index.terms, texts)
        keys = [blake2b(a.tobytes() + b.tobytes(), digest_size=16).digest() for a, b in vectors]
        if len(known) > 4_000:
            known.clear()
        todo = {key: vector for key, vector in zip(keys, vectors) if key not in known}
        for key, (near, similarity) in zip(todo, index.all_nearest(list(todo.values()), judge.k, [None] * len(todo))):
            p = min(1.0, max(0.0, judge.probability(index.vote(near, similarity))))
            evidence = [
                {"doc_id": int(index.id_at[i]), "similarity": float(s), "toxic": int(index.labels[i])}
                for i, s in zip(near[:5], similarity[:5])
            ]
            known[key] = (p, int(p >= judge.threshold), evidence)
        return [known[key] for key in keys]

    @F.arrow_udf(returnType=T.StructType.fromDDL(RESULT))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index, known = sent.value, {}
        try:
            for texts in batches:
                values = score(index, known, [t or "" for t in texts.to_pylist()])
                yield pa.StructArray.from_arrays(
                    [pa.array([v[i] for v in values], f.type) for i, f in enumerate(result)], fields=list(result)
                )
        finally:
            index.release()

    return run


def scored(docs: DataFrame, model: Model, *, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a struct column ``into``: score, predicted, evidence (the five nearest examples).

    A column of that name is replaced; to keep it, name another.
    """
    return small_batches(docs).withColumn(into, scorer(model)(text_or_empty(text)))


def without_toxic(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The documents the model does not reject, with their own columns."""
    name = fresh(docs, "toxicity")
    kept = scored(docs, model, text=text, into=name).where(F.col(f"{name}.predicted") == 0)
    return kept.drop(name)
