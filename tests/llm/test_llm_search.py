"""Ranked search, target resampling and vector classes against plain Python."""

from __future__ import annotations

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import lexical, quantised, queries, targets

FOLDER = "/root/testdata/sf0.001"
real = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def plain_search(items, docs, k):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    total, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c, n in counted:
            m = 100 - 75 + (75 * n * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text) if t in c
            )
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def frame(spark, rows, schema, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def test_search_equals_scoring_every_document(spark):
    rng = np.random.default_rng(1)
    words = ["Alpha", "beta", "gamma", "é", "Δ9", "x1", "omega", "the"]
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 30)))) for i in range(300)]
    docs += [(1000 + i, "gamma omega, the") for i in range(50)]  # ties
    docs += [(2000, None), (2001, ""), (2002, " -- "), (None, "gamma omega x1"), (2003, "beta-" * 60_000)]
    items = [(1, "gamma GAMMA omega"), (2, "é_Δ9 nowhere"), (3, None), (4, "..."), (5, "nowhere"), (6, "the the beta")]
    found = lexical.search(
        frame(spark, [(*i, "kept out") for i in items] + [(1, "gamma GAMMA omega", "twice")], "item_id long, text string, score string"),
        frame(spark, [(d, t, "x") for d, t in docs], "doc_id long, text string, item string", 7), k=10,
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == plain_search(items, docs, 10)
    small = lexical.search(
        frame(spark, items, "item_id long, text string"), frame(spark, docs, "doc_id long, text string"), k=10, max_postings=2
    )
    assert sorted((tuple(r) for r in small.collect()), key=str) == got  # a block of items at a time


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(items, docs.where("false")).count() == 0
    assert lexical.search(items.where("false"), docs).count() == 0
    assert [tuple(r) for r in lexical.search(items, docs).collect()] == [(1, 1, 1, lexical.weight(1, 1) * (10**9 // 1800))]


def test_heaps_merge_in_rounds(spark):
    rng = np.random.default_rng(2)
    rows = [(i % 3, int(rng.integers(0, 5000)), int(rng.integers(1, 40)), p) for p in range(1500) for i in range(6)]
    best = lexical.merged(spark.createDataFrame(rows, "item long, doc_id long, score long, part int"), 1500, 4)
    want = []
    for item in range(3):
        order = sorted((-s, d) for i, d, s, _ in rows if i == item)[:4]
        want += [(item, d, -s, n + 1) for n, (s, d) in enumerate(order)]
    assert sorted(tuple(r) for r in best.collect()) == sorted(want)


def plain_resampling(docs, target, runs, buckets, share, least_words):
    def features(text):
        words = [t for t in terms(text)]
        return words, [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    raw = Counter(bucket(f) for _, t in docs for f in features(t)[1])
    aim = Counter(bucket(f) for t in target for f in features(t)[1])
    s, t = sum(raw.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets)))) for b in raw}
    out = []
    for doc, text in docs:
        words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(found), weight, score, None, len(words) >= least_words])
    may = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, r in enumerate(may[: share * len(may) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("runs", [1, 3])
def test_resampling_equals_the_definition(spark, runs):
    rng = np.random.default_rng(3)
    words = ["ab", "Cd", "é", "zzz", "q", "longer-word", "x9"]
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 60)))) for i in range(400)]
    docs += [(500, None), (501, ""), (502, "?!"), (None, "ab " * 30), (600, "ab " * 25), (600, "ab " * 25), (601, "q " * 40_000)]
    target = ["zzz é", None, "zzz zzz x9", ""]
    got = targets.resampled(
        frame(spark, [(d, t, 1) for d, t in docs], "doc_id long, text string, rank int", 5),
        frame(spark, [(t, "x") for t in target], "text string, doc_id string"),
        runs=runs, buckets=97, share=10, least_words=20,
    )
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_resampling(docs, target, runs, 97, 10, 20)


def test_checksums_by_length():
    features = [b"", b"a", b"\xc3\xa9", b"abc", b"a", "long" * 99, b"\x00"]
    features = [f if isinstance(f, bytes) else f.encode() for f in features]
    assert targets.checksums(features).tolist() == [zlib.crc32(f) for f in features]
    assert targets.checksums([]).tolist() == []


def test_resampling_of_empty_tables_and_invalid_utf8(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert targets.resampled(docs.where("false"), docs).count() == 0
    row = targets.resampled(docs, docs.where("false"), runs=1).first()
    assert row["n_features"] == 2 and row["rank"] is None
    broken = docs.withColumn("text", F.expr("cast(X'61FF20C3' as string)"))
    assert targets.resampled(broken, docs, runs=1).first()["n_features"] == 2


def plain_classes(rows, least):
    """Id, links, smallest id reachable, of rows (id, label, vector); all pairs compared."""
    def fit(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    near = [set() for _ in range(n)]
    for i, (_, a, v) in enumerate(rows):
        for j in range(i):
            _, b, w = rows[j]
            if a is not None and a == b and fit(v) and fit(w) and len(v) == len(w):
                x, y = np.array(v), np.array(w)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= least:
                    near[i].add(j)
                    near[j].add(i)
    out = []
    for i, (name, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            more = near[todo.pop()] - seen
            seen |= more
            todo += more
        least_id = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((name, len(near[i]), least_id, name is not None and name == least_id))
    return sorted(out, key=str)


@pytest.mark.parametrize("how", [{}, {"list_size": 8, "block": 5, "sample": 200}])
def test_vector_classes_equal_all_pairs(spark, how):
    rng = np.random.default_rng(4)
    rows = []
    for label in (0, 1):
        base = rng.normal(size=(12, 16))
        for b in base:  # loose groups around the limit
            rows += [(label, (b + rng.normal(size=16) * s).tolist()) for s in rng.uniform(0.02, 0.25, 9)]
        rows += [(label, base[0].tolist())] * 40 + [(label, (base[1] * 3).tolist())] * 2
        rows += [(label, rng.normal(size=16).tolist()) for _ in range(60)]
        rows += [(label, (base[2] + 0.02 * rng.normal(size=16)).tolist()) for _ in range(60)]  # one hot, near group
    rows += [(None, rows[0][1]), (0, None), (0, []), (0, [0.0] * 16), (0, [float("nan")] * 16), (0, [None, 1.0]),
             (0, [1.0, 0.0]), (0, [2.0, -0.0]), (1, [float("inf"), 1.0]), (1, [1e300, 1e300]), (1, [1e-300, 1e-300])]
    rows = [(i, label, v) for i, (label, v) in enumerate(rows)]
    rows += [(None, 0, rows[0][2]), (3, 0, rows[3][2]), (None, None, None)]
    df = frame(spark, [(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, n_links string", 5)
    got = quantised.classes(df, **how)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    scaled = [(i, a, v if v is None or len(v) != 2 or None in v or not all(map(math.isfinite, v)) or not any(v) else
               [x / max(map(abs, v)) for x in v]) for i, a, v in rows]  # for squares of 1e300
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_classes(scaled, 0.98)


def test_probes_reach_every_list_with_a_neighbour():
    rng = np.random.default_rng(5)
    x = quantised.units(rng.normal(size=(2000, 8)))
    x = np.concatenate((x, quantised.units(x + 0.05 * rng.normal(size=x.shape))))
    q = quantised.Quantiser.fitted(x, 40, 4, 1)
    own = quantised.nearest(x, q.coarse)
    visits = [set(p.tolist()) for p in q.probes(x, own, 0.2)]
    near = np.argwhere(np.triu(x @ x.T >= 0.98, 1))
    crossing = [(a, b) if own[a] < own[b] else (b, a) for a, b in near if own[a] != own[b]]
    assert len(crossing) > 100 and all(own[b] in visits[a] for a, b in crossing)
    assert np.mean([len(v) for v in visits]) < 20  # and not all lists


def test_code_distances_bound_the_true_ones():
    rng = np.random.default_rng(6)
    x = quantised.units(rng.normal(size=(500, 12)))
    q = quantised.Quantiser.fitted(x, 5, 4, 1)
    own = quantised.nearest(x, q.coarse)
    for no in range(5):
        codes, missed = q.coded(x[own == no], own[own == no])
        true = np.sqrt(quantised.squares(x, x[own == no]))
        assert (np.abs(q.lookup(x, no, codes) - true) <= missed + 1e-6).all()


def test_vector_classes_of_an_empty_table_and_floats(spark):
    df = spark.createDataFrame([(1, 0, [1.0, 0.0]), (2, 0, [1.0, 0.01])], "vec_id long, label int, embedding array<float>")
    assert quantised.classes(df.where("false")).count() == 0
    assert sorted(tuple(r) for r in quantised.classes(df).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]


@real
def test_queries_use_production_parameters(spark):
    for name in ("op11_lexical", "op12_target_importance", "op13_vector_classes"):
        assert queries.QUERIES[name](spark, FOLDER).limit(1).count() == 1
        assert name in queries.ORACLES
