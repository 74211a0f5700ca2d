"""Rows with repeated or null ids in near-dedup, search and decontamination."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import collision_search

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def test_near_copies_are_dropped_by_row(spark):
    a, b, c, d = map(prose, range(4))
    rows = [(1, a), (5, a + " more"), (5, b), (7, c), (7, c), (7, c), (None, c), (None, d), (None, d), (8, None), (None, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, lang string")
    got = corpus_pipeline.near_copies_out(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, [(1, a), (5, b), (7, c), (None, d), (8, None), (None, None), (9, "")]))


def test_repeated_vectors_count_once(spark):
    x = np.random.default_rng(3).standard_normal((3000, 16))
    rows = [(i, [float(v) for v in x[i]]) for i in range(len(x)) for _ in range(60 if i == 7 else 3)]
    rows += [(9000, [float(v) for v in x[0] * 3])] * 60
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got: dict = {}
    for r in collision_search.search(df, F.col("vec_id") % 300 == 0).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    y, ids = np.concatenate([x, x[:1] * 3]), np.append(np.arange(3000), 9000)
    hits = 0
    for q, found in got.items():
        order = np.argsort(-(y * y[ids == q]).sum(1))
        assert len(set(found)) == len(found) == 20
        hits += len(set(found) & set([i for i in ids[order].tolist() if i != q][:20]))
    assert sorted(got) == [*range(0, 3000, 300), 9000] and hits >= 0.9 * 20 * len(got)


def test_windows_of_a_part_of_the_queries(monkeypatch):
    """Queries in several parts find what they find at once, and the recall on the contract's queries is stated."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((6000, 24))
    block = collision_search.Block(np.arange(6000), x)
    ids = list(range(0, 6000, 20))
    found = {}
    for n in (1 << 11, 7):
        monkeypatch.setattr(collision_search, "AT_ONCE", n)
        found[n] = [i.tolist() for i, _, _ in block.nearest(ids, x[ids], 20)]
    hits = {n: 0 for n in found}
    for k, q in enumerate(ids):
        scores = x @ x[q]
        scores[q] = -np.inf
        best = {*np.argsort(-scores, kind="stable")[:20].tolist()}
        for n in found:
            hits[n] += len(best & {*found[n][k]})
    assert min(hits.values()) >= 0.9 * 20 * len(ids)
