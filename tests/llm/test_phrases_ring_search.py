"""Operators 11 to 13 against brute force, with the cases that their docstrings name."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import bitmaps, phrases, ranked_search, ring_sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def made(seed, n, words="the of a red green blue old new house tree river stone Über ärger naïve x9 10 20".split()):
    rng = random.Random(seed)
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    out = [(i, made(i % 40, 5 + i * 7 % 90), ["en", "de", None][i % 3], "s", 1) for i in range(150)]
    out += [(200, "", "en", None, None), (201, None, "en", "s", 0), (202, "THE OF A " * 4000, "en", "s", 9), (None, "the of a red", "en", "s", 3), (None, None, None, None, None)]
    out += [(203, "of the of the", "de", "s", 1)] * 3 + [(203, "another text", "de", "s", 1), (204, "\x01 a\x1cb \x00 the of  ", "en", "s", 1)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).withColumn("phrase", F.lit("clash")).withColumn("shingles", F.lit(1)).withColumn("rank", F.lit(1)).repartition(5)


# ---- operator 11


def best_phrases(rows, least, top):
    counts, totals, out = {}, Counter(), []
    for _, text, lang, *_ in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(ws)
            for d in range(1, 5):
                counts.setdefault(lang, Counter()).update(tuple(ws[i : i + d]) for i in range(len(ws) - d + 1))
    for lang, f in counts.items():
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        hidden = {s for p, a in some.items() for d in range(2, len(p)) for i in range(len(p) - d + 1) if 100 * a >= 80 * f[s := p[i : i + d]]}
        found = []
        for p, a in some.items():
            if p not in hidden:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.mark.parametrize("shard", [phrases.SHARD, 500])
@pytest.mark.parametrize("least,top", [(30, 2000), (5, 40)])
def test_phrases_are_the_brute_force_ones(spark, docs, rows, monkeypatch, shard, least, top):
    monkeypatch.setattr(phrases, "SHARD", shard)
    got = sorted(tuple(r)[:8] for r in phrases.phrases(docs, least, top).collect())
    assert got == best_phrases(rows, least, top)
    assert least == 30 or {r[0] for r in got} == {"en", "de", "und"}


def test_full_bitmaps_change_nothing(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(phrases, "bitmap", lambda df, hashed: np.full(bitmaps.BITS // 8, 255, np.uint8))
    assert sorted(tuple(r)[:8] for r in phrases.phrases(docs, 10, 50).collect()) == best_phrases(rows, 10, 50)


def test_no_phrases(spark):
    assert phrases.phrases(spark.createDataFrame([], DOCS)).collect() == []
    assert phrases.phrases(spark.createDataFrame([(1, "one two three", "en", "s", 1)], DOCS)).collect() == []


# ---- operator 12


def test_shards_hold_equal_counts(spark, docs, rows):
    found = ring_sharding.sharded(docs, 7)
    assert set(found.columns) == {*docs.columns, "shard", "slot"}
    got = found.collect()
    assert Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in got) == Counter(rows)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(7):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))


def plain_ring(rows, shards):
    """One row after the other: homes first, then what is over, clockwise."""
    places = ring_sharding.ring(shards)
    key = lambda i, t: str(i) if i is not None else "content " + ring_sharding.hashlib.md5((t or "").encode()).hexdigest()
    held = []
    for i, t, *_ in rows:
        pos = ring_sharding.position(key(i, t))
        arc = next((k for k, (p, _) in enumerate(places) if p >= pos), 0)
        held.append((arc, ring_sharding.position(t or ""), pos, i, t))
    homes = [sum(places[h[0]][1] == s for h in held) for s in range(shards)]
    most, filled, out, over = ring_sharding.shares(homes), [0] * shards, [], []
    for row in sorted(held, key=lambda h: h[:3]):
        s = places[row[0]][1]
        if filled[s] < most[s]:
            out.append((row[3], row[4], s, filled[s]))
            filled[s] += 1
        else:
            over.append(row)
    for row in over:
        k = row[0]
        while filled[places[k][1]] >= most[places[k][1]]:
            k = (k + 1) % len(places)
        s = places[k][1]
        out.append((row[3], row[4], s, filled[s]))
        filled[s] += 1
    return out


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_shards_are_the_plain_rings(spark, docs, rows, shards):
    assert Counter((r.doc_id, r.text, r.shard, r.slot) for r in ring_sharding.sharded(docs, shards).collect()) == Counter(plain_ring(rows, shards))


def test_a_hot_id_and_a_hot_row(spark):
    rows = [(5, "same")] * 400 + [(5, f"other {i}") for i in range(400)] + [(i, "same") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = ring_sharding.sharded(df, 24).collect()
    assert Counter((r.doc_id, r.text, r.shard, r.slot) for r in got) == Counter(plain_ring(rows, 24))
    assert {n // 45 for n in Counter(r.shard for r in got).values()} == {1}


def test_a_new_shard_moves_little(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    before, after = ({r.doc_id: r.shard for r in ring_sharding.sharded(df, n).collect()} for n in (24, 25))
    assert sum(before[i] != after[i] for i in before) / len(before) < 0.16  # 0.04 must move
    homes = ring_sharding.ring(24)
    at = sorted(p for p, _ in homes)
    own = sum(dict(homes)[at[np.searchsorted(at, p) % len(at)]] == before[i] for i in before for p in [ring_sharding.position(str(i))])
    assert own / len(before) > 0.93


def test_shards_of_nothing_and_written_ones(spark, docs, rows, tmp_path):
    assert ring_sharding.sharded(docs.limit(0)).collect() == []
    ring_sharding.write_shards(docs, str(tmp_path / "shards"), 3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(r[:2] for r in rows)
    assert {r["count"] // (len(rows) // 3) for r in back.groupBy("shard").count().collect()} == {1}


def test_digest_columns(spark, rows, tmp_path):
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = ring_sharding.op12_bounded_ring(spark, str(tmp_path)).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


# ---- operator 13


def scored(rows, items, top):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
    held = [(i, Counter(found), len(found)) for i, t, *_ in rows if (found := terms(t))]
    n, length = len(held), sum(h[2] for h in held)
    df = Counter(t for h in held for t in h[1])
    out = []
    for item, text in items:
        asked, got = Counter(terms(text)), []
        for i, tf, size in held:
            m = 75 + 25 * size * n // length
            got.append((sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m)) for t, q in asked.items() if t in tf), i))
        got = sorted(((s, i) for s, i in got if s > 0), key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:top]
        out += [(item, k + 1, i, s) for k, (s, i) in enumerate(got)]
    return out


ITEMS = [(1, "Red house; RED house, red tree"), (2, "x9 ärger"), (3, None), (4, "..."), (5, "nothing of that kind"), (5, "stone"), (None, "blue river 10"), (6, "the of a")]


@pytest.mark.parametrize("shard", [ranked_search.SHARD, 300])
@pytest.mark.parametrize("open_,held", [(ranked_search.OPEN, ranked_search.HELD), (3, 4)])
def test_search_is_the_brute_force_one(spark, docs, rows, monkeypatch, shard, open_, held):
    for name, value in (("SHARD", shard), ("OPEN", open_), ("HELD", held)):
        monkeypatch.setattr(ranked_search, name, value)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("score", F.lit("clash"))
    got = [tuple(r) for r in ranked_search.search(docs, items).collect()]
    order = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(got, key=order) == sorted(scored(rows, ITEMS, 20), key=order)


@pytest.mark.parametrize("most", [4, 1000])
def test_treaps(most):
    rng = np.random.default_rng(most)
    for _ in range(60):
        docs, terms = int(rng.integers(1, 90)), int(rng.integers(1, 8))
        at = [(t, d) for t in range(terms) for d in range(docs) if d == t % docs or rng.random() < 0.5]
        term, doc = np.array(at).T
        impact = rng.integers(1, most, len(at))
        treaps = ranked_search.Treaps(term, doc, impact, terms)
        for k in range(len(at)):
            for child, side in ((treaps.left[k], -1), (treaps.right[k], 1)):
                assert child < 0 or treaps.impact[child] <= treaps.impact[k] and (treaps.doc[child] > treaps.doc[k]) == (side > 0)
        weights = rng.integers(1, 6, terms)
        sums = np.bincount(doc, impact * weights[term], docs).astype(int)
        for top in (1, 3, 20):
            ids, scores = treaps.best(np.arange(terms), weights, docs, top)
            assert list(zip(-scores, ids, strict=True)) == sorted((-sums[d], d) for d in range(docs) if sums[d])[:top]


def test_search_prunes_and_survives_copies():
    """A third of the documents are copies: their treaps stay shallow, and few documents are scored."""
    rng = np.random.default_rng(5)
    docs, terms = 30_000, 8
    at = [(t, d) for t in range(terms) for d in range(docs) if d % 3 == 0 or rng.random() < 0.2]
    term, doc = np.array(at).T
    impact = np.where(doc % 3 == 0, 500, rng.integers(1, 1000, len(at)))
    treaps = ranked_search.Treaps(term, doc, impact, terms)
    opened, within = [], treaps.within
    treaps.within = lambda nodes, low, high: opened.append(len(nodes)) or within(nodes, low, high)
    ids, scores = treaps.best(np.arange(terms), np.ones(terms, np.int64), docs, 20)
    sums = np.bincount(doc, impact, docs).astype(int)
    assert list(zip(-scores, ids, strict=True)) == sorted((-sums[d], d) for d in range(docs))[:20]
    assert sum(opened) / 3 < docs * 0.4  # 47 % of the documents hold a term twice or more


def test_search_of_nothing(spark):
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b", "en", "s", 1)], DOCS)
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search.search(none, items).collect() == []
    assert ranked_search.search(some, items.limit(0)).collect() == []
    assert [tuple(r)[:3] for r in ranked_search.search(some, items).collect()] == [(1, 1, 1)]
