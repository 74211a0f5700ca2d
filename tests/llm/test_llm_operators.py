"""Small tests of the training-data operators: brute force, round trips, and the cases named in their docstrings."""

import base64
import hashlib
import random
import sys
import zlib

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from corpusloom.llm import collision_search, decontaminate, html_text, near_dedup, packing, pretokens, shingles, suffix_dedup, token_counts, toxicity, url_filter, warc
from corpusloom.llm.components import components
from corpusloom.llm.induced import common_prefixes, suffix_array

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def docs_of(spark, rows):
    """Rows of documents with a null in every column, empty texts, repeated rows and a column whose name clashes."""
    more = [(900, "", "en", "s", 0), (901, None, None, None, None), (None, "no id here", "en", "s", 3), (902, "one", "en", "s", 3), (902, "one", "en", "s", 3)]
    return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows] + more, DOCS).withColumn("component_id", F.lit("clash")).withColumn("_spans_", F.lit(1))


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


# ---- operator 1


def test_toxicity_held_out(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = [rng.choice(WORDS) + str(rng.randrange(9)) for _ in range(60)]
        if bad:
            for k in rng.sample(range(60), 5):
                words[k] = rng.choice(["vileword", "nastything", "cruelsay"])
        rows.append((i, " ".join(words)))
        if i < 400:
            labels.append((i, i % 3 % 2, int(bad)))
    docs = docs_of(spark, rows)
    model = toxicity.fitted(docs, spark.createDataFrame([*labels, (None, 1, 1), (5000, None, 1), (7, 1, None)], "doc_id long, quality int, toxic int"))
    got = toxicity.severity(docs, model).collect()
    assert len(got) == 605
    held = [r for r in got if r.doc_id is not None and 400 <= r.doc_id < 600]
    assert sum(r.toxic == (r.doc_id % 4 == 0) for r in held) >= 196
    assert all(0 <= r.p_toxic <= r.expected_severity <= 2 for r in got)
    kept = toxicity.not_toxic(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.toxic for r in got)


def test_toxicity_without_labels(spark):
    model = toxicity.fitted(docs_of(spark, [(1, "a b")]), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert toxicity.not_toxic(docs_of(spark, [(1, "a b")]), model).count() == 6
    assert toxicity.severity(empty(spark), model).count() == 0


def test_thresholds_rise_and_share_weights():
    y = np.array([0, 0, 1, 1, 2, 2] * 20)
    model = toxicity.fit(np.arange(120), np.zeros(120, np.int64), y.astype(float), y, [b"f"])
    assert model.thresholds[0] < model.thresholds[1] and model.weights[b"f"] > 0


def test_likelihood_and_its_gradient():
    rng = np.random.default_rng(9)
    rows, cols, values, y = np.repeat(np.arange(30), 4), rng.integers(0, 7, 120), rng.random(120), rng.integers(0, 3, 30)
    loss = toxicity.Likelihood(rows, cols, values, y, 7, 3, 1e-2, rng.random(30) + 0.5)
    x = rng.standard_normal(9)
    value, grad = loss(x)
    for k in range(9):
        step = np.zeros(9)
        step[k] = 1e-6
        assert abs((loss(x + step)[0] - loss(x - step)[0]) / 2e-6 - grad[k]) < 1e-6
    low, high = loss.thresholds(x)
    dense = np.zeros((30, 7))
    np.add.at(dense, (rows, cols), values)
    over = [1 / (1 + np.exp(-(dense @ x[:7] - t))) for t in (low, high)]
    mass = np.stack([1 - over[0], over[0] - over[1], over[1]])[y, np.arange(30)]
    assert abs(value - (-(loss.each * np.log(mass)).mean() + 5e-3 * (x[:7] @ x[:7]))) < 1e-9


def test_a_score_is_the_sum_of_its_features(spark):
    model = toxicity.Model({b"vileword": 2.0, b"4vile": 0.5, b"5words": 1.0, b"6rd\xc3\xa9xyz": 3.0}, [1.0, 2.5], 0.5)
    texts = [(1, "Vileword plain, vile-vile!"), (2, None), (3, "rd\u00e9xyz " * 100_000), (4, "12 34"), (5, "vilevile")]
    got = {r.doc_id: r for r in toxicity.severity(spark.createDataFrame(texts, "doc_id long, text string").withColumn("grade", F.lit(9)), model).collect()}
    scores = {1: 100 * (2.5 + 0.5 + 0.5) / 4, 2: 0.0, 3: 300.0, 4: 0.0, 5: 50.0}
    for i, score in scores.items():
        p = [1 / (1 + np.exp(-(score - t))) for t in model.thresholds]
        assert abs(got[i].p_toxic - p[0]) < 1e-12 and abs(got[i].expected_severity - sum(p)) < 1e-12 and got[i].grade == sum(x >= 0.5 for x in p)
        assert abs(model.word_weight(b"vilevile") - 0.5) < 1e-12


def test_repeated_rows_of_a_labelled_document_are_one(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a")] * 500 + [(2, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, toxicity.labelled_sample(docs, labels).collect())) == [(1, "a", 2), (2, "c", 0)]


# ---- operator 2 and 6


@pytest.fixture(scope="module")
def tokenizers():
    from tokenizers import Tokenizer

    return {n: Tokenizer.from_file(pretokens.vocabulary_path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}


def test_counts_and_ids_are_the_librarys(tokenizers):
    rng = random.Random(2)
    parts = [*pretokens.plain_characters(), *" \n\tabc'st" * 30, "<|endoftext|>", "<|startoftext|>", "日本", "é", "İ", " ", "😀", "the", " don't", "12"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(4000)] + ["", "a" * 100_000, " " * 5000 + "x"]
    count = token_counts.Counter(pretokens.vocabulary_path("word_bpe_49k.json"), token_counts.whole_tokens(tokenizers["word_bpe_49k.json"]))
    assert count(texts) == [len(tokenizers["word_bpe_49k.json"].encode(t, add_special_tokens=False).ids) for t in texts]
    ids = packing.Ids(pretokens.vocabulary_path("byte_bpe_50k.json"))
    for t in texts:
        assert ids(t) == np.array(tokenizers["byte_bpe_50k.json"].encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_token_counts(spark):
    got = token_counts.token_counts(docs_of(spark, [(1, "hello world"), (2, "é" * 5000)])).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 7 and by[1].n_tokens == 2 and by[1].n_bytes == 11 and by[2].n_bytes == 10_000 and by[2].over_limit and by[901].n_tokens == 0
    assert token_counts.token_counts(empty(spark)).count() == 0


def packed_ok(rows, tokenizer, texts):
    full = {i: np.append(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4"), np.uint32(1)).astype("<u4") for i, t in texts.items()}
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if r.doc_id in full:
            part = full[r.doc_id][r.start : r.start + r.length]
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(full[r.doc_id])
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    return by


def test_packing(spark, tokenizers):
    texts = {i: prose(i, [3, 30, 300, 1500][i % 4]) for i in range(40)}
    rows = packing.packed(docs_of(spark, list(texts.items()))).collect()
    by = packed_ok(rows, tokenizers["byte_bpe_50k.json"], texts)
    assert sorted(by) == list(range(len(by)))
    assert sum(r.length for r in rows if r.doc_id == 902) == 4 and sum(r.length for r in rows if r.doc_id == 901) == 1
    assert sum(packing.LENGTH - sum(n for _, n in parts) for parts in by.values()) < packing.LENGTH * 2  # little padding: but for the last ones, sequences are full
    assert packing.packed(empty(spark)).count() == 0


def test_patterns_hold_the_histogram():
    rng = random.Random(3)
    for _ in range(30):
        histogram = {rng.randrange(1, 2049): rng.randrange(1, 500) for _ in range(rng.randrange(1, 60))}
        patterns = packing.packed_patterns(histogram)
        held: dict = {}
        for packs, pattern in patterns:
            assert sum(s * c for s, c in pattern) <= 2048
            for s, c in pattern:
                held[s] = held.get(s, 0) + packs * c
        assert held == histogram


# ---- operator 3


def brute_components(texts, least=(75, 100)):
    seen = shingles.WordHashes()
    sets = {i: set(shingles.shingle_set(t, seen).tolist()) for i, t in texts.items() if i is not None}
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def test_near_duplicates_are_the_brute_force_ones(spark):
    rng = random.Random(4)
    texts = {}
    for g in range(12):
        base = prose(100 + g, 120).split()
        for k in range(6):
            words = base[:]
            for _ in range(rng.randrange(0, 7)):
                words[rng.randrange(120)] = f"edit{rng.randrange(999)}"
            texts[g * 10 + k] = " ".join(words).upper() if k == 2 else "\n".join(words)
    texts |= {500: "a b", 501: "A  b", 502: "a c", 503: "a b a b a b a b", 504: "x" * 200_000}
    truth, sizes = brute_components(texts | {900: "", 901: None, 902: "one"})
    got = near_dedup.near_duplicates(docs_of(spark, list(texts.items()))).collect()
    assert len(got) == len(texts) + 5
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles, r.kept) == (truth[r.doc_id], sizes[r.doc_id], truth[r.doc_id] == r.doc_id), r
    assert near_dedup.near_duplicates(empty(spark)).count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1040)] + [(1, None), (7, 7)]
    comp: dict = {}

    def find(x):
        while comp.setdefault(x, x) != x:
            x = comp[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = find(a), find(b)
            comp[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in comp}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- operator 4


def test_warc_round_trip(spark, tmp_path):
    pages = [(i, f"http://h{i}.org/é x", prose(i % 50, 300)) for i in range(120)] + [(200, None, None), (201, "u", ""), (None, "u", prose(3, 300)), (5, "again", prose(5, 300))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    archives = warc.write_archives(df, str(tmp_path))
    assert archives.agg(F.sum("records")).first()[0] == len(pages)
    got = warc.read_archives(archives).collect()
    assert len(got) == len(pages)
    last: dict = {}
    for i, _, h in pages:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", -1))
    for r in got:
        html = next((h or "" for i, _, h in pages if i == r.page_id), None)
        assert r.payload_bytes == len(html.encode()) and r.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        if r.page_id is not None and r.page_id != last[html]:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", last[html], None)
        else:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, html.encode())
    assert warc.read_archives(warc.write_archives(df.limit(0), str(tmp_path))).count() == 0


def test_corrupt_archives_are_refused():
    records = [warc.record(i, "u", prose(i, 400).encode(), None) for i in range(80)]
    data = warc.archive(records)
    assert data[:4] == b"\x5d\x2a\x4d\x18" and list(warc.frames(data)) == records
    assert list(warc.frames(warc.archive(records[:1]))) == records[:1]
    for bad in (data[:-3], data + b"xx", data[: len(data) // 2] + bytes([data[len(data) // 2] ^ 255]) + data[len(data) // 2 + 1 :]):
        with pytest.raises(warc.CorruptArchive):
            [warc.read_record(c) for c in warc.frames(bad)]
    good = records[0]
    for bad in (good[:-1], good.replace(b"WARC/1.1", b"WARX/1.1"), good.replace(b"WARC-Date", b"WARC-Dxte"), good.replace(b"alpha", b"alphx"), good.replace(b"Content-Length: ", b"Content-Length: 9")):
        with pytest.raises(warc.CorruptArchive):
            warc.read_record(bad)


# ---- operator 5


def test_url_filter(spark):
    link = '<LINK rel="canonical" href="%s">'
    rows = [(1, "http://a.net/x", link % "http://b.org/de/y"), (2, "http://b.org/de/y", ""), (3, "https://C.org/z?q#f", '<meta http-equiv=refresh content="0; url=/w">'), (4, "http://c.org/w", link % "//example.com/de/1"), (5, None, None), (6, "none", ""), (7, "http://d.org/a", link % "http://e.org/fr/1"), (8, "http://d.org/a", link % "http://q.net/1"), (9, "http://x.EXAMPLE.net/en/1", link % "http://q.net/1"), (None, "http://net", "")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filtered(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("rule", F.lit(1)), url_filter.rules_frame(spark)).collect()}
    assert got == {1: ("a.net", "/x", "net/", "block"), 2: ("b.org", "/de/y", None, "block"), 3: ("c.org", "/z", None, "block"), 4: ("c.org", "/w", None, "block"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("d.org", "/a", None, "allow"), 8: ("d.org", "/a", None, "allow"), 9: ("x.example.net", "/en/1", "example.net/en/", "allow"), None: ("net", "", None, "allow")}


def test_url_filter_is_its_sql_on_linked_rows(spark):
    import duckdb

    link = '<link rel="canonical" href="%s">'
    rows = [(1, "http://a.com/x", link % "http://b.net/y"), (2, "http://c.com/z", link % "http://a.com/x"), (3, "http://d.org/w", '<meta http-equiv="refresh" content="0; url=http://example.net/en/1">'), (4, "http://e.com/", link % "http://d.org/w"), (5, None, None), (6, "none", link % "http://b.net/y"), (7, "http://lone.com/a#x", ""), (8, "http://q.net/1", link % "http://example.net/en/1")]
    got = url_filter.filtered(spark.createDataFrame(rows, "page_id long, url string, html string"), url_filter.rules_frame(spark)).select("page_id", "host", "path", "rule", "verdict").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({url_filter.ORACLE})").fetchall()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {r.page_id: r.verdict for r in got} == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block"}
    nothing = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.filtered(nothing, url_filter.rules_frame(spark)).count() == 0


# ---- operator 7


def test_suffix_arrays():
    rng = np.random.default_rng(6)
    for k in range(150):
        a = rng.integers(0, rng.integers(1, 5) + 1, rng.integers(1, 120)).astype(np.uint8)
        a = np.tile(a, 3) if k % 3 == 0 else a
        b = a.tobytes()
        sa = suffix_array(a)
        assert sa.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
        lcp = common_prefixes(a, sa)
        for i in range(1, len(sa)):
            x, y = b[sa[i - 1] :], b[sa[i] :]
            assert lcp[i] == next((n for n, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def test_suffix_arrays_take_few_python_steps():
    """Names that repeat are sorted on arrays as well: a step of Python for each would be most of an operator's time."""
    data = np.frombuffer(prose(8, 8000).encode(), np.uint8)
    steps = 0

    def count(frame, event, arg):
        nonlocal steps
        steps += 1
        return count

    before = sys.gettrace()
    sys.settrace(count)
    try:
        sa = suffix_array(data)
    finally:
        sys.settrace(before)
    assert sorted(sa.tolist()) == list(range(len(data))) and steps < len(data) // 2


def brute_repeats(rows):
    seen: dict = {}
    for n, (_, t) in enumerate(rows):
        b = (t or "").encode()
        for s in range(len(b) - 199):
            seen.setdefault(b[s : s + 200], []).append((n, s))
    cover = [np.zeros(len((t or "").encode()) + 1, int) for _, t in rows]
    for places in seen.values():
        if len(places) > 1:
            for n, s in places:
                cover[n][s : s + 200] = 1
    return cover


@pytest.mark.parametrize("most", [1024, 2])
def test_repeats_are_the_brute_force_ones(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "GROUP_MOST", most)
    shared = prose(1, 60)
    rows = [(i, f"{prose(50 + i, 40)} {shared[i : 260 + i * 3]} é{prose(90 + i, 30)}") for i in range(30)]
    rows += [(100, "ab" * 700), (101, "q" * 900), (102, (prose(3, 30) + "\n") * 3), (103, shared), (103, shared), (104, prose(9, 80)), (None, prose(9, 80)), (105, "é" * 150 + "x"), (106, "y" + "é" * 150)]
    given = spark.createDataFrame([(i, t, None, None, None) for i, t in rows] + [(901, None, None, None, None)], DOCS).withColumn("s", F.lit(1)).withColumn("did", F.lit(2)).withColumn("_spans", F.lit(3)).withColumn("rk", F.lit(4))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.without_repeats(given).collect())
    want = []
    for (i, t), c in zip([*rows, (901, None)], brute_repeats([*rows, (901, None)])):
        b, c = (t or "").encode(), c[:-1]
        left = bytes(np.frombuffer(b, np.uint8)[c == 0])
        want.append((str(i), len(b), int(c.sum()), int((np.diff(np.append(0, c)) == 1).sum()), hashlib.sha256(left).hexdigest()))
    assert got == sorted(want)
    cut = suffix_dedup.cleaned(given)
    assert cut.columns == given.columns and cut.count() == len(rows) + 1
    assert suffix_dedup.without_repeats(given.limit(0)).count() == 0


def test_bytes_at_the_borders_of_contexts(spark):
    q = "a" * 100 + "\0" + "b" * 99
    parts = ["x" * 60 + q + "b1", "m" * 150 + "a" * 100, "b" * 99 + "b2" * 60, "y" * 60 + q + "b3"]
    rows = list(enumerate(parts))
    got = {r.doc_id: r.n_removed for r in suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: int(c[:-1].sum()) for (i, _), c in zip(rows, brute_repeats(rows))} and got[0] == 201
    owner, start, end = suffix_dedup.repeated([p.encode() for p in parts], np.zeros(4, bool), np.arange(4), np.zeros(4, np.int64))
    assert list(zip(owner.tolist(), start.tolist(), end.tolist())) == [(0, 60, 261), (3, 60, 261)]


def test_many_rows_without_an_id(spark):
    shared = prose(1, 60)
    rows = [(None, f"{prose(1000 + k, 12)} {shared if k % 50 == 0 else ''} {prose(5000 + k, 12)}") for k in range(10_000)] + [(7, prose(2, 60))] * 2000
    got = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("doc_id", (F.col("n_removed") > 300).alias("cut")).count().collect()
    assert {(r.doc_id, r.cut): r["count"] for r in got} == {(None, True): 200, (None, False): 9800, (7, True): 2000}


# ---- operator 8


def test_search_recall_and_cases(spark):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((6000, 32)) * rng.uniform(0.5, 2, (6000, 1))
    x[100:140] = x[100]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(7000, None), (7001, [0.0] * 32), (7002, [float("nan")] * 32), (7003, [None] * 32), (7004, [1.0] * 3), (None, [1.0] * 32), (11, [float(v) for v in x[11]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(0))
    got: dict = {}
    for r in collision_search.search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert sorted(got) == list(range(0, 6000, 20))
    hits = 0
    for q, found in got.items():
        scores = (x * x[q]).sum(1)
        order = [i for i in np.lexsort((np.arange(6000), -scores)) if i != q][:20]
        hits += len({i for i, _ in found} & set(order))
        assert all(abs(s - scores[i]) < 1e-12 for i, s in found) and len(found) == 20
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
    assert hits >= 0.9 * 20 * len(got)
    assert collision_search.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = collision_search.search(df.where("vec_id < 5"), F.col("vec_id") == 0)
    assert few.count() == 4


def test_search_of_a_hundred_thousand_vectors():
    """Recall and share verified of queries divisible by 50, on vectors without any clusters: the hardest to tell apart."""
    rng = np.random.default_rng(10)
    x = rng.standard_normal((100_000, 64))
    x /= np.sqrt((x * x).sum(1))[:, None]
    ids = np.arange(len(x))
    queries = ids[ids % 50 == 0][:: len(x) // 2000]
    found = {int(q): [] for q in queries}
    verified = 0
    for part in np.array_split(rng.permutation(ids), -(-len(x) // collision_search.BLOCK)):
        for q, (near, scores, n) in zip(queries.tolist(), collision_search.Block(ids[part], x[part]).nearest(queries.tolist(), x[queries], 20)):
            found[q] += zip((-scores).tolist(), near.tolist())
            verified += n
    hits = sum(len({i for _, i in sorted(v)[:20]} & {i for i in np.argsort(-(x @ x[q]))[:21].tolist() if i != q}) for q, v in found.items())
    assert hits / 20 / len(found) >= 0.95 and verified / len(x) / len(found) < 0.12


# ---- operator 9


def test_main_text(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1><nav><ul><li><a href=x>Home</a></ul></nav></header>
    <div class="cookie-notice">We use cookies and many more words than you like</div><div id=main><div class="post"><h2>Title &amp; more</h2><p>First para\n with&nbsp;words in it.<p>Second one has many words<br>line two.
    <div class="ad">Buy now</div><script>var t="</p>";</script><ul><li>point one is long enough<li>point two as well</ul><p>Third closes it with more words.</div><div class="comments"><p>I think this is great said a reader</p></div></div><aside>side</aside><form><p>Name</form><footer>c 2020</footer>"""
    want = "Title & more\n\nFirst para with words in it.\n\nSecond one has many words line two.\n\npoint one is long enough\n\npoint two as well\n\nThird closes it with more words."
    pages = spark.createDataFrame([(1, "u", page), (2, None, None), (None, "v", ""), (3, "w", "1 < 2 and <b>bold"), (4, "x", "<p>a<script>x<"), (5, "y", "<!-- " * 3000 + "<p>end</p>")], "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {r.page_id: r for r in html_text.page_texts(pages, html_text.fitted_weights(pages)).collect()}
    assert got[1].text == want and got[1].n_chars == len(want)
    assert (got[2].text, got[None].text, got[3].text, got[4].text) == ("", "", "1 < 2 and bold", "a")


PLAIN = {
    "unmarked edges": ("""<body><div><a href=1>Home</a> <a href=2>About us</a> <a href=3>Contact</a></div><div><h1>A title</h1><p>One paragraph of plain words, long enough to count.<p>Another one <a href=x>with a link</a> in it, and more words.</div><ul><li><a href=4>Next thing</a><li><a href=5>Other thing</a></ul></body>""",
                       "A title\n\nOne paragraph of plain words, long enough to count.\n\nAnother one with a link in it, and more words."),
    "implied ends": ("<div><p>Words before the advert are many here.<p class='ad'>Buy now<p>Real text follows it, as it should.<p>The end.</div>", "Words before the advert are many here.\n\nReal text follows it, as it should.\n\nThe end."),
    "inline adverts": ("<div><p>Some text with <span class=ad>a sold word</span> an advert in the line.</p></div>", "Some text with an advert in the line."),
    "an article's own parts": ("<article><header><h1>Title</h1><p class=byline>By A. Writer</p></header><p>Text of it.</p><section class='related-work'><h2>Related work</h2><p>Others did so.</p></section><p class=copyright>Rights of the text.</p><p class='tags search social'>x y</p></article>",
                               "Title\n\nBy A. Writer\n\nText of it.\n\nRelated work\n\nOthers did so.\n\nRights of the text.\n\nx y"),
    "no label": ("<header class=masthead>Site</header><nav><a href=1>x</a></nav><div class='post has-sidebar'><h2>Head</h2><p>Body of the post in words.</p><form><label>Name</label></form><p>Last.</p></div><div id=comments><p>Nice one, I liked reading it a lot.</p></div><div class=sidebar>Popular now and then</div>", "Head\n\nBody of the post in words.\n\nLast."),
}


def labelled_pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="module")
def learned(spark):
    return html_text.fitted_weights(labelled_pages(spark))


@pytest.mark.parametrize("name", PLAIN)
def test_main_text_of_pages_without_labels(learned, name):
    html, want = PLAIN[name]
    assert html_text.main_text(html, html_text.Weights({})) == want
    assert html_text.main_text(html, learned) == want


def test_scan_and_weights_decide(spark, learned):
    html, want = PLAIN["unmarked edges"]
    assert html_text.main_text(html, learned, scan=False) != want
    assert learned.known["word"] > 0 and all(v < 0 for k, v in learned.known.items() if k.startswith("<") and not k.endswith(">"))
    flat = html_text.Weights({k: 1.0 if k == "word" else -1.0 if k.startswith("<") and not k.endswith(">") else 0.0 for k in learned.known})
    pages = [r.html for r in labelled_pages(spark).collect()]
    assert sum(html_text.main_text(h, flat) != html_text.main_text(h, learned) for h in pages) > 0.9 * len(pages)
    assert learned.known[".ad"] < html_text.Weights({}).surrounding(".ad") - 1


def test_surroundings_are_learned(spark):
    """An unknown class that stands outside is left out; one that stands inside stays; a notice is one also within an article."""
    page = "<div class=qq>Words of an unknown kind of part, {} times</div><article><p>The text of page {}, with more words.</p><p class=hint>A hint that belongs to the text.</p><p class=notice>A notice.</p></article>"
    pages = spark.createDataFrame([(k, "u", page.format(k, k)) for k in range(60)] + [(100, "u", "<div><p>A text without a label.</p><div class=qq>Unknown part</div><p class=hint>Its own hint.</p><p class=notice>Its notice.</p></div>")], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.page_texts(pages, html_text.fitted_weights(pages)).collect()}
    assert got[7] == "The text of page 7, with more words.\n\nA hint that belongs to the text."
    assert got[100] == "A text without a label.\n\nIts own hint."


PARTS = {
    "form": "<form><p>Sign up here with your name and your address and more</p></form>",
    "newsletter": "<div class='newsletter box'>Get our letter every week and read what we write of it</div>",
    "sponsored": "<div class=sponsored><p>Buy what we sell, it is cheap and it is good as well</p></div>",
    "aside": "<aside><p>What others read while they should have been reading this text</p></aside>",
    "comments": "<div class=comments><p>I have read it and I liked it, said one of the many readers</p></div>",
}


@pytest.mark.parametrize("n", [0, 1, 2, 5, 20, 100])
def test_parts_within_articles_stay_out(spark, learned, n):
    """Pages whose articles hold adverts and forms teach nobody that these are text."""
    whole = "<article><h1>Head</h1><p>{} words of an article that goes on for a while.</p>{}<p>Its end.</p></article>"
    rows = [r.html for r in labelled_pages(spark).collect()] + [whole.format(k, part) for k in range(n) for part in PARTS.values()]
    pages = spark.createDataFrame([(k, "u", h) for k, h in enumerate(rows)], "page_id long, url string, html string")
    weights = html_text.fitted_weights(pages, 10_000)
    for part in PARTS.values():
        for holder in (whole, whole.replace("article>", "div>")):
            assert html_text.main_text(holder.format("Some", part), weights) == "Head\n\nSome words of an article that goes on for a while.\n\nIts end."


def test_the_scan_alone_finds_the_text_of_unseen_pages(spark):
    """Weights from one half of the pages, text of the other half: without their label, and without leaving anything out of the region."""
    import re

    pages = labelled_pages(spark)
    weights = html_text.fitted_weights(pages.where("page_id % 2 = 0"))
    held = [r.html for r in pages.where("page_id % 2 = 1").collect()]
    for html in held:
        bare = re.sub("</?article>", "", html)
        whole = html_text.main_text(html, weights)
        assert html_text.main_text(bare, weights) == html_text.main_text(bare, weights, left_out=False) == whole
        assert html_text.main_text(bare, weights, scan=False, left_out=False) != whole


def test_regions_are_the_brute_force_ones():
    rng = random.Random(9)
    for _ in range(300):
        known = {"word": rng.choice([0.25, 0.5, 1.0]), "linked": rng.choice([-1.0, 0.5]), "<": -0.25, "<p": -0.25, "<li": -1.0, ".ad": -9.0}
        weights = html_text.Weights(known)
        off = [frozenset(), frozenset(), frozenset([".ad"])]
        found = [html_text.Item(rng.choice(["word", "linked"]), "", "w " * rng.randrange(4), rng.choice(off), False) if rng.random() < 0.5 else html_text.Item(rng.choice(["<p", "<li", "<b"]), "x", "", rng.choice(off), False) for _ in range(rng.randrange(25))]

        def score(x, before):
            if weights.off(x.off):
                return 0.0 if before else -html_text.COST
            return len(x.text.split()) * known[x.kind] if x.text else known.get(x.kind, known["<"])

        each = [score(x, k > 0 and weights.off(found[k - 1].off)) for k, x in enumerate(found)]
        sums = {(a, b): sum(each[a:b]) for a in range(len(each)) for b in range(a + 1, len(each) + 1)}
        best = max([0.0, *sums.values()])
        a, b = html_text.region(found, weights)
        assert sum(each[a:b]) == best and (best > 0 or (a, b) == (0, 0))


def test_what_surrounds_the_label_is_not_held_against_it(learned):
    page = "<form class='sidebar ad'><nav>menu</nav><div class=promo><article class=sponsored><p>All of the text of this page is here.</p><div class=ad>Buy</div></article></div><footer>end</footer></form>"
    assert html_text.main_text(page, learned) == "All of the text of this page is here."


def test_main_text_of_no_pages_and_of_long_ones(spark, learned):
    empty_pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.page_texts(empty_pages, html_text.fitted_weights(empty_pages)).count() == 0
    long = "<p>" + "word " * 300_000 + "</p>" + "<div>" * 50_000 + "</b>" * 50_000 + "<p>end"
    assert len(html_text.main_text(long, learned)) > 1_400_000


def test_main_text_on_labelled_pages(spark, learned):
    import html
    import re

    pages = labelled_pages(spark)
    got = {r.page_id: r.text for r in html_text.page_texts(pages, learned).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


# ---- operator 10


def test_decontamination(spark):
    item = "If Alice buys 12 apples at 3 dollars each and gives 5 of them to Bob, how many apples does she have left now in total?"
    other = item.replace("Alice", "Carol").replace("12", "40").replace("Bob", "Dave").replace("5", "9")
    mixed_up = "If Carol buys 12 apples at 3 dollars each and gives 5 of them to Bob. If Erin buys 13 apples at 4 dollars each and gives 6 of them to Fay, how many"
    docs = docs_of(spark, [(1, f"{prose(1, 50)} {item} {prose(2, 50)}"), (2, f"Intro. {other} {prose(3, 20)}"), (3, prose(4, 200)), (4, item.upper()), (5, prose(5, 3) + " six words here"), (6, mixed_up + prose(6, 90))])
    bench = spark.createDataFrame([(10, item), (11, "six words here"), (12, None), (None, item), (10, item)], "item_id long, text string").withColumn("doc_id", F.lit(1))
    want = {(1, 10), (2, 10), (4, 10), (5, 11)}
    got = decontaminate.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert {r.doc_id: r.changed_slots > 0 for r in got if r.item_id == 10} == {1: False, 2: True, 4: False}
    left = decontaminate.decontaminated(docs, bench)
    assert left.columns == docs.columns and {3, 6, 900, 901, 902} <= {r.doc_id for r in left.collect()} and not {1, 2, 4, 5} & {r.doc_id for r in left.collect()}
    assert decontaminate.contaminated(empty(spark), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
