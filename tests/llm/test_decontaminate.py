"""Copies of benchmark items that are changed a little, with bitmaps that hold the items' windows and with full ones; and matching against brute force."""

import random

import numpy as np
import pytest

from corpusloom.llm import bitmaps, decontaminate

ITEM = "If Alice buys 12 apples at 3 dollars each and gives 5 of them to Bob, how many apples does she have left now in total?"


@pytest.fixture(params=[False, True], ids=["bitmap", "full bitmap"])
def most(request, monkeypatch):
    """Full bitmaps let every window through, as those of a very large benchmark would."""
    if request.param:
        monkeypatch.setattr(decontaminate, "bitmap", lambda df, hashed: np.full(bitmaps.BITS // 8, 255, np.uint8))


def found(spark, docs, items, most=None):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}


def test_copies_in_other_case(spark, most):
    assert found(spark, [(4, ITEM.upper()), (5, ITEM.lower())], [(10, ITEM)], most) == {(4, 10), (5, 10)}


def test_one_and_two_changed_words(spark, most):
    docs, items = [], []
    for n in (15, 37):
        words = [f"w{n}x{k}" for k in range(n)]
        items.append((n, " ".join(words)))
        edits = [(k,) for k in range(n)] + [(a, b) for a in range(n) for b in range(a)]
        docs += [(n * 10_000 + at, "before it " + " ".join("other" if k in e else w for k, w in enumerate(words)) + " after it") for at, e in enumerate(edits)]
        docs += [(n * 10_000 + 9999, " ".join(words[: n // 3]))]
    assert found(spark, docs, items, most) == {(i, i // 10_000) for i, _ in docs if i % 10_000 != 9999}


def test_items_of_mostly_slots(spark, most):
    items = ["12 + 7 = 19, 30 - 4 = ?", "7 kg", "Anna, Berta, Carla, Dora, Emil, Fritz, Gustav, Hans, Ida, Jan, Karl, Lena"]
    docs = [(k, f"words before {t} and words after") for k, t in enumerate(items)] + [(10, "words 13 + 8 = 21, 31 - 5 = ? and 8 kg"), (11, "the names Anna, Berta, Carla and Dora"), (12, "Olga, Paul, Quirin, Rosa, Sven, Tina, Udo, Vera, Willi, Xaver, Yves, Zoe")]
    assert found(spark, docs, list(enumerate(items)), most) == {(0, 0), (1, 1), (2, 2)}


def test_names_that_begin_sentences(spark, most):
    items = ["Tom has 12 red apples. Tom gives 5 to Ann. How many apples does Tom have left?", "Tom ate 3 pears. Ann ate 4 figs. Bob ate 5 plums. Eve ate 6 nuts. Who ate most?"]
    names = {"Tom": "Sam", "Ann": "Lea", "Bob": "Max", "Eve": "Ina"}
    docs = []
    for k, text in enumerate(items):
        for a, b in names.items():
            text = text.replace(a, b)
        docs += [(k, f"before it. {text} After it."), (k + 10, items[k])]
    assert found(spark, docs, list(enumerate(items)), most) == {(0, 0), (1, 1), (10, 0), (11, 1)}


def test_decides_by_row(spark):
    rows = [(1, ITEM), (1, "a clean text"), (None, ITEM), (None, "another clean text"), (2, ITEM), (2, ITEM), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(10, ITEM)], "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()]
    assert sorted(got, key=str) == sorted([(1, 10), (None, 10), (2, 10), (2, 10)], key=str)
    left = decontaminate.decontaminated(docs, bench)
    assert left.columns == docs.columns and {tuple(r) for r in left.collect()} == {(1, "a clean text"), (None, "another clean text"), (3, None)}


BOXES = "Anna packs {a} red boxes and {b} blue boxes for Berlin, then gives {a} labels to Peter and {c} to Anna again before noon."


def test_slots_must_stand_one_to_one(spark, most):
    item = BOXES.format(a=12, b=30, c=7)
    docs = [(1, BOXES.format(a=40, b=51, c=9)), (2, BOXES.format(a=40, b=51, c=9).replace("gives 40", "gives 9")), (3, BOXES.format(a=40, b=40, c=40)), (4, BOXES.format(a=40, b=51, c=9).replace("Peter", "Anna"))]
    docs += [(5, f"{BOXES.format(a=40, b=51, c=9)} Then: {BOXES.format(a=60, b=8, c=11)}"), (6, item.lower())]
    assert found(spark, docs, [(0, item)], most) == {(1, 0), (5, 0), (6, 0)}


def test_scripts_without_spaces(spark, most):
    item = "東京から大阪まで新幹線で何時間かかりますか"
    assert found(spark, [(1, f"前の文。{item}。後の文。"), (2, "東京の天気は晴れです"), (3, "a\u00a0b"), (4, "\ud83d\ude00")], [(0, item), (1, "a b")], most) == {(1, 0), (3, 1)}


def brute(text, item):
    """Passages within a stretch, and windows of all sizes along one diagonal, word by word."""
    t, i = text.lower().split(), item.lower().split()
    n, sizes = len(i), decontaminate.window_sizes(len(i))
    places = [(d, q, z) for z in {*sizes} for d in range(len(t) - z + 1) for q in range(n - z + 1) if t[d : d + z] == i[q : q + z]]
    words = lambda some: len({q + j for _, q, z in some for j in range(z)})
    stretches = [words([x for x in places if x[2] == sizes[-1] and s <= x[0] and x[0] + x[2] <= s + 2 * n]) for s in range(len(t))]
    slack = max(2, n // 8)
    diagonals = [words([x for x in places if s <= x[0] - x[1] <= s + slack]) for s in {x[0] - x[1] for x in places}]
    return max(stretches + diagonals, default=0) >= 0.6 * n


def test_copies_are_the_brute_force_ones(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(300)}x"
    items = [(k, " ".join(word() for _ in range(rng.randrange(1, 60)))) for k in range(40)]
    docs = []
    for k in range(150):
        words = [word() for _ in range(30)]
        source = rng.choice(items)[1].split()
        a = rng.randrange(len(source))
        part = source[: rng.randrange(len(source)) + 1] if k % 2 else source[a:]
        part = [word() if rng.random() < 0.06 else w for w in part]
        at = rng.randrange(30)
        docs.append((k, " ".join(words[:at] + part + words[at:])))
    want = {(d, i) for d, t in docs for i, x in items if brute(t, x)}
    assert len(want) > 40
    assert found(spark, docs, items) == want


def test_a_long_text_and_a_frequent_window(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    texts = [(1, "one two three four five " * 60_000), (2, "x " * 300_000 + item + " y" * 300_000)]
    assert found(spark, texts, [(0, item)]) == {(2, 0)}
