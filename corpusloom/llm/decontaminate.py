"""Operator 10, benchmark decontamination by template canonicalisation.

Words become template words: numbers, names and units are replaced by typed placeholders, other words are lower-cased
and lose their outer punctuation; a character of scripts without spaces is a word. A capitalised word that begins a
sentence may be a name or not; its windows are made both ways. Windows of so many template words, of benchmark items
and of documents, meet by hash, and so do windows of the lower-cased words themselves.

An item is found in a document in one of three ways:

- as a passage: windows of WINDOW of its own words, or the whole of a shorter item, cover LEAST_COPY of its words or more within a stretch of SPAN times
  its length;
- as an edited copy: windows of its own words, shorter ones too if the item is short, cover LEAST_COPY of its words along one diagonal;
- with other parameters: template windows cover LEAST_TEMPLATE of its words along one diagonal.

The latter two need slots that are consistent throughout: each value of the item stands against one value, and different
ones against different ones, also in gaps between windows that are shifted alike. A diagonal takes in places whose
shift differs by a few words.

Template windows of mostly slots would meet any list of numbers; they don't count, and such passages are found as
copies. Nothing else is left out.

Windows meet in a hash join. Each document gives the hashes of its windows once, those that a bitmap of fixed size may
hold of the benchmark's; items give theirs, and both are dealt by hash. What a document shares with an item is counted, and
only pairs that share enough to cover the item go on: a window that many documents or items hold makes no pairs by
itself. Then each such document's text meets its items, in the order of documents, and is compared place by place. The
documents are read once for windows and once for the texts of those pairs, however large the benchmark is, and neither
side passes the driver."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmaps import bitmap, holds
from .common import batch, mapped, pieces, stored, table
from .shingles import mixed

#: Words in a window; least shares of an item's words that its own words' windows and template windows cover.
WINDOW, LEAST_COPY, LEAST_TEMPLATE = 8, 0.6, 0.75
#: Words in the further windows of shorter items: (most words of the item, words in its windows). From 15 words on, any two
#: changed words leave LEAST_COPY of the words in windows.
SEEDS = ((23, 3), (47, 4))
#: Matched words count together within so many times the item's length in the document.
SPAN = 2
#: Items that a worker keeps prepared.
KEPT = 5000

#: Units that are replaced by a placeholder when they follow a number.
UNITS = frozenset("mm cm m km in ft yd mi g kg mg lb oz l ml s sec min h hr hour hours minute minutes second seconds day days week weeks month months year years metre metres meter meters kilometre kilometres kilometer kilometers mile miles gram grams kilogram kilograms litre litres liter liters dollar dollars euro euros cent cents percent".split())

_NUMBER = re.compile(rb"[$+-]?\d[\d.,:/]*(?:e[+-]?\d+)?([a-z%]*)")
_OUTER = bytes(c for c in range(128) if not chr(c).isalnum())
_ENDS = (b".", b"!", b"?", b":")
_IS_NUMBER, _IS_NAME, _ENDS_SENTENCE, _IS_UNIT, _IS_EMPTY = 1, 2, 4, 8, 16
_FLAGS = np.uint64(31)
_M, _HALF = np.uint64(0x9E3779B97F4A7C15), np.uint64(32)
#: Characters that are words of their own, and spaces beyond ASCII.
_ALONE = re.compile("([\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])|[\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_PLACEHOLDER = {k: np.uint64(xxhash.xxh3_64_intdigest(k) & ~31) for k in ("number", "name", "unit")}
_UNITS = frozenset(u.encode() for u in UNITS)


class Words(dict):
    """Word to its hash with flags in the lowest bits, remembered; emptied when it holds most entries."""

    most = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        core = word.strip(_OUTER)
        flags = _ENDS_SENTENCE * (len(core) < len(word) and word.rstrip(b"\"')]}").endswith(_ENDS))
        lower = core.lower()
        if core.isalpha():  # ASCII letters only
            flags |= _IS_NAME * (len(core) > 1 and core.istitle()) | _IS_UNIT * (lower in _UNITS)
        elif not core:
            flags |= _IS_EMPTY
        elif (m := _NUMBER.fullmatch(lower)) and (not m[1] or m[1] == b"%" or m[1] in _UNITS):
            flags |= _IS_NUMBER
        else:
            letters = core.decode(errors="replace")
            flags |= _IS_NAME * (len(letters) > 1 and letters[0].isupper() and letters[1:].islower())
            lower = letters.lower().encode()
        found = self[word] = xxhash.xxh3_64_intdigest(lower) & ~31 | flags
        return found


def words_of(text: str | None) -> list[bytes]:
    if not text:
        return []
    if not text.isascii():
        text = _ALONE.sub(r" \1 ", text)
    return text.encode().split()


def template(texts: list[list[bytes]], seen: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts as words -> rows of word hashes (literal; template; template with capitalised words that begin a sentence as
    names), whether each is a slot, its place among the words of its text, and its text; bare punctuation is left out."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    n = int(sizes.sum())
    h = np.fromiter(map(seen.__getitem__, chain.from_iterable(texts)), np.uint64, n)
    of = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.flatnonzero((h & np.uint64(_IS_EMPTY)) == 0)
    begins = (np.append(True, (h[:-1] & np.uint64(_ENDS_SENTENCE)) > 0) | (place == 0))[at] if n else np.zeros(0, bool)
    h, of, place = h[at], of[at], place[at]
    number = (h & np.uint64(_IS_NUMBER)) > 0
    name = (h & np.uint64(_IS_NAME)) > 0
    unit = ((h & np.uint64(_IS_UNIT)) > 0) & np.append(False, number[:-1] & (of[1:] == of[:-1])) if len(h) else number
    out = np.stack([h & ~_FLAGS] * 3)
    slot = np.stack([np.zeros(len(h), bool), number | (name & ~begins) | unit, number | name | unit])
    for row, x in ((1, name & ~begins), (2, name)):
        for mask, k in ((number, "number"), (x, "name"), (unit, "unit")):
            out[row, mask] = _PLACEHOLDER[k]
    return out, slot, place, of


def template_windows(out: np.ndarray, slot: np.ndarray, of: np.ndarray, sizes: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Each of the rising sizes with the hashes of the windows of so many words, by rows; 0 where a window spans two
    texts, and in template rows where it has no slot (it is in the row before) or more than half of it is slots."""
    n = out.shape[1]
    w, k = out, 1
    filled = np.concatenate([np.zeros((3, 1), np.int64), np.cumsum(slot, 1)], 1)
    for size in sizes:
        if size > n:
            return
        for k in range(k, size):
            w = (w[:, : n - k] ^ (w[:, : n - k] >> _HALF)) * _M + out[:, k:]
        k = size
        found = mixed(w)
        slots = filled[:, size:] - filled[:, :-size]
        found[1:][(slots[1:] == slots[:-1]) | (slots[1:] * 2 > size)] = 0
        found[:, of[size - 1 :] != of[: n - size + 1]] = 0
        yield size, found


def window_sizes(n: int, width: int = WINDOW) -> list[int]:
    """Sizes of the windows of an item of so many words, rising; items up to a window's length are one window."""
    if n <= width:
        return [n] * (n > 0)
    return [*[z for most, z in SEEDS if n <= most and z < width][:1], width]


class Document:
    """A text's words and the places of its windows, made for the sizes that items ask for."""

    def __init__(self, text: str | None, seen: Words) -> None:
        self.words = words_of(text)
        self.out, self.slot, self.place, self.of = template([self.words], seen)
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def of_size(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, place and row of each window, by hash."""
        if size not in self.windows:
            rows = next((x for _, x in template_windows(self.out, self.slot, self.of, [size])), np.zeros((3, 0), np.uint64))
            row, d = np.nonzero(rows)
            h = rows[row, d]
            order = np.argsort(h, kind="stable")
            self.windows[size] = h[order], d[order], row[order]
        return self.windows[size]


class Item:
    """A benchmark item: its words, slots and windows."""

    def __init__(self, text: str | None, seen: Words, width: int = WINDOW) -> None:
        ws = words_of(text)
        out, slot, place, of = template([ws], seen)
        sizes = window_sizes(len(place), width)
        self.n, self.longest = len(place), sizes[-1] if sizes else 0
        self.slots, self.words = slot, [ws[p].strip(_OUTER).lower() for p in place]
        self.windows: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        for size, own in template_windows(out, slot, of, sizes):
            row, q = np.nonzero(own)
            self.windows.append((size, own[row, q], q, row))

    def match(self, document: Document) -> tuple[float, int, int] | None:
        """(share of its words, slots compared, slots with another value) if the document holds it."""
        hits = []
        for size, own, q, theirs in self.windows:
            keys, d, row = document.of_size(size)
            lo, hi = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            n = hi - lo
            at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            theirs = np.repeat(theirs, n)
            hits.append(np.stack([d[at], np.repeat(q, n), np.full(len(at), size), np.maximum(row[at], theirs), theirs]))
        hits = np.concatenate(hits, 1) if hits else np.zeros((5, 0), np.int64)
        # three rows may give a window thrice; fewer windows than this can't cover LEAST_COPY of the item
        if not hits.shape[1] or hits.shape[1] * self.longest < LEAST_COPY * self.n:
            return None
        hits = hits[:, np.lexsort(hits[::-1])]
        return self._best(list(map(tuple, hits.T.tolist())), document.words, document.place)

    def _best(self, places: list[tuple], ws: list[bytes], at: np.ndarray) -> tuple[float, int, int] | None:
        """places: (document word, item word, size, row, the item's row), by document word."""
        n, longest = self.n, self.longest
        own = [x for x in places if x[3] == 0]
        if covered := self._passage(n, [x for x in own if x[2] == longest]):
            return covered / n, int(self.slots[1].sum()), 0
        for least, some in ((LEAST_COPY, own), *((LEAST_TEMPLATE, [x for x in places if x[3] <= most]) for most in (1, 2))):  # words that begin sentences are taken for names only if needed
            for covered, stretch in self._diagonals(n, some, least):
                if compared := self._compared(stretch, ws, at):
                    return covered / n, *compared
        return None

    @staticmethod
    def _passage(n: int, places: list[tuple]) -> int:
        """The most words of the item that are covered within a stretch of SPAN * n words; 0 if too few."""
        held, first, best = Counter(), 0, 0
        covered = 0
        for d, q, z, *_ in places:
            for j in range(q, q + z):
                covered += not held[j]
                held[j] += 1
            while places[first][0] + max(SPAN * n, z) < d + z:
                _, p, y, *_ = places[first]
                for j in range(p, p + y):
                    held[j] -= 1
                    covered -= not held[j]
                first += 1
            best = max(best, covered)
        return best if best >= LEAST_COPY * n else 0

    @staticmethod
    def _diagonals(n: int, places: list[tuple], least: float) -> list[tuple[int, list[tuple]]]:
        """Places by how far they are shifted, within a few words; those that cover enough of the item, the fullest first."""
        order = sorted(places, key=lambda x: (x[0] - x[1], x[0]))
        shift = [x[0] - x[1] for x in order]
        slack = max(2, n // 8)
        found, first = [], 0
        held: Counter = Counter()
        covered = 0
        for last, (_, q, z, *_) in enumerate(order):
            for j in range(q, q + z):
                covered += not held[j]
                held[j] += 1
            while shift[first] < shift[last] - slack:
                _, p, y, *_ = order[first]
                for j in range(p, p + y):
                    held[j] -= 1
                    covered -= not held[j]
                first += 1
            if covered >= least * n and (last + 1 == len(order) or shift[last + 1] > shift[last]):
                found.append((-covered, first, last))
        return [(-c, order[a : b + 1]) for c, a, b in sorted(found)]

    def _compared(self, places: list[tuple], ws: list[bytes], at: np.ndarray) -> tuple[int, int] | None:
        """Slots compared and slots with another value; None unless values stand against each other one to one."""
        slots, theirs = self.slots, self.words
        votes: dict[int, Counter] = defaultdict(Counter)
        for d, q, z, _, row in places:
            use = slots[row or 2]
            for j in range(z):
                if use[q + j]:
                    votes[q + j][d + j] += 1
        middle = sorted(x[0] - x[1] for x in places)[len(places) // 2]
        # a slot in a gap stands where both neighbours put it
        ends = sorted((q, d - q) for d, q, *_ in places), sorted((q + z, d - q) for d, q, z, *_ in places)
        for q in np.flatnonzero(slots[1]).tolist():
            if q not in votes:
                before, after = bisect_right(ends[1], (q, len(ws))) - 1, bisect_left(ends[0], (q, -len(ws)))
                if before >= 0 and after < len(ends[0]) and ends[1][before][1] == ends[0][after][1]:
                    votes[q][q + ends[0][after][1]] += 1
        against: dict[bytes, bytes] = {}
        back: dict[bytes, bytes] = {}
        for q, of in votes.items():
            d = min(of, key=lambda d: (-of[d], abs(d - q - middle), d))
            mine, value = theirs[q], ws[at[d]].strip(_OUTER).lower()
            if against.setdefault(mine, value) != value or back.setdefault(value, mine) != mine:
                return None
        return len(against), sum(a != b for a, b in against.items())


_MATCHES_DDL = "k1 long, k2 long, item_id long, share double, slots long, changed_slots long"
_MATCHES = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("item_id", pa.int64()), ("share", pa.float64()), ("slots", pa.int64()), ("changed_slots", pa.int64())])
_ITEM_WINDOWS = pa.schema([("item", pa.int64()), ("n", pa.int64()), ("longest", pa.int64()), ("size", pa.int64()), ("hash", pa.int64()), ("times", pa.int64())])
_ITEM_WINDOWS_DDL = "item long, n long, longest long, size long, hash long, times long"
_DOC_WINDOWS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("size", pa.int64()), ("hash", pa.int64())])
_DOC_WINDOWS_DDL = "k1 long, k2 long, size long, hash long"


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct hashes of an item's windows, with how many windows have them."""
    seen = Words()
    for given in batches:
        for item, text in zip(given.column(0).to_pylist(), given.column(1).to_pylist(), strict=True):
            known = Item(text, seen)
            for size, own, _, _ in known.windows:
                hashes, times = np.unique(own, return_counts=True)
                m = len(hashes)
                yield batch(_ITEM_WINDOWS, {"item": np.full(m, item), "n": np.full(m, known.n), "longest": np.full(m, known.longest), "size": np.full(m, size), "hash": hashes.view(np.int64), "times": times})


def _doc_windows(bits: np.ndarray, sizes: list[int]):
    """Distinct hashes of a document's windows that the bitmap may hold, by size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Words()
        for given in batches:
            k1, k2, texts = given.column(0).to_numpy(), given.column(1).to_numpy(), given.column(2).to_pylist()
            for a, b in pieces(texts, 1 << 19):
                out, slot, _, of = template([words_of(t) for t in texts[a:b]], seen)
                for size, rows in template_windows(out, slot, of, sizes):
                    row, d = np.nonzero(rows)
                    h = rows[row, d]
                    some = holds(bits, h)
                    found = np.unique(np.stack([of[d[some]].astype(np.uint64), h[some]]), axis=1)
                    at = found[0].astype(np.int64) + a
                    yield batch(_DOC_WINDOWS, {"k1": k1[at], "k2": k2[at], "size": np.full(len(at), size), "hash": found[1].view(np.int64)})

    return run


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by (k1, k2, kind): a document's text, then the items that it may hold."""
    seen, kept = Words(), {}
    now, document = None, None
    for given in batches:
        out = []
        for row in given.to_pylist():
            if row["kind"] == 0:
                now, document = (row["k1"], row["k2"]), Document(row["text"], seen)
                continue
            if now != (row["k1"], row["k2"]):
                raise ValueError("an item without its document")
            if row["item"] not in kept:
                if len(kept) >= KEPT:
                    kept.clear()
                kept[row["item"]] = Item(row["text"], seen)
            if found := kept[row["item"]].match(document):
                out.append((*now, row["item_id"], *found))
        if out:
            yield batch(_MATCHES, dict(zip(_MATCHES.names, zip(*out))))


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with two hashes that tell their rows apart by id and text."""
    id_ = F.col("doc_id").cast("long")
    return docs.withColumns({_K1: F.xxhash64(id_, "text"), _K2: F.xxhash64("text", id_)})


_K1, _K2 = "_leak_key_1_", "_leak_key_2_"


def _matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """k1, k2, item_id, share, slots, changed_slots of each distinct document and item that match."""
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).where("item_id IS NOT NULL").dropDuplicates()
    items = stored(items.withColumn("item", F.monotonically_increasing_id()), "items")
    windows = stored(items.select("item", "text").transform(mapped, _item_windows, _ITEM_WINDOWS_DDL), "windows")
    sizes = sorted(r.size for r in windows.select("size").distinct().collect())  # WINDOW at most
    keyed = _keyed(docs.select("doc_id", "text")).select(F.col(_K1).alias("k1"), F.col(_K2).alias("k2"), "text")
    held = keyed.transform(mapped, _doc_windows(bitmap(windows, F.col("hash")), sizes), _DOC_WINDOWS_DDL).dropDuplicates()
    shared = held.join(windows, ["size", "hash"]).groupBy("k1", "k2", "item").agg(F.sum("times").alias("times"), F.first("n").alias("n"), F.first("longest").alias("longest"))
    pairs = stored(shared.where(F.col("times") * F.col("longest") >= LEAST_COPY * F.col("n")).select("k1", "k2", "item"), "pairs")
    texts = keyed.join(pairs.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    none = F.lit(None).cast("long")
    asked = pairs.join(items, "item").select("k1", "k2", F.lit(1).alias("kind"), "item", "item_id", "text")
    both = texts.select("k1", "k2", F.lit(0).alias("kind"), none.alias("item"), none.alias("item_id"), "text").unionByName(asked)
    return both.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "kind").transform(mapped, _verified, _MATCHES_DDL)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...), benchmark(item_id, text) -> doc_id, item_id, share, slots, changed_slots of each match.

    Null or empty texts match nothing. Rows of docs that repeat give repeated matches; null ids stay null. Items that
    repeat count once, items without an id or a word match nothing. Texts of any length are read whole. Of several
    stretches that hold an item the fullest counts, of equal ones the first. Other columns are not looked at; without
    rows on either side the result is empty."""
    found = stored(_matches(docs, benchmark), "matches")
    rows = _keyed(docs.select(F.col("doc_id").cast("long"), "text")).select("doc_id", F.col(_K1).alias("k1"), F.col(_K2).alias("k2"))
    return rows.join(found, ["k1", "k2"]).select("doc_id", "item_id", "share", "slots", "changed_slots")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that match no item, all columns as they are."""
    gone = stored(_matches(docs, benchmark).select(F.col("k1").alias(_K1), F.col("k2").alias(_K2)).distinct(), "gone")
    return _keyed(docs).join(gone, [_K1, _K2], "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def op10_template_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
