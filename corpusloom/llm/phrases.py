"""Operator 11, phrases whose words keep company: count tries of bounded depth.

Each shard of the texts (at most SHARD words) is counted in a trie of depth 4: a level's nodes are numbered in the order
of their paths, and a node is its parent's number, its word and its count. A trie is written in the order of its paths;
these runs are dealt by ranges of paths, which begin with the prefix, and merged range by range: equal paths meet in one
task, one row for each shard that has them, and their counts are added.

A part of a phrase occurs at least as often as the phrase. So phrases below LEAST occurrences aren't needed for anything,
and a phrase can only reach LEAST if all its parts do. Tries are therefore counted in three passes: words; pairs of words
that reach LEAST; phrases of three and four words whose pairs all reach it. Which words and pairs do is sent as a bitmap
of fixed size, which may let others through but keeps none out: counts are exact whatever it holds.

In the merged trie, a table of nodes, a node's left parts are its ancestors: its parent's left parts and the parent. Its
right parts are reached by suffix links, from the path to the path without its first word: the link's end and that
node's right parts. Both are followed for a whole level at once, by a join with the level above.

A candidate inside a longer one of four words is inside one of three that occurs at least as often, so it suffices to
look at those that are one word longer."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bitmaps import bitmap, holds, holds_one
from .common import mapped, pieces, stored, table

DEPTH, LEAST, TOP, SALTS = 4, 30, 2000, 64
#: Words counted in one trie.
SHARD = 2_000_000

_FOLDED = bytes.maketrans(bytes(range(65, 91)) + b",;:!?\x0a\x0b\x0c\x0d\x09", bytes(range(97, 123)) + b"." * 9 + b" ")
_RUN = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])
_RUN_DDL = "lang string, phrase string, f long"


def tokens(text: str | None) -> list[bytes]:
    """Words of a text, with a "." at each border of pieces."""
    return (text or "").encode().translate(_FOLDED).replace(b".", b" . ").split()


class Numbers(dict):
    """Word to number, from 1; 0 for borders and for words that surely don't reach LEAST."""

    def __init__(self, lang: str, bits: np.ndarray) -> None:
        super().__init__()
        self.seed, self.bits, self.names, self.hashes = xxhash.xxh64_intdigest(lang.encode(), 42), bits, [b""], [0]
        self[b"."] = 0

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word, self.seed)
        if not holds_one(self.bits, found):
            self[word] = 0
            return 0
        self[word] = len(self.names)
        self.names.append(word)
        self.hashes.append(found)
        return self[word]


def _level(parents: np.ndarray, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Children of nodes: parent, word and count of each, in the order of paths, and which of them each occurrence is."""
    keys, which, counts = np.unique(parents * width + words, return_inverse=True, return_counts=True)
    return keys // width, keys % width, counts, which


def _trie(lang: str, numbers: Numbers, a: np.ndarray, pairs: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The count trie of a shard as runs in the order of paths: its pairs, or, given the pairs' bitmap, its levels 3 and 4."""
    order = sorted(range(len(numbers.names)), key=numbers.names.__getitem__)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    width, a, held = len(order), rank[a], np.array(numbers.hashes, np.uint64)[order]
    names = pa.array([numbers.names[k].decode() for k in order], pa.string())
    ok = (a[:-1] > 0) & (a[1:] > 0)
    if pairs is not None:
        at = np.flatnonzero(ok)
        ok[at] = holds(pairs, (held[a[at]] << np.uint64(1)) ^ held[a[at + 1]])
    at = np.flatnonzero(ok)
    parent, word, count, which = _level(a[at], a[at + 1], width)
    paths = pc.binary_join_element_wise(names.take(pa.array(parent)), names.take(pa.array(word)), " ")
    if pairs is None:
        yield from _run(lang, paths, count)
        return
    for depth in range(3, DEPTH + 1):
        # of the occurrences of a level, those go on that the next pair continues
        more = np.zeros(len(a), bool)
        more[: len(ok)] = ok
        nodes = np.full(len(a), -1)
        nodes[at] = which
        last = at + depth - 2
        at = at[more[last]]
        if not len(at):
            return
        parent, word, count, which = _level(nodes[at], a[at + depth - 1], width)
        paths = pc.binary_join_element_wise(paths.take(pa.array(parent)), names.take(pa.array(word)), " ")
        yield from _run(lang, paths, count)


def _run(lang: str, paths: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(paths), 1 << 16):
        some = paths.slice(k, 1 << 16)
        yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(some)), some, pa.array(counts[k : k + (1 << 16)], pa.int64())], schema=_RUN)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Level 1 of the tries."""
    held: dict[str, Counter] = {}

    def run() -> Iterator[pa.RecordBatch]:
        for lang, found in sorted(held.items()):
            found.pop(b".", None)
            if found:
                keys = sorted(found)
                yield from _run(lang, pa.array([k.decode() for k in keys], pa.string()), np.array([found[k] for k in keys]))
        held.clear()

    for given in batches:
        langs, texts = given.column(0).to_pylist(), given.column(1).to_pylist()
        for k, text in enumerate(texts):
            held.setdefault(langs[k], Counter()).update(tokens(text))
        if sum(map(len, held.values())) > SHARD // 8:
            yield from run()
    yield from run()


def _deeper(bits: np.ndarray, pairs: np.ndarray | None):
    """Level 2 of the tries, or, given the pairs' bitmap, levels 3 and 4."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Numbers] = {}
        held: dict[str, list[np.ndarray]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in sorted(held):
                a = np.concatenate([*held[lang], np.zeros(1, np.int64)])
                yield from _trie(lang, seen[lang], a, pairs)
            seen.clear()
            held.clear()

        n = 0
        for given in batches:
            langs, texts = given.column(0).to_pylist(), given.column(1).to_pylist()
            for start, end in pieces(texts):
                for lang, text in zip(langs[start:end], texts[start:end], strict=True):
                    if lang not in seen:
                        seen[lang], held[lang] = Numbers(lang, bits), []
                    found = tokens(text)
                    held[lang].append(np.fromiter(map(seen[lang].__getitem__, found), np.int64, len(found)))
                    held[lang].append(np.zeros(1, np.int64))
                    n += len(found)
                if n >= SHARD:
                    yield from flush()
                    n = 0
        yield from flush()

    return run


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """Runs of all shards merged by ranges of paths; the nodes that occur least times or more."""
    dealt = runs.repartitionByRange("lang", "phrase").sortWithinPartitions("lang", "phrase")
    return stored(dealt.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least), "trie")


def _linked(nodes: DataFrame, upper: DataFrame, depth: int) -> DataFrame:
    """Nodes of a level with the counts of their left parts and right parts, by length of the left part."""
    rows = nodes.withColumns({"parent": F.substring_index("phrase", " ", depth - 1), "suffix": F.substring_index("phrase", " ", 1 - depth)})
    walk = upper.select("lang", F.col("phrase").alias("parent"), F.concat("lefts", F.array("f")).alias("lefts"))
    link = upper.select("lang", F.col("phrase").alias("suffix"), F.concat(F.array("f"), "rights").alias("rights"))
    return stored(rows.join(walk, ["lang", "parent"]).join(link, ["lang", "suffix"]), "links")


def phrases(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """docs(lang, text, ...) -> lang, rank, phrase, a, l, r, n, score, k: each language's first phrases of 2 to 4 words.

    A-Z are lower-cased. A null text is empty, a null lang is `und`. Phrases lie within a piece, and occurrences may overlap.
    Rows that repeat count each. Texts of any length are read whole. Equal scores are ordered by a, then by the phrase's
    bytes; of equal cuts (k words to the left) the first counts. Without rows, or without a phrase that occurs least
    times, the result is empty. Other columns of docs are not looked at, whatever their names."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text"))
    runs = stored(texts.transform(mapped, _words, _RUN_DDL), "runs")
    totals = runs.groupBy("lang").agg(F.sum("f").alias("n"))
    empty = F.array().cast("array<bigint>")
    level = _merged(runs, least).withColumns({"lefts": empty, "rights": empty})
    words = bitmap(level, F.xxhash64("lang", "phrase"))
    two = _merged(stored(texts.transform(mapped, _deeper(words, None), _RUN_DDL), "runs"), least)
    halves = [F.xxhash64("lang", F.substring_index("phrase", " ", k)) for k in (1, -1)]
    pairs = bitmap(two, F.shiftleft(halves[0], 1).bitwiseXOR(halves[1]))
    more = _merged(stored(texts.transform(mapped, _deeper(words, pairs), _RUN_DDL), "runs"), least)
    size = F.length("phrase") - F.length(F.translate("phrase", " ", "")) + 1
    levels = []
    for depth in range(2, DEPTH + 1):
        level = _linked(two if depth == 2 else more.where(size == depth), level, depth)
        levels.append(level)
    found, inside = levels[0], []
    for deeper in levels[1:]:
        found = found.unionByName(deeper)
        inside += [deeper.select("lang", F.col(c).alias("phrase"), "f") for c in ("parent", "suffix")]
    longer = inside[0]
    for rows in inside[1:]:
        longer = longer.unionAll(rows)
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    kept = found.join(longer, ["lang", "phrase"], "left").where("longest IS NULL OR CAST(longest AS DECIMAL(20,0)) * 100 < CAST(f AS DECIMAL(20,0)) * 80")
    cut = """array_min(transform(lefts, (l, k) -> struct(
        CAST((CAST(f AS DECIMAL(20,0)) * 2000000) div (CAST(l AS DECIMAL(20,0)) + CAST(rights[k] AS DECIMAL(20,0))) AS BIGINT) AS score, CAST(k + 1 AS BIGINT) AS k, l AS l, rights[k] AS r)))"""
    scored = kept.withColumn("cut", F.expr(cut)).select("lang", "phrase", F.col("f").alias("a"), "cut.*")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top)
    first = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "k")


def op11_phrase_collocations(spark, sf_dir):
    return phrases(table(spark, sf_dir, "documents"))


#: The same by counting every phrase.
ORACLE = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, d, unnest(list_transform(range(1, greatest(len(ws) - d + 2, 1)), lambda i: array_to_string(ws[i : i + d - 1], ' '))) AS phrase FROM w, (SELECT unnest([1, 2, 3, 4]) AS d)),
c AS MATERIALIZED (SELECT lang, d, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c WHERE d = 1 GROUP BY 1),
x AS MATERIALIZED (SELECT lang, d, phrase, f AS a, string_split(phrase, ' ') AS ws FROM c WHERE d >= 2 AND f >= 30),
u AS (SELECT x.*, unnest(range(1, d)) AS k FROM x),
v AS (SELECT u.*, l.f AS l, r.f AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
      FROM u JOIN c l ON l.lang = u.lang AND l.phrase = array_to_string(ws[1 : k], ' ') JOIN c r ON r.lang = u.lang AND r.phrase = array_to_string(ws[k + 1 :], ' ')),
b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
s AS (SELECT lang, d, a AS f, unnest(flatten(list_transform(range(2, d), lambda m: list_transform(range(1, d - m + 2), lambda i: array_to_string(ws[i : i + m - 1], ' '))))) AS phrase FROM x WHERE d > 2),
o AS (SELECT lang, phrase, max(f) AS longest FROM s GROUP BY 1, 2),
t AS (SELECT b.* FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE longest IS NULL OR CAST(100 AS HUGEINT) * longest < CAST(80 AS HUGEINT) * a)
SELECT lang, rank, phrase, a, l, r, n, score, k FROM (SELECT t.*, n.n, row_number() OVER (PARTITION BY t.lang ORDER BY score DESC, a DESC, encode(t.phrase)) AS rank FROM t JOIN n ON n.lang = t.lang) WHERE rank <= 2000
"""
