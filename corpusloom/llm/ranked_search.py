"""Operator 13, ranked lexical search by inverted treaps.

Texts are read once. What a document holds of the queries' terms is stored with its length; which terms those are is told
to the readers by a bitmap of fixed size, and a join by term afterwards leaves out what else it let through. Documents are
dealt to shards of about SHARD postings. In a shard each term's postings form a treap: a binary search tree in the order of
doc_id, and a heap by impact, what the posting would add for a term of weight 1. Equal impacts are ordered at random, so
that copies make no long chains.

A query runs through the treaps of its terms at the same time. A range of documents has, for each term, the treap's
highest node within it; these nodes' impacts add up to the most that any document of the range can score. The ranges with
the highest sums are opened first, several at once: the document with the largest single addition is scored, which
splits its range in two. Ranges whose sum can't enter the best go. Bounds are exact integers, and at equal scores a range
goes only if all its documents come after the last of the best. So nothing is lost.

A query set is judged against all shards; a shard's answer has `top` rows a query, of which the first are taken."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bitmaps import bitmap, holds_one
from .common import mapped, pieces, stored, table

TOP, SHARD = 20, 1_000_000
#: Ranges opened at once are as many as hold OPEN nodes; beyond HELD nodes ranges don't keep theirs, but find them again.
OPEN, HELD = 1 << 14, 1 << 24

#: All bytes but digits, letters and those of characters beyond ASCII part terms.
_FOLDED = bytes((b + 32 if 65 <= b < 91 else b) if b >= 128 or bytes([b]).isalnum() else 32 for b in range(256))

_HITS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.string())), ("tfs", pa.list_(pa.int64()))])
_HITS_DDL = "doc_id long, n long, terms array<string>, tfs array<long>"
_FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLDED).split()


class Sought(dict):
    """Term to whether the bitmap holds it."""

    def __init__(self, bits: np.ndarray) -> None:
        super().__init__()
        self.bits = bits

    def __missing__(self, term: bytes) -> bool:
        if len(self) > 300_000:
            self.clear()
        found = self[term] = holds_one(self.bits, xxhash.xxh64_intdigest(term, 42))
        return found


def _counted(bits: np.ndarray | None):
    """Texts to their terms that the bitmap holds, or all, with counts, and the number of all terms; texts without terms go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = Sought(bits) if bits is not None else None
        for given in batches:
            ids, texts = given.column(0).to_pylist(), given.column(1).to_pylist()
            for start, end in pieces(texts):
                out: dict[str, list] = {k: [] for k in _HITS.names}
                for k in range(start, end):
                    found = terms_of(texts[k])
                    if not found:
                        continue
                    some = Counter(found if sought is None else filter(sought.__getitem__, found))
                    out["doc_id"].append(ids[k])
                    out["n"].append(len(found))
                    out["terms"].append([t.decode() for t in some])
                    out["tfs"].append(list(some.values()))
                yield pa.RecordBatch.from_pydict(out, schema=_HITS)

    return run


class Treaps:
    """The treaps of a shard. Nodes are postings in the order of term and document; the last, -1, is none."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, terms: int) -> None:
        order = np.lexsort((doc, term))
        term, doc, impact = term[order], doc[order], impact[order]
        n = len(term)
        chance = np.random.default_rng(13).integers(0, 1 << 30, n)
        rank = np.empty(n, np.int64)
        rank[np.lexsort((chance, impact))] = np.arange(n)
        left, right, roots = [-1] * (n + 1), [-1] * (n + 1), [-1] * terms
        heap, at, up = rank.tolist(), term.tolist(), []
        for k in range(n):
            if k and at[k] != at[k - 1]:
                up = []
            below = -1
            while up and heap[up[-1]] < heap[k]:
                below = up.pop()
            left[k] = below
            if up:
                right[up[-1]] = k
            else:
                roots[at[k]] = k
            up.append(k)
        self.left, self.right, self.roots = np.array(left, np.int32), np.array(right, np.int32), np.array(roots, np.int32)
        self.doc, self.impact = np.append(doc, -1), np.append(impact, 0)

    def within(self, nodes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For nodes (ranges x terms), whose subtrees hold all that lies within low to high: the highest nodes that do."""
        out, width = nodes.ravel().copy(), nodes.shape[1]
        at = np.flatnonzero(out >= 0)
        while len(at):
            node = out[at]
            doc, of = self.doc[node], at // width
            before, after = doc < low[of], doc >= high[of]
            moves = before | after
            at, node, before = at[moves], node[moves], before[moves]
            out[at] = node = np.where(before, self.right[node], self.left[node])
            at = at[node >= 0]
        return out.reshape(-1, width)

    def best(self, terms: np.ndarray, weights: np.ndarray, docs: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents with the highest scores above 0, and these; of equal ones those with lower numbers."""
        root = self.roots[terms][None, :]
        at_once, kept = max(1, OPEN // len(terms)), True
        low, high, nodes = np.zeros(1, np.int64), np.full(1, docs), root
        most = (self.impact[nodes] * weights).sum(1)
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        while True:
            if len(scores) == top:
                open_ = (most > scores[-1]) | (most == scores[-1]) & (low < ids[-1])
            else:
                open_ = most > 0
            if not open_.any():
                return ids, scores
            low, high, most = low[open_], high[open_], most[open_]
            nodes = nodes[open_] if kept else nodes
            if kept and nodes.size > HELD:
                nodes, kept = root, False
            # the most promising ranges; at the start few, so that a lower limit is known early
            take = np.argsort(-most, kind="stable")[: at_once if len(scores) == top else min(at_once, top)]
            rest = np.ones(len(most), bool)
            rest[take] = False
            lo, hi = low[take], high[take]
            here = nodes[take] if kept else self.within(np.repeat(root, len(take), 0), lo, hi)
            first = here[np.arange(len(take)), np.argmax(self.impact[here] * weights, 1)]
            doc = self.doc[first]
            new = self.within(np.concatenate([here, here, here]), np.concatenate([lo, doc + 1, doc]), np.concatenate([doc, hi, doc + 1]))
            sums = (self.impact[new] * weights).sum(1)
            k = len(take)
            ids, scores = np.concatenate([ids, doc]), np.concatenate([scores, sums[2 * k :]])
            order = np.lexsort((ids, -scores))[:top]
            ids, scores = ids[order], scores[order]
            low, high, most = np.concatenate([low[rest], lo, doc + 1]), np.concatenate([high[rest], doc, hi]), np.concatenate([most[rest], sums[: 2 * k]])
            nodes = np.concatenate([nodes[rest], new[: 2 * k]]) if kept else root


class Shard:
    """Collects the documents of a shard, in the order of doc_id, and answers queries."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.numbers: dict[str, int] = {}
        self.docs, self.treaps = 0, None

    def add(self, given: pa.RecordBatch) -> None:
        ids, m, terms, tfs = (given.column(c) for c in ("id", "m", "terms", "nums"))
        sizes = np.diff(terms.offsets.to_numpy())
        coded = terms.flatten().dictionary_encode()
        number = np.array([self.numbers.setdefault(t, len(self.numbers)) for t in coded.dictionary.to_pylist()], np.int64)
        tf, length = tfs.flatten().to_numpy(), np.repeat(m.to_numpy(), sizes)
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * length)
        self.parts.append((number[coded.indices.to_numpy()], np.repeat(np.arange(self.docs, self.docs + len(ids)), sizes), impact))
        self.ids.append(ids)
        self.docs += len(ids)

    def answer(self, item: int, terms: list[str], weights: list[int], top: int) -> pa.RecordBatch | None:
        if not self.parts:
            return None
        if self.treaps is None:
            self.treaps = Treaps(*(np.concatenate(x) for x in zip(*self.parts, strict=True)), len(self.numbers))
            self.all = pa.concat_arrays(self.ids)
        at = [k for k, t in enumerate(terms) if t in self.numbers]
        if not at:
            return None
        found, scores = self.treaps.best(np.array([self.numbers[terms[k]] for k in at]), np.array([weights[k] for k in at], np.int64), self.docs, top)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(found), item)), self.all.take(pa.array(found)), pa.array(scores)], schema=_FOUND)


def _answers(top: int):
    """Rows in the order of (shard, kind, id): a shard's documents, then the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, now = Shard(), None
        for given in batches:
            keys = given.column("shard").to_numpy() * 2 + given.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]
            for s, e in zip(cuts, cuts[1:]):
                if s == e:
                    continue
                if keys[s] // 2 != now:
                    shard, now = Shard(), keys[s] // 2
                some = given.slice(s, e - s)
                if keys[s] % 2 == 0:
                    shard.add(some)
                    continue
                for row in some.select(["id", "terms", "nums"]).to_pylist():
                    if found := shard.answer(row["id"], row["terms"], row["nums"], top):
                        yield found

    return run


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """docs(doc_id, text, ...), items(item_id, text, ...) -> item_id, rank, doc_id, score: each item's best documents.

    Null and empty texts have no terms: such documents aren't counted, such items have no rows. Each row of docs is a document
    and each row of items an item, also where ids repeat. Documents with a null doc_id are counted and can be found; at
    equal scores they come last. An item's repeated terms count as often. Texts of any length are read whole. Without
    documents or items the result is empty. Other columns are not looked at, whatever their names."""
    items = stored(items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), "text"), "items")
    asked = items.select(F.col("item").alias("doc_id"), "text").transform(mapped, _counted(None), _HITS_DDL)
    asked = stored(asked.select(F.col("doc_id").alias("item"), F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("item", F.col("x.terms").alias("term"), F.col("x.tfs").alias("times")), "asked")
    bits = bitmap(asked, F.xxhash64("term"))
    hits = stored(docs.select(F.col("doc_id").cast("long"), "text").transform(mapped, _counted(bits), _HITS_DDL), "hits")
    held = hits.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    n, length, postings = (int(x) for x in held)
    df = hits.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = asked.join(df, "term").select("item", "term", (F.col("times") * weight).alias("w")).where("w > 0")
    queries = weighed.groupBy("item").agg(F.collect_list(F.struct("term", "w")).alias("x"))
    queries = stored(queries.select("item", F.col("x.term").alias("terms"), F.col("x.w").alias("nums")), "queries")
    shards = max(1, -(-postings // SHARD))
    dealt = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    m = F.expr(f"75 + (25 * n * {n}L) div {max(1, length)}L")
    rows = hits.select(dealt.alias("shard"), F.lit(0).alias("kind"), F.col("doc_id").alias("id"), m.alias("m"), "terms", F.col("tfs").alias("nums")).where("size(terms) > 0")
    asks = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), F.col("item").alias("id"), F.lit(None).cast("long").alias("m"), "terms", "nums")
    both = rows.unionByName(asks).repartition(3 * shards, "shard").sortWithinPartitions("shard", "kind", F.col("id").asc_nulls_last())
    found = stored(both.transform(mapped, _answers(top), "item long, doc_id long, score long"), "found")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    first = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return first.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op13_treap_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The same by scoring every document that holds a term.
ORACLE = r"""
WITH t AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM t WHERE len(ts) > 0),
q AS MATERIALIZED (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
p AS MATERIALIZED (SELECT doc_id, len AS n, term, count(*) AS tf FROM (SELECT doc_id, len(ts) AS len, unnest(ts) AS term FROM t) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2.0 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY 1), s),
i AS MATERIALIZED (SELECT doc_id, p.term, w.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) AS x FROM p JOIN w ON w.term = p.term, s),
r AS (SELECT item_id, doc_id, CAST(sum(x) AS BIGINT) AS score FROM q JOIN i ON i.term = q.term GROUP BY 1, 2)
SELECT item_id, rank, doc_id, score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r WHERE score > 0) WHERE rank <= 20
"""
