"""Operator 8, nearest neighbours by collision-counting hashing.

Vectors get one more component, so that all have the norm of the largest in their block and the largest inner product is
the least distance. Each axis of a random rotation has a sorted array of the block's projections. Around a query's
projection a window grows, from radius to radius (virtual rehashing: no array is built again), and each vector that
enters it gains a collision. Vectors with COLLISIONS or more, as a share of the projections, are verified by their exact
inner products, in double precision. The window stops growing when a vector as near as the k-th best that is verified
would have had as many collisions with a probability of CERTAIN, taking projections of the difference as normal; nearer
ones are more certain. Nothing else ends the search, whatever the number of vectors: how many are verified follows from
the data, and is a large share where neighbours are hardly nearer than the rest.

Rows that repeat an id are folded first. They are dealt to blocks of about BLOCK vectors and the queries to chunks of
about CHUNK; each block meets each chunk in one task of bounded size, which builds the block's arrays once and hands on
its nearest only. So a block is sent once for every CHUNK queries. All rows are indexed, none is dropped for a full bucket."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batch, table

NEAREST, EVERY = 20, 20
#: Collisions that make a candidate, as a share of the projections; first radius, in deviations of the projections, and
#: its growth; steps that it takes at once at most.
COLLISIONS, FIRST, GROWTH, JUMP = 0.88, 1.2, 1.04, 4
#: Probability that a neighbour at the distance of the k-th best is verified.
CERTAIN = 0.8
BLOCK, CHUNK = 1 << 14, 1 << 16
#: Queries whose windows are kept at a time.
AT_ONCE = 1 << 11


def certain_radius(projections: int, share: float = COLLISIONS, certain: float = CERTAIN) -> float:
    """Radius, for a vector at distance 1, at which it has so large a share of collisions with that probability."""
    z, low, high = NormalDist().inv_cdf(certain), share, 1.0
    for _ in range(50):
        p = (low + high) / 2
        low, high = (p, high) if p - z * (p * (1 - p) / projections) ** 0.5 < share else (low, p)
    return NormalDist().inv_cdf((1 + min(low, 1 - 1e-9)) / 2) / projections**0.5

_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
_FOUND_DDL = "query_id long, vec_id long, score double"


class Block:
    """Sorted projections of a block of vectors with distinct ids, on the axes of a random rotation."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, seed: int = 11) -> None:
        self.ids, self.x = ids, x
        squares = (x * x).sum(1)
        self.norm = np.sqrt(squares.max())
        wide = np.concatenate([x, np.sqrt(np.maximum(0, squares.max() - squares))[:, None]], 1)
        size = wide.shape[1]
        self.directions = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))[0]
        p = (wide @ self.directions).T
        self.order = np.argsort(p, axis=1, kind="stable")
        self.sorted = np.take_along_axis(p, self.order, 1)
        self.step = max(float(np.median(p.std(1))) * FIRST, 1e-300)

    def nearest(self, query_ids: list[int], queries: np.ndarray, k: int):
        """(ids, scores) of each query's k nearest among the vectors that are verified, and how many these are."""
        for s in range(0, len(query_ids), AT_ONCE):
            yield from self._nearest(query_ids[s : s + AT_ONCE], queries[s : s + AT_ONCE], k)

    def _nearest(self, query_ids: list[int], queries: np.ndarray, k: int):
        n, m = len(self.ids), len(self.sorted)
        lengths = np.sqrt((queries * queries).sum(1))
        at = (np.concatenate([queries * (self.norm / lengths)[:, None], np.zeros((len(queries), 1))], 1) @ self.directions).T
        missable, sure = m - int(np.ceil(COLLISIONS * m)), certain_radius(m)
        windows: dict[int, list] = {}

        def window(level: int) -> list:
            if level not in windows:
                r = self.step * GROWTH**level
                windows[level] = [np.stack([np.searchsorted(s, a + d, side) for s, a in zip(self.sorted, at)], 1) for d, side in ((-r, "left"), (r, "right"))]
            return windows[level]

        least = None  # the level at which the quickest query so far has ended: none starts far below it
        for i, (query_id, q) in enumerate(zip(query_ids, queries)):
            level = 0 if least is None else max(0, least - JUMP)
            low, high = (e[i].tolist() for e in window(level))
            missed = np.bincount(np.concatenate([o[:a] for o, a in zip(self.order, low)] + [o[b:] for o, b in zip(self.order, high)]), minlength=n)
            verified, found, rough, count = np.zeros(n, bool), [], [], 0
            best = np.full(k, -np.inf)
            while True:
                new = np.flatnonzero((missed <= missable) & ~verified)
                verified[new] = True
                count += len(new)
                new = new[self.ids[new] != query_id]
                found.append(new), rough.append(self.x[new] @ q)
                both = np.concatenate([best, rough[-1]])
                best = np.partition(both, len(both) - k)[len(both) - k :]
                if count == n:
                    break
                kth = best.min()
                apart = 2 * self.norm * max(0.0, self.norm - kth / lengths[i])  # squared distance of the k-th
                need = sure * np.sqrt(apart) if kth > -np.inf else np.inf
                ahead = next((j for j in range(JUMP) if self.step * GROWTH ** (level + j) >= need), JUMP)
                if not ahead:
                    break
                level += ahead
                new_low, new_high = (e[i].tolist() for e in window(level))
                entered = [o[a:b] for o, a, b in zip(self.order, new_low, low)] + [o[a:b] for o, a, b in zip(self.order, high, new_high)]
                missed -= np.bincount(np.concatenate(entered), minlength=n)
                low, high = new_low, new_high
            least = level if least is None else min(least, level)
            some, rough = np.concatenate(found), np.concatenate(rough)
            some = some[rough >= best.min() - 1e-9 * self.norm * lengths[i]]  # ties with the last of them included
            scores, ids = (self.x[some] * q).sum(1), self.ids[some]
            order = np.lexsort((ids, -scores))[:k]
            yield ids[order], scores[order], count


def usable(c: str | Column, size: int) -> Column:
    """Vectors of so many finite components, not all of them zero."""
    c = F.col(c) if isinstance(c, str) else c
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return c.isNotNull() & (F.size(c) == size) & finite & F.exists(c, lambda x: x != 0)


def _met(t: pa.Table, k: int) -> pa.Table:
    is_query, ids = t["is_query"].to_numpy(), t["vec_id"].to_numpy()
    flat = t["v"].combine_chunks()
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)
    out = ([], [], [])
    if is_query.any() and not is_query.all():
        block = Block(ids[~is_query], x[~is_query])
        queries, first = np.unique(ids[is_query], return_index=True)
        for qid, (found, scores, _) in zip(queries.tolist(), block.nearest(queries.tolist(), x[is_query][first], k)):
            out[0].append(np.full(len(found), qid)), out[1].append(found), out[2].append(scores)
    columns = {n: np.concatenate(c) if c else [] for n, c in zip(_FOUND.names, out)}
    return pa.Table.from_batches([batch(_FOUND, columns)])


def search(vectors: DataFrame, queries: Column, k: int = NEAREST, vector: str = "embedding", block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """vectors(vec_id, embedding, ...) and a condition that tells the queries -> query_id, rank, vec_id, score.

    Each query's k nearest by inner product among all other ids, ties to the smaller id; all of them, if fewer. Vectors
    that are null, zero, of another length than most, or hold null or non-finite components take no part, neither do
    null ids. An id that repeats is one vector, the least of its own. Without queries or vectors the result is empty."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("is_query")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    sizes = rows.groupBy("vec_id", F.size("v").alias("z")).agg(F.max("is_query").alias("is_query")).groupBy("z").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q")).orderBy(F.desc("n"), "z").limit(1).collect()
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks, chunks = max(1, -(-sizes[0].n // block)), max(1, -(-sizes[0].q // chunk))
    rows = rows.where(usable("v", sizes[0].z)).groupBy("vec_id").agg(F.min("v").alias("v"), F.max("is_query").alias("is_query"))
    of = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = rows.select("vec_id", "v", F.lit(False).alias("is_query"), of(blocks).alias("b"), all_of(chunks).alias("c"))
    asked = rows.where("is_query").select("vec_id", "v", "is_query", all_of(blocks).alias("b"), of(chunks).alias("c"))
    met = dealt.unionByName(asked).groupBy("b", "c").applyInArrow(lambda t: _met(t, k), _FOUND_DDL)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_collision_counting_search(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
