"""Operator 3, MinHash near-duplicates by odd sketches.

Each text's set of five-word shingles is sampled by 128 MinHash functions. 32 bands of 4 samples give buckets; a pair
of similarity 0.75 misses all of them with a probability of 5e-6. The samples are also folded into a 512-bit parity
bitmap, the odd sketch: the population count of two sketches' XOR estimates how many samples differ, and precisely so
for high similarities. A second bitmap folds the whole set; its XOR count never exceeds the true difference, so beyond
(|A| + |B|) / 7 a pair is surely below 0.75. Pairs that pass both are confirmed on full sets.

Texts with equal sets are one class and only the least id goes on. A bucket is first linked as a star to its most
central member (the one whose buckets are largest), so a group of copies costs one comparison a member. Where the confirmed
links leave a bucket with several components, each member outside the largest one is compared with all members outside
its own component, by sizes and bitmaps in blocks of BLOCK members; only pairs that these allow go on. So no link between
components is lost and no bucket is gathered in one task. The price is a square: N members of one bucket that have no
links to each other cost N * N / 2 comparisons of bitmaps and N / BLOCK copies of each member's bitmaps.

Sizes, leaders and largest components of buckets are stored before they are joined back: both sides of such a join are
then exchanges of its own, which adaptive execution can split at a hot bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, mapped, pieces, stored, table
from .components import components
from .shingles import WordHashes, shingle_set

SAMPLES, BAND_ROWS, ODD_BITS, PARITY_BITS, BLOCK = 128, 4, 512, 1024, 1024
#: At similarity 0.75 a pair's odd sketches differ in about 57 bits, with a deviation of 9; 110 is over five deviations away.
ODD_MOST = 110
_NODE = "_near_dedup_node_"

_FEATURES = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64())), ("odd", pa.list_(pa.int64())), ("parity", pa.list_(pa.int64()))])
_FEATURES_DDL = "doc_id long, n_shingles long, set_key binary, bands array<long>, odd array<long>, parity array<long>"


def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    a = (rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    b = rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)
    return a[:, None], b[:, None], rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)


def minhash(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (found >> np.uint64(32)).astype(np.uint32)
    out = None
    for at in range(0, len(x), 4096):
        least = (x[None, at : at + 4096] * a + b).min(1)
        out = least if out is None else np.minimum(out, least)
    return out


def folded(values: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmap: bit value % bits is set if an odd number of values fall on it."""
    odd = np.bincount((values % np.uint64(bits)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b, salt = _functions()
    seen = WordHashes()
    m = np.uint64(0x9E3779B97F4A7C15)
    for given in batches:
        ids, texts = given.column(0), given.column(1).to_pylist()
        for start, end in pieces(texts):
            n, keys, bands, odds, parities = [], [], [], [], []
            for text in texts[start:end]:
                found = shingle_set(text, seen)
                n.append(len(found))
                if not len(found):
                    keys.append(None), bands.append(None), odds.append(None), parities.append(None)
                    continue
                sample = minhash(found, a, b)
                keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                bands.append(np.array([xxhash.xxh3_64_intdigest(sample[k : k + BAND_ROWS].tobytes(), seed=k) for k in range(0, SAMPLES, BAND_ROWS)], np.uint64).view(np.int64))
                each = (sample.astype(np.uint64) ^ salt) * m
                odds.append(folded(each >> np.uint64(40), ODD_BITS))
                parities.append(folded(found >> np.uint64(7), PARITY_BITS))
            yield batch(_FEATURES, {"doc_id": ids.slice(start, end - start).cast(pa.int64()), "n_shingles": n, "set_key": keys, "bands": bands, "odd": odds, "parity": parities})


def features(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, key of the shingle set, band hashes, odd sketch of the samples, parity bitmap of the set."""
    return docs.select(F.col("doc_id").cast("long"), "text").transform(mapped, _features, _FEATURES_DDL)


def _apart(x: str, y: str) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("int")), F.lit(0), lambda s, v: s + v)


def plausible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes, odd sketches and parity bitmaps allow."""
    side = lambda k: sketches.select(F.col("doc_id").alias(k), *(F.col(c).alias(f"{c}_{k}") for c in ("n_shingles", "odd", "parity")))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    fits = (F.least("n_shingles_a", "n_shingles_b") * 100 >= F.greatest("n_shingles_a", "n_shingles_b") * 75) & (_apart("odd_a", "odd_b") <= ODD_MOST)
    return both.where(fits & (_apart("parity_a", "parity_b") * 7 <= F.col("n_shingles_a") + F.col("n_shingles_b"))).select("a", "b")


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, last = WordHashes(), (None, None)
    for given in batches:
        a, b, x, y = (given.column(k).to_pylist() for k in range(4))
        keep = []
        for k in range(len(a)):
            if last[0] != a[k]:
                last = a[k], shingle_set(x[k], seen)
            other = shingle_set(y[k], seen)
            both = len(np.intersect1d(last[1], other, assume_unique=True))
            keep.append(100 * both >= 75 * (len(last[1]) + len(other) - both) > 0)
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([given.column(0).filter(mask), given.column(1).filter(mask)], names=["a", "b"])


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that 100 * |A and B| >= 75 * |A or B| holds for, on full sets made again from the texts."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    need = pairs.select("a").unionAll(pairs.select("b")).distinct().withColumnRenamed("a", "id")
    some = stored(texts.join(need, "id", "left_semi"), "texts")
    both = pairs.join(some.select(F.col("id").alias("b"), F.col("text").alias("y")), "b").join(some.select(F.col("id").alias("a"), F.col("text").alias("x")), "a")
    return both.select("a", "b", "x", "y").transform(mapped, _linked, "a long, b long")


_CROSS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _bits(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64).reshape(-1, width)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by (bucket, i, j) -> pairs of different components that may be linked."""

    def compared(t: pa.Table) -> pa.RecordBatch | None:
        t = t.combine_chunks()
        doc, comp, n, minor = (t[c].to_numpy() for c in ("doc_id", "comp", "n_shingles", "minor"))
        odd, parity = (_bits(t[c].combine_chunks(), w // 64) for c, w in (("odd", ODD_BITS), ("parity", PARITY_BITS)))
        left = np.flatnonzero(minor)
        right = left if t["i"][0].as_py() < 0 else np.flatnonzero(~minor)
        a, b = [], []
        for k in left:
            ok = right[(comp[right] != comp[k]) & (np.minimum(n[right], n[k]) * 100 >= np.maximum(n[right], n[k]) * 75)]
            ok = ok[np.bitwise_count(odd[ok] ^ odd[k]).sum(1) <= ODD_MOST] if len(ok) else ok
            ok = ok[np.bitwise_count(parity[ok] ^ parity[k]).sum(1).astype(np.int64) * 7 <= n[ok] + n[k]] if len(ok) else ok
            a.append(np.minimum(doc[ok], doc[k]))
            b.append(np.maximum(doc[ok], doc[k]))
        if not a or not sum(map(len, a)):
            return None
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
        return batch(_CROSS, {"a": pairs[0], "b": pairs[1]})

    held: list[pa.Table] = []
    key = None
    for given in batches:
        t = pa.Table.from_batches([given])
        keys = np.stack([t[c].to_numpy() for c in ("bucket", "i", "j")])
        if not t.num_rows:
            continue
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1), t.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            if (now := tuple(keys[:, s])) != key:
                if held and (out := compared(pa.concat_tables(held))):
                    yield out
                key, held = now, []
            held.append(t.slice(s, e - s))
    if held and (out := compared(pa.concat_tables(held))):
        yield out


def _crossing(members: DataFrame, comp: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) of one bucket but different components that may be linked."""
    rows = members.join(comp.select(F.col("node").alias("doc_id"), F.col("component").alias("comp")), "doc_id", "left").withColumn("comp", F.coalesce("comp", "doc_id"))
    rows = stored(rows.select("bucket", "doc_id", "comp"), "members")
    each = rows.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("k"))
    mixed = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.sum("k").alias("all"), F.max(F.struct("k", "comp")).alias("top")).where("parts > 1")
    mixed = mixed.select("bucket", F.col("top.comp").alias("top"), F.ceil(F.col("top.k") / BLOCK).alias("majors"), F.ceil((F.col("all") - F.col("top.k")) / BLOCK).alias("minors"))
    mixed = stored(mixed, "mixed")
    rows = rows.join(mixed, "bucket").withColumn("minor", F.expr("comp <> top"))
    at = F.expr("pmod(xxhash64(doc_id), IF(minor, minors, majors))")
    rows = rows.withColumn("at", at)
    pair = lambda i, j: F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1)
    among = F.transform(upto("minors"), lambda j: pair(-1 - F.least(j, F.col("at")), F.greatest(j, F.col("at"))))
    keys = F.when(F.col("minor"), F.concat(F.transform(upto("majors"), lambda i: pair(i, F.col("at"))), among)).otherwise(F.transform(upto("minors"), lambda j: pair(F.col("at"), j)))
    rows = rows.select("bucket", "doc_id", "comp", "minor", F.explode(keys).alias("key")).select("bucket", "key.i", "key.j", "doc_id", "comp", "minor")
    rows = rows.join(sketches.select("doc_id", "n_shingles", "odd", "parity"), "doc_id")
    dealt = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return dealt.transform(mapped, _across, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, n_shingles, component_id, kept, class_id; one row per row of docs.

    Null or empty texts have no shingles and are linked with nothing. A null doc_id takes no part: its component is
    null and it is kept. Rows that repeat an id are one node. Texts of any length are read whole; of equal sizes or weights the
    least id leads. Other columns of docs are not looked at; without rows the result is empty."""
    found = stored(features(docs), "features")
    some = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(some.groupBy("set_key").agg(F.min("doc_id").alias("class_id")), "classes")
    sketches = stored(some.join(classes.select(F.col("class_id").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "n_shingles", "bands", "odd", "parity"), "sketches")
    rows = sketches.select("doc_id", F.explode("bands").alias("bucket"))
    shared = stored(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    members = stored(rows.join(shared, "bucket"), "buckets")
    central = members.groupBy("doc_id").agg(F.sum("size").alias("weight"))
    leaders = members.join(central, "doc_id").groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("doc_id")).alias("minus"))).alias("top")).select("bucket", (-F.col("top.minus")).alias("leader"))
    leaders = stored(leaders, "leaders")
    stars = members.join(leaders, "bucket").where("doc_id <> leader").select(F.least("leader", "doc_id").alias("a"), F.greatest("leader", "doc_id").alias("b")).distinct()
    links = stored(confirmed(stored(plausible(stars, sketches), "stars"), docs), "links")
    first = stored(components(links), "components")
    more = stored(confirmed(stored(_crossing(members, first, sketches), "crossing"), docs), "links")
    last = components(links.unionAll(more))
    out = found.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left").join(last.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
    whole = F.coalesce("component", "class_id", "doc_id")
    return out.select("doc_id", "n_shingles", whole.alias("component_id"), F.coalesce(F.col("doc_id") == whole, F.lit(True)).alias("kept"), "class_id")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component of near-duplicates, all columns as they are: one with the least id, rows without an id last.

    Nodes are pairs of id and text by a 63-bit hash, so an id that has several texts loses only those that are copies. Of
    rows that repeat id and text one stays, also of those without shingles."""
    node = F.xxhash64(F.col("doc_id").cast("long"), "text").bitwiseAND(F.lit((1 << 63) - 1))
    found = near_duplicates(docs.select(node.alias("doc_id"), "text")).select(F.col("doc_id").alias("node"), "component_id")
    found = stored(found.groupBy("node").agg(F.first("component_id").alias("component"), F.count(F.lit(1)).alias("n")), "nodes")
    groups = stored(found.groupBy("component").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("component"), "groups")
    some = found.select("node", "component").join(groups, "component", "left_semi")
    ids = docs.select(node.alias("node"), F.col("doc_id").cast("long").alias("id"))
    best = some.join(ids, "node").groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("first"))
    gone = some.join(best.select(F.col("first.node").alias("node")), "node", "left_anti").select("node")
    again = found.where("n > 1").select("node").join(gone, "node", "left_anti")
    left = docs.withColumn(_NODE, node)
    among = lambda df, how: left.join(df.withColumnRenamed("node", _NODE), _NODE, how)
    once = among(stored(gone.unionAll(again), "gone"), "left_anti").unionByName(among(again, "left_semi").dropDuplicates([_NODE]))
    return once.select(*(F.col(f"`{c}`") for c in docs.columns))


def op3_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


#: The same by plain set intersection.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END)) AS sh FROM w),
c AS MATERIALIZED (SELECT doc_id, len(sh) AS n, CASE WHEN len(sh) > 0 THEN min(doc_id) OVER (PARTITION BY sh) END AS class_id FROM s),
x AS MATERIALIZED (SELECT s.doc_id, c.n, unnest(s.sh) AS k FROM s JOIN c ON s.doc_id = c.class_id AND c.doc_id = s.doc_id),
e0 AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS MATERIALIZED (SELECT a, b FROM e0 UNION SELECT b, a FROM e0),
r(n, m) AS (SELECT a, a FROM e UNION SELECT r.n, e.b FROM r JOIN e ON r.m = e.a),
g AS (SELECT n, min(m) AS m FROM r GROUP BY 1)
SELECT c.doc_id, CAST(c.n AS BIGINT) AS n_shingles, coalesce(g.m, c.class_id, c.doc_id) AS component_id, c.doc_id = coalesce(g.m, c.class_id, c.doc_id) AS kept, c.class_id
FROM c LEFT JOIN g ON c.class_id = g.n
"""
