"""Operator 12, shards by a consistent-hash ring with bounded loads.

Each shard stands at POINTS places of a ring of 2^60 positions; a document's id has a position too and its home is the
shard of the next place clockwise. A shard takes as many rows as its share and no more: the total divided by the number
of shards, and one more in as many shards as the division leaves over, which are those with most homes. What a shard
can't take goes on clockwise, from place to place, to the first shards that have room when all have taken in their
own. So counts are at most one apart (the law `rows`), and most rows are at home whatever else there is.

Rows between two places are an arc, and within it they stand in the order of a hash of their texts, then of their
positions. The driver sees only how many rows each arc has (places are few and don't grow with the rows) and answers with
runs: of an arc, rows from rank to rank go to a shard, at these slots. A row's rank in its arc is made of how many rows the
arc's earlier cells have, 256 to an arc, and of a running sum within the cell. Rows that repeat count as one row with a
number, for each input partition, so neither a frequent id nor a frequent row is gathered in one task.

Equal texts are not kept together: a group of copies may be larger than a shard's share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table

SHARDS, POINTS, SECTOR_BITS, CELL_BITS = 24, 128, 12, 8
_ARC, _POS, _MARK, _PART, _CELL, _RANK = "_ring_arc_", "_ring_pos_", "_ring_mark_", "_ring_part_", "_ring_cell_", "_ring_rank_"


def position(key: str) -> int:
    """60 bits of a key's MD5."""
    return int(hashlib.md5(key.encode()).hexdigest()[:15], 16)


def ring(shards: int, points: int = POINTS) -> list[tuple[int, int]]:
    """(position, shard) of all places, clockwise. A shard's places don't depend on how many other shards there are."""
    return sorted((position(f"shard {s} point {k}"), s) for s in range(shards) for k in range(points))


def shares(homes: list[int]) -> list[int]:
    """How many rows each shard takes, from how many have their home there."""
    share, more = divmod(sum(homes), len(homes))
    first = sorted(range(len(homes)), key=lambda s: (-homes[s], s))[:more]
    return [share + (s in first) for s in range(len(homes))]


def runs(counts: list[int], owners: list[int], shards: int) -> Iterable[tuple[int, int, int, int, int]]:
    """(arc, first rank, rank after the last, shard, slot of the first) for arcs with so many rows, clockwise."""
    homes = [0] * shards
    for n, s in zip(counts, owners, strict=True):
        homes[s] += n
    most, filled, over = shares(homes), [0] * shards, []
    for arc, (n, s) in enumerate(zip(counts, owners, strict=True)):
        stay = min(n, most[s] - filled[s])
        if stay:
            yield arc, 0, stay, s, filled[s]
        filled[s] += stay
        if stay < n:
            over.append((arc, stay, n))
    for arc, rank, n in over:
        at = arc
        while rank < n:
            at = (at + 1) % len(owners)
            s = owners[at]
            if take := min(n - rank, most[s] - filled[s]):
                yield arc, rank, rank + take, s, filled[s]
                rank, filled[s] = rank + take, filled[s] + take


def _position(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def _arcs(rows: DataFrame, places: list[tuple[int, int]]) -> DataFrame:
    """Rows with the number of the next place clockwise, found among the few places of a 4096th of the ring."""
    spark, shift = rows.sparkSession, 60 - SECTOR_BITS
    by: list[list[tuple[int, int]]] = [[] for _ in range(1 << SECTOR_BITS)]
    for arc, (pos, _) in enumerate(places):
        by[pos >> shift].append((pos, arc))
    after, sectors = 0, []
    for sector in range(len(by) - 1, -1, -1):
        sectors.append((sector, by[sector], after))
        after = by[sector][0][1] if by[sector] else after
    small = spark.createDataFrame(sectors, "_sector_ int, _places_ array<struct<pos: long, arc: int>>, _after_ int")
    found = rows.withColumn("_sector_", F.shiftright(_POS, shift).cast("int")).join(F.broadcast(small), "_sector_")
    arc = F.expr(f"coalesce(get(filter(_places_, p -> p.pos >= {_POS}), 0).arc, _after_)")
    return found.withColumn(_ARC, arc).drop("_sector_", "_places_", "_after_")


def placed(rows: DataFrame, key: Column, content: Column, shards: int = SHARDS, points: int = POINTS) -> DataFrame:
    """Rows with `shard` and `slot`: slots of a shard are gapless from 0.

    key, a string, decides where a row's home is; content, a string, the order within an arc. Rows with equal keys and contents
    are interchangeable: which of them gets which slot is open. Null keys take their contents' place, null contents
    count as empty. Without rows the result is empty. All other columns stay as they are; shard and slot must be new."""
    kept, cell = rows.columns, F.shiftright(_MARK, 60 - CELL_BITS)
    content = F.coalesce(content, F.lit(""))
    places = ring(shards, points)
    at = rows.withColumns({_POS: _position(F.coalesce(key, F.concat(F.lit("content "), F.md5(content)))), _MARK: _position(content)})
    at = stored(_arcs(at, places).withColumn(_PART, F.spark_partition_id()), "ring")
    counts = [0] * len(places)
    for arc, n in at.groupBy(_ARC).count().collect():
        counts[arc] = n
    same = [_ARC, _MARK, _POS, _PART]
    groups = stored(at.groupBy(*same).agg(F.count(F.lit(1)).alias("_n_")).withColumn(_CELL, cell), "groups")
    before = lambda by, order: F.coalesce(F.sum("_n_").over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = groups.groupBy(_ARC, _CELL).agg(F.sum("_n_").alias("_n_")).select(_ARC, _CELL, before([_ARC], [_CELL]).alias("_start_"))
    within = groups.withColumn("_first_", before([_ARC, _CELL], [_MARK, _POS, _PART])).drop("_n_")
    cells = stored(cells, "cells")
    starts = stored(within.join(cells, [_ARC, _CELL]).select(*same, (F.col("_first_") + F.col("_start_")).alias("_first_")), "starts")
    copy = F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0)))
    ranked = at.join(starts, same).withColumn(_RANK, F.col("_first_") + copy - 1)
    plan = list(runs(counts, [s for _, s in places], shards))
    to = rows.sparkSession.createDataFrame(plan, f"{_ARC} int, _from_ long, _to_ long, shard int, _slot_ long")
    found = ranked.join(F.broadcast(to), _ARC).where(f"{_RANK} >= _from_ AND {_RANK} < _to_")
    return found.select(*(F.col(f"`{c}`") for c in kept), "shard", (F.col("_slot_") + F.col(_RANK) - F.col("_from_")).alias("slot"))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """docs(doc_id, text, ...) with shard and slot, all columns as they are."""
    return placed(docs, F.col("doc_id").cast("string"), F.col("text"), shards)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Writes docs as one folder a shard, rows in the order of slots; a shard's rows are written by several tasks."""
    out = sharded(docs, shards)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op12_bounded_ring(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.md5(text).alias("content"))
    found = placed(docs, F.col("doc_id").cast("string"), F.col("content"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The same ring; overflow is passed on place by place.
ORACLE = r"""
WITH RECURSIVE t AS (SELECT i, list_reduce(list_prepend(i, [1 for x in range(8)]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM (SELECT unnest(range(CAST(256 AS BIGINT))) AS i)),
crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS v FROM t),
d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS MATERIALIZED (SELECT doc_id, CAST(length(h) // 2 + 8 AS BIGINT) AS size, md5(text) AS content,
      xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(h), 2), lambda i: CAST(('0x' || h[i : i + 1]) AS BIGINT))), lambda a, x: xor(a >> 8, v[(xor(a, x) & 255) + 1])), 4294967295) AS text_crc32 FROM d, crc),
r AS MATERIALIZED (SELECT *, CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), 'content ' || md5(content)))[1 : 15] AS BIGINT) AS pos, CAST('0x' || md5(content)[1 : 15] AS BIGINT) AS mark FROM b),
v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY pos) - 1 AS arc, pos, shard FROM (SELECT shard, CAST('0x' || md5('shard ' || shard || ' point ' || k)[1 : 15] AS BIGINT) AS pos FROM (SELECT unnest(range(24)) AS shard), (SELECT unnest(range(128)) AS k))),
a AS MATERIALIZED (SELECT r.*, coalesce(v.arc, 0) AS arc FROM r ASOF LEFT JOIN v ON r.pos <= v.pos),
k AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY arc ORDER BY mark, pos) - 1 AS rank FROM a),
c AS MATERIALIZED (SELECT v.arc, v.shard, count(a.arc) AS n FROM v LEFT JOIN a ON a.arc = v.arc GROUP BY 1, 2),
m AS MATERIALIZED (SELECT shard, sum(sum(n)) OVER () // 24 + CASE WHEN row_number() OVER (ORDER BY sum(n) DESC, shard) <= sum(sum(n)) OVER () % 24 THEN 1 ELSE 0 END AS most FROM c GROUP BY shard),
f AS MATERIALIZED (SELECT arc, c.shard, n, most, coalesce(sum(n) OVER (PARTITION BY c.shard ORDER BY arc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS slot FROM c JOIN m ON m.shard = c.shard),
g AS MATERIALIZED (SELECT *, greatest(0, least(n, most - slot)) AS stay FROM f),
o AS MATERIALIZED (SELECT list({'arc': arc, 'stay': stay, 'n': n} ORDER BY arc) AS xs FROM g WHERE stay < n),
w AS MATERIALIZED (SELECT (SELECT list(shard ORDER BY arc) FROM v) AS owners, (SELECT list(CAST(most AS BIGINT) ORDER BY shard) FROM m) AS most, xs FROM o WHERE xs IS NOT NULL),
e AS (SELECT 1 AS x, xs[1].arc AS place, xs[1].stay AS rank, CAST(0 AS HUGEINT) AS take, CAST(0 AS BIGINT) AS shard, CAST(0 AS BIGINT) AS slot, CAST(-1 AS BIGINT) AS arc,
           (SELECT list(CAST(s AS BIGINT) ORDER BY shard) FROM (SELECT shard, sum(stay) AS s FROM g GROUP BY 1)) AS filled FROM w
      UNION ALL
      SELECT CASE WHEN done THEN x + 1 ELSE x END, CASE WHEN done THEN xs[x + 1].arc ELSE nxt END, CASE WHEN done THEN xs[x + 1].stay ELSE rank + took END, took, s, filled[s + 1], xs[x].arc,
             list_transform(filled, lambda y, i: CASE WHEN i = s + 1 THEN CAST(y + took AS BIGINT) ELSE y END)
      FROM (SELECT *, rank + took = xs[x].n AS done FROM (SELECT *, least(xs[x].n - rank, most[s + 1] - filled[s + 1]) AS took FROM
           (SELECT *, owners[nxt + 1] AS s FROM (SELECT e.x, e.place, e.rank, e.filled, w.*, (e.place + 1) % 3072 AS nxt FROM e, w WHERE e.x <= len(w.xs)))))),
h AS MATERIALIZED (SELECT arc, CAST(0 AS HUGEINT) AS lo, stay AS hi, shard, slot FROM g WHERE stay > 0
      UNION ALL SELECT arc, lo, lo + take, shard, slot FROM (SELECT *, (SELECT stay FROM g WHERE g.arc = e.arc) + coalesce(sum(take) OVER (PARTITION BY arc ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo
           FROM (SELECT *, row_number() OVER (ORDER BY x, list_sum(filled)) AS step FROM e WHERE take > 0) AS e))
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(h.shard AS INTEGER) AS shard, CAST(h.slot + rank - h.lo AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM k JOIN h ON h.arc = k.arc AND k.rank >= h.lo AND k.rank < h.hi
"""
