"""Operator 6, packing by shortest-pack-first over the histogram of lengths.

Texts become ids, closed by an end id, and are cut at multiples of the sequence length; full pieces are sequences of
their own, so that a text has one remainder at most. The histogram of remainders, which has as many entries as a
sequence has places, is packed on the driver: lengths are placed longest first, each into the pack that holds least,
for all packs of the same pattern at once. Patterns are joined back by rank: the n-th piece of a length goes to the
n-th place that the patterns have for it. Ranks are counted within salted parts of each length, so that a length that
most pieces share is dealt to many tasks."""

from __future__ import annotations

import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import batch, mapped, pieces, stored, table
from .pretokens import BYTES, Plain, byte_characters, vocabulary_path

LENGTH, END_ID = 2048, 1
if array("I").itemsize != 4 or sys.byteorder != "little":
    raise ImportError("ids are packed as little-endian unsigned 32-bit integers")
#: Pieces that one task ranks, about.
RANKED = 200_000

_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


class Ids:
    """Ids of texts, as little-endian unsigned 32-bit bytes; made once in each Python worker.

    The vocabulary file's ids rise in the order of its merges, so they serve as ranks to tiktoken, which gives the same
    ids as the tokenizers library twice to five times as fast. Texts outside the characters that both were compared for
    (pretokens.py), or with special strings, go to the library itself."""

    _made: dict = {}

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.plain = Plain(path)
        back = byte_characters()
        ranks = {bytes(back[c] for c in entry): k for entry, k in self.tokenizer.get_vocab(with_added_tokens=False).items() if entry not in self.plain.special}
        self.encode = tiktoken.Encoding("ranks", pat_str=BYTES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @classmethod
    def made(cls, path: str) -> Ids:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __call__(self, text: str) -> bytes:
        ids = self.encode(text) if self.plain(text) else self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()


def cut(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """docs(doc_id, text) -> doc_id, start, length, ids_crc32, doc_tokens of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = Ids.made(path)
        end = np.array([END_ID], "<u4").tobytes()
        for given in batches:
            ids, texts = given.column(0).to_pylist(), given.column(1).to_pylist()
            for a, b in pieces(texts):
                out: dict = {f.name: [] for f in _PIECES}
                for i in range(a, b):
                    data = memoryview(ids_of(texts[i] or "") + end)
                    total = len(data) // 4
                    for s in range(0, total, length):
                        part = data[4 * s : 4 * (s + length)]
                        for name, value in zip(out, (ids[i], s, len(part) // 4, zlib.crc32(part), total)):
                            out[name].append(value)
                yield batch(_PIECES, out)

    return docs.select(F.col("doc_id").cast("long"), "text").transform(mapped, run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def packed_patterns(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, list[tuple[int, int]]]]:
    """Length to count -> (packs, [(length, copies), ...]) for each pattern.

    Longest first; each length goes into the pack that holds least, as long as it fits, all packs of a pattern at once;
    where none has room, new packs take as many of it as they can."""
    open_: dict[int, list] = defaultdict(list)  # by the room that is left
    done: list = []
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        room = length
        while left:
            while room >= size and not open_[room]:
                room -= 1
            if room < size:
                copies = min(length // size, left)
                packs = left // copies
                left -= packs * copies
                room = length - copies * size
                (open_[room] if room else done).append((packs, [(size, copies)]))
                continue
            packs, pattern = open_[room].pop()
            used = min(packs, left)
            if used < packs:
                open_[room].append((packs - used, pattern))
            left -= used
            pattern = [*pattern[:-1], (size, pattern[-1][1] + 1)] if pattern[-1][0] == size else [*pattern, (size, 1)]
            (open_[room - size] if room > size else done).append((used, pattern))
    return done + [x for r in sorted(open_) for x in open_[r]]


def places(patterns: list) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, packs, first sequence and offset of every run of places that the patterns have for it."""
    out: dict[int, list] = defaultdict(list)
    ranks: dict[int, int] = defaultdict(int)
    sequence = 0
    for packs, pattern in patterns:
        offset = 0
        for size, copies in pattern:
            out[size].append((ranks[size], packs, sequence, offset))
            ranks[size] += packs * copies
            offset += size * copies
        sequence += packs
    return {size: tuple(np.array(x, np.int64).T) for size, x in out.items()}


_PLACED = pa.schema([*_PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])


def packed(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; one row per piece.

    A null or empty text is the end id alone. Null ids stay null; rows that repeat are packed each. Without rows the
    result is empty. Other columns are not looked at. The driver gets the histogram of lengths only, of at most length entries; the
    executors get the places, of which there are a few for each length."""
    spark = docs.sparkSession
    cuts = stored(cut(docs, path or vocabulary_path("byte_bpe_50k.json"), length), "pieces")
    histogram = {r[0]: r[1] for r in cuts.groupBy("length").count().collect()}
    at = spark.sparkContext.broadcast(places(packed_patterns(histogram, length)))
    salts = max(16, sum(histogram.values()) // RANKED)
    salted = cuts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)))
    before = salted.groupBy("length", "salt").count().withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32"))
    before = before.select("length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    ranked = salted.withColumn("nth", nth).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("nth") - 1)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = at.value
        for given in batches:
            t = pa.Table.from_batches([given])
            size, rank = t["length"].to_numpy(), t["rank"].to_numpy()
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            order = np.argsort(size, kind="stable")
            values, first = np.unique(size[order], return_index=True)
            for value, rows in zip(values.tolist(), np.split(order, first[1:])):
                start, packs, base, offsets = table[value]
                k = np.searchsorted(start, rank[rows], "right") - 1
                within = rank[rows] - start[k]
                sequence[rows] = base[k] + within % packs[k]
                offset[rows] = offsets[k] + within // packs[k] * value
            yield batch(_PLACED, {f.name: t[f.name].combine_chunks() for f in _PIECES} | {"sequence_id": sequence, "offset": offset})

    return ranked.select(*_PIECES.names, "rank").transform(mapped, placed, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op6_shortest_pack_first(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))
