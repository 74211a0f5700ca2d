"""Operator 7, removal of repeated passages by suffix arrays.

A byte goes if it lies in a 200-byte string that starts at two places of the corpus or more. Three steps find these
strings without a suffix array of the whole corpus:

1. Anchors. A 200-byte string holds 137 strings of 64 bytes; the one with the least hash is its anchor, so equal strings
   have equal anchors. Anchors are dealt by hash; those that occur once are dropped.
2. Contexts. The 200-byte strings of an anchor start next to each other; what they cover is its context. Where two
   occurrences have equal contexts, these bytes are repeated. Each anchor with several contexts hands on one occurrence
   of each.
3. Shards. The contexts of an anchor meet in one shard. Its suffix array is made by induced sorting; permuted common
   prefixes of 200 bytes or more between neighbours tell the strings that repeat.

Equal contexts, and so exact copies, are settled by step 2 and meet no suffix array. An anchor with more contexts than a
shard should hold (a short passage within a great many different texts) is not gathered in one shard either: its 200-byte
strings are dealt by their 128-bit hashes and pre-aggregated. Both ways give the same spans."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, mapped, pieces, stored, table
from .induced import common_prefixes, suffix_array

LENGTH, GRAM = 200, 64
REACH = LENGTH - GRAM
SHARD_BYTES, GROUP_MOST = 1 << 19, 1024
#: A text is looked at in slices of so many bytes, which overlap by a window.
SLICE = 1 << 22
_PLACE = np.uint64((1 << 23) - 1)

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64))
_TABLE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Powers:
    """Powers of the base and of its inverse, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", _P), ("down", _P_INVERSE)):
                x = np.full(size, base)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))


def gram_hashes(data: np.ndarray, powers: _Powers) -> np.ndarray:
    n = len(data)
    powers.upto(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * powers.up[:n])])
    h = (sums[GRAM:] - sums[:-GRAM]) * powers.down[: n - GRAM + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def anchors(data: np.ndarray, powers: _Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the anchors; starts and ends of what their LENGTH-byte strings cover."""
    if len(data) > SLICE + LENGTH:
        parts = [(s, anchors(data[s : s + SLICE + LENGTH - 1], powers)) for s in range(0, len(data) - LENGTH + 1, SLICE)]
        return tuple(np.concatenate([x[k] + (s if k else np.uint64(0)) for s, x in parts]) for k in range(3))
    if len(data) < LENGTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, w = gram_hashes(data, powers), REACH + 1
    # a hash with its place in the lowest bits: of equal ones the first is least
    least, have = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), 1
    while have < w:
        step = min(have, w - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    last = np.append(first[1:], len(least)) - 1
    return h[least[first] & _PLACE], first, last + LENGTH


def _row_key() -> tuple[Column, Column]:
    """What tells the rows of docs apart: doc_id, 0 for null, and a hash of the text and of whether the id is null."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")), F.xxhash64("text", F.col("doc_id").isNull())


_ANCHORS = pa.schema([("f", pa.int64()), ("ctx", pa.int64()), ("did", pa.int64()), ("rk", pa.int64()), ("s", pa.int32()), ("e", pa.int32()), ("more", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))])


def _anchor_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = _Powers()
    for given in batches:
        texts = given.column(0).to_pylist()
        for start, end in pieces(texts):
            found = []
            for t in texts[start:end]:
                values, counts = np.unique(anchors(np.frombuffer(t.encode(), np.uint8), powers)[0], return_counts=True)
                found += [values, values[counts > 1]]  # twice at most
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["f"])


def _thinned(ctxs: list[int], s: list[int], e: list[int]) -> tuple[list[int], list]:
    """Of equal contexts in one text, the first two stand for all: their places, and on the second what the others cover."""
    seen: dict[int, int] = {}
    keep: list[int] = []
    more: list = []
    for k, c in enumerate(ctxs):
        first = seen.get(c)
        if first is None:
            seen[c] = -1
        elif first < 0:
            seen[c] = len(keep)
        else:
            spans = more[first] = more[first] or []
            if spans and s[k] <= spans[-1]["e"]:
                spans[-1]["e"] = max(e[k], spans[-1]["e"])
            else:
                spans.append({"s": s[k], "e": e[k]})
            continue
        keep.append(k)
        more.append(None)
    return keep, more


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = _Powers()
    digest = xxhash.xxh3_64_intdigest
    for given in batches:
        texts, ids, keys = (given.column(k).to_pylist() for k in range(3))
        for start, end in pieces(texts):
            fs, ctxs, froms, tos, mores, dids, rks, counts = [], [], [], [], [], [], [], []
            for i in range(start, end):
                data = (texts[i] or "").encode()
                h, s, e = anchors(np.frombuffer(data, np.uint8), powers)
                if not len(h):
                    continue
                view = memoryview(data)
                froms_, tos_ = s.tolist(), e.tolist()
                mine, more = [digest(view[a:b]) for a, b in zip(froms_, tos_)], [None] * len(h)
                if len(set(mine)) < len(mine):
                    keep, more = _thinned(mine, froms_, tos_)
                    mine, h, s, e = [mine[k] for k in keep], h[keep], s[keep], e[keep]
                ctxs += mine
                mores += more
                fs.append(h), froms.append(s), tos.append(e)
                dids.append(ids[i]), rks.append(keys[i]), counts.append(len(h))
            if fs:
                yield batch(_ANCHORS, {"f": np.concatenate(fs).view(np.int64), "ctx": np.array(ctxs, np.uint64).view(np.int64), "did": np.repeat(dids, counts), "rk": np.repeat(np.array(rks, np.int64), counts), "s": np.concatenate(froms).astype(np.int32), "e": np.concatenate(tos).astype(np.int32), "more": mores})


_CONTEXTS = pa.schema([("f", pa.int64()), ("many", pa.bool_()), ("did", pa.int64()), ("rk", pa.int64()), ("start", pa.int32()), ("bytes", pa.binary())])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(did, rk, text, wanted contexts) -> the contexts' bytes. Rows that repeat come one after another and are cut once."""
    last = None
    for given in batches:
        dids, rks, texts = (given.column(k).to_pylist() for k in range(3))
        for at, end in pieces(texts, 1 << 21):
            out: dict = {f.name: [] for f in _CONTEXTS}
            for k, wanted in zip(range(at, end), given.column(3).slice(at, end - at).to_pylist()):
                if last == (dids[k], rks[k]):
                    continue
                last, data = (dids[k], rks[k]), (texts[k] or "").encode()
                for x in wanted:
                    for name, value in (("f", x["f"]), ("many", x["many"]), ("did", dids[k]), ("rk", rks[k]), ("start", x["s"]), ("bytes", data[x["s"] : x["e"]])):
                        out[name].append(value)
            if out["f"]:
                yield batch(_CONTEXTS, out)


_SPANS = pa.schema([("did", pa.int64()), ("rk", pa.int64()), ("s", pa.int32()), ("e", pa.int32())])


def _runs(owner: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of LENGTH-byte strings, ordered within owners -> owner, start and end of what they cover."""
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (starts[1:] > starts[:-1] + LENGTH)
    first = np.flatnonzero(fresh)
    return owner[first], starts[first], starts[np.append(first[1:] - 1, len(starts) - 1)] + LENGTH


def repeated(parts: list[bytes], many: np.ndarray, text_of: np.ndarray, start_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts -> (context, start, end) of what is repeated, by the suffix array of all of them.

    many: contexts that occur several times. text_of, start_of: where each lies; the same place in two contexts isn't
    a repetition. Between contexts stands a symbol that is no byte, so nothing that crosses a border equals what doesn't."""
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes + 1) - 1
    data = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.int16) + 1
    data[ends] = 0
    sa = suffix_array(data)
    lcp = common_prefixes(data, sa)
    part = np.repeat(np.arange(len(parts)), sizes + 1)
    room = ends[part] - np.arange(len(data))
    fits = room[sa] >= LENGTH
    joined = (lcp >= LENGTH) & fits
    joined[1:] &= fits[:-1]
    joined[0] = False
    group = np.cumsum(~joined)
    sizes_of = np.bincount(group)
    some = np.flatnonzero((sizes_of[group] > 1) & fits)
    p = sa[some]
    owner, group = part[p], group[some]
    place = start_of[owner] + p - (ends - sizes)[owner]
    order = np.lexsort((place, text_of[owner], group))
    owner, group, place, p = owner[order], group[order], place[order], p[order]
    differs = np.zeros(len(p), bool)
    differs[1:] = (group[1:] == group[:-1]) & ((place[1:] != place[:-1]) | (text_of[owner[1:]] != text_of[owner[:-1]]))
    bad = np.zeros(int(group[-1]) + 1 if len(group) else 1, bool)
    bad[group[differs | many[owner]]] = True
    hit = bad[group]
    owner, place = owner[hit], place[hit]
    order = np.lexsort((place, owner))
    if not len(order):
        return owner, place, place
    return _runs(owner[order], place[order])


def _sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts ordered by anchor -> repeated spans; anchors that are neighbours share a shard."""

    def solved(t: pa.Table) -> pa.RecordBatch:
        places = np.stack([t[c].to_numpy() for c in ("f", "did", "rk", "start")])
        if len(once := np.unique(places, axis=1, return_index=True)[1]) < t.num_rows:  # rows that repeat, from different tasks
            t = t.take(pa.array(np.sort(once)))
        did, rk, start = (t[c].to_numpy() for c in ("did", "rk", "start"))
        text_of = np.unique(np.stack([did, rk]), axis=1, return_inverse=True)[1].ravel()
        owner, s, e = repeated(t["bytes"].to_pylist(), t["many"].to_numpy(), text_of, start.astype(np.int64))
        return batch(_SPANS, {"did": did[owner], "rk": rk[owner], "s": s.astype(np.int32), "e": e.astype(np.int32)})

    held, size, last = [], 0, None
    for given in batches:
        t = pa.Table.from_batches([given])
        f = t["f"].to_numpy()
        if not len(f):
            continue
        cuts = [0, *(np.flatnonzero(f[1:] != f[:-1]) + 1), len(f)]
        weight = np.concatenate([[0], np.cumsum(pc.binary_length(t["bytes"]).to_numpy())])
        begin = 0
        for s, e in zip(cuts, cuts[1:]):
            if size + weight[s] - weight[begin] >= SHARD_BYTES and f[s] != last:
                if s > begin:
                    held.append(t.slice(begin, s - begin))
                yield solved(pa.concat_tables(held))
                held, size, begin = [], 0, s
            last = f[s]
        held.append(t.slice(begin))
        size += weight[-1] - weight[begin]
    if held:
        yield solved(pa.concat_tables(held))


_STRINGS = pa.schema([("h", pa.binary()), ("did", pa.int64()), ("rk", pa.int64()), ("s", pa.int32()), ("many", pa.bool_())])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for given in batches:
        out: dict = {f.name: [] for f in _STRINGS}
        for x in given.to_pylist():
            view = memoryview(x["bytes"])
            for k in range(len(view) - LENGTH + 1):
                for name, value in (("h", xxhash.xxh3_128_digest(view[k : k + LENGTH])), ("did", x["did"]), ("rk", x["rk"]), ("s", x["start"] + k), ("many", x["many"])):
                    out[name].append(value)
        yield batch(_STRINGS, out)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> (did, rk, s, e): byte ranges of each text that are repeated; they may overlap.

    did, rk: what tells rows apart. Anchors that recur, and those with several contexts, are stored before they are joined
    back, so that adaptive execution can split a hot one."""
    did, rk = _row_key()
    texts = docs.select("text", did.alias("did"), rk.alias("rk")).where(F.octet_length("text") >= LENGTH)
    found = texts.transform(mapped, _anchored, "f long, ctx long, did long, rk long, s int, e int, more array<struct<s:int,e:int>>")
    again = stored(texts.select("text").transform(mapped, _anchor_hashes, "f long").groupBy("f").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("f"), "again")
    places = stored(found.join(again, "f"), "anchors")
    contexts = stored(places.groupBy("f", "ctx").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("did", "rk", "s", "e")).alias("at")), "contexts")
    whole = places.join(contexts.where("n > 1").select("f", "ctx"), ["f", "ctx"]).select("did", "rk", F.explode(F.concat(F.array(F.struct("s", "e")), F.coalesce("more", F.array().cast("array<struct<s:int,e:int>>")))).alias("span")).select("did", "rk", "span.*")
    kinds = stored(contexts.groupBy("f").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "kinds")
    wanted = contexts.join(kinds, "f").select("f", "kinds", (F.col("n") > 1).alias("many"), "at.*")
    by_text = wanted.groupBy("did", "rk").agg(F.collect_list(F.struct("s", "e", "f", (F.col("kinds") > GROUP_MOST).alias("huge"), "many")).alias("wanted"))
    sides = texts.join(by_text, ["did", "rk"])
    spans = whole
    for huge in (False, True):
        some = sides.select("did", "rk", "text", F.filter("wanted", lambda x: x.huge if huge else ~x.huge).alias("wanted")).where(F.size("wanted") > 0)
        cut = some.transform(mapped, _cut_out, "f long, many boolean, did long, rk long, start int, bytes binary")
        if huge:
            strings = cut.transform(mapped, _strings, "h binary, did long, rk long, s int, many boolean").distinct()
            bad = strings.groupBy("h").agg((F.count(F.lit(1)) + F.max(F.col("many").cast("int"))).alias("n")).where("n > 1").select("h")
            spans = spans.unionAll(strings.join(bad, "h").select("did", "rk", "s", (F.col("s") + LENGTH).cast("int").alias("e")))
        else:
            dealt = cut.repartition("f").sortWithinPartitions("f")
            spans = spans.unionAll(dealt.transform(mapped, _sharded, "did long, rk long, s int, e int"))
    return spans


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _without(text: str | None, spans: list | None) -> tuple[bytes, bytes, int]:
    """The text's bytes, what is left of them, and the number of maximal runs that go."""
    data = (text or "").encode()
    if not spans:
        return data, data, 0
    rest, done, runs, reach = [], 0, 0, -1
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if s > reach:
            runs += 1
            rest.append(data[done:s])
        reach = done = max(e, reach)
    rest.append(data[done:])
    return data, b"".join(rest), runs


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for given in batches:
        texts = given.column(1).to_pylist()
        for at, end in pieces(texts):
            out: dict = {f.name: [] for f in _RESULT}
            out["doc_id"] = given.column(0).slice(at, end - at)
            for text, spans in zip(texts[at:end], given.column(2).slice(at, end - at).to_pylist()):
                data, kept, runs = _without(text, spans)
                for name, value in (("n_bytes", len(data)), ("n_removed", len(data) - len(kept)), ("n_spans", runs), ("kept_sha256", hashlib.sha256(kept).hexdigest()), ("kept", kept)):
                    out[name].append(value)
            yield batch(_RESULT, out)


_DID, _RK, _OF = "_suffix_dedup_did_", "_suffix_dedup_rk_", "_suffix_dedup_spans_"


def _with_spans(docs: DataFrame) -> DataFrame:
    """docs with a last column, the repeated spans of each text."""
    per = stored(repeated_spans(docs).groupBy(F.col("did").alias(_DID), F.col("rk").alias(_RK)).agg(F.collect_set(F.struct("s", "e")).alias(_OF)), "spans")
    did, rk = _row_key()
    return docs.withColumn(_DID, did).withColumn(_RK, rk).join(per, [_DID, _RK], "left").select(*(F.col(f"`{c}`") for c in docs.columns), _OF)


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left).

    One row per row of docs, without rows the result is empty. A null text is an empty one; texts below 200 bytes lose
    nothing, longer ones are looked at whole, in slices. Rows that repeat an id or have none are told apart by their texts; a
    repeated row repeats all its strings. Other columns are not looked at."""
    spans = _with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return spans.transform(mapped, _kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def cleaned(docs: DataFrame) -> DataFrame:
    """The rows of docs with their repeated passages cut out of the texts, all other columns as they are.

    A character of which only some bytes are repeated goes as a whole. Null texts stay null."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            texts, spans = given.column(at).to_pylist(), given.column(given.num_columns - 1).to_pylist()
            new = [None if t is None else _without(t, s)[1].decode(errors="ignore") if s else t for t, s in zip(texts, spans)]
            columns = [pa.array(new, pa.string()) if k == at else given.column(k) for k in range(given.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, names=given.schema.names[:-1])

    return _with_spans(docs).transform(mapped, run, docs.schema)


def op7_suffix_array_dedup(spark, sf_dir):
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")
