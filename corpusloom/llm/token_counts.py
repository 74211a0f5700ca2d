"""Operator 2, token counts by the whole-token shortcut.

Before any text is read, each vocabulary string is encoded alone; those that come out as one token are the table. A
text is split into pieces (pretokens.py); a piece in the table counts one, directly, and only the rest is merged by the
library, once for each that a worker meets."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import batch, mapped, pieces, table
from .pretokens import WORDS, Pieces, Plain, byte_characters, vocabulary_path

LIMIT = 2048
END_OF_WORD = "</w>"


def whole_tokens(tokenizer: Tokenizer) -> list[str]:
    """The pieces, as split, that the library encodes alone as one token: every vocabulary string is tried."""
    back = byte_characters()
    found = []
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        body = entry.removesuffix(END_OF_WORD)
        try:
            text = bytes(back[c] for c in body).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if text and WORDS.findall(text.lower()) == [text]:
            found.append(text)
    return [t for t, e in zip(found, tokenizer.encode_batch(found, add_special_tokens=False)) if len(e.ids) == 1]


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


class Counter:
    """Counts the tokens of texts; made once in each Python worker."""

    _made: dict = {}

    def __init__(self, path: str, whole: list[str]) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.plain = Plain(path)
        self.sizes = Pieces(self.tokenizer, len, dict.fromkeys(whole, 1))

    @classmethod
    def made(cls, path: str, whole: list[str]) -> Counter:
        if path not in cls._made:
            cls._made[path] = cls(path, whole)
        return cls._made[path]

    def __call__(self, texts: list[str]) -> list[int]:
        split = [WORDS.findall(t.lower()) if self.plain(t) else None for t in texts]
        self.sizes.learn([x for x in split if x is not None])
        size = self.sizes.__getitem__
        return [sum(map(size, x)) if x is not None else len(self.tokenizer.encode(t, add_special_tokens=False).ids) for t, x in zip(texts, split)]


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, n_bytes, n_tokens, over_limit; one row per row of docs, null texts as empty ones.

    path: a tokenizers file with lower-cased words and word ends, in the same place on all executors. The table of
    whole tokens is proved on the driver and sent out; its size is bounded by the vocabulary. Null ids stay null, rows
    that repeat are counted each, other columns are not looked at."""
    path = path or vocabulary_path("word_bpe_49k.json")
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(Tokenizer.from_file(path)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter.made(path, whole.value)
        for given in batches:
            texts = given.column(1).to_pylist()
            for at, end in pieces(texts):
                some = [t or "" for t in texts[at:end]]
                yield batch(_RESULT, {"doc_id": given.column(0).slice(at, end - at), "n_bytes": [len(t) if t.isascii() else len(t.encode()) for t in some], "n_tokens": count(some)})

    out = docs.select(F.col("doc_id").cast("long"), "text").transform(mapped, counted, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op2_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))
