"""Splitting texts into the pieces that a public tokenizer merges one by one.

Merges never cross these pieces, so a text's ids are those of its pieces, and a piece that recurs need be merged only
once. The split is done here for texts of a set of characters for which both this code and the library were compared
(see plain_characters); any other text, and one that holds a special string, is given to the library whole."""

from __future__ import annotations

import json
import os
import re
import unicodedata

from tokenizers import Tokenizer

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the work; a task is one thread
TOKENIZERS = os.environ.get("CORPUSLOOM_TOKENIZERS", "")
_SPACE = "\t-\r \x85\xa0"


def vocabulary_path(name: str, folder: str = TOKENIZERS) -> str:
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def plain_characters() -> str:
    """Basic Latin to Latin Extended-A and common punctuation, but for one letter whose lower case is two characters."""
    return "".join(map(chr, [*range(0x180), *range(0x2010, 0x2028), 0x20AC])).replace("İ", "")


def _classes() -> tuple[str, str]:
    of = lambda k: re.escape("".join(c for c in plain_characters() if unicodedata.category(c)[0] == k))
    return of("L"), of("N")


_L, _N = _classes()
#: The split of word_bpe_49k.json, over lower-cased text; spaces are dropped.
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_SPACE}{_L}{_N}]+")
#: The split of byte_bpe_50k.json; every character is in one piece.
BYTES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_OTHER = re.compile(f"[^{re.escape(plain_characters())}]")


def special_strings(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [x["content"] for x in json.load(f)["added_tokens"]]


def byte_characters() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class Plain:
    """Tells whether a text may be split here."""

    def __init__(self, path: str) -> None:
        self.special = special_strings(path)

    def __call__(self, text: str) -> bool:
        return (text.isascii() or _OTHER.search(text) is None) and not any(x in text for x in self.special)


class Pieces(dict):
    """Piece to whatever value(ids) makes of its ids, remembered; emptied when it holds most entries."""

    most = 250_000

    def __init__(self, tokenizer: Tokenizer, value, known=()) -> None:
        super().__init__(known)
        self.tokenizer, self.value, self.known = tokenizer, value, dict(known)

    def learn(self, given: list[list[str]]) -> None:
        """Merges what is new in given, all at once."""
        new = list(set().union(*given).difference(self))
        if len(self) + len(new) > self.most + len(self.known):
            self.clear()
            self.update(self.known)
            new = list(set().union(*given).difference(self))
        for s in range(0, len(new), 20_000):
            some = new[s : s + 20_000]
            self.update(zip(some, (self.value(e.ids) for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False))))
