"""Blocks of Markdown by the publishing grammar, as a table function for lateral joins.

A block is a rule, a heading, a code fence, an image, a quote, a table, a list or a paragraph. Definitions of image targets are
collected first, wherever they stand, and the last one of a name counts; then they are blanked and the lines read."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

# Patterns of definitions, blocks, and lines that end a paragraph.
DEFINITION = r'^\[([^\]]+)\]:\s*(\S+)(?:\s+"([^"]+)")?'
_DEFINED_LINE = r"^\[[^\]]+\]:\s*\S+.*$"
_HEADING = r"(#{1,6})\s+(.+)"
_NAMED_IMAGE = r">\s*!\[([^\]]+)\]\[([^\]]+)\]"
_IMAGE = r"!\[([^\]]*)\]\(([^)]+)\)"
_BULLET, _NUMBER = r"\s*-\s+", r"\s*\d+\.\s+"
_TABLE_RULE = r"\s*\|?\s*[-:]+"
_ENDS_PARAGRAPH = r"#{1,6}\s|```|>|\|.*\||\s*-\s+|\s*\d+\.\s+|---\s*$|!\["

BLOCK = "kind string, level int, lang string, alt string, target string, via string, lines array<string>"


class Block(NamedTuple):
    kind: str
    lines: list[str] | tuple[()] = ()
    level: int | None = None
    lang: str | None = None
    alt: str | None = None
    target: str | None = None
    via: str | None = None


class _Lines:
    """Lines yet to be read, and the targets that the document defines."""

    def __init__(self, body: str) -> None:
        self.targets = {m[1]: m[2] for m in re.finditer(DEFINITION, body, re.M)}
        self.left = re.sub(_DEFINED_LINE, "", body, flags=re.M).split("\n")
        self.at = 0

    def line(self, ahead: int = 0) -> str | None:
        return self.left[self.at + ahead] if self.at + ahead < len(self.left) else None

    def run(self, belongs: Callable[[str], object], skip: int = 0) -> list[str]:
        """The lines from here, after so many that are skipped, for as long as they belong."""
        start = end = min(self.at + skip, len(self.left))
        while end < len(self.left) and belongs(self.left[end]):
            end += 1
        self.at = end
        return self.left[start:end]


def _one_line(lines: _Lines, bare: str) -> Block | None:
    if bare == "---":
        return Block("hr")
    if m := re.fullmatch(_HEADING, bare):
        return Block("heading", [m[2].strip()], level=len(m[1]))
    if m := re.fullmatch(_NAMED_IMAGE, bare):
        return Block("image", alt=m[1], target=lines.targets.get(m[2]), via=m[2])
    if m := re.fullmatch(_IMAGE, bare):
        return Block("image", alt=m[1], target=m[2])
    return None


def _fence(lines: _Lines, bare: str) -> Block | None:
    if not bare.startswith("```"):
        return None
    block = Block("code", lines.run(lambda x: not x.strip().startswith("```"), skip=1), lang=bare[3:].strip() or "text")
    lines.at += 1  # the closing fence
    return block


def _quote(lines: _Lines, bare: str) -> Block | None:
    if not bare.startswith(">"):
        return None
    found = [re.sub(r"^>\s?", "", x) if x.strip() else "" for x in lines.run(lambda x: x.strip()[:1] in ("", ">"))]
    last = max((k for k, x in enumerate(found) if x.strip()), default=-1)
    return Block("quote", found[: last + 1])


def _table(lines: _Lines, bare: str) -> Block | None:
    rule = lines.line(1)
    if "|" not in bare or rule is None or not re.match(_TABLE_RULE, rule.strip()):
        return None
    return Block("table", [lines.line(), *lines.run(lambda x: "|" in x and x.strip(), skip=2)])


def _list(kind: str, mark: str):
    def rule(lines: _Lines, bare: str) -> Block | None:
        found = lines.run(lambda x: re.match(mark, x))
        return Block(kind, [re.sub(f"^{mark}", "", x) for x in found]) if found else None

    return rule


def _paragraph(lines: _Lines, bare: str) -> Block:
    more = lines.run(lambda x: x.strip() and not re.match(_ENDS_PARAGRAPH, x.strip()), skip=1)
    return Block("p", [" ".join([bare, *(x.strip() for x in more)])])


_RULES = (_fence, _quote, _table, _list("ul", _BULLET), _list("ol", _NUMBER), _paragraph)


def blocks_of(body: str | None) -> list[Block]:
    return list(_blocks(_Lines(body or "")))


def _blocks(lines: _Lines) -> Iterator[Block]:
    while (line := lines.line()) is not None:
        bare = line.strip()
        if not bare:
            lines.at += 1
        elif block := _one_line(lines, bare):
            lines.at += 1
            yield block
        else:
            yield next(b for rule in _RULES if (b := rule(lines, bare)))


class _Blocks:
    def eval(self, body: str) -> Iterator[tuple]:
        for n, b in enumerate(blocks_of(body), 1):
            yield n, b.kind, b.level, b.lang, b.alt, b.target, b.via, list(b.lines)


markdown_blocks = udtf(_Blocks, returnType=f"block_no int, {BLOCK}", useArrow=True)


def md_blocks(docs: DataFrame, body: str = "body") -> DataFrame:
    """docs(..., body) -> docs' columns and block_no (from 1), kind, level, lang, alt, target, via, lines, by a lateral join.

    lines: the text of a heading or a paragraph; the lines of code and quotes; the items of a list; the rows of a table, without
    the rule. via: the name by which an image is defined; its target is null if nothing defines it. A null body has no blocks."""
    return docs.lateralJoin(markdown_blocks(F.col(body).outer()))
