"""Column functions over Markdown text. All are built-in expressions, so they stay in the JVM."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Unicode white space, as the reference semantics ask for; Spark's \\s is ASCII only.
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
_SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: What counts as page noise, as a chapter line and as an error text of a provider.
PAGE_NOISE = rf"(?i)^{WS}*(#{{1,6}}{WS}*)?((page{WS}+\d+({WS}+of{WS}+\d+)?)|(\d+{WS}*/{WS}*\d+)|([-_]{{3,}})){WS}*$"
CHAPTER = rf"(?i)^((Chapter|Section|Article){WS}+\d+([.\-]\d+)*|第.{{1,12}}[章节条款]|[一二三四五六七八九十]+[、.]){WS}*(.{{2,120}})$"
HEADING = rf"^(#{{1,6}}){WS}+(.+?){WS}*$"
PROVIDER_ERRORS = ("<think>", "invalid api key", "sensitive image", "server error")
COMMENT = r"(?s)<!--.*?-->"
COMPACTED = rf"[#*|:`_\-\s\x0b\x1c-\x1f\x85\p{{Z}}]"
#: What a cell's relaxed form leaves out, beside white space, and what its number does.
RELAXED = r"""[\s\x0b\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000,，.。;；:：!！?？()（）\[\]【】<>《》"'“”‘’、/\\|-]+"""
NUMBER_MARKS = "[,，%￥¥]"
NUMBER = r"^[-+]?\d+(\.\d+)?$"
SEPARATOR_CELL = rf"^{WS}*:?-{{3,}}:?{WS}*$"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACES))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(_SPACES))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(_SPACES))


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c), where c is evaluated once however often f reads it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def newlines(c: Column) -> Column:
    """CRLF and CR become LF."""
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def lines(c: Column) -> Column:
    return F.split(newlines(c), "\n")


def without_controls(c: Column) -> Column:
    """Control characters but tab and LF go; no-break spaces become spaces."""
    return F.replace(F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""), F.lit("\u00a0"), F.lit(" "))


def slug(c: Column, most: int = 90) -> Column:
    """File-name form: each reserved or control character and each run of white space becomes _, the rest is trimmed and cut."""
    s = F.regexp_replace(c, r'[<>:"/\\|?*\x00-\x1f]', "_")
    s = F.regexp_replace(F.regexp_replace(s, rf"{WS}+", "_"), r"^[._ ]+|[._ ]+$", "")
    s = F.substring(s, 1, most)
    return F.when(F.length(s) > 0, s).otherwise("document")


def hash_id(c: Column, length: int = 14) -> Column:
    return F.substring(F.sha1(c), 1, length)


def compact(c: Column) -> Column:
    """Text without comments, Markdown marks and white space."""
    return F.regexp_replace(F.regexp_replace(c, COMMENT, ""), COMPACTED, "")


def is_noise(s: Column) -> Column:
    """Of a stripped line. Only lines that begin like noise are matched."""
    return F.when(F.substring(s, 1, 1).isin(*"#pP-_0123456789"), s.rlike(PAGE_NOISE)).otherwise(False)


def is_chapter(s: Column) -> Column:
    """A stripped line that reads like a chapter's title."""
    begins = F.substring(s, 1, 1).isin(*"cCsSaA第一二三四五六七八九十")
    return F.when(begins & (F.length(s) <= 140), ~s.contains("|") & s.rlike(CHAPTER)).otherwise(False)


def promoted(line: Column) -> Column:
    """Chapter-like lines become second-level headings."""
    s = strip(line)
    return F.when(is_chapter(s), F.concat(F.lit("## "), s)).otherwise(line)


def relaxed(c: Column) -> Column:
    """A cell for comparison: without white space and punctuation, lower-cased."""
    return F.lower(F.regexp_replace(c, RELAXED, ""))


def numeric(c: Column) -> Column:
    """A cell as a number, where separators, percent and currency signs are left out; null unless digits with a sign and a fraction at most."""
    plain = F.regexp_replace(strip(c), NUMBER_MARKS, "")
    return once(plain, lambda x: F.when(x.rlike(NUMBER), x.cast("double")))


def same_cell(a: Column, b: Column) -> Column:
    """Cells of two engines agree: as numbers if one is a number, else in their relaxed forms; equal cells aren't looked at."""
    numbers = once(F.struct(numeric(a).alias("x"), numeric(b).alias("y")), lambda n: F.when(n["x"].isNotNull() | n["y"].isNotNull(), F.coalesce(F.abs(n["x"] - n["y"]) <= 1e-9, F.lit(False))))
    return F.when(a == b, F.lit(True)).otherwise(F.coalesce(numbers, relaxed(a) == relaxed(b)))


def alphanumeric(text: str | None) -> str:
    """Letters and digits of the text's NFKC form; case is kept."""
    return "".join(filter(str.isalnum, unicodedata.normalize("NFKC", text or "")))


@F.pandas_udf(StringType())
def alphanumeric_key(texts: pd.Series) -> pd.Series:
    """alphanumeric() by Arrow batches, as Spark has no NFKC."""
    return texts.map(alphanumeric)


@F.pandas_udf(StringType())
def unescaped(texts: pd.Series) -> pd.Series:
    """Character references decoded, by Arrow batches, as Spark has no table of their names; null stays null."""
    return texts.map(html.unescape, na_action="ignore")


def decoded(c: Column) -> Column:
    """Only texts with an & leave the JVM."""
    return F.coalesce(unescaped(F.when(c.contains("&"), c)), c)


def page_numbers(c: Column) -> Column:
    """Sorted distinct page numbers of a list with commas, semicolons of both widths and spaces."""
    return _numbers(F.split(c, r"[,;，；\s]+"))


def page_numbers_by_comma(c: Column) -> Column:
    """The same for lists with commas only: a part that holds anything else is no number."""
    return _numbers(F.transform(F.split(c, ","), strip))


def _numbers(parts: Column) -> Column:
    parts = F.filter(parts, lambda x: x.rlike(r"^\d+$"))
    return F.array_sort(F.array_distinct(F.transform(parts, lambda x: x.cast("long"))))


def sample_indexes(pages: Column, most: Column) -> Column:
    """At most so many evenly spaced page indexes; with one sample, the first page."""
    n = F.least(pages, most)
    even = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.floor(i * (pages - 1) / F.greatest(n - 1, F.lit(1))).cast("long"))
    return F.when(n <= 0, F.array().cast("array<long>")).otherwise(F.array_distinct(even))


def _headings(level: int) -> Callable[[Column], Column]:
    """HTML headings of a level; only texts that have some are looked through."""
    pattern = rf"(?is)<h{level}[^>]*>\s*((?:(?!</h{level}>).)*?)\s*</h{level}>"
    to = "\n" + "#" * min(level + 1, 6) + " $1\n"
    return lambda x: F.when(x.contains(f"<h{level}") | x.contains(f"<H{level}"), F.regexp_replace(x, pattern, to)).otherwise(x)


def _tags(c: Column) -> Column:
    for level in range(1, 7):
        c = once(c, _headings(level))
    c = F.regexp_replace(c, r"(?i)<br\s*/?>|</p\s*>", "\n")
    c = F.regexp_replace(c, r"(?i)</?(p|div|body|html)[^>]*>", "")
    return F.regexp_replace(c, r"<(?!!--)[^>]+>", "")


def without_tags(c: Column) -> Column:
    """HTML fragments within Markdown: fences, headings, breaks, paragraphs, other tags; comments stay."""
    fences = lambda x: F.regexp_replace(F.regexp_replace(x, r"(?is)```html\s*(.*?)\s*```", "$1"), r"(?im)^```html\s*$", "")
    c = once(c, lambda x: F.when(x.contains("```"), fences(x)).otherwise(x))
    return once(c, lambda x: F.when(x.contains("<"), _tags(x)).otherwise(x))


def with_references_decoded(c: Column) -> Column:
    """What follows without_tags(): character references, then blanks before line ends. It reads c three times."""
    return F.regexp_replace(decoded(c), r"[ \t]+\n", "\n")


def html_fragments(c: Column) -> Column:
    return with_references_decoded(without_tags(c))
