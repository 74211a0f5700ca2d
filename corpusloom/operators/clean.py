"""Cleaning and chunking of Markdown bodies. Lines stay in arrays within their row: cleaning and chunking don't shuffle."""

from __future__ import annotations

import re
from itertools import groupby, pairwise

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions import batches, frontmatter
from ..functions import text as T

#: A line of at most so many characters that occurs so often is a running header or footer.
SHORT, OFTEN = 80, 4
CHUNK, LEAST_CUT = 2200, 800


def bound(docs: DataFrame, name: str, value: Column) -> DataFrame:
    """docs with a column that is evaluated once a row: the optimizer would copy a plain one into each place that reads it,
    also into functions that run for every line. No row is added or lost and nothing is shuffled."""
    return docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != name), F.explode(F.array(value)).alias(name))


def repeated_short(sorted_short: str) -> Column:
    """The distinct lines that occur OFTEN times: in sorted_short, each stands OFTEN - 1 places before its equal."""
    return F.array_distinct(F.filter(sorted_short, lambda x, i: F.get(F.col(sorted_short), i + OFTEN - 1) == x))


def with_lines(docs: DataFrame, body: str = "body") -> DataFrame:
    """docs with rows, an array of (line, its stripped form, whether it is page noise), and short, the sorted short lines.

    Each line is stripped and matched once; later steps read the array."""
    text = T.without_controls(T.newlines(F.col(body)))
    for end in "\x85\u2028\u2029":
        text = F.replace(text, F.lit(end), F.lit("\n"))
    lines = F.transform(F.split(text, "\n"), T.rstrip)  # trimming at the right is the dear half: once a line
    docs = docs.withColumn("rows", F.transform(lines, lambda x: F.struct(x.alias("line"), T.lstrip(x).alias("s"))))
    docs = docs.withColumn("rows", F.transform("rows", lambda r: F.struct(r["line"].alias("line"), r["s"].alias("s"), T.is_noise(r["s"]).alias("noise"))))
    short = F.filter("rows", lambda r: (F.length(r["s"]) > 0) & (F.length(r["s"]) <= SHORT) & ~r["noise"])
    return docs.withColumn("short", F.array_sort(F.transform(short, lambda r: r["s"])))


def clean_lines(docs: DataFrame, body: str = "body") -> DataFrame:
    """docs with cleaned: noise and repeated short lines go, chapter lines become headings, blank runs collapse."""
    docs = bound(with_lines(docs, body), "repeats", repeated_short("short"))
    kept = F.filter("rows", lambda r: ~r["noise"] & ~F.array_contains("repeats", r["s"]))
    lines = F.transform(kept, lambda r: F.when(T.is_chapter(r["s"]), F.concat(F.lit("## "), r["s"])).otherwise(r["line"]))
    joined = F.concat(T.strip(F.array_join(lines, "\n")), F.lit("\n"))
    return docs.withColumn("cleaned", F.regexp_replace(joined, r"\n{3,}", "\n\n")).drop("rows", "short", "repeats")


_CELL_END, _RULE = re.compile(r"(?<!\\)\|"), re.compile(r"\s*:?-{3,}:?\s*")


def _is_row(line: str) -> bool:
    s = line.strip()
    return s.startswith("|") and s.endswith("|")


def evened(text: str | None) -> str | None:
    """Pipe blocks with rows of equal width and a rule; cells stay as they are."""
    out: list[str] = []
    for is_row, lines in groupby((text or "").split("\n"), _is_row):
        if not is_row:
            out += lines
            continue
        rows = [_CELL_END.split(x.strip()[1:-1]) for x in lines]
        width = max(map(len, rows))
        rows = [r + [""] * (width - len(r)) for r in rows]
        rule = [" --- "] * width
        rows = [rule if all(map(_RULE.fullmatch, r)) else r for r in rows]
        if rule not in rows:
            rows.insert(1, rule)
        out += ("|" + "|".join(r) + "|" for r in rows)
    return None if text is None else "\n".join(out)


@F.pandas_udf(StringType())
def evened_tables(texts: pd.Series) -> pd.Series:
    return texts.map(evened)


def clean_markdown(docs: DataFrame, body: str = "body", meta: Column | None = None) -> DataFrame:
    """docs with cleaned: frontmatter, merged with meta, which comes first; and the body without HTML fragments, references,
    control characters, noise, running heads and blank runs, its chapters as headings, its tables evened.

    Only bodies with a pipe or an & leave the JVM; nothing is shuffled."""
    docs = batches.small(docs).withColumn("_meta", frontmatter.parsed(F.col(body)))
    docs = bound(docs, "_text", T.without_tags(T.newlines(frontmatter.body(F.col(body)))))
    docs = bound(docs, "_text", T.with_references_decoded(F.col("_text")))
    docs = clean_lines(docs, "_text")
    docs = bound(docs, "cleaned", F.col("cleaned"))
    even = F.coalesce(evened_tables(F.when(F.contains("cleaned", F.lit("|")), F.col("cleaned"))), F.col("cleaned"))
    known = F.coalesce("_meta", F.create_map().cast("map<string,string>"))
    if meta is not None:
        known = F.map_concat(F.map_filter(known, lambda k, v: ~F.map_contains_key(meta, k)), meta)
    head = F.when(F.size(known) > 0, frontmatter.encoded(known)).otherwise("")
    return docs.withColumn("cleaned", F.concat(head, even)).drop("_meta", "_text")


def parts_of(text: str | None) -> list[str]:
    """Text cut into parts of at most CHUNK characters, at the last newline after LEAST_CUT if there is one."""
    rest, out, at = (text or "").strip(), [], 0
    end = len(rest)
    while end - at > CHUNK:
        cut = rest.rfind("\n", at, at + CHUNK)
        cut = at + CHUNK if cut < at + LEAST_CUT else cut
        out.append(rest[at:cut].strip())
        at = cut
        while at < end and rest[at].isspace():
            at += 1
    out.append(rest[at:])
    return [x for x in out if x]


@F.pandas_udf(ArrayType(StringType()))
def chunks_of(texts: pd.Series) -> pd.Series:
    """Arrow batches, as a fold over built-in expressions copies the rest of the text at every cut: it is quadratic in a
    document's length, this is linear."""
    return texts.map(parts_of)


def chunk(docs: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """key, seq (from 1), chunk: one row per chunk."""
    return docs.select(key, chunks_of(F.col(body)).alias("parts")).select(key, F.posexplode("parts").alias("seq", "chunk")).withColumn("seq", F.col("seq").cast("long") + 1)


_HEADING_LINE = re.compile(r"(?m)^#{1,6}[^\S\n]+(\S.*?)[^\S\n]*$")


def sectioned(text: str | None, title: str | None) -> list[tuple[str | None, str]]:
    """(section, part): a heading opens a section, what comes before the first one bears the title."""
    text = text or ""
    heads = [(0, title), *((m.start(), m[1]) for m in _HEADING_LINE.finditer(text)), (len(text), None)]
    return [(name, part) for (at, name), (end, _) in pairwise(heads) for part in parts_of(text[at:end])]


@F.pandas_udf(ArrayType(StructType([StructField("section", StringType()), StructField("text", StringType())])))
def sections_of(texts: pd.Series, titles: pd.Series) -> pd.Series:
    return pd.Series([[{"section": s, "text": t} for s, t in sectioned(x, y)] for x, y in zip(texts, titles)])


def section_chunks(docs: DataFrame) -> DataFrame:
    """docs(doc_id string, doc_title, source_path, markdown_path, body) -> chunk_id, doc_id, doc_title, section_title,
    citation, markdown_path, source_path, text. Chunks are numbered within their row, so nothing is shuffled."""
    each = docs.select("doc_id", "doc_title", "source_path", "markdown_path", F.posexplode(sections_of("body", "doc_title")).alias("n", "x"))
    n = (F.col("n") + 1).cast("string")
    number = F.when(F.length(n) < 4, F.lpad(n, 4, "0")).otherwise(n)
    citation = F.concat("doc_title", F.lit(" > "), "x.section")
    return each.select(F.concat("doc_id", F.lit("-"), number).alias("chunk_id"), "doc_id", "doc_title", F.col("x.section").alias("section_title"), citation.alias("citation"), "markdown_path", "source_path", F.col("x.text").alias("text"))


def sections(docs: DataFrame, key: str = "doc_id", body: str = "body") -> DataFrame:
    """key, line_no, line, section (0 before the first heading), is_heading: lines numbered within their document."""
    rows = docs.select(key, F.posexplode(T.lines(F.col(body))).alias("line_no", "line")).withColumn("is_heading", F.col("line").rlike(T.HEADING))
    order = Window.partitionBy(key).orderBy("line_no")
    return rows.withColumn("section", F.sum(F.col("is_heading").cast("long")).over(order))
