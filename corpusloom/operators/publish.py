"""Publishing: HTML to Markdown, Markdown blocks, headings, images, HTML."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import escape, unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import batches
from ..functions import text as T
from ..functions.blocks import DEFINITION, Block, blocks_of, md_blocks
from ..functions.html_markdown import STRIP, markdown_of

__all__ = ["blocks_of", "decoded", "html_of", "html_to_markdown", "image_refs", "inline_html", "markdown_of", "md_blocks", "md_to_html", "toc"]


def html_to_markdown(pages: DataFrame, strip: tuple[str, ...] = STRIP, bullets: str = "-", heading_style: str = "atx") -> DataFrame:
    """pages(page_id, html) -> page_id, markdown; see markdown_of() for the options. A null page is an empty line."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"page_id": f["page_id"], "markdown": [markdown_of(h, strip, bullets, heading_style) for h in f["html"]]})

    return batches.small(pages).select("page_id", "html").mapInPandas(run, "page_id long, markdown string")


def decoded(docs: DataFrame, column: str) -> DataFrame:
    """docs with the character references of a column decoded; only rows that hold an ampersand leave the JVM."""
    at = [f.name for f in docs.schema]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f[column] = [unescape(x) if isinstance(x, str) else x for x in f[column]]
            yield f[at]

    has = F.coalesce(F.contains(F.col(column), F.lit("&")), F.lit(False))
    return docs.where(~has).unionByName(docs.where(has).mapInPandas(run, docs.schema))


def inline_html(text: str) -> str:
    """Bold, italic, code and links within a line."""
    s = escape(text, quote=False)
    s = re.sub(r"`([^`]+)`", r"<code>\1</code>", s)
    s = re.sub(r"\*\*(.+?)\*\*", r"<strong>\1</strong>", s)
    s = re.sub(r"(?<!\*)\*(?!\s)([^*]+)(?<!\s)\*(?!\*)", r"<em>\1</em>", s)
    return re.sub(r"\[([^\]]+)\]\(([^)]+)\)", r'<a href="\2">\1</a>', s)


def _cells(row: str) -> list[str]:
    return [c.strip().replace("\\|", "|") for c in re.split(r"(?<!\\)\|", re.sub(r"^\s*\||(?<!\\)\|\s*$", "", row))]


def _html(b: Block) -> str:
    lines = [inline_html(x) for x in b.lines]
    if b.kind == "heading":
        return f"<h{b.level}>{lines[0]}</h{b.level}>"
    if b.kind == "code":
        code = escape("\n".join(b.lines), quote=False)
        return f'<pre><code class="language-{escape(b.lang)}">{code}</code></pre>'
    if b.kind in ("ul", "ol"):
        return f"<{b.kind}>" + "".join(f"<li>{x}</li>" for x in lines) + f"</{b.kind}>"
    if b.kind == "table":
        rows = ["".join(f"<{tag}>{inline_html(c)}</{tag}>" for c in _cells(r)) for r, tag in zip(b.lines, ["th"] + ["td"] * len(b.lines))]
        return "<table>" + "".join(f"<tr>{r}</tr>" for r in rows) + "</table>"
    if b.kind == "image":
        caption = f"<figcaption>{escape(b.alt, quote=False)}</figcaption>" if b.alt else ""
        return f'<figure><img src="{escape(b.target or "")}">{caption}</figure>'
    if b.kind == "quote":
        return "<blockquote>" + "<br>".join(lines) + "</blockquote>"
    return "<hr>" if b.kind == "hr" else f"<p>{lines[0]}</p>"


def html_of(body: str | None) -> str:
    return "\n".join(map(_html, blocks_of(body)))


def md_to_html(docs: DataFrame, body: str = "body") -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"], "html": [html_of(t) for t in f["b"]]})

    return batches.small(docs).select("doc_id", F.col(body).alias("b")).mapInPandas(run, "doc_id long, html string")


def toc(docs: DataFrame, body: str = "body") -> DataFrame:
    """doc_id, entry (from 1), level, title of each heading."""
    headings = F.filter(T.lines(F.col(body)), lambda x: x.rlike(T.HEADING))
    rows = docs.select("doc_id", F.posexplode(headings).alias("n", "line"))
    return rows.select("doc_id", (F.col("n") + 1).cast("long").alias("entry"), F.length(F.regexp_extract("line", "^(#+)", 1)).cast("long").alias("level"), F.regexp_extract("line", T.HEADING, 2).alias("title"))


def image_refs(docs: DataFrame, body: str = "body") -> DataFrame:
    """doc_id, alt, ref, target of the images that a document shows, inline or by a name that it defines.

    A quoted line `> ![alt][name]` shows the image of that name. Names are defined anywhere, `[name]: target`; the last definition
    counts, and a name without one has no target. ref is null for inline images. Repeated images are repeated rows."""
    text, name, bare = F.col(body), r"(?m)^[ \t]*>\s*!\[([^\]]+)\]\[([^\]]+)\]\s*$", r"!\[([^\]]*)\]\(([^)\s\"]+)"
    all_of = lambda pattern, group: F.regexp_extract_all(text, F.lit(pattern), group)
    pairs = lambda pattern, a, b: F.arrays_zip(all_of(pattern, a).alias("a"), all_of(pattern, b).alias("b"))
    defined = docs.withColumns({"_defined": pairs(f"(?m){DEFINITION}", 1, 2), "_named": pairs(name, 1, 2), "_inline": pairs(bare, 1, 2)})
    image = lambda alt, ref, target: F.struct(alt.alias("alt"), ref.alias("ref"), target.alias("target"))
    none = F.lit(None).cast("string")
    target = lambda ref: F.get(F.reverse(F.filter("_defined", lambda d: d["a"] == ref)), F.lit(0))["b"]
    shown = F.concat(F.transform("_inline", lambda x: image(x["a"], none, x["b"])), F.transform("_named", lambda x: image(x["a"], x["b"], target(x["b"]))))
    return defined.select("doc_id", F.explode(shown).alias("image")).select("doc_id", "image.*")
