"""Blocks, image definitions and HTML trees on literal rows and against plain versions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.blocks import blocks_of, md_blocks
from corpusloom.functions.html_markdown import markdown_of, spread
from corpusloom.operators import publish


def kinds(body):
    return [(b.kind, list(b.lines)) for b in blocks_of(body)]


@pytest.mark.parametrize(
    "body,want",
    [
        ("", []),
        (None, []),
        (" \n\t\n", []),
        ("--- \n----", [("hr", []), ("p", ["----"])]),
        ("#no\n####### no", [("p", ["#no ####### no"])]),
        ("# yes #\ntext", [("heading", ["yes #"]), ("p", ["text"])]),
        ("* a\n+ b\n1) c", [("p", ["* a + b 1) c"])]),
        ("- a\n  - b\n-c", [("ul", ["a", "b"]), ("p", ["-c"])]),
        ("1. a\n2. b\n3.c", [("ol", ["a", "b"]), ("p", ["3.c"])]),
        ("a | b\nc | d", [("p", ["a | b c | d"])]),
        ("a | b\n- x", [("table", ["a | b"])]),
        ("text\n| a | b |", [("p", ["text"]), ("p", ["| a | b |"])]),
        ("> a\n\n\n> b  \n \n> \n\nend", [("quote", ["a", "", "", "b  "]), ("p", ["end"])]),
        (">", [("quote", [])]),
        ("```\na\n\n```js\nb\n```", [("code", ["a", ""]), ("p", ["b"]), ("code", [])]),
        ("![a](b c)\nx ![y](z)", [("image", []), ("p", ["x ![y](z)"])]),
        ("x\n![a](b)", [("p", ["x"]), ("image", [])]),
        ("[n]: t\n> ![a][n]\n> ![a][m]", [("image", []), ("image", [])]),
    ],
)
def test_block_grammar(body, want):
    assert kinds(body) == want


def test_every_line_is_in_a_block():
    rng = random.Random(3)
    parts = ["# h", "text", "- i", "2. n", "> q", "|a|b|", "|-|-|", "```", "---", "", "![x](y)", "  deep", "[r]: s", "> ![x][r]"]
    for _ in range(400):
        lines = [rng.choice(parts) for _ in range(rng.randrange(12))]
        got = blocks_of("\n".join(lines))
        held = " ".join(x for b in got for x in b.lines)
        for word, line in (("text", "text"), ("deep", "  deep"), ("h", "# h")):
            if "```" not in lines:
                assert len(re.findall(rf"\b{word}\b", held)) == lines.count(line)


def test_blocks_by_lateral_join(spark):
    docs = spark.createDataFrame([(1, "# a\n\n[x]: 1\n> ![i][x]\n[x]: 2", "k"), (2, None, "k"), (3, "", None)], "doc_id long, body string, kept string")
    got = md_blocks(docs).collect()
    assert [(r.doc_id, r.kept, r.block_no, r.kind, r.level, r.target, r.via) for r in got] == [(1, "k", 1, "heading", 1, None, None), (1, "k", 2, "image", None, "2", "x")]
    assert md_blocks(docs.limit(0)).collect() == []


def test_images(spark):
    body = '![a](b.png "t") ![](c)\n> ![d][n]\n[n]: 1.png "x"\n  > ![e][m] \n[n]: 2.png\n![f][n]\n[o]: 3'
    docs = spark.createDataFrame([(1, body), (2, None), (3, "none")], "doc_id long, body string").withColumn("alt", F.lit("clash"))
    got = [tuple(r) for r in publish.image_refs(docs).collect()]
    assert got == [(1, "a", None, "b.png"), (1, "", None, "c"), (1, "d", "n", "2.png"), (1, "e", "m", None)]


@pytest.mark.parametrize(
    "html,want",
    [
        ("a  b<!-- c --> d", "a b d"),
        ("<p>a<p>b", "a\n\nb"),
        ("<p> <b> x </b>y</p>", "**x** y"),
        ("<i></i><b> </b>z", "z"),
        ('<a href="u"><img src="s" alt="x"></a>', "[![x](s)](u)"),
        ("<a>no</a> <a href='u' title='t\"q'>yes</a>", "no [yes](u \"t'q\")"),
        ("<code>``</code>", "``` `` ```"),
        ("<pre>a\n  b\n```\n</pre>", "````\na\n  b\n```\n````"),
        ("<ol start=9><li>a<li>b<p>c</ol>", "9. a\n10. b\n\n    c"),
        ("<ul><li>a<ul><li>b<ul><li>c</ul></ul><li>d</ul>", "- a\n  - b\n    - c\n- d"),
        ("<ul><li>a</li><ul><li>b</li></ul></ul>", "- a\n  - b"),
        ("<blockquote>a<blockquote>b</blockquote></blockquote>", "> a\n>\n> > b"),
        ("<dl><dt>t<dd>d<dt>u</dl>", "**t**\n\n: d\n\n**u**"),
        ("<table><tr><td>a<table><tr><td>in</table><td>b</table>", "| a<br>\\| in \\|<br>\\| --- \\| | b |\n| --- | --- |"),
        ("<table></table>x<table><tr></tr></table>", "x"),
        ("<form>f</form><aside>a</aside>m<script>s</script>", "m"),
        ("</p></div>x</li>", "x"),
        ("&lt;b&gt; &amp;amp; &#233;", "<b> &amp; é"),
    ],
)
def test_trees(html, want):
    assert markdown_of(html) == want + "\n"


def test_tree_options():
    html = "<h1>A</h1><h2>B</h2><h3>C</h3><nav>n</nav><ul><li>x<ul><li>y</ul></ul>"
    assert markdown_of(html, heading_style="setext") == "A\n=\n\nB\n-\n\n### C\n\n- x\n  - y\n"
    assert markdown_of(html, heading_style="atx_closed").startswith("# A #\n\n## B ##")
    assert markdown_of(html, strip=(), bullets="*+").endswith("n\n\n* x\n  + y\n")
    with pytest.raises(ValueError):
        markdown_of(html, heading_style="none")


def test_deep_and_long_pages():
    assert markdown_of("<div>" * 20_000 + "x") == "x\n"
    assert markdown_of("<p>" + "word " * 200_000).count("word") == 200_000


def test_spans_against_a_plain_grid():
    """Each cell is put, by trying places one by one, where nothing stands yet."""
    rng = random.Random(7)
    for _ in range(200):
        rows = [[(f"{y}.{k}", rng.choice([1, 1, 2, 3]), rng.choice([1, 1, 2, 9])) for k in range(rng.randrange(5))] for y in range(rng.randrange(6))]
        held = {}
        for y, row in enumerate(rows):
            for text, wide, high in row:
                x = next(x for x in range(100) if (y, x) not in held)
                for yy in range(y, min(len(rows), y + high)):
                    for xx in range(x, x + wide):
                        held.setdefault((yy, xx), text)
        got = spread(rows)
        assert {(y, x): t for y, r in enumerate(got) for x, t in enumerate(r) if t} == held
