"""Further queries: frontmatter, manifests, repair and reconciliation of tables, publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import frontmatter, ocr
from ..functions import text as T
from ..operators import audit, publish, tables
from ..sources import manifest, readers
from .catalog import _LINES, _LEVEL, _MD, _STRIP, query
from .fixtures import dealt, load, md_documents, table_rows

_META = "'---' || chr(10) || 'doc_title: \"T ' || doc_id || ' \\\\\"q\\\\\"\"' || chr(10) || 'doc_id: \"' || doc_id || '\"' || chr(10) || 'zeta: plain' || chr(10) || 'source_path: in/' || source || '.pdf' || chr(10) || '---' || chr(10) || text"


@query("""SELECT doc_id, 'T ' || doc_id || ' "q"' AS title, 'in/' || source || '.pdf' AS source_path, sha1(text) AS body_sha1,
'---' || chr(10) || 'doc_id: "' || doc_id || '"' || chr(10) || 'doc_title: "T ' || doc_id || ' \\"q\\""' || chr(10) || 'source_path: "in/' || source || '.pdf"' || chr(10) || 'zeta: "plain"' || chr(10) || '---' || chr(10) || chr(10) AS encoded FROM documents""")
def frontmatter_roundtrip(spark, sf_dir):
    whole = load(spark, sf_dir, "documents").selectExpr("doc_id", f"{_META} AS whole")
    meta = whole.select("doc_id", frontmatter.parsed(F.col("whole")).alias("m"), F.sha1(frontmatter.body(F.col("whole"))).alias("body_sha1"))
    return meta.select("doc_id", F.col("m")["doc_title"].alias("title"), F.col("m")["source_path"].alias("source_path"), "body_sha1", frontmatter.encoded(F.col("m")).alias("encoded"))


_STATUS = f"""st AS (SELECT doc_id, {_STRIP('text')} AS t, CASE doc_id % 5 WHEN 0 THEN '.png' WHEN 1 THEN '.pdf' ELSE '.html' END AS ext, CASE WHEN doc_id % 5 = 1 THEN CASE WHEN doc_id % 10 = 1 THEN 'needs_ocr' ELSE 'text_ok' END ELSE '' END AS pdf, doc_id % 3 = 0 AS model FROM documents),
oc AS (SELECT doc_id, t, CASE WHEN ext = '.png' AND NOT model THEN 'needs_ocr' WHEN ext = '.png' OR (pdf = 'needs_ocr' AND model) THEN 'vision_ocr_attempted' WHEN pdf <> '' THEN pdf ELSE 'not_required' END AS ocr_status FROM st),
qs AS (SELECT doc_id, ocr_status, CASE WHEN length(t) < 80 OR ocr_status IN ('needs_ocr', 'needs_review') THEN 'needs_review' ELSE 'ok' END AS quality_status, CASE WHEN doc_id % 17 = 0 THEN 'failed' ELSE 'converted' END AS conversion_status FROM oc)"""


def _statuses(spark, sf_dir):
    d = load(spark, sf_dir, "documents").selectExpr("doc_id", "text", "CASE doc_id % 5 WHEN 0 THEN '.png' WHEN 1 THEN '.pdf' ELSE '.html' END AS ext", "CASE WHEN doc_id % 5 = 1 THEN CASE WHEN doc_id % 10 = 1 THEN 'needs_ocr' ELSE 'text_ok' END ELSE '' END AS pdf", "doc_id % 3 = 0 AS model", "CASE WHEN doc_id % 17 = 0 THEN 'failed' ELSE 'converted' END AS conversion_status")
    d = d.withColumn("ocr_status", manifest.ocr_status(F.col("ext"), F.col("pdf"), F.col("model")))
    return d.select("doc_id", "ocr_status", manifest.quality_status(F.col("text"), F.col("ocr_status")).alias("quality_status"), "conversion_status")


@query(f"WITH {_STATUS} SELECT * FROM qs")
def manifest_status(spark, sf_dir):
    return _statuses(spark, sf_dir)


@query(f"WITH {_STATUS} SELECT conversion_status, quality_status, ocr_status, count(*) AS n FROM qs WHERE conversion_status = 'failed' OR quality_status = 'needs_review' OR ocr_status IN ('needs_ocr', 'needs_review') GROUP BY ALL")
def unresolved(spark, sf_dir):
    return manifest.unresolved(_statuses(spark, sf_dir)).groupBy("conversion_status", "quality_status", "ocr_status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 25 OFFSET 10")
def manifest_slice(spark, sf_dir):
    return manifest.sliced(load(spark, sf_dir, "part").select("p_partkey", "p_name"), ["p_partkey"], 11, 25)


@query(f"""WITH p AS (SELECT conv_id, turn + 1 AS page, {_STRIP('text')} AS t FROM conversations), f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY page) AS k FROM p WHERE page <= 10 AND length(t) >= 30),
g AS (SELECT conv_id, count(*) AS samples, (sum(length(t)) + count(*) - 1) / count(*) AS density FROM f WHERE k <= 3 GROUP BY 1)
SELECT c.conv_id, CASE WHEN samples IS NULL THEN 'needs_ocr' WHEN density < 180 THEN 'needs_review' ELSE 'text_ok' END AS ocr_status, coalesce(samples, 0) AS samples FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g USING (conv_id)""")
def pdf_text_density(spark, sf_dir):
    return manifest.sampled_density(load(spark, sf_dir, "conversations").selectExpr("conv_id", "turn + 1 AS page", "text"), "conv_id")


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN upper(p_brand) || CASE WHEN p_partkey % 8 = 0 THEN ' again' ELSE '' END ELSE p_brand END AS p_brand, p_size FROM part")
def manifest_update(spark, sf_dir):
    part = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    updates = part.where("p_partkey % 4 = 0").selectExpr("p_partkey", "1 AS nth", "upper(p_brand) AS p_brand")
    return manifest.upserted(part, updates.unionAll(updates.where("p_partkey % 8 = 0").selectExpr("p_partkey", "2", "p_brand || ' again'")), ["p_partkey"], "nth")


_COMMENTARY = "(?i)^[ \\t\\x0b\\x0c\\x1c-\\x1f\\x85\\p{Z}]*(The user wants\\b|Let me\\b|I can see\\b|I see\\b|The page appears\\b|The document appears\\b|The document is\\b|The rest of the page\\b|Starting from\\b|Body text starts\\b|Header:|Document number:|Title:|Signature area\\b|Page number:|At the (top|bottom),\\b|And the page number\\b|I''ll mark\\b|我看到|让我|下面是|以下是.*转写)"


@query(f"""WITH g AS (SELECT conv_id, turn, unnest(string_split(regexp_replace(text || CASE WHEN turn % 4 = 1 THEN chr(10) || 'At the top,x' || chr(10) || 'At the top, y' ELSE '' END, '\\r\\n?', chr(10), 'g'), chr(10))) AS line, generate_subscripts(string_split(regexp_replace(text || CASE WHEN turn % 4 = 1 THEN chr(10) || 'At the top,x' || chr(10) || 'At the top, y' ELSE '' END, '\\r\\n?', chr(10), 'g'), chr(10)), 1) AS n FROM conversations WHERE turn % 4 <> 3),
j AS (SELECT conv_id, turn, {_STRIP("string_agg(line, chr(10) ORDER BY n)")} AS t FROM g WHERE NOT regexp_matches(line, '{_COMMENTARY}') GROUP BY 1, 2)
SELECT c.conv_id, c.turn, CASE WHEN coalesce(t, '') = '' THEN '[blank page]' ELSE t END AS answer FROM conversations c LEFT JOIN j ON c.conv_id = j.conv_id AND c.turn = j.turn""")
def ocr_clean_response(spark, sf_dir):
    rows = load(spark, sf_dir, "conversations")
    given = rows.selectExpr("conv_id", "turn", """CASE turn % 4 WHEN 0 THEN '```markdown\n' || text || '\n```' WHEN 1 THEN to_json(named_struct('content', 'x', 'text', text || '\nAt the top,x\nAt the top, y')) WHEN 2 THEN 'Let me see.\n' || text || '\nI can see a page' ELSE '  ' END AS given""")
    return given.select("conv_id", "turn", ocr.answer(F.col("given")).alias("answer"))


# ---- tables

_FOUND = f"""{_LEVEL}, fd AS (SELECT doc_id % 300 AS file_no, doc_id % 4 + 1 AS page, level FROM lv WHERE doc_id % 5 <> 0), ex AS (SELECT o_orderkey % 300 AS file_no, o_orderkey % 4 + 1 AS page, count(*) AS tables FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1, 2)"""


@query(f"""WITH {_FOUND}, pg AS (SELECT file_no, page, count(*) AS n, max(CASE level WHEN 'red' THEN 2 WHEN 'yellow' THEN 1 ELSE 0 END) AS worst FROM fd GROUP BY 1, 2),
b AS (SELECT coalesce(ex.file_no, pg.file_no) AS file_no, tables, n, worst FROM ex FULL JOIN pg ON ex.file_no = pg.file_no AND ex.page = pg.page),
g AS (SELECT file_no, CAST(coalesce(sum(tables), 0) AS BIGINT) AS expected_tables, CAST(coalesce(sum(n), 0) AS BIGINT) AS markdown_tables, CAST(count_if(tables > 0 AND n IS NULL) AS BIGINT) AS missing_pages, coalesce(max(worst), 0) AS w, coalesce(max(n), 0) AS crowd FROM b GROUP BY 1)
SELECT file_no, expected_tables, markdown_tables, missing_pages, CASE WHEN expected_tables = 0 THEN 'green' WHEN expected_tables <> markdown_tables OR missing_pages > 0 OR w = 2 THEN 'red' WHEN w = 1 OR crowd > 1 OR expected_tables >= 10 THEN 'yellow' ELSE 'green' END AS level FROM g""")
def count_reconcile(spark, sf_dir):
    levels = tables.leveled(tables.profile(table_rows(spark, sf_dir), ["doc_id"], "row_no"))
    found = levels.where("doc_id % 5 <> 0").selectExpr("doc_id % 300 AS file_no", "doc_id % 4 + 1 AS page", "level")
    expected = load(spark, sf_dir, "orders").where("o_orderkey % 7 <> 0").selectExpr("o_orderkey % 300 AS file_no", "o_orderkey % 4 + 1 AS page").groupBy("file_no", "page").agg(F.count(F.lit(1)).alias("tables"))
    return tables.file_levels(found, expected, "file_no")


@query("""WITH o AS (SELECT o_custkey AS page, o_orderkey AS table_no, o_custkey % 9 + 1 AS rows, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders),
e AS (SELECT o_custkey AS page, o_custkey % 7 + 1 AS rows, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders WHERE o_orderkey % 3 <> 0)
SELECT o.page, table_no, CASE WHEN e.rows IS NULL THEN 'kept_missing_enhanced_table' ELSE 'replaced' END AS status, o.rows AS original_rows, coalesce(e.rows, 0) AS enhanced_rows FROM o LEFT JOIN e ON o.page = e.page AND o.k = e.k""")
def apply_repair(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    original = orders.selectExpr("o_custkey AS page", "o_orderkey AS table_no", "o_custkey % 9 + 1 AS rows")
    enhanced = orders.where("o_orderkey % 3 <> 0").selectExpr("o_custkey AS page", "o_orderkey AS table_no", "o_custkey % 7 + 1 AS rows")
    return tables.repaired(original, enhanced, ["page"])


@query("SELECT path, n FROM (SELECT CAST(o_custkey AS VARCHAR) AS path, count(*) AS n FROM orders GROUP BY 1) ORDER BY n DESC, path LIMIT 30")
def top_tables(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("path")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "path").limit(30)


# ---- recall and publishing


@query(r"""WITH c AS (SELECT item_id, regexp_replace(unnest(string_split(text, ' ')), '[^\p{L}\p{N}]', '', 'g') AS c FROM benchmark), t AS (SELECT item_id, regexp_replace(CASE WHEN item_id % 2 = 0 THEN text ELSE substr(text, 1, 60) END, '[^\p{L}\p{N}]', '', 'g') AS t FROM benchmark)
SELECT t.item_id, count(c.c) AS cells, round(coalesce(avg(contains(t, c.c)::INT), 1.0), 6) AS exact_cell_rate FROM t LEFT JOIN c ON t.item_id = c.item_id AND c.c <> '' GROUP BY 1""")
def exact_cell_rate(spark, sf_dir):
    b = load(spark, sf_dir, "benchmark")
    cells = b.select("item_id", F.explode(F.split("text", " ")).alias("cell"))
    return audit.exact_cell_rate(cells, b.selectExpr("item_id", "CASE WHEN item_id % 2 = 0 THEN text ELSE substr(text, 1, 60) END AS text"), "item_id")


@query(f"WITH {_MD}, {_LINES} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS entry, length(regexp_extract(line, '^(#+)', 1)) AS level, regexp_extract(line, '{T.HEADING}', 2) AS title FROM ls WHERE regexp_matches(line, '{T.HEADING}')")
def toc(spark, sf_dir):
    return publish.toc(md_documents(spark, sf_dir))


@query("SELECT doc_id, 'img/' || doc_id || '.png' AS target FROM documents UNION ALL SELECT doc_id, 'b.jpg' FROM documents WHERE doc_id % 2 = 0")
def image_refs(spark, sf_dir):
    d = load(spark, sf_dir, "documents").selectExpr("doc_id", "'![a](img/' || doc_id || '.png) ' || text || CASE WHEN doc_id % 2 = 0 THEN ' ![](b.jpg \"t\")' ELSE '' END AS body")
    return publish.image_refs(d).select("doc_id", "target")


@query()
def html_to_markdown(spark, sf_dir):
    return publish.html_to_markdown(load(spark, sf_dir, "pages"))


#: Bodies with each kind of block, around what the tables hold. Documents define an image twice, once or never.
_BODY = """'# Head ' || doc_id || '  ' || chr(10) || chr(10) || ' first of ' || lang || chr(10) || 'and ' || source || ' ' || chr(10) || '- a' || chr(10) || ' -  b | c' || chr(10) || '7. x' || chr(10)
 || '8. y' || chr(10) || '> q **' || lang || '**' || chr(10) || chr(10) || '> r  ' || chr(10) || chr(10) || 'A | ' || doc_id || chr(10) || ' :-- | --' || chr(10) || '| 1 |' || chr(10) || chr(10)
 || '---' || chr(10) || '```sql ' || chr(10) || '  SELECT ' || doc_id || chr(10) || chr(10) || '```' || chr(10) || '> ![fig][f1]' || chr(10) || '![](p/' || doc_id || '.png)' || chr(10)
 || CASE WHEN doc_id % 3 < 2 THEN '[f1]: one.png "t"' || chr(10) ELSE '' END || '* no list' || chr(10) || '* nor this' || chr(10) || CASE WHEN doc_id % 3 = 0 THEN '[f1]: two' || doc_id || '.png' || chr(10) ELSE '' END
 || '###### six' || chr(10) || '```' || chr(10) || 'open'"""
_FIG = "CASE doc_id % 3 WHEN 0 THEN 'two' || doc_id || '.png' WHEN 1 THEN 'one.png' END"


@query(f"""SELECT doc_id, unnest(range(1, 14))::INTEGER AS block_no, unnest(['heading', 'p', 'ul', 'ol', 'quote', 'table', 'hr', 'code', 'image', 'image', 'p', 'heading', 'code']) AS kind,
 unnest([1, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 6, NULL])::INTEGER AS level, unnest([NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'sql', NULL, NULL, NULL, NULL, 'text']) AS lang,
 unnest([NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'fig', '', NULL, NULL, NULL]) AS alt, unnest([NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, {_FIG}, 'p/' || doc_id || '.png', NULL, NULL, NULL]) AS target,
 unnest([NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'f1', NULL, NULL, NULL, NULL]) AS via,
 unnest(['Head ' || doc_id, 'first of ' || lang || ' and ' || source, 'a' || chr(10) || 'b | c', 'x' || chr(10) || 'y', 'q **' || lang || '**' || chr(10) || chr(10) || 'r  ', 'A | ' || doc_id || chr(10) || '| 1 |', '',
 '  SELECT ' || doc_id || chr(10), '', '', '* no list * nor this', 'six', 'open']) AS lines FROM documents""")
def md_blocks(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").selectExpr("doc_id", f"{_BODY} AS body")
    return publish.md_blocks(docs).drop("body").withColumn("lines", F.array_join("lines", "\n"))


@query("""SELECT doc_id, '<h1>Head ' || doc_id || '</h1>' || chr(10) || '<p>first of ' || lang || ' and ' || source || '</p>' || chr(10) || '<ul><li>a</li><li>b | c</li></ul>' || chr(10)
 || '<ol><li>x</li><li>y</li></ol>' || chr(10) || '<blockquote>q <strong>' || lang || '</strong><br><br>r  </blockquote>' || chr(10) || '<table><tr><th>A</th><th>' || doc_id || '</th></tr><tr><td>1</td></tr></table>' || chr(10)
 || '<hr>' || chr(10) || '<pre><code class="language-sql">  SELECT ' || doc_id || chr(10) || '</code></pre>' || chr(10) || '<figure><img src="' || coalesce(""" + _FIG + """, '') || '"><figcaption>fig</figcaption></figure>' || chr(10)
 || '<figure><img src="p/' || doc_id || '.png"></figure>' || chr(10) || '<p>* no list * nor this</p>' || chr(10) || '<h6>six</h6>' || chr(10) || '<pre><code class="language-text">open</code></pre>' AS html FROM documents""")
def md_to_html(spark, sf_dir):
    return publish.md_to_html(load(spark, sf_dir, "documents").selectExpr("doc_id", f"{_BODY} AS body"))


@query(f"""SELECT doc_id, NULL AS ref, '' AS alt, 'p/' || doc_id || '.png' AS target FROM documents UNION ALL SELECT doc_id, 'f1', 'fig', {_FIG} FROM documents
 UNION ALL SELECT doc_id, NULL, 'x', 'in/' || source FROM documents WHERE doc_id % 2 = 0""")
def image_definitions(spark, sf_dir):
    more = "CASE WHEN doc_id % 2 = 0 THEN chr(10) || 'text ![x](in/' || source || ' \"t\") text' ELSE '' END"
    return publish.image_refs(load(spark, sf_dir, "documents").selectExpr("doc_id", f"{_BODY} || {more} AS body"))


#: Pages with each construct of the tree, around what the tables hold.
_TREE = """'<head><title>x</title></head><body><nav>menu ' || page_id || '</nav><h1>Page  ' || page_id || '</h1><p>See <a href="' || url || '">the <b> link</b></a>,<br> <em>' || page_id || '</em>
 and <code>a*b</code>.<ul><li>one<ul><li>in ' || page_id || '<li>in2</ul><li><p>two</p><p>more</p></ul><ol start="3"><li>c</li><li>d</ol><blockquote><p>q</p><p>' || page_id || '</p></blockquote><pre><code class="language-sql">SELECT 1
  ' || page_id || '</code></pre><table><caption>cap</caption><tr><th rowspan="2">A<th colspan="2">B|' || page_id || '</tr><tr><td>1<td>2<br>3<tr><td>z</table><img src="' || page_id || '.png" alt="i" title="t"><script>no()</script><footer>foot</footer></body>'"""


@query("""SELECT page_id, '# Page ' || page_id || chr(10) || chr(10) || 'See [the **link**](' || url || '),' || chr(10) || '*' || page_id || '* and `a*b`.' || chr(10) || chr(10) || '- one' || chr(10) || '  - in ' || page_id || chr(10)
 || '  - in2' || chr(10) || '- two' || chr(10) || chr(10) || '  more' || chr(10) || chr(10) || '3. c' || chr(10) || '4. d' || chr(10) || chr(10) || '> q' || chr(10) || '>' || chr(10) || '> ' || page_id || chr(10) || chr(10)
 || '```sql' || chr(10) || 'SELECT 1' || chr(10) || '  ' || page_id || chr(10) || '```' || chr(10) || chr(10) || 'cap' || chr(10) || chr(10) || '| A | B\\|' || page_id || ' | B\\|' || page_id || ' |' || chr(10)
 || '| --- | --- | --- |' || chr(10) || '| A | 1 | 2<br>3 |' || chr(10) || '| z |  |  |' || chr(10) || chr(10) || '![i](' || page_id || '.png "t")' || chr(10) AS markdown FROM pages""")
def html_tree_markdown(spark, sf_dir):
    return publish.html_to_markdown(load(spark, sf_dir, "pages").selectExpr("page_id", f"{_TREE} AS html"))


@query("SELECT doc_id, sha1(text || ' <b> A é ' || chr(160) || '& &nosuch; x') AS text_sha1 FROM documents")
def entity_decode(spark, sf_dir):
    d = load(spark, sf_dir, "documents").selectExpr("doc_id", "replace(text, '&', '&amp;') || ' &lt;b&gt; &#65; &eacute; &nbsp;&amp; &nosuch; x' AS t")
    return d.select("doc_id", F.sha1(T.decoded(F.col("t"))).alias("text_sha1"))


_INNER = "SELECT 'in/' || p_partkey || '.zip' AS archive, unnest(CASE WHEN p_partkey % 3 = 0 THEN ['top/a.txt', 'top/sub/b.txt'] WHEN p_partkey % 3 = 1 THEN ['a.txt', 'top/b.txt'] ELSE [NULL] END) AS member, unnest(CASE WHEN p_partkey % 3 = 0 THEN ['a.txt', 'sub/b.txt'] WHEN p_partkey % 3 = 1 THEN ['a.txt', 'top/b.txt'] ELSE [NULL] END) AS target, unnest(CASE WHEN p_partkey % 3 = 2 THEN [NULL] ELSE [sha1(p_name), sha1(p_brand)] END) AS bytes_sha1, p_partkey % 3 = 2 AS failed FROM part"


@query(_INNER)
def archive_members(spark, sf_dir):
    part = dealt(spark, sf_dir, "part", "p_partkey").selectExpr("p_partkey", "'in/' || p_partkey || '.zip' AS path", "CASE p_partkey % 3 WHEN 0 THEN array('top/a.txt', 'top/sub/b.txt') WHEN 1 THEN array('a.txt', 'top/b.txt') END AS names", "array(p_name, p_brand) AS texts")
    found = readers.archive_members(part.select("path", readers.zipped("names", "texts").alias("content")))
    return found.select("archive", "member", "target", F.sha1("bytes").alias("bytes_sha1"), F.col("error").isNotNull().alias("failed"))


@query(f"SELECT 'top/inner.zip' AS via, * FROM ({_INNER}) UNION ALL SELECT '', 'in/' || p_partkey || '.zip', 'top/note.txt', 'note.txt', sha1(p_name), false FROM part")
def nested_archives(spark, sf_dir):
    part = dealt(spark, sf_dir, "part", "p_partkey").selectExpr("p_name", "'in/' || p_partkey || '.zip' AS path", "CASE p_partkey % 3 WHEN 0 THEN array('top/a.txt', 'top/sub/b.txt') WHEN 1 THEN array('a.txt', 'top/b.txt') END AS names", "array(p_name, p_brand) AS texts")
    inner = F.array(readers.zipped("names", "texts"), F.col("p_name").cast("binary"))
    whole = part.select("path", readers.zipped(F.array(F.lit("top/inner.zip"), F.lit("top/note.txt")), inner).alias("content"))
    found = readers.nested_members(whole)
    return found.select("archive", F.array_join("via", "!").alias("via"), "member", "target", F.sha1("bytes").alias("bytes_sha1"), F.col("error").isNotNull().alias("failed"))
