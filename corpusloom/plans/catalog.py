"""Named queries over the test tables, and the same in SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audit, clean, tables
from ..sources import route
from .fixtures import CELLS, MD, PATHS, PDF_PAGES, load, md_documents, table_rows

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_WS = T.WS
_NOISE = T.PAGE_NOISE.replace("'", "''")
_CHAPTER = T.CHAPTER.replace("'", "''")
_COMPACTED = T.COMPACTED.replace("'", "''")
_STRIP = lambda x: f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"
_COMPACT = lambda x: f"regexp_replace(regexp_replace({x}, '(?s)<!--.*?-->', '', 'g'), '{_COMPACTED}', '', 'g')"
_MD = f"md AS (SELECT doc_id, {MD} AS body FROM documents)"
_LINES = "ls AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS n, unnest(l) AS line FROM (SELECT doc_id, string_split(regexp_replace(body, '\\r\\n?', chr(10), 'g'), chr(10)) AS l FROM md))"


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _long(*names: str) -> list:
    return [F.col(n).cast("long").alias(n) for n in names]


# ---- cleaning and chunks

_CHUNKS = """WITH RECURSIVE s(doc_id, seq, part, rest) AS (
  SELECT doc_id, 0, '', {strip} FROM documents
  UNION ALL
  SELECT doc_id, seq + 1, CASE WHEN length(rest) > 2200 THEN {strip_cut} ELSE rest END, CASE WHEN length(rest) > 2200 THEN {strip_rest} ELSE '' END
  FROM (SELECT *, CASE WHEN instr(reverse(rest[1:2200]), chr(10)) = 0 OR 2200 - instr(reverse(rest[1:2200]), chr(10)) < 800 THEN 2200 ELSE 2200 - instr(reverse(rest[1:2200]), chr(10)) END AS cut FROM s) WHERE rest <> ''
), c AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS seq, part FROM s WHERE seq > 0 AND part <> '')""".format(strip=_STRIP("text"), strip_cut=_STRIP("rest[1:cut]"), strip_rest=_STRIP("rest[cut + 1:]"))


@query(_CHUNKS + " SELECT doc_id, seq, length(part) AS n_chars, sha1(part) AS chunk_sha1 FROM c")
def chunk_documents(spark, sf_dir):
    return clean.chunk(load(spark, sf_dir, "documents")).select("doc_id", "seq", F.length("chunk").cast("long").alias("n_chars"), F.sha1("chunk").alias("chunk_sha1"))


@query(_CHUNKS + " SELECT doc_id, count(*) AS n_chunks, max(length(part)) AS longest, min(length(part)) AS shortest FROM c GROUP BY doc_id")
def chunk_stats(spark, sf_dir):
    n = F.length("chunk").cast("long")
    return clean.chunk(load(spark, sf_dir, "documents")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks"), F.max(n).alias("longest"), F.min(n).alias("shortest"))


@query(f"""WITH {_MD}, {_LINES}, r AS (SELECT doc_id, n, regexp_replace(regexp_replace(replace(line, chr(160), ' '), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g'), '{_WS}+$', '') AS line FROM ls),
t AS (SELECT *, {_STRIP('line')} AS s FROM r), rep AS (SELECT doc_id, s FROM t WHERE s <> '' AND length(s) <= 80 AND NOT regexp_matches(s, '{_NOISE}') GROUP BY 1, 2 HAVING count(*) >= 4),
k AS (SELECT t.doc_id, t.n, CASE WHEN t.s <> '' AND NOT starts_with(t.s, '#') AND NOT contains(t.s, '|') AND length(t.s) <= 140 AND regexp_matches(t.s, '{_CHAPTER}') THEN '## ' || t.s ELSE t.line END AS line
  FROM t LEFT JOIN rep ON t.doc_id = rep.doc_id AND t.s = rep.s WHERE rep.s IS NULL AND NOT regexp_matches(t.s, '{_NOISE}')),
j AS (SELECT doc_id, regexp_replace({_STRIP("string_agg(line, chr(10) ORDER BY n)")} || chr(10), '\\n{{3,}}', chr(10) || chr(10), 'g') AS cleaned FROM k GROUP BY 1)
SELECT documents.doc_id, sha1(coalesce(cleaned, chr(10))) AS cleaned_sha1, length(coalesce(cleaned, chr(10))) AS n_chars FROM documents LEFT JOIN j USING (doc_id)""")
def clean_body(spark, sf_dir):
    return clean.clean_lines(md_documents(spark, sf_dir)).select("doc_id", F.sha1("cleaned").alias("cleaned_sha1"), F.length("cleaned").cast("long").alias("n_chars"))


@query(f"WITH {_MD}, {_LINES} SELECT doc_id, count(*) AS noise_lines FROM ls WHERE regexp_matches({_STRIP('line')}, '{_NOISE}') GROUP BY doc_id")
def page_noise_lines(spark, sf_dir):
    n = F.size(F.filter(T.lines(F.col("body")), lambda x: T.is_noise(T.strip(x)))).cast("long")
    return md_documents(spark, sf_dir).select("doc_id", n.alias("noise_lines")).where("noise_lines > 0")


@query(f"WITH {_MD}, {_LINES}, t AS (SELECT doc_id, {_STRIP('line')} AS s FROM ls) SELECT doc_id, s AS line FROM t WHERE s <> '' AND length(s) <= 80 AND NOT regexp_matches(s, '{_NOISE}') GROUP BY 1, 2 HAVING count(*) >= 4")
def repeated_lines(spark, sf_dir):
    docs = clean.with_lines(md_documents(spark, sf_dir))
    return docs.select("doc_id", F.explode(clean.repeated_short("short")).alias("line"))


@query(f"WITH {_MD}, {_LINES}, t AS (SELECT doc_id, n, {_STRIP('line')} AS s FROM ls) SELECT doc_id, n AS line_no, '## ' || s AS heading FROM t WHERE s <> '' AND NOT starts_with(s, '#') AND NOT contains(s, '|') AND length(s) <= 140 AND regexp_matches(s, '{_CHAPTER}')")
def promote_headings(spark, sf_dir):
    rows = md_documents(spark, sf_dir).select("doc_id", F.posexplode(T.lines(F.col("body"))).alias("line_no", "line")).withColumn("heading", T.promoted(F.col("line")))
    return rows.where("heading <> line").select("doc_id", *_long("line_no"), "heading")


@query(f"WITH {_MD}, {_LINES}, s AS (SELECT *, sum(CASE WHEN regexp_matches(line, '{T.HEADING}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS section FROM ls) SELECT doc_id, CAST(section AS BIGINT) AS section, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM s GROUP BY 1, 2")
def sections(spark, sf_dir):
    rows = clean.sections(md_documents(spark, sf_dir))
    return rows.groupBy("doc_id", "section").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).cast("long").alias("n_chars"))


# ---- scalar functions


@query("SELECT doc_id, substr(sha1(source || '|' || doc_id), 1, 14) AS file_id FROM documents")
def doc_ids(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", T.hash_id(F.concat_ws("|", "source", "doc_id")).alias("file_id"))


@query(r"""WITH s AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '[<>:"/\\|?*\x00-\x1f]', '_', 'g'), '\s+', '_', 'g'), '^[._ ]+|[._ ]+$', '', 'g')[1:90] AS s FROM pages) SELECT page_id, CASE WHEN s = '' THEN 'document' ELSE s END AS slug FROM s""")
def slugs(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", T.slug(F.col("url")).alias("slug"))


@query(f"SELECT doc_id, length({_COMPACT('text')}) AS compact_chars, length({_COMPACT('text')}) < 30 AS near_empty FROM documents")
def compact_length(spark, sf_dir):
    return audit.inspected(load(spark, sf_dir, "documents")).select("doc_id", "compact_chars", "near_empty")


_ODD_CELL = "CASE p_partkey % 11 WHEN 0 THEN p_size || '%' WHEN 1 THEN '1e5' WHEN 2 THEN 'NaN' WHEN 3 THEN '1 2' WHEN 4 THEN ' ￥1,23' || p_size || '.5 ' WHEN 5 THEN 'Infinity' WHEN 6 THEN '-' || p_size WHEN 7 THEN '.5' WHEN 8 THEN '+7.' WHEN 9 THEN '（' || p_brand || '）—x_y' ELSE p_brand END"
_RELAX = lambda x: f"lower(regexp_replace({x}, '[\\s\\x0b\\x1c-\\x1f\\x85\\p{{Z}},，.。;；:：!！?？()（）\\[\\]【】<>《》\"''“”‘’、/\\\\|-]+', '', 'g'))"
_PLAIN_NUMBER = lambda x: f"regexp_replace({_STRIP(x)}, '[,，%￥¥]', '', 'g')"
_NUM = lambda x: f"CASE WHEN regexp_full_match({_PLAIN_NUMBER(x)}, '[-+]?[0-9]+(\\.[0-9]+)?') THEN CAST({_PLAIN_NUMBER(x)} AS DOUBLE) END"


@query(f"WITH c AS (SELECT p_partkey, {_ODD_CELL} AS cell, p_name || ' - ' || p_brand || '.' AS name FROM part) SELECT p_partkey, {_RELAX('name')} AS relaxed, {_RELAX('cell')} AS relaxed_cell, {_NUM('cell')} AS numeric FROM c")
def relaxed_cells(spark, sf_dir):
    part = load(spark, sf_dir, "part").selectExpr("p_partkey", f"{_ODD_CELL} AS cell", "p_name || ' - ' || p_brand || '.' AS name")
    return part.select("p_partkey", T.relaxed(F.col("name")).alias("relaxed"), T.relaxed(F.col("cell")).alias("relaxed_cell"), T.numeric(F.col("cell")).alias("numeric"))


@query(r"""WITH l AS (SELECT o_orderkey, list_sort(list_distinct(list_transform(list_filter(string_split_regex(o_orderkey % 50 || ', ' || o_custkey % 9 || ';' || o_orderstatus || ' ' || o_orderkey % 50, '[,;，；\s]+'), lambda x: regexp_full_match(x, '\d+')), lambda x: CAST(x AS BIGINT)))) AS p FROM orders)
SELECT o_orderkey, array_to_string(p, ',') AS pages FROM l""")
def page_list_parse(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderkey % 50 || ', ' || o_custkey % 9 || ';' || o_orderstatus || ' ' || o_orderkey % 50 AS given")
    return orders.select("o_orderkey", F.array_join(T.page_numbers(F.col("given")).cast("array<string>"), ",").alias("pages"))


@query("""WITH p AS (SELECT DISTINCT p_size AS pages, p_partkey % 9 AS most FROM part), i AS (SELECT pages, most, least(pages, most) AS n, unnest(range(CAST(least(pages, most) AS BIGINT))) AS k FROM p)
SELECT CAST(pages AS BIGINT) AS pages, CAST(most AS BIGINT) AS most, string_agg(DISTINCT CAST(k * (pages - 1) // greatest(n - 1, 1) AS BIGINT), ',' ORDER BY CAST(k * (pages - 1) // greatest(n - 1, 1) AS BIGINT)) AS sampled FROM i GROUP BY 1, 2""")
def sample_indexes(spark, sf_dir):
    p = load(spark, sf_dir, "part").selectExpr("CAST(p_size AS BIGINT) AS pages", "p_partkey % 9 AS most").distinct().where("most > 0")
    return p.select("pages", "most", F.array_join(T.sample_indexes(F.col("pages"), F.col("most")).cast("array<string>"), ",").alias("sampled"))


_ENTITIES = [("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "\u0027\u0027"), ("&eacute;", "é"), ("&#x41;", "A"), ("&amp;", "&")]
_FRAGMENT = """'intro' || chr(10) || '```html' || chr(10) || '<h2 class=x>Cost &lt; 5&nbsp;&eacute;</h2>' || chr(10) || '```' || chr(10) || '<H6>deep</H6><p>' || replace(replace(text, '&', '&amp;'), '<', '&lt;') || '</p><br/>a<div>b</div> &quot;q&quot; <!-- keep &#x41; --> <b>bold</b>  ' || chr(10) || 'end'"""


def _unescaped_sql(x: str) -> str:
    for name, value in _ENTITIES:
        x = f"replace({x}, '{name}', '{value}')"
    return x


@query(f"""WITH f AS (SELECT doc_id, {_FRAGMENT} AS t FROM documents), a AS (SELECT doc_id, regexp_replace(regexp_replace(t, '(?is)```html\\s*(.*?)\\s*```', '\\1', 'g'), '(?i)<h2[^>]*>\\s*([^<]*?)\\s*</h2>', chr(10) || '### \\1' || chr(10), 'g') AS t FROM f),
b AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(a.t, '(?i)<h6[^>]*>\\s*([^<]*?)\\s*</h6>', chr(10) || '###### \\1' || chr(10), 'g'), '(?i)<br\\s*/?>|</p\\s*>', chr(10), 'g'), '(?i)</?(p|div|body|html|b)[^>]*>', '', 'g') AS t FROM a)
SELECT doc_id, sha1(regexp_replace({_unescaped_sql('t')}, '[ \\t]+\\n', chr(10), 'g')) AS fragment_sha1 FROM b""")
def html_fragments(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").selectExpr("doc_id", f"{_FRAGMENT} AS t")
    bare = clean.bound(docs, "t", T.without_tags(F.col("t")))
    whole = clean.bound(bare, "t", T.with_references_decoded(F.col("t")))
    return whole.select("doc_id", F.sha1("t").alias("fragment_sha1"))


# ---- routing and manifest

_ROUTED = f"f AS (SELECT {PATHS} AS path, p_size AS bytes FROM part), e AS (SELECT path, lower(regexp_extract(path, '(\\.[^./]+)$', 1)) AS extension, CAST(bytes AS BIGINT) AS bytes FROM f WHERE NOT regexp_matches(path, '(^|/)\\.[^/]') AND NOT regexp_matches(path, '(^|/)~\\$[^/]*$')), r AS (SELECT path, extension, bytes, CASE WHEN extension IN ('.csv', '.docx', '.htm', '.html', '.json', '.md', '.pptx', '.txt', '.xlsx', '.xml') THEN 'simple_direct' WHEN extension IN ('.doc', '.ppt', '.xls') THEN 'legacy_office' WHEN extension IN ('.bmp', '.jpeg', '.jpg', '.png', '.tif', '.tiff', '.webp') THEN 'needs_ocr' WHEN extension IN ('.rar', '.zip') THEN 'archive' WHEN extension = '.pdf' THEN 'pdf_text' ELSE 'unsupported' END AS bucket FROM e)"


def _files(spark, sf_dir):
    return load(spark, sf_dir, "part").selectExpr(f"{PATHS} AS path", "CAST(p_size AS BIGINT) AS bytes")


@query(f"WITH {_ROUTED} SELECT * FROM r")
def route_entries(spark, sf_dir):
    return route.routed(_files(spark, sf_dir))


@query(f"WITH {_ROUTED} SELECT bucket, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes FROM r GROUP BY bucket")
def route_counts(spark, sf_dir):
    return route.routed(_files(spark, sf_dir)).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))


@query(f"""WITH p AS ({PDF_PAGES}), g AS (SELECT path, count(*) AS pages, round(avg(n_text_chars), 1) AS average_text_chars, count_if(n_text_chars < 40) AS low_text_pages, count_if(n_images > 0) AS image_pages, count_if(n_tables > 0) AS table_pages, bool_and(ok) AS ok FROM p GROUP BY path)
SELECT path, pages, average_text_chars, CAST(low_text_pages AS BIGINT) AS low_text_pages, CAST(image_pages AS BIGINT) AS image_pages, CAST(table_pages AS BIGINT) AS table_pages,
CASE WHEN table_pages > 0 THEN 'pdf_table' WHEN low_text_pages / pages >= 0.7 AND image_pages / pages >= 0.5 THEN 'needs_ocr' WHEN low_text_pages = pages OR NOT ok THEN 'manual_review' ELSE 'pdf_text' END AS bucket FROM g""")
def pdf_route(spark, sf_dir):
    return route.pdf_route(spark.sql(PDF_PAGES.replace("FROM conversations", "FROM {c}"), c=load(spark, sf_dir, "conversations")).withColumnRenamed("ok", "table_detection_ok"))


@query("SELECT source, CASE WHEN avg(n_chars) < 180 THEN 'needs_review' ELSE 'text_ok' END AS ocr_status, count(*) AS n, round(avg(n_chars), 1) AS average_chars FROM documents GROUP BY source")
def text_density(spark, sf_dir):
    each = load(spark, sf_dir, "documents").groupBy("source").agg(F.avg("n_chars").alias("a"), F.count(F.lit(1)).alias("n"))
    return each.select("source", route.text_status(F.col("a")).alias("ocr_status"), "n", F.round("a", 1).alias("average_chars"))


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def manifest_upsert(spark, sf_dir):
    return audit.latest(load(spark, sf_dir, "events"), ["user_id"], ["event_id"], "event_type")


@query("SELECT event_type, count(*) AS n FROM (SELECT * FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE user_id % 3 = 0)) GROUP BY event_type")
def ocr_resume(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    return route.resume(events, events.where("user_id % 3 = 0"), ["event_id"]).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


# ---- assembly, inspection, audit


@query("""WITH o AS (SELECT doc_id, lang || ' ocr' AS body FROM documents WHERE doc_id % 4 = 0 UNION ALL SELECT doc_id + 10000000, 'extra' FROM documents WHERE doc_id % 50 = 0), p AS (SELECT doc_id, source || ' page' AS body FROM documents WHERE doc_id % 3 = 0),
b AS (SELECT doc_id, lang AS body, doc_id % 2 = 0 AS is_pdf FROM documents)
SELECT coalesce(b.doc_id, o.doc_id, p.doc_id) AS doc_id, CASE WHEN b.doc_id IS NOT NULL AND NOT is_pdf THEN 'original' WHEN o.doc_id IS NOT NULL THEN 'ocr' WHEN p.doc_id IS NOT NULL THEN 'page_aware' ELSE 'original' END AS origin,
CASE WHEN b.doc_id IS NOT NULL AND NOT is_pdf THEN b.body WHEN o.doc_id IS NOT NULL THEN o.body WHEN p.doc_id IS NOT NULL THEN p.body ELSE b.body END AS body
FROM b FULL JOIN o ON b.doc_id = o.doc_id FULL JOIN p ON coalesce(b.doc_id, o.doc_id) = p.doc_id""")
def assemble_precedence(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    ocr = d.where("doc_id % 4 = 0").selectExpr("doc_id", "lang || ' ocr' AS body").unionAll(d.where("doc_id % 50 = 0").selectExpr("doc_id + 10000000", "'extra'"))
    return audit.assembled(d.selectExpr("doc_id", "lang AS body", "doc_id % 2 = 0 AS is_pdf"), ocr, d.where("doc_id % 3 = 0").selectExpr("doc_id", "source || ' page' AS body"))


@query(f"""WITH {_MD}, {_LINES.replace('FROM md', "FROM (SELECT doc_id, regexp_replace(body, '(?s)<!--.*?-->', '', 'g') AS body FROM md)")}, c AS (SELECT doc_id, length(regexp_replace(line, '{_COMPACTED}', '', 'g')) AS k FROM ls), g AS (SELECT doc_id, count_if(k > 0) AS n, count_if(k BETWEEN 1 AND 2) AS tiny FROM c GROUP BY 1)
SELECT md.doc_id, contains(body, '�') AS replacement_char, contains(lower(body), '<think>') OR contains(lower(body), 'invalid api key') OR contains(lower(body), 'sensitive image') OR contains(lower(body), 'server error') AS provider_error, n >= 20 AND tiny / n >= 0.65 AS fragmented FROM md JOIN g USING (doc_id)""")
def inspect_documents(spark, sf_dir):
    return audit.inspected(md_documents(spark, sf_dir), "body").select("doc_id", "replacement_char", "provider_error", "fragmented")


@query(f"""WITH p AS (SELECT conv_id AS doc_id, turn + 1 + CASE WHEN conv_id % 5 = 1 THEN 1 ELSE 0 END AS page, CASE WHEN conv_id % 4 = 0 THEN '--' ELSE text END AS text FROM conversations), g AS (SELECT doc_id, count(*) AS n_pages, count(DISTINCT page) AS d, min(page) AS lo, max(page) AS hi, sum(length({_COMPACT('text')})) AS chars, count_if(length({_COMPACT('text')}) < 5) AS blank FROM p GROUP BY 1)
SELECT doc_id, n_pages, d <> n_pages AS duplicate_markers, lo <> 1 OR hi <> d AS non_contiguous, chars < greatest(30, n_pages * 12) AS sparse, n_pages >= 3 AND blank / n_pages > 0.5 AS mostly_blank FROM g""")
def ocr_page_issues(spark, sf_dir):
    c = load(spark, sf_dir, "conversations").selectExpr("conv_id AS doc_id", "turn + 1 + CASE WHEN conv_id % 5 = 1 THEN 1 ELSE 0 END AS page", "CASE WHEN conv_id % 4 = 0 THEN '--' ELSE text END AS text")
    return audit.page_issues(c)


@query("SELECT sha1(text) AS text_sha1, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_sources(spark, sf_dir):
    return audit.duplicates(load(spark, sf_dir, "documents").select(F.sha1("text").alias("text_sha1")), "text_sha1")


@query("WITH c AS (SELECT doc_id FROM documents WHERE doc_id % 10 <> 3 UNION SELECT doc_id + 10000000 FROM documents WHERE doc_id % 20 = 0) SELECT doc_id, 'without_chunks' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM c) UNION ALL SELECT doc_id, 'without_document' FROM c WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def chunk_coverage(spark, sf_dir):
    d = load(spark, sf_dir, "documents").select("doc_id")
    return audit.coverage(d, d.where("doc_id % 10 <> 3").unionAll(d.where("doc_id % 20 = 0").selectExpr("doc_id + 10000000")))


@query("SELECT count(*) AS documents, count(DISTINCT doc_id) AS distinct_ids, count(DISTINCT sha1(text)) AS distinct_texts, count_if(n_chars < 30) AS short FROM documents")
def audit_summary(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    return d.agg(F.count(F.lit(1)).alias("documents"), F.count_distinct("doc_id").alias("distinct_ids"), F.count_distinct(F.sha1("text")).alias("distinct_texts"), F.count_if(F.col("n_chars") < 30).alias("short"))


# ---- source recall

_WIDE, _NARROW = "ＡＢＣＤＥＦＧＨａｂｃｄｅｆｇｈ０１２３４５６７８９", "ABCDEFGHabcdefgh0123456789"
_SOURCE = f"CASE WHEN item_id % 5 = 0 THEN translate(text, '{_NARROW}', '{_WIDE}') ELSE text END"
_TARGET = "CASE WHEN item_id % 3 = 0 THEN reverse(text) WHEN item_id % 3 = 1 THEN substr(text, 1, CAST(floor(length(text) / 2) AS INT)) ELSE '' END"
_PAIRS = f"pr AS (SELECT item_id, translate({_SOURCE}, '{_WIDE}', '{_NARROW}') AS a, {_TARGET} AS b FROM benchmark)"


def _pairs(spark, sf_dir):
    return load(spark, sf_dir, "benchmark").selectExpr("item_id", f"{_SOURCE} AS a", f"{_TARGET} AS b")


_CHARACTERS = lambda c, n: f"(SELECT item_id, c, count(*) AS n FROM (SELECT item_id, unnest(string_split(regexp_replace({c}, '[^\\p{{L}}\\p{{N}}]', '', 'g'), '')) AS c FROM pr) WHERE c <> '' GROUP BY 1, 2)"
_RECALL = f"""{_PAIRS}, x AS {_CHARACTERS('a', 'n')}, y AS {_CHARACTERS('b', 'n')},
rc AS (SELECT pr.item_id, round(coalesce(sum(least(x.n, coalesce(y.n, 0))) / sum(x.n), 1.0), 6) AS recall FROM pr LEFT JOIN x USING (item_id) LEFT JOIN y ON x.item_id = y.item_id AND x.c = y.c GROUP BY 1)"""


@query(f"WITH {_RECALL} SELECT item_id, recall FROM rc")
def char_recall(spark, sf_dir):
    return audit.char_recall(_pairs(spark, sf_dir), "a", "b", "item_id")


@query(f"WITH {_RECALL} SELECT count(*) AS checked, count_if(recall < 0.9) AS below, coalesce(min(recall), 1.0) AS lowest FROM rc")
def recall_summary(spark, sf_dir):
    r = audit.char_recall(_pairs(spark, sf_dir), "a", "b", "item_id")
    return r.agg(F.count(F.lit(1)).alias("checked"), F.count_if(F.col("recall") < audit.LEAST_RECALL).alias("below"), F.coalesce(F.min("recall"), F.lit(1.0)).alias("lowest"))


@query("""WITH r AS (SELECT DISTINCT 'd' || doc_id % 40 AS document, CAST(doc_id % 3 AS VARCHAR) AS page, CAST(doc_id % 2 AS VARCHAR) AS table_no, 'open' AS status FROM labels), a AS (SELECT DISTINCT 'd' || doc_id % 40 AS document, CASE WHEN doc_id % 40 % 4 = 0 THEN '' ELSE CAST(doc_id % 3 AS VARCHAR) END AS page,
CASE WHEN doc_id % 40 % 4 < 2 THEN '' ELSE CAST(doc_id % 2 AS VARCHAR) END AS table_no, 's' || doc_id % 40 % 4 AS status FROM labels WHERE doc_id % 40 < 30)
SELECT r.*, coalesce(a0.status, a1.status, a2.status, r.status) AS final_status FROM r LEFT JOIN a a0 ON a0.document = r.document AND a0.page = r.page AND a0.table_no = r.table_no LEFT JOIN a a1 ON a1.document = r.document AND a1.page = r.page AND a1.table_no = '' LEFT JOIN a a2 ON a2.document = r.document AND a2.page = '' AND a2.table_no = ''""")
def attestation_precedence(spark, sf_dir):
    l = load(spark, sf_dir, "labels")  # noqa: E741
    rows = l.selectExpr("'d' || doc_id % 40 AS document", "CAST(doc_id % 3 AS STRING) AS page", "CAST(doc_id % 2 AS STRING) AS table_no", "'open' AS status").distinct()
    said = l.where("doc_id % 40 < 30").selectExpr("'d' || doc_id % 40 AS document", "CASE WHEN doc_id % 40 % 4 = 0 THEN '' ELSE CAST(doc_id % 3 AS STRING) END AS page", "CASE WHEN doc_id % 40 % 4 < 2 THEN '' ELSE CAST(doc_id % 2 AS STRING) END AS table_no", "'s' || doc_id % 40 % 4 AS status").distinct()
    return audit.attested(rows, said)


# ---- tables

_CELLS = f"tr AS ({CELLS})"
_PROFILE = f"""{_CELLS}, tp AS (SELECT doc_id, count(*) AS rows, CAST(3 AS BIGINT) AS cols, round(1 - sum((c1 <> '')::INT + (c2 <> '')::INT + (c3 <> '')::INT) / (3 * count(*)), 4) AS empty_ratio,
CAST(3 - arg_min((c1 <> '')::INT + (c2 <> '')::INT + (c3 <> '')::INT, row_no) AS BIGINT) AS blank_header_cells, CAST(3 AS BIGINT) AS header_cells, CAST(sum((length(c1) > 120)::INT + (length(c2) > 120)::INT + (length(c3) > 120)::INT) AS BIGINT) AS long_cell_count FROM tr GROUP BY doc_id)"""
_LEVEL = f"""{_PROFILE}, lv AS (SELECT *, CASE WHEN rows < 2 OR cols < 2 OR blank_header_cells / header_cells >= 0.5 OR empty_ratio >= 0.65 THEN 'red' WHEN empty_ratio >= 0.42 OR cols >= 8 OR rows >= 20 OR long_cell_count > 0 THEN 'yellow' ELSE 'green' END AS level,
concat_ws(',', CASE WHEN rows < 2 OR cols < 2 THEN 'table_too_small_or_parse_failed' END, CASE WHEN blank_header_cells / header_cells >= 0.5 THEN 'mostly_blank_header' END, CASE WHEN empty_ratio >= 0.65 THEN 'too_many_empty_cells' WHEN empty_ratio >= 0.42 THEN 'many_empty_cells' END,
CASE WHEN cols >= 8 THEN 'wide_table' END, CASE WHEN rows >= 20 THEN 'long_table' END, CASE WHEN long_cell_count > 0 THEN 'long_wrapped_cells' END) AS reasons FROM tp)"""


@query(f"""WITH {_CELLS}, o AS (SELECT doc_id, row_no, '| ' || replace(c1, '|', '\\|') || ' | ' || replace(c2, '|', '\\|') || ' | ' || replace(c3, '|', '\\|') || ' |' AS line FROM tr),
p AS (SELECT doc_id, row_no * 2 AS k, line FROM o UNION ALL SELECT doc_id, min(row_no) * 2 + 1, '| --- | --- | --- |' FROM o GROUP BY doc_id) SELECT doc_id, sha1(string_agg(line, chr(10) ORDER BY k)) AS table_sha1 FROM p GROUP BY doc_id""")
def render_tables(spark, sf_dir):
    return tables.rendered(table_rows(spark, sf_dir), ["doc_id"], "row_no").select("doc_id", F.sha1("markdown").alias("table_sha1"))


@query(f"WITH {_PROFILE} SELECT * FROM tp")
def table_profile(spark, sf_dir):
    return tables.profile(table_rows(spark, sf_dir), ["doc_id"], "row_no")


@query(f"WITH {_LEVEL} SELECT doc_id, level, reasons FROM lv")
def table_level(spark, sf_dir):
    return tables.leveled(tables.profile(table_rows(spark, sf_dir), ["doc_id"], "row_no")).select("doc_id", "level", "reasons")


@query(f"WITH {_LEVEL} SELECT level, count(*) AS n FROM lv GROUP BY level")
def table_level_counts(spark, sf_dir):
    return tables.leveled(tables.profile(table_rows(spark, sf_dir), ["doc_id"], "row_no")).groupBy("level").agg(F.count(F.lit(1)).alias("n"))


_BLOCKS = f"""{_MD}, {_LINES}, pl AS (SELECT doc_id, n, string_split(s[2:-2], '|') AS cells FROM (SELECT doc_id, n, {_STRIP('line')} AS s FROM ls) WHERE starts_with(s, '|') AND ends_with(s, '|')),
bl AS (SELECT *, n - row_number() OVER (PARTITION BY doc_id ORDER BY n) AS block FROM pl),
br AS (SELECT *, len(cells) AS w, first_value(len(cells)) OVER (PARTITION BY doc_id, block ORDER BY n) AS w0, max(len(cells)) OVER (PARTITION BY doc_id, block) AS width, min(n) OVER (PARTITION BY doc_id, block) AS n0, len(list_filter(cells, lambda c: regexp_matches(c, '{T.SEPARATOR_CELL}'))) = len(cells) AS is_rule FROM bl)"""


@query(f"WITH {_BLOCKS}, g AS (SELECT doc_id, block, sum((w <> w0)::INT) AS off, bool_or(is_rule) AS ruled FROM br GROUP BY 1, 2) SELECT doc_id, CAST(sum(off) AS BIGINT) AS column_mismatch, CAST(sum((NOT ruled)::INT) AS BIGINT) AS missing_separator FROM g GROUP BY 1")
def table_issues(spark, sf_dir):
    return tables.syntax_issues(md_documents(spark, sf_dir))


@query(f"""WITH {_BLOCKS}, x AS (SELECT *, is_rule AND w = width AS rule_row, bool_or(is_rule AND w = width) OVER (PARTITION BY doc_id, block) AS ruled FROM br), o AS (
SELECT doc_id, block, n * 2 AS k, CASE WHEN rule_row THEN '|' || repeat(' --- |', width) ELSE '|' || array_to_string(cells, '|') || repeat('|', width - w) || '|' END AS row FROM x
UNION ALL SELECT doc_id, block, n * 2 + 1, '|' || repeat(' --- |', width) FROM x WHERE n = n0 AND NOT ruled)
SELECT doc_id, dense_rank() OVER (PARTITION BY doc_id ORDER BY block) AS block, row_number() OVER (PARTITION BY doc_id, block ORDER BY k) AS line_no, row FROM o""")
def normalize_tables(spark, sf_dir):
    return tables.normalized(md_documents(spark, sf_dir))


_CHANGED = "CASE WHEN doc_id % 4 = 1 AND row_no <= doc_id % 6 THEN c1 || 'x' WHEN doc_id % 4 = 2 THEN '(' || c1 || '）' WHEN doc_id % 4 = 3 AND row_no > 1 THEN c1 || '.0%' ELSE c1 END"
_SIDES = f"""{_CELLS}, ta AS (SELECT * FROM tr WHERE doc_id % 11 <> 0), tb AS (SELECT doc_id, row_no, {_CHANGED} AS c1, upper(c2) AS c2, c3 FROM tr WHERE doc_id % 13 <> 0 AND (doc_id % 9 <> 2 OR row_no > 1)),
na AS (SELECT doc_id, count(*) AS n, row_number() OVER () FROM ta GROUP BY doc_id), nb AS (SELECT doc_id, count(*) AS n FROM tb GROUP BY doc_id),
oa AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY row_no) AS k, c1, c2, c3 FROM ta), ob AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY row_no) AS k, c1, c2, c3 FROM tb),
ce AS (SELECT doc_id, {_STRIP("regexp_replace(unnest([oa.c1, oa.c2, oa.c3]), '[ \\t]+', ' ', 'g')")} AS u, {_STRIP("regexp_replace(unnest([ob.c1, ob.c2, ob.c3]), '[ \\t]+', ' ', 'g')")} AS v FROM oa JOIN ob USING (doc_id, k)),
nu AS (SELECT doc_id, u, v, {_NUM('u')} AS x, {_NUM('v')} AS y FROM ce),
mm AS (SELECT doc_id, count_if(CASE WHEN x IS NOT NULL OR y IS NOT NULL THEN NOT coalesce(abs(x - y) <= 1e-9, false) ELSE {_RELAX('u')} <> {_RELAX('v')} END) AS n FROM nu GROUP BY 1),
cmp AS (SELECT coalesce(na.doc_id, nb.doc_id) AS doc_id, CASE WHEN na.n = nb.n AND mm.n = 0 THEN 'high' ELSE 'conflict' END AS confidence, CASE WHEN na.n IS NULL THEN 'pdfplumber_missing_table' WHEN nb.n IS NULL THEN 'camelot_missing_table' WHEN na.n <> nb.n THEN 'shape_mismatch:' || na.n || 'x3!=' || nb.n || 'x3'
 WHEN mm.n >= 3 THEN 'cell_mismatch:3_or_more' WHEN mm.n > 0 THEN 'cell_mismatch:' || mm.n ELSE 'engines_agree_structure_and_cells' END AS reason FROM na FULL JOIN nb ON na.doc_id = nb.doc_id LEFT JOIN mm ON mm.doc_id = coalesce(na.doc_id, nb.doc_id))"""


def _compared(spark, sf_dir):
    rows = table_rows(spark, sf_dir).selectExpr("doc_id", "row_no", "cells[0] AS c1", "cells[1] AS c2", "cells[2] AS c3")
    b = rows.where("doc_id % 13 <> 0 AND (doc_id % 9 <> 2 OR row_no > 1)").selectExpr("doc_id", "row_no", f"array({_CHANGED}, upper(c2), c3) AS cells")
    return tables.compared(rows.where("doc_id % 11 <> 0").selectExpr("doc_id", "row_no", "array(c1, c2, c3) AS cells"), b, ["doc_id"])


@query(f"WITH {_SIDES} SELECT * FROM cmp")
def engine_compare(spark, sf_dir):
    return _compared(spark, sf_dir)


@query(f"WITH {_SIDES}, c AS (SELECT DISTINCT doc_id % 100 AS file_no, CAST(doc_id % 7 AS INT) AS page, reason FROM cmp WHERE confidence <> 'high'), p AS (SELECT file_no, page, 'dual_engine_conflict:' || array_to_string(list_sort(list(reason))[1:5], ';') AS page_reason FROM c GROUP BY ALL), f AS (SELECT file_no, 'dual_engine_conflict:' || array_to_string(list_sort(list(DISTINCT reason))[1:8], ';') AS file_reason FROM c GROUP BY ALL) SELECT * FROM p JOIN f USING (file_no)")
def conflict_candidates(spark, sf_dir):
    c = _compared(spark, sf_dir).where("confidence <> 'high'").select((F.col("doc_id") % 100).alias("file_no"), (F.col("doc_id") % 7).cast("int").alias("page"), "reason")
    return tables.conflicts(c, "file_no", "page", "reason")


_BOX = "SELECT l_orderkey AS doc_id, l_linenumber AS n, CAST(l_quantity AS DOUBLE) AS x0, CAST(l_partkey % 90 AS DOUBLE) AS y0, CAST(l_quantity + 20 AS DOUBLE) AS x1, CAST(l_partkey % 90 + 15 AS DOUBLE) AS y1 FROM lineitem"


@query(f"""WITH a AS ({_BOX}) SELECT t.doc_id, CAST(t.n AS BIGINT) AS n FROM a t WHERE t.n % 2 = 0 AND NOT EXISTS (SELECT 1 FROM a b WHERE b.n % 2 = 1 AND b.doc_id = t.doc_id AND greatest(0.0, least(t.x1, b.x1) - greatest(t.x0, b.x0)) * greatest(0.0, least(t.y1, b.y1) - greatest(t.y0, b.y0)) / greatest(1.0, (t.x1 - t.x0) * (t.y1 - t.y0)) > 0.18)""")
def overlap_antijoin(spark, sf_dir):
    boxes = spark.sql(_BOX.replace("FROM lineitem", "FROM {lineitem}"), lineitem=load(spark, sf_dir, "lineitem"))
    return tables.outside_boxes(boxes.where("n % 2 = 0"), boxes.where("n % 2 = 1"), ["doc_id"]).select("doc_id", *_long("n"))


@query("WITH s AS (SELECT conv_id, count(*) AS pages FROM conversations GROUP BY 1), r AS (SELECT conv_id, pages, CAST(sum(pages) OVER (ORDER BY conv_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM s) SELECT * FROM r WHERE running <= 200")
def page_budget(spark, sf_dir):
    sizes = load(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("pages"))
    return audit.within_budget(sizes, "conv_id", "pages", 200)


from . import archives, extra, files, more, office, pdfs  # noqa: E402, F401  register their queries
