"""Further queries: the cleaning composition, section chunks, audits, joins by steps, pages, titles, targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import frontmatter, labels
from ..functions import text as T
from ..operators import audit, clean, links, pages, tables
from ..sources import route
from .catalog import _CHAPTER, _MD, _NOISE, _ROUTED, _STRIP, _WS, _files, query
from .fixtures import MD, load

# ---- cleaning and chunks

_TAIL = "'<p>Tail &amp; <b>more</b>&nbsp;x</p>'"
_WHOLE = f"""'---' || chr(10) || 'doc_id: "' || doc_id || '"' || chr(10) || 'zeta: plain' || chr(10) || 'quality_status: "old"' || chr(10) || '---' || chr(10) || {MD.replace('CASE doc_id', '(CASE doc_id', 1)}) || chr(10) || {_TAIL}"""


@query(f"""WITH md AS (SELECT doc_id, {MD.replace('CASE doc_id', '(CASE doc_id', 1)}) || chr(10) || 'Tail & more x' || chr(10) AS body FROM documents),
ls AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS n, unnest(l) AS line FROM (SELECT doc_id, string_split(regexp_replace(body, '\\r\\n?', chr(10), 'g'), chr(10)) AS l FROM md)),
r AS (SELECT doc_id, n, regexp_replace(regexp_replace(replace(line, chr(160), ' '), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g'), '{_WS}+$', '') AS line FROM ls),
t AS (SELECT *, {_STRIP('line')} AS s FROM r), rep AS (SELECT doc_id, s FROM t WHERE s <> '' AND length(s) <= 80 AND NOT regexp_matches(s, '{_NOISE}') GROUP BY 1, 2 HAVING count(*) >= 4),
k AS (SELECT t.doc_id, t.n, CASE WHEN t.s <> '' AND NOT starts_with(t.s, '#') AND NOT contains(t.s, '|') AND length(t.s) <= 140 AND regexp_matches(t.s, '{_CHAPTER}') THEN '## ' || t.s ELSE t.line END AS line
  FROM t LEFT JOIN rep ON t.doc_id = rep.doc_id AND t.s = rep.s WHERE rep.s IS NULL AND NOT regexp_matches(t.s, '{_NOISE}')),
j AS (SELECT doc_id, regexp_replace({_STRIP("string_agg(line, chr(10) ORDER BY n)")} || chr(10), '\\n{{3,}}', chr(10) || chr(10), 'g') AS c FROM k GROUP BY 1),
e AS (SELECT doc_id, replace(replace(c, '| A | B |' || chr(10) || '| x |' || chr(10) || '| y | z | w |', '| A | B ||' || chr(10) || '| --- | --- | --- |' || chr(10) || '| x |||' || chr(10) || '| y | z | w |'), '| --- | :---: |', '| --- | --- |') AS c FROM j)
SELECT doc_id, sha1('---' || chr(10) || 'doc_id: "' || doc_id || '"' || chr(10) || 'quality_status: "ok"' || chr(10) || 'zeta: "plain"' || chr(10) || '---' || chr(10) || chr(10) || c) AS cleaned_sha1, length(c) AS body_chars FROM e""")
def clean_markdown(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").selectExpr("doc_id", f"{_WHOLE} AS body")
    out = clean.clean_markdown(docs, "body", F.create_map(F.lit("quality_status"), F.lit("ok")))
    return out.select("doc_id", F.sha1("cleaned").alias("cleaned_sha1"), F.length(frontmatter.body(F.col("cleaned"))).cast("long").alias("body_chars"))


_SECTIONS = f"""WITH RECURSIVE {_MD}, ls AS (SELECT doc_id, generate_subscripts(l, 1) AS n, unnest(l) AS line FROM (SELECT doc_id, string_split(body, chr(10)) AS l FROM md)),
g AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^#{{1,6}}[ \\t\\r]+[^ ]') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS sec FROM ls),
sx AS (SELECT doc_id, sec, CASE WHEN sec = 0 THEN 'Document ' || doc_id ELSE {_STRIP("regexp_extract(arg_min(line, n), '^#{1,6}[ \\t\\r]+(.*)$', 1)")} END AS title, {_STRIP("string_agg(line, chr(10) ORDER BY n)")} AS t FROM g GROUP BY 1, 2),
s(doc_id, sec, title, seq, part, rest) AS (SELECT doc_id, sec, title, 0, '', t FROM sx UNION ALL
  SELECT doc_id, sec, title, seq + 1, CASE WHEN length(rest) > 2200 THEN {_STRIP('rest[1:cut]')} ELSE rest END, CASE WHEN length(rest) > 2200 THEN {_STRIP('rest[cut + 1:]')} ELSE '' END
  FROM (SELECT *, CASE WHEN instr(reverse(rest[1:2200]), chr(10)) = 0 OR 2200 - instr(reverse(rest[1:2200]), chr(10)) < 800 THEN 2200 ELSE 2200 - instr(reverse(rest[1:2200]), chr(10)) END AS cut FROM s) WHERE rest <> ''),
c AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sec, seq) AS k FROM s WHERE seq > 0 AND part <> '')"""


@query(_SECTIONS + " SELECT 'd' || doc_id || '-' || CASE WHEN k < 10000 THEN lpad(CAST(k AS VARCHAR), 4, '0') ELSE CAST(k AS VARCHAR) END AS chunk_id, 'Document ' || doc_id || ' > ' || title AS citation, title AS section_title, sha1(part) AS text_sha1 FROM c")
def section_chunks(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").selectExpr("'d' || doc_id AS doc_id", "'Document ' || doc_id AS doc_title", "source AS source_path", "'md/' || doc_id || '.md' AS markdown_path", f"{MD} AS body")
    return clean.section_chunks(docs).select("chunk_id", "citation", "section_title", F.sha1("text").alias("text_sha1"))


# ---- audits

_OCR = "CASE doc_id % 19 WHEN 0 THEN 'needs_ocr' WHEN 1 THEN 'paddleocr_partial' WHEN 2 THEN 'vision_ocr_partial' WHEN 3 THEN 'needs_review' ELSE 'text_ok' END"
_QUALITY = "CASE doc_id % 7 WHEN 0 THEN 'needs_review' WHEN 1 THEN 'needs_human_spotcheck' ELSE 'ok' END"
_BODY = "CASE WHEN doc_id % 23 = 0 THEN text || ' Server Error' WHEN doc_id % 29 = 0 THEN repeat('x' || chr(10), 25) ELSE text END"
_CHARS = lambda x: f"length(regexp_replace(regexp_replace({x}, '(?s)<!--.*?-->', '', 'g'), '{T.COMPACTED}', '', 'g'))"
_ERROR = "contains(lower({0}), '<think>') OR contains(lower({0}), 'invalid api key') OR contains(lower({0}), 'sensitive image') OR contains(lower({0}), 'server error')"


@query(f"""WITH d AS (SELECT doc_id, {_OCR} AS ocr, {_QUALITY} AS q, {_BODY} AS b FROM documents),
c AS (SELECT *, {_CHARS('b')} < 30 AS near, contains(b, '�') OR {_ERROR.format('b')} OR doc_id % 29 = 0 AND doc_id % 23 <> 0 AS bad FROM d),
s AS (SELECT count(*) AS documents, count_if(ocr IN ('needs_ocr', 'paddleocr_partial', 'vision_ocr_partial')) AS unresolved_ocr, count_if(near) AS near_empty, count_if(bad) AS suspicious, count_if(q <> 'ok') AS needs_spotcheck FROM c)
SELECT documents, CAST(unresolved_ocr AS BIGINT) AS unresolved_ocr, CAST(near_empty AS BIGINT) AS near_empty, CAST(suspicious AS BIGINT) AS suspicious, CAST(needs_spotcheck AS BIGINT) AS needs_spotcheck, unresolved_ocr + near_empty + suspicious = 0 AS ready FROM s""")
def readiness(spark, sf_dir):
    return audit.readiness(load(spark, sf_dir, "documents").selectExpr(f"{_OCR} AS ocr_status", f"{_QUALITY} AS quality_status", f"{_BODY} AS body"))


@query("""SELECT doc_id, doc_id % 5 = 0 OR doc_id % 7 = 0 OR doc_id % 11 = 0 OR doc_id % 13 = 0 AS is_pdf FROM documents""")
def pdf_documents(spark, sf_dir):
    d = load(spark, sf_dir, "documents").selectExpr("doc_id", "CASE WHEN doc_id % 5 = 0 THEN 'pdf' END AS kind", "CASE WHEN doc_id % 7 = 0 THEN '.PDF' ELSE '.html' END AS ext", "CASE WHEN doc_id % 11 = 0 THEN 'in/A.Pdf' END AS source_path", "CASE WHEN doc_id % 13 = 0 THEN 'PDF/a.md' ELSE 'x/pdf/a.md' END AS path")
    return d.select("doc_id", labels.is_pdf(F.col("kind"), F.col("ext"), F.col("source_path"), F.col("path")).alias("is_pdf"))


_SOURCE = "CASE WHEN doc_id % 31 = 0 THEN '' ELSE 'src/' || (doc_id - doc_id % 37 % 2) || '.pdf' END"
_ID = "CASE WHEN doc_id % 41 = 0 THEN '' WHEN doc_id % 43 = 0 THEN 'same' ELSE 'd' || doc_id END"
_AUDITED = f"""ds AS (SELECT doc_id AS k, 'md/' || doc_id || '.md' AS path, {_ID} AS doc_id, {_SOURCE} AS source_path, CASE WHEN doc_id % 3 = 0 THEN 'm' || doc_id ELSE '' END AS member, text AS b, {_CHARS('text')} AS chars FROM documents),
iss AS (SELECT k, path, doc_id, source_path, member, chars AS body_chars, concat_ws(',', CASE WHEN k % 13 = 0 THEN 'utf8_bom' END, CASE WHEN k % 17 = 0 THEN 'invalid_utf8' END, CASE WHEN contains(b, '�') THEN 'replacement_character' END, CASE WHEN {_ERROR.format('b')} THEN 'provider_error' END,
 CASE WHEN doc_id = '' THEN 'missing_doc_id' END, CASE WHEN source_path = '' THEN 'missing_source_path' WHEN k % 20 = 7 THEN 'source_path_not_found' END) AS issues FROM ds)"""


def _audited(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").selectExpr("'md/' || doc_id || '.md' AS path", f"{_ID} AS doc_id", f"{_SOURCE} AS source_path", "CASE WHEN doc_id % 3 = 0 THEN 'm' || doc_id ELSE '' END AS member", "text AS body", "concat(CASE WHEN doc_id % 13 = 0 THEN X'EFBBBF' ELSE X'' END, encode('x', 'UTF-8'), CASE WHEN doc_id % 17 = 0 THEN X'FF' ELSE X'' END) AS raw", "doc_id % 20 = 7 AS lost")
    inventory = docs.where("NOT lost").select(F.col("source_path").alias("path"))
    return docs, inventory


@query(f"WITH {_AUDITED}, h AS (SELECT DISTINCT source_path FROM ds WHERE k % 20 <> 7) SELECT path, doc_id, source_path, body_chars, CASE WHEN k % 20 = 7 AND source_path IN (SELECT source_path FROM h) THEN replace(replace(issues, ',source_path_not_found', ''), 'source_path_not_found', '') ELSE issues END AS issues FROM iss")
def document_issues(spark, sf_dir):
    docs, inventory = _audited(spark, sf_dir)
    return audit.document_issues(docs, inventory).select("path", "doc_id", "source_path", "body_chars", F.array_join("issues", ",").alias("issues"))


#: Every fiftieth line of the chunks' file is cut off, by number.
_COUNTED = f"""WITH {_AUDITED}, h AS (SELECT DISTINCT source_path AS p FROM ds WHERE k % 20 <> 7 UNION SELECT path FROM ds WHERE k % 10 <> 1), ch AS (SELECT CASE WHEN k % 50 = 0 THEN 'c' ELSE 'c' || k END AS chunk_id, doc_id, path AS markdown_path, source_path FROM ds WHERE k % 9 <> 4),
f AS (SELECT count_if(CASE WHEN k % 20 = 7 AND source_path IN (SELECT p FROM h) THEN replace(replace(issues, ',source_path_not_found', ''), 'source_path_not_found', '') ELSE issues END <> '') AS failed FROM iss), key AS (SELECT source_path || CASE WHEN member <> '' THEN '::' || member ELSE '' END AS s FROM ds WHERE source_path <> ''),
v AS (SELECT (SELECT count(*) FROM ds) AS documents, (SELECT failed FROM f) AS failed_documents, (SELECT count(DISTINCT doc_id) FROM ds WHERE doc_id <> '') AS unique_doc_ids, (SELECT count(DISTINCT s) FROM key) AS unique_source_paths, (SELECT count(*) FROM ch) AS chunks, (SELECT count(DISTINCT doc_id) FROM ch WHERE doc_id <> '') AS unique_chunk_doc_ids,
 (SELECT count(*) FROM (SELECT doc_id FROM ds WHERE doc_id <> '' GROUP BY 1 HAVING count(*) > 1)) AS a, (SELECT count(*) FROM (SELECT s FROM key GROUP BY 1 HAVING count(*) > 1)) AS b, (SELECT count(*) FROM (SELECT chunk_id FROM ch GROUP BY 1 HAVING count(*) > 1)) AS c, (SELECT count(*) FROM ch WHERE markdown_path NOT IN (SELECT p FROM h)) AS m, (SELECT count(*) FROM ch WHERE source_path NOT IN (SELECT p FROM h)) AS n),
i AS (SELECT 0 AS kind, 0 AS line, CASE WHEN documents <> 12 THEN 'document_count_mismatch:' || documents || '!=12' END AS issue FROM v UNION ALL SELECT 1, 0, CASE WHEN a > 0 THEN 'duplicate_doc_ids:' || a END FROM v
 UNION ALL SELECT 2, 0, CASE WHEN b > 0 THEN 'duplicate_source_paths:' || b END FROM v UNION ALL SELECT 3, 0, CASE WHEN c > 0 THEN 'duplicate_chunk_ids:' || c END FROM v UNION ALL SELECT 4, k, 'invalid_chunk_json_line:' || k FROM ds WHERE k % 50 = 3
 UNION ALL SELECT 5, 0, CASE WHEN m > 0 THEN 'missing_chunk_markdown_paths:' || m END FROM v UNION ALL SELECT 6, 0, CASE WHEN n > 0 THEN 'missing_chunk_source_paths:' || n END FROM v UNION ALL SELECT 7, 0, 'chunk_document_coverage_mismatch')"""


def _final(spark, sf_dir):
    docs, inventory = _audited(spark, sf_dir)
    nth = F.regexp_extract("path", r"(\d+)", 1).try_cast("long")
    inventory = inventory.unionAll(docs.where(nth % 10 != 1).select("path"))
    found = audit.document_issues(docs, inventory).join(docs.select("path", "member"), "path")
    chunks = docs.where(nth % 9 != 4).select(F.when(nth % 50 == 0, "c").otherwise(F.concat(F.lit("c"), nth.cast("string"))).alias("chunk_id"), "doc_id", F.col("path").alias("markdown_path"), "source_path", F.lit(None).cast("int").alias("bad_line"))
    bad = docs.where(nth % 50 == 3).select(*(F.lit(None).cast("string").alias(c) for c in ("chunk_id", "doc_id", "markdown_path", "source_path")), nth.cast("int").alias("bad_line"))
    return found, chunks.unionAll(bad), inventory, 12


@query(f"{_COUNTED} SELECT documents, CAST(failed_documents AS BIGINT) AS failed_documents, unique_doc_ids, unique_source_paths, chunks, unique_chunk_doc_ids, (SELECT count(issue) FROM i) AS global_issues, false AS clean, CAST(kind * 1099511627776 + line AS BIGINT) AS nth, issue FROM v, i WHERE issue IS NOT NULL")
def final_audit(spark, sf_dir):
    return audit.audited_issues(*_final(spark, sf_dir))


@query(f"{_COUNTED} SELECT CAST(kind * 1099511627776 + line AS BIGINT) AS nth, issue FROM i WHERE issue IS NOT NULL")
def final_issues(spark, sf_dir):
    return audit.final_issues(*_final(spark, sf_dir))


# ---- joins by steps


_LEFT = "SELECT p_partkey AS k, CASE WHEN p_partkey % 4 = 0 THEN 'X/' ELSE 'a/' END || 'F' || (p_partkey + p_partkey % 3) || '.pdf' AS source_path FROM part"
#: Of four rows two share a name.
_RIGHT = "SELECT p_partkey AS nth, CASE WHEN p_partkey % 3 = 0 THEN 'b/' ELSE 'A/' END || 'f' || CASE WHEN p_partkey % 4 < 2 THEN p_partkey ELSE p_partkey - 1 END || '.PDF' AS source_path FROM part"


@query(f"""WITH l AS ({_LEFT}), r AS ({_RIGHT}), e AS (SELECT lower(source_path) AS p, max(nth) AS nth FROM r GROUP BY 1),
n AS (SELECT regexp_extract(lower(source_path), '([^/]*)$', 1) AS n, min(nth) AS nth FROM r GROUP BY 1 HAVING count(*) = 1)
SELECT l.k, CAST(coalesce(e.nth, n.nth) AS BIGINT) AS found FROM l LEFT JOIN e ON lower(l.source_path) = e.p LEFT JOIN n ON regexp_extract(lower(l.source_path), '([^/]*)$', 1) = n.n""")
def preflight_repair(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    left, right = (spark.sql(x.replace("FROM part", "FROM {part}"), part=part) for x in (_LEFT, _RIGHT))
    return links.by_path_or_name(left, right).select("k", F.col("match.nth").alias("found"))


_REPAIRS = "SELECT p_partkey AS row_id, 'in/' || CASE WHEN p_partkey % 5 = 4 THEN 'zz' ELSE '' END || p_partkey % 150 || '.pdf' AS source_path, 'id' || p_partkey AS file_id, CASE WHEN p_partkey % 3 = 1 THEN 'md/t' || p_partkey || '.md' ELSE 'gone.md' END AS output_markdown FROM part"
_MARKDOWN = "SELECT 'md/doc ' || p_partkey || '--id' || p_partkey || '.md' AS path FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT 'md/t' || p_partkey || '.md' FROM part WHERE p_partkey % 6 = 1"


@query(f"""WITH r AS ({_REPAIRS}), m AS (SELECT path, regexp_extract(path, '([^/]*)$', 1) AS name FROM ({_MARKDOWN})), h AS (SELECT r.row_id, min(m.name) AS name FROM r JOIN m ON contains(m.name, replace(replace(r.source_path, 'in/', ''), '.pdf', '')) GROUP BY 1)
SELECT r.row_id, coalesce(i.path, t.path, hm.path) AS markdown_path FROM r LEFT JOIN m i ON i.name LIKE '%--' || r.file_id || '.md' LEFT JOIN m t ON t.path = r.output_markdown LEFT JOIN h ON h.row_id = r.row_id LEFT JOIN m hm ON hm.name = h.name""")
def repair_markdown(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    with_part = lambda sql: spark.sql(sql.replace("FROM part", "FROM {part}"), part=part)
    return links.markdown_of(with_part(_REPAIRS), with_part(_MARKDOWN))


@query("""SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 AND p_partkey % 5 <> 0 THEN 'id/' || p_partkey WHEN p_partkey % 3 = 0 THEN 'name/' || p_partkey WHEN p_partkey % 7 = 0 THEN 'manifest/' || p_partkey WHEN p_partkey % 11 = 0 THEN 'front/' || p_partkey END AS source FROM part""")
def choose_source(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    rows = part.selectExpr("p_partkey AS k", "CASE WHEN p_partkey % 2 = 0 THEN 'id/' || p_partkey END AS by_id", "CASE WHEN p_partkey % 3 = 0 THEN 'name/' || p_partkey ELSE '' END AS by_name", "'manifest/' || p_partkey AS by_manifest", "'front/' || p_partkey AS by_front")
    inventory = part.selectExpr("explode(array(CASE WHEN p_partkey % 5 <> 0 THEN 'id/' || p_partkey END, 'name/' || p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'manifest/' || p_partkey END, CASE WHEN p_partkey % 11 = 0 THEN 'front/' || p_partkey END)) AS path")
    return links.first_existing(rows, ["by_id", "by_name", "by_manifest", "by_front"], inventory, "k")


@query("""WITH d AS (SELECT c_custkey AS document, c_custkey % 6 + 2 AS pages FROM customer), o AS (SELECT o_custkey AS document, o_orderkey % 9 - 1 AS page, o_orderkey % 4 AS table_no FROM orders)
SELECT o.document, page, table_no, CASE WHEN page < 1 OR page > coalesce(pages, 0) THEN 'source_page_out_of_range' WHEN page > 9 OR table_no < 1 OR table_no > (o.document + page + 1) % 3 THEN 'source_table_not_redetected' ELSE 'checked' END AS status, count(*) AS n FROM o LEFT JOIN d ON d.document = o.document GROUP BY ALL""")
def table_markers(spark, sf_dir):
    markers = load(spark, sf_dir, "orders").selectExpr("o_custkey AS document", "o_orderkey % 9 - 1 AS page", "o_orderkey % 4 AS table_no")
    documents = load(spark, sf_dir, "customer").selectExpr("c_custkey AS document", "c_custkey % 6 + 2 AS pages")
    found = documents.selectExpr("document", "explode(sequence(1L, 9L)) AS page").selectExpr("document", "page", "explode(sequence(1L, greatest(1L, (document + page + 1) % 3))) AS table_no").where("table_no <= (document + page + 1) % 3")
    return links.table_sources(markers, documents, found).groupBy("document", "page", "table_no", "status").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH c AS (SELECT DISTINCT conv_id AS f FROM conversations WHERE conv_id % 3 <> 0), s AS (SELECT conv_id AS f, turn AS page, 'r' || turn AS reason, 'table' AS type FROM conversations WHERE turn % 2 = 0), m AS (SELECT DISTINCT conv_id AS f, turn AS page FROM conversations WHERE turn < 4)
SELECT coalesce(s.f, m.f) AS file_id, coalesce(s.page, m.page) AS page, coalesce(s.reason, 'manual') AS reason, coalesce(s.type, 'manual') AS type FROM s FULL JOIN m ON s.f = m.f AND s.page = m.page WHERE coalesce(s.f, m.f) IN (SELECT f FROM c)""")
def page_selection(spark, sf_dir):
    c = load(spark, sf_dir, "conversations")
    selected = c.where("turn % 2 = 0").selectExpr("conv_id AS file_id", "turn AS page", "'r' || turn AS reason", "'table' AS type")
    return links.page_targets(c.where("conv_id % 3 <> 0").selectExpr("conv_id AS file_id"), selected, c.where("turn < 4").selectExpr("conv_id AS file_id", "turn AS page"))


@query("SELECT p_partkey AS ref_id, CASE p_partkey % 5 WHEN 0 THEN '/abs/' || p_partkey || '.png' WHEN 1 THEN 'md/img/' || p_partkey || '.png' WHEN 2 THEN 'images/' || p_partkey || '.png' WHEN 3 THEN 'md/img/' || p_partkey || '.png' END AS source FROM part")
def image_files(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    refs = part.selectExpr("p_partkey AS ref_id", "'md' AS folder", "CASE WHEN p_partkey % 5 = 0 THEN '/abs/' ELSE 'img/' END || p_partkey || '.png' AS target")
    there = part.selectExpr("explode(CASE p_partkey % 5 WHEN 0 THEN array('/abs/' || p_partkey || '.png') WHEN 1 THEN array('md/img/' || p_partkey || '.png') WHEN 2 THEN array('images/' || p_partkey || '.png') WHEN 3 THEN array('images/' || p_partkey || '.png', 'md/img/' || p_partkey || '.png') ELSE array('x') END) AS path")
    return links.image_files(refs, there, "images")


#: A digest of paths that doesn't depend on their order: nobody gathers a bucket's paths.
_DIGEST_SQL = "CAST(sum(CAST('0x' || md5(path)[1 : 8] AS BIGINT)) AS BIGINT)"


@query(f"""WITH {_ROUTED}, p AS (SELECT unnest([
    'simple_direct', 'pdf_text', 'legacy_office', 'needs_ocr', 'pdf_table', 'archive', 'manual_review', 'unsupported']) AS bucket, unnest(range(8)) AS place),
w AS (SELECT bucket, place, CASE WHEN bucket IN ('simple_direct', 'pdf_text', 'legacy_office', 'archive') THEN 'converter'
    WHEN bucket = 'needs_ocr' THEN 'ocr' WHEN bucket = 'pdf_table' THEN 'table_repair' ELSE 'router' END AS skill FROM p),
g AS (SELECT bucket, count(*) AS n, {_DIGEST_SQL} AS paths_digest FROM r GROUP BY bucket)
SELECT g.*, skill, CAST(row_number() OVER (ORDER BY place) AS INTEGER) AS recommended_order FROM g JOIN w ON w.bucket = g.bucket""")
def route_plan(spark, sf_dir):
    plan = route.planned(route.routed(_files(spark, sf_dir)))
    digests = plan.groupBy("bucket").agg(F.sum(F.conv(F.substring(F.md5("path"), 1, 8), 16, 10).cast("long")).alias("paths_digest"))
    return route.recommended(plan).join(digests, "bucket")


@query(f"WITH {_ROUTED} SELECT DISTINCT path FROM r WHERE bucket IN ('simple_direct', 'pdf_text', 'legacy_office')")
def route_selection(spark, sf_dir):
    return route.selected(route.planned(route.routed(_files(spark, sf_dir))))


# ---- pages


@query(f"SELECT conv_id AS doc_id, turn + 1 AS page, {_STRIP('text')} AS text FROM conversations")
def page_sections(spark, sf_dir):
    c = load(spark, sf_dir, "conversations").selectExpr("conv_id AS doc_id", "turn + 1 AS page", "text")
    return pages.page_sections(pages.marked_pages(c))


@query(f"SELECT conv_id AS doc_id, sha1(string_agg({_STRIP('text')}, '|' ORDER BY turn)) AS text_sha1, count(*) AS n_pages FROM (SELECT * FROM conversations WHERE {_STRIP('text')} <> '') WHERE conv_id % 2 = 0 AND turn % 3 <> 2 GROUP BY 1")
def ocr_pages_roundtrip(spark, sf_dir):
    c = load(spark, sf_dir, "conversations").selectExpr("conv_id AS doc_id", "turn + 1 AS page", "CASE WHEN turn % 3 = 2 THEN ' ' ELSE text END AS text")
    docs = pages.ocr_body(c).selectExpr("doc_id", "body", "CASE WHEN doc_id % 2 = 0 THEN 'vision_ocr:m' ELSE 'pdf' END AS extraction_method")
    found = pages.ocr_pages(docs)
    return found.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("ps")).select("doc_id", F.sha1(F.array_join(F.transform("ps", lambda x: x["text"]), "|")).alias("text_sha1"), F.size("ps").cast("long").alias("n_pages"))


_ITEMS = "SELECT l_orderkey AS doc_id, CAST(l_linenumber % 2 AS INT) AS page, CASE WHEN l_partkey % 3 = 0 THEN 'table' ELSE 'text' END AS kind, l_discount * 10 AS x, l_tax * 100 AS y, 'b' || l_partkey || '.' || l_suppkey || '.' || l_linenumber AS text FROM lineitem"


@query(f"WITH i AS ({_ITEMS}) SELECT doc_id, page, '<!-- source_page: ' || page || ' -->' || chr(10) || chr(10) || string_agg(text, chr(10) || chr(10) ORDER BY round(y, 1), round(x, 1), kind <> 'text', text) AS markdown FROM i GROUP BY 1, 2")
def page_interleave(spark, sf_dir):
    return pages.interleaved(spark.sql(_ITEMS.replace("FROM lineitem", "FROM {lineitem}"), lineitem=load(spark, sf_dir, "lineitem")), ["doc_id"])


_SCANNED = "SELECT o_orderkey % 200 AS path, o_orderkey % 6 + 1 AS page, o_orderkey AS table_no, l_linenumber AS row_no, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE l_returnflag END AS a, CASE WHEN o_orderkey % 4 = 0 AND l_linenumber > 1 THEN ' ' ELSE 'v' END AS b FROM orders JOIN lineitem ON o_orderkey = l_orderkey"


@query(f"""WITH s AS ({_SCANNED}), t AS (SELECT path, page, table_no, count(*) AS n, sum((trim(a) <> '')::INT + (trim(b) <> '')::INT) AS f FROM s GROUP BY 1, 2, 3)
SELECT path, CAST(count_if(f >= 2) AS BIGINT) AS tables, coalesce(max(n) FILTER (f >= 2), 0) AS max_rows, CAST(CASE WHEN count_if(f >= 2) > 0 THEN 2 ELSE 0 END AS BIGINT) AS max_cols, coalesce(string_agg(DISTINCT page, ',' ORDER BY page) FILTER (f >= 2), '') AS table_pages, count_if(f >= 2) > 0 AS needs_repair FROM t GROUP BY 1""")
def table_scan(spark, sf_dir):
    rows = spark.sql(_SCANNED.replace("FROM orders JOIN lineitem", "FROM {orders} JOIN {lineitem}"), orders=load(spark, sf_dir, "orders"), lineitem=load(spark, sf_dir, "lineitem"))
    return pages.table_scan(rows.withColumn("cells", F.array("a", "b"))).withColumn("table_pages", F.array_join(F.col("table_pages").cast("array<string>"), ","))


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter([p_partkey % 7, p_size % 5, p_partkey % 3], lambda x: x NOT IN (p_size % 4, p_partkey % 2)))), ',') AS missing FROM part")
def missing_table_pages(spark, sf_dir):
    part = load(spark, sf_dir, "part").selectExpr("p_partkey", "array(p_partkey % 7, p_size % 5, p_partkey % 3) AS e", "array(p_size % 4, p_partkey % 2) AS f")
    return part.select("p_partkey", F.array_join(pages.missing_pages(F.col("e"), F.col("f").cast("array<bigint>")).cast("array<string>"), ",").alias("missing"))


_HEADED = "'intro' || chr(10) || '| no | table |' || chr(10) || '### Source PDF page 2 table 1' || chr(10) || chr(10) || '| A | ' || doc_id || ' |' || chr(10) || '| --- | :---: |' || chr(10) || '| x |  | z |' || chr(10) || 'after' || chr(10) || '| not this |' || chr(10) || '### Source PDF page 10 table 3  ' || chr(10) || 'nothing here' || chr(10) || '### Source PDF page 11 table 1' || chr(10) || '|' || source || '|'"


@query("""SELECT doc_id, unnest([2, 2, 10, 11])::BIGINT AS page, unnest([1, 1, 3, 1])::BIGINT AS table_no, unnest([1, 2, NULL, 1])::BIGINT AS row_no, unnest(['A;' || doc_id, 'x;;z', NULL, source]) AS cells FROM documents""")
def headed_tables(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").selectExpr("doc_id", f"{_HEADED} AS body")
    return pages.headed_tables(docs).withColumn("cells", F.array_join("cells", ";"))


_SECTION = """'a' || chr(10) || CASE conv_id % 3 WHEN 0 THEN '  | A | ' || turn || ' |  ' || chr(10) || '| --- |' || chr(10) || '| x |' || chr(10) || 'between' || chr(10) || '| alone |' || chr(10) || chr(10) || '| B |' || chr(10) || '|--|' || chr(10) || '<table><tr><td>not this</table>'
 WHEN 1 THEN '| one row |' || chr(10) || '<TABLE><tr><td>h<td>' || role || '</tr><tr><td>v</td></tr></TABLE> and <table><tr><th>z</table>' ELSE 'no table | here' || chr(10) || '| one |' END"""


@query("""SELECT conv_id AS doc_id, turn + 1 AS page, CAST(unnest([1, 2]) AS BIGINT) AS table_no, unnest(['  | A | ' || turn || ' |' || chr(10) || '| --- |' || chr(10) || '| x |', '| B |' || chr(10) || '|--|']) AS markdown FROM conversations WHERE conv_id % 3 = 0
UNION ALL SELECT conv_id, turn + 1, unnest([1, 2]), unnest(['| h | ' || role || ' |' || chr(10) || '| --- | --- |' || chr(10) || '| v |  |', '| z |' || chr(10) || '| --- |']) FROM conversations WHERE conv_id % 3 = 1""")
def section_tables(spark, sf_dir):
    return pages.section_tables(load(spark, sf_dir, "conversations").selectExpr("conv_id AS doc_id", "turn + 1 AS page", f"{_SECTION} AS text"))


_PAGES = """'| not | in a page |' || chr(10) || '| --- | --- |' || chr(10) || '## Source Page 4' || chr(10) || '| old |' || chr(10) || '| --- |' || chr(10) || '## Source Page 4  ' || chr(10) || '| ' || p_brand || ' |' || chr(10) || '| --- |' || chr(10) || '## Source Page 4' || chr(10) || 'none'
 || chr(10) || '## Source Page 7' || chr(10) || '<table><tr><td>' || p_name || '</table>'"""


@query("SELECT p_partkey AS doc_id, CAST(unnest([4, 7]) AS BIGINT) AS page, 1::BIGINT AS table_no, '| ' || unnest([p_brand, p_name]) || ' |' || chr(10) || '| --- |' AS markdown FROM part")
def enhanced_tables(spark, sf_dir):
    return pages.enhanced_tables(load(spark, sf_dir, "part").selectExpr("p_partkey AS doc_id", f"{_PAGES} AS body"))


_HTML_TABLE = "'<p>x</p><TABLE class=a><tr><th>H&amp;M</th><th> two  words </th></tr><tr><td><b>' || doc_id || '</b><td>a|b</td><td>extra<tr><td> </td></tr></TABLE> text <table></table><table><tr><td>' || source || '</table>'"


@query("""SELECT doc_id, unnest([1, 3])::BIGINT AS table_no, unnest(['| H&M | two words |  |' || chr(10) || '| --- | --- | --- |' || chr(10) || '| ' || doc_id || ' | a\\|b | extra |', '| ' || source || ' |' || chr(10) || '| --- |']) AS markdown FROM documents""")
def html_tables(spark, sf_dir):
    return pages.html_tables(load(spark, sf_dir, "documents").selectExpr("doc_id", f"{_HTML_TABLE} AS html"))


_TARGETS = "SELECT doc_id AS nth, CASE doc_id % 3 WHEN 0 THEN 'needs_ocr' WHEN 1 THEN 'needs_review' ELSE 'text_ok' END AS ocr_status, 'T ' || lang || doc_id AS doc_title, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 < 3 THEN 'pdf' ELSE 'image' END AS document_kind, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE doc_id % 40 END AS pages FROM documents"


@query(f"""WITH t AS ({_TARGETS}), s AS (SELECT nth, CASE WHEN pages > 30 THEN 'skipped by --skip-over-pages=30; source pages=' || pages END AS ocr_error FROM t WHERE ocr_status IN ('needs_ocr', 'needs_review') AND contains(doc_title, 'e') AND coalesce(document_kind <> 'image', true))
SELECT * FROM (SELECT * FROM s WHERE ocr_error IS NULL ORDER BY nth LIMIT 20) UNION ALL SELECT * FROM s WHERE ocr_error IS NOT NULL""")
def ocr_targets(spark, sf_dir):
    rows = spark.sql(_TARGETS.replace("FROM documents", "FROM {documents}"), documents=load(spark, sf_dir, "documents"))
    return pages.ocr_targets(rows, ["needs_ocr", "needs_review"], "e", exclude=("image",), most_pages=30, limit=20).select("nth", "ocr_error")


# ---- tables of a file


@query("""WITH f AS (SELECT conv_id AS key, count(*) AS n FROM conversations GROUP BY 1),
fl AS (SELECT key, CASE key % 5 WHEN 0 THEN 0 WHEN 1 THEN 12 ELSE n END AS e, key % 7 <> 3 AS has, key % 4 = 1 AS gap FROM f),
t AS (SELECT conv_id AS key, turn // 2 + 1 AS page, turn % 2 + 1 AS table_no, turn % 6 = 5 AS red FROM conversations),
a AS (SELECT key, count(*) AS n, max(page) AS pages, bool_or(red) AS red, count(*) > count(DISTINCT page) AS crowd, string_agg(CASE WHEN red THEN 'p' || page || 't' || table_no || ':wide_table;p' || page || 't' || table_no || ':long_table' END, ';' ORDER BY page, table_no) AS own FROM t GROUP BY 1),
x AS (SELECT fl.key, CASE WHEN e = 0 THEN 'green' WHEN NOT has OR e <> a.n OR pages < 3 OR red THEN 'red' WHEN gap OR crowd OR e >= 10 THEN 'yellow' ELSE 'green' END AS level,
 CASE WHEN e = 0 THEN 'no_detected_tables' WHEN NOT has THEN 'missing_repaired_markdown' ELSE concat_ws(';', CASE WHEN e <> a.n THEN 'table_count_mismatch:' || e || '!=' || a.n END, CASE WHEN pages < 3 THEN 'missing_table_pages:' || CASE pages WHEN 1 THEN '2,3' ELSE '3' END END, CASE WHEN gap THEN 'non_contiguous_page_markers' END, own, CASE WHEN crowd THEN 'multiple_tables_on_page' END, CASE WHEN e >= 10 THEN 'many_tables_in_document' END) END AS reasons FROM fl JOIN a USING (key)) SELECT * FROM x""")
def file_reasons(spark, sf_dir):
    c = load(spark, sf_dir, "conversations")
    files = c.groupBy(F.col("conv_id").alias("key")).agg(F.count(F.lit(1)).alias("n")).selectExpr("key", "CASE key % 5 WHEN 0 THEN 0 WHEN 1 THEN 12 ELSE n END AS expected_tables", "array(3L, 1L, 2L) AS expected_pages", "key % 7 <> 3 AS has_markdown", "CASE WHEN key % 4 = 1 THEN array(1L, 3L) ELSE array(2L, 1L, 1L) END AS markers")
    found = c.selectExpr("conv_id AS key", "turn DIV 2 + 1 AS page", "turn % 2 + 1 AS table_no", "CASE WHEN turn % 6 = 5 THEN 'red' ELSE 'green' END AS level", "CASE WHEN turn % 6 = 5 THEN array('wide_table', 'long_table') ELSE CAST(array() AS array<string>) END AS reasons")
    return tables.file_reasons(files, found)


@query("SELECT o_orderkey, array_to_string(list_filter(['mostly_blank_header', 'too_many_empty_cells', 'table_count_mismatch'], lambda r: CASE r WHEN 'mostly_blank_header' THEN o_orderkey % 3 = 1 WHEN 'too_many_empty_cells' THEN false ELSE o_orderkey % 2 = 0 END), ',') AS hard FROM orders")
def hard_reasons(spark, sf_dir):
    d = load(spark, sf_dir, "orders").selectExpr("o_orderkey", "'p1t2:wide_table;p' || (o_orderkey % 3) || 't1:mostly_blank_header;p11t1:too_many_empty_cells' || CASE WHEN o_orderkey % 2 = 0 THEN ';table_count_mismatch:3!=4' ELSE '' END AS reasons")
    return d.select("o_orderkey", F.array_join(tables.hard_reasons(F.col("reasons"), F.lit(1)), ",").alias("hard"))


# ---- names and marks


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Given' WHEN 1 THEN 'Head ' || doc_id ELSE 'file ' || doc_id END AS title, sha1(CASE WHEN doc_id % 4 < 2 THEN chr(10) || text ELSE text END) AS body_sha1 FROM documents")
def title_inference(spark, sf_dir):
    d = load(spark, sf_dir, "documents").selectExpr("doc_id", "CASE WHEN doc_id % 4 < 2 THEN '\n#  Head ' || doc_id || ' \n\n  \n' || text ELSE text END AS body", "CASE WHEN doc_id % 4 = 0 THEN 'Given' ELSE '' END AS given", "'in/file ' || doc_id || '.md' AS path")
    return d.select("doc_id", labels.title_and_body(F.col("body"), F.col("given"), F.col("path")).alias("x")).select("doc_id", "x.title", F.sha1("x.body").alias("body_sha1"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN '附录' ELSE p_size || p_name END AS title FROM part")
def title_cleanup(spark, sf_dir):
    p = load(spark, sf_dir, "part").selectExpr("p_partkey", "CASE p_partkey % 4 WHEN 0 THEN '第 3 章 ' || p_name WHEN 1 THEN '附录 07  ' || p_name WHEN 2 THEN '附录' ELSE p_size || p_name END AS t")
    return p.select("p_partkey", labels.clean_title(F.col("t")).alias("title"))


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'warning' WHEN 1 THEN 'tip' WHEN 2 THEN 'ok' WHEN 3 THEN 'warning' ELSE 'note' END AS callout FROM part")
def callouts(spark, sf_dir):
    p = load(spark, sf_dir, "part").selectExpr("p_partkey", "CASE p_partkey % 5 WHEN 0 THEN '⚠️ ' || p_name WHEN 1 THEN '  💡 a ✅ ' || p_name WHEN 2 THEN p_brand || ' ' || p_name || ' **✅ done** ⚠️' WHEN 3 THEN '💡 ' || p_name || ' **⚠️ x**' ELSE p_brand || p_name || ' ⚠️ too late' END AS q")
    return p.select("p_partkey", labels.callout(F.col("q")).alias("callout"))


@query("SELECT doc_id, unnest([1, 2, 3, 4, 5, 6, 7, 8])::BIGINT AS n, unnest(['text', 'bold', 'text', 'italic', 'code', 'text', 'link', 'text']) AS kind, unnest(['see ', lang, ' * and ', source, 'a*b', ' ', 'l' || doc_id, ' [x] end**']) AS text, unnest([NULL, NULL, NULL, NULL, NULL, NULL, 'u/' || doc_id, NULL]) AS target FROM documents")
def inline_tokens(spark, sf_dir):
    d = load(spark, sf_dir, "documents").selectExpr("doc_id", "'see **' || lang || '** ' || chr(42) || ' and ' || chr(42) || source || chr(42) || '`a*b` [l' || doc_id || '](u/' || doc_id || ') [x] end**' AS t")
    fixed = d.withColumn("t", F.replace(F.col("t"), F.lit(" * and *"), F.lit(" ∗ and *")))
    out = fixed.select("doc_id", F.posexplode(labels.inline_tokens(F.col("t"))).alias("n", "x"))
    return out.select("doc_id", (F.col("n") + 1).cast("long").alias("n"), "x.kind", F.replace("x.text", F.lit("∗"), F.lit("*")).alias("text"), "x.target")


@query("SELECT p_partkey, 'data:' || CASE p_partkey % 4 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/svg+xml' ELSE 'application/octet-stream' END || ';base64,' || base64(encode(p_name || repeat('x', 100))) AS uri FROM part")
def data_uris(spark, sf_dir):
    p = load(spark, sf_dir, "part").selectExpr("p_partkey", "'a.b/' || p_name || CASE p_partkey % 4 WHEN 0 THEN '.PNG' WHEN 1 THEN '.jpeg' WHEN 2 THEN '.svg' ELSE '' END AS path", "encode(p_name || repeat('x', 100), 'UTF-8') AS content")
    return p.select("p_partkey", labels.data_uri(F.col("path"), F.col("content")).alias("uri"))


@query(r"SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '1,' || 2 + p_partkey % 30 WHEN 1 THEN '' ELSE '5' END AS pages FROM part")
def page_list_by_comma(spark, sf_dir):
    p = load(spark, sf_dir, "part").selectExpr("p_partkey", "CASE p_partkey % 3 WHEN 0 THEN ' ' || (2 + p_partkey % 30) || ' ,1, 1,x' WHEN 1 THEN '3;4, 7 8' ELSE '5,5' END AS given")
    return p.select("p_partkey", F.array_join(T.page_numbers_by_comma(F.col("given")).cast("array<string>"), ",").alias("pages"))


@query("""SELECT doc_id, level, priority FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'RED' WHEN 1 THEN 'yellow' ELSE 'green' END AS level, CASE doc_id % 3 WHEN 0 THEN 'High' ELSE 'low' END AS priority, doc_id % 5 AS p FROM documents) WHERE lower(level) IN ('red', 'yellow') AND lower(priority) = 'high' AND p > 0""")
def candidate_filter(spark, sf_dir):
    d = load(spark, sf_dir, "documents").selectExpr("doc_id", "CASE doc_id % 4 WHEN 0 THEN 'RED' WHEN 1 THEN 'yellow' ELSE 'green' END AS level", "CASE doc_id % 3 WHEN 0 THEN 'High' ELSE 'low' END AS priority", "CASE WHEN doc_id % 5 = 0 THEN ' ;x' ELSE '3;4' END AS pages")
    return tables.candidates(d, ("red", "yellow"), ("high",)).select("doc_id", "level", "priority")


@query("SELECT conv_id AS document, count(*) AS cells, round(avg((turn % 3 <> 2)::INT), 6) AS exact_cell_rate FROM conversations WHERE regexp_matches(text, '[\\p{L}\\p{N}]') GROUP BY 1")
def docx_cells(spark, sf_dir):
    c = load(spark, sf_dir, "conversations").selectExpr("conv_id AS document", "turn", "text AS cell")
    text = c.where("turn % 3 <> 2").groupBy("document").agg(F.array_join(F.collect_list("cell"), " ").alias("text"))
    cells = c.selectExpr("document", "CASE WHEN turn % 3 = 2 THEN cell || ' qqqzzz9' ELSE cell END AS cell")
    return audit.exact_cell_rate(cells, c.select("document").distinct().join(text, "document", "left"), "document")
