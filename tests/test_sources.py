"""Readers, archives, frontmatter, manifests and publishing on literal rows."""

import io
import random
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import frontmatter
from corpusloom.operators import publish, tables
from corpusloom.plans.catalog import ORACLES, QUERIES
from corpusloom.sources import manifest, readers, route


def zipped(names):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n in names:
            z.writestr(n, n.upper())
    return out.getvalue()


def test_archive_members_keep_their_path_and_lose_the_shared_root(spark):
    rows = [("a.zip", zipped(["root/x.txt", "root/sub/y.txt"])), ("b.zip", zipped(["x.txt", "root/y.txt"])), ("c.zip", zipped(["root/../../z"])), ("d.zip", b"broken")]
    got = {(r.archive, r.member): (r.target, r.error) for r in readers.archive_members(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert got[("a.zip", "root/x.txt")] == ("x.txt", None) and got[("a.zip", "root/sub/y.txt")] == ("sub/y.txt", None)
    assert got[("b.zip", "root/y.txt")] == ("root/y.txt", None)
    assert got[("c.zip", "root/../../z")] == (None, "unsafe_member_path") and got[("d.zip", None)][1].startswith("archive_failed")


def zipped_bytes(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for n, data in members.items():
            z.writestr(n, data)
    return out.getvalue()


def test_archives_within_archives(spark):
    deep = zipped_bytes({"r/z.txt": b"Z", "r/b.zip": b"no archive", "r/c.rar": b"rar"})
    spoilt = bytearray(zipped_bytes({"x.txt": b"0123456789" * 99}))
    spoilt[40] ^= 0xFF
    rows = [("a.zip", zipped_bytes({"t/in.ZIP": zipped_bytes({"m.zip": deep, "n.txt": b"N"}), "t/p.txt": b"P"})), ("e.zip", zipped_bytes({})), ("n.zip", None), ("s.zip", bytes(spoilt))]
    df = spark.createDataFrame(rows, "path string, content binary")
    got = {(r.archive, tuple(r.via), r.member): (r.target, r.bytes and bytes(r.bytes), r.error) for r in readers.nested_members(df).collect()}
    errors = {k: v[2].split(":")[0] for k, v in got.items() if v[2]}
    assert {k: v[:2] for k, v in got.items() if not v[2]} == {("a.zip", (), "t/p.txt"): ("p.txt", b"P"), ("a.zip", ("t/in.ZIP",), "n.txt"): ("n.txt", b"N"), ("a.zip", ("t/in.ZIP", "m.zip"), "r/z.txt"): ("z.txt", b"Z")}
    assert errors == dict.fromkeys([("a.zip", ("t/in.ZIP", "m.zip", "r/b.zip"), None), ("a.zip", ("t/in.ZIP", "m.zip"), "r/c.rar"), ("n.zip", (), None), ("s.zip", (), None)], "archive_failed")
    shallow = {(tuple(r.via), r.member): r.error for r in readers.nested_members(df.where("path = 'a.zip'"), depth=1).collect()}
    assert shallow == {((), "t/p.txt"): None, (("t/in.ZIP",), "n.txt"): None, (("t/in.ZIP",), "m.zip"): "archive_failed: not expanded"}


def test_names_in_gbk():
    name = "报告.txt"
    assert readers.repaired_name(name.encode("gbk").decode("cp437"), False) == name
    assert readers.repaired_name("plain.txt", False) == "plain.txt" and readers.repaired_name(name, True) == name


def test_json_lines_keep_bad_ones(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('﻿{"chunk_id": "a"}\n\nnot json\n{"chunk_id": "b"}\n', encoding="utf-8")
    got = readers.json_lines(spark, str(tmp_path), "chunk_id string").orderBy("line_no").collect()
    assert [(r.line_no, r.row.chunk_id if r.row else None, r.issue) for r in got] == [(1, "a", None), (3, None, "invalid_chunk_json_line:3"), (4, "b", None)]


def test_files_and_csv(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in ("a.md", ".hidden.md", "~$b.md", "c.txt"):
        (tmp_path / "in" / n).write_text("x")
    assert [r.path.rsplit("/", 1)[1] for r in readers.files(spark, str(tmp_path / "in"), "*.md").collect()] == ["a.md"]
    df = spark.createDataFrame([(1, "a,b\nc")], "n long, s string")
    readers.write_csv(df, str(tmp_path / "csv"))
    assert readers.csv_rows(spark, str(tmp_path / "csv"), "n long, s string").collect() == df.collect()
    readers.write_json_lines(df, str(tmp_path / "json"))
    assert spark.read.schema("n long, s string").json(str(tmp_path / "json")).collect() == df.collect()


#: Blanks at the ends, line ends, quotes and backslashes, NUL; the sign that is read for null, alone and with others.
ODD = [None, "", " ", "\t", "\n", "\r\n", " a", "a ", "\ta\t", "a\n", "\na", "a\r", "a\r\nb", "\u00a0a\u3000", "\x00a", "a\x00", "\x1fa\x0b", '"', '"a', 'a"\n', "\\", "a\\", '\\"', 'a,\\"\n', "#a", "null", "\\N", "\ufeffa", "\ue000", "\ue000\ue000", "\ue000\n", "a\ue000"]


def test_csv_keeps_texts_as_they_are(spark, tmp_path):
    for columns in ("n long, s string, `t.u` string", "s string"):
        rows = [(i, t, ODD[-i]) if "," in columns else (t,) for i, t in enumerate(ODD)]
        df = spark.createDataFrame(rows, columns).coalesce(1)
        readers.write_csv(df, str(tmp_path / "csv"))
        assert list(map(tuple, readers.csv_rows(spark, str(tmp_path / "csv"), columns).collect())) == rows


def test_csv_round_trip_of_odd_texts_is_that_of_sql(spark, tmp_path):
    rows = [(i, t, "en", s, 1) for i, (t, s) in enumerate(zip(ODD, ["src", "src ", "", None, 'a"\n'] * 7))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(ORACLES["csv_round_trip"] + " ORDER BY doc_id").fetchall()
    assert list(map(tuple, QUERIES["csv_round_trip"](spark, str(tmp_path)).orderBy("doc_id").collect())) == want


def test_frontmatter(spark):
    whole = '---\nzeta: "last"\ndoc_id: "1"\ndoc_title: "a \\"b\\": c"\nsource_path: "C:\\\\\\\\x"\nzeta: "won"\n---\nbody\n'
    r = spark.createDataFrame([(whole,)], "w string").select(frontmatter.parsed(F.col("w")).alias("m"), frontmatter.body(F.col("w")).alias("b")).first()
    assert r.m == {"doc_id": "1", "doc_title": 'a "b": c', "source_path": "C:\\x", "zeta": "won"} and r.b == "body\n"
    none = spark.createDataFrame([("no block",)], "w string").select(frontmatter.parsed(F.col("w")).alias("m"), frontmatter.body(F.col("w")).alias("b")).first()
    assert none.m == {} and none.b == "no block"


def test_resume_and_adapter(spark):
    todo = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "f long, p long")
    left = route.resume(todo, todo.where("f = 1 AND p = 2"), ["f", "p"])
    double = readers.adapted(left, lambda frames: (f.assign(p=f.p * 2) for f in frames), "f long, p long")
    assert sorted(map(tuple, double.collect())) == [(1, 2), (2, 2)]


def test_repair_keeps_what_was_not_enhanced(spark):
    schema = "page long, table_no long, rows long"
    got = tables.repaired(spark.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 1, 7)], schema), spark.createDataFrame([(1, 1, 4)], schema), ["page"]).orderBy("page", "table_no").collect()
    assert [(r.status, r.enhanced_rows) for r in got] == [("replaced", 4), ("kept_missing_enhanced_table", 0), ("kept_missing_enhanced_table", 0)]


def test_unresolved(spark):
    rows = spark.createDataFrame([("failed", "ok", "text_ok"), ("converted", "ok", "text_ok"), ("converted", None, "needs_ocr")], "conversion_status string, quality_status string, ocr_status string")
    assert manifest.unresolved(rows).count() == 2


def test_publishing():
    body = "# T\n\npara *one*\nline `x`\n\n- a\n- **b**\n\n1. c\n\n> q\n\n| A | B |\n| --- | --- |\n| 1 | 2 |\n\n```py\n<x>\n```\n\n![i](p.png)\n\n---\n"
    assert [b[0] for b in publish.blocks_of(body)] == ["heading", "p", "ul", "ol", "quote", "table", "code", "image", "hr"]
    html = publish.html_of(body)
    assert "<h1>T</h1>" in html and "<strong>b</strong>" in html and "&lt;x&gt;" in html and '<img src="p.png">' in html and "<td>2</td>" in html
    assert publish.markdown_of("<nav>m</nav><h2>A &amp; b</h2><p>x<br>y<p><b>z</b><script>s</script>") == "## A & b\n\nx\ny\n\n**z**\n"
    assert publish.html_of("") == "" and publish.blocks_of(None) == []


def test_scan_order_and_exclusions(spark, tmp_path):
    for name in ("B.md", "a.md", "out/c.md", ".x/d.md", "a draft.md"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(name)
    found = readers.files(spark, str(tmp_path), "*.md", without=str(tmp_path / "out"), excluded=("draft",))
    assert [bytes(r.content).decode() for r in found.collect()] == ["a.md", "B.md"]


def test_json_documents(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "name string, n int, note string")
    readers.write_json_document(df, str(tmp_path / "j"))
    assert sorted(map(tuple, readers.json_document(spark, str(tmp_path / "j"), "name string, n int, note string").collect())) == [("a", 1, None), ("b", 2, "x")]
    assert "\n" in next(p for p in (tmp_path / "j").glob("part-*") if p.stat().st_size).read_text().strip()


def test_missing_chunks_file(spark, tmp_path):
    assert [r.issue for r in readers.json_lines_or_missing(spark, str(tmp_path / "none.jsonl"), "chunk_id string").collect()] == ["chunks_file_missing"]


def test_native_conversion(spark):
    given = [("a.txt", b"\xef\xbb\xbfplain"), ("a.CSV", b'x,"y|z"\n1,2\n3'), ("a.html", b"<h1>T</h1><p>b &amp; c</p>"), ("a.json", b'{"a": 1}'), ("a.docx", b"PK"), ("b.md", None)]
    got = {r.path: (r.markdown, r.error) for r in readers.converted(spark.createDataFrame(given, "path string, content binary")).collect()}
    assert got["a.txt"] == ("plain", None) and got["b.md"] == ("", None) and got["a.docx"] == (None, "package_failed: BadZipFile")
    assert got["a.CSV"][0] == "| x | y\\|z |\n| --- | --- |\n| 1 | 2 |\n| 3 |  |" and got["a.json"][0] == '```json\n{"a": 1}\n```' and got["a.html"][0] == "# T\n\nb & c\n"


def test_report(spark):
    counts = spark.createDataFrame([("red", 2), ("green", 1)], "name string, value long")
    items = spark.createDataFrame([("z",), ("a",), ("m",)], "line string")
    assert readers.report("Audit", counts, items, 2).first().markdown == "# Audit\n\n- green: 1\n- red: 2\n\n- a\n- m"
    assert readers.report("Audit", counts).first().markdown == "# Audit\n\n- green: 1\n- red: 2"


def test_routing_constants():
    """As the blueprint lists them, word for word."""
    assert route.CHEAP == ("simple_direct", "pdf_text", "legacy_office")
    assert route.ORDER == ("simple_direct", "pdf_text", "legacy_office", "needs_ocr", "pdf_table", "archive", "manual_review", "unsupported")
    assert route.BUCKETS == {
        **dict.fromkeys([".csv", ".docx", ".htm", ".html", ".json", ".md", ".pptx", ".txt", ".xlsx", ".xml"], "simple_direct"),
        **dict.fromkeys([".doc", ".ppt", ".xls"], "legacy_office"),
        **dict.fromkeys([".bmp", ".jpeg", ".jpg", ".png", ".tif", ".tiff", ".webp"], "needs_ocr"),
        **dict.fromkeys([".rar", ".zip"], "archive"),
        ".pdf": "pdf_text",
    }
    assert (route.LOW_TEXT, route.NEEDS_OCR_SHARE, route.IMAGE_SHARE) == (40, 0.7, 0.5)


def test_route_plan_and_selection(spark):
    paths = [("a.txt", 1), ("B.pdf", 2), ("c.DOC", 3), ("d.zip", 4), ("e.png", 5), ("f.xyz", 6), ("g.md", 7), (".h.txt", 8)]
    plan = route.planned(route.routed(spark.createDataFrame(paths, "path string, bytes long")))
    rows = sorted(route.recommended(plan).collect(), key=lambda r: r.recommended_order)
    assert [(r.bucket, r.n) for r in rows] == [("simple_direct", 2), ("pdf_text", 1), ("legacy_office", 1), ("needs_ocr", 1), ("archive", 1), ("unsupported", 1)]
    assert [r.recommended_order for r in rows] == [1, 2, 3, 4, 5, 6] and rows[3].skill == "ocr"
    assert sorted(r.path for r in route.selected(plan).collect()) == ["B.pdf", "a.txt", "c.DOC", "g.md"]
    assert [r.path for r in route.selected(plan, ("archive", "manual_review")).collect()] == ["d.zip"]
    with pytest.raises(ValueError):
        route.selected(plan, ("nonsense",))


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("split", [64, 1000, 1 << 20])
def test_line_numbers_across_splits(spark, tmp_path, end, split):
    """Lines of every length, longer than a split too, with blank ones, in large and small files."""
    rng = random.Random(split)
    texts = {}
    for name, n in (("big", 2000), ("one", 1), ("empty", 0), ("small", 30)):
        texts[name] = [rng.choice(["", "é" * rng.randrange(40), "x" * rng.randrange(300), " "]) + (f"#{i}" if i % 3 else "") for i in range(n)]
        (tmp_path / f"{name}.jsonl").write_bytes((("﻿" if name == "big" else "") + "".join(x + end for x in texts[name])).encode())
    was = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        rows = readers.numbered_lines(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() >= 1
        got = {}
        for r in rows.collect():
            got.setdefault(r.path.rsplit("/", 1)[-1].split(".")[0], []).append((r.line_no, r.line))
        splits = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was[0])
        spark.conf.set("spark.sql.files.openCostInBytes", was[1])
    assert splits > (50 if split == 1000 else 0)
    for name, lines in texts.items():
        assert sorted(got.get(name, [])) == list(enumerate(lines, 1))
