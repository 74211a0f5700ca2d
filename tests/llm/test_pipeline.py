"""The pipeline against its operators, stage by stage, and the registered queries."""

import pytest
from conftest import SF
from test_llm_operators import packed_ok
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from corpusloom.llm import near_dedup, pretokens, suffix_dedup, toxicity


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, []
    texts = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
        if name == "toxicity":
            scores = toxicity.severity(before, toxicity.fitted(before, spark.read.parquet(f"{SF}/labels.parquet")))
            assert sizes[-1] == scores.where("NOT toxic").count()
        elif name == "near_dedup":
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in near_dedup.near_duplicates(before).where("kept").collect()}
        elif name == "suffix_array_dedup":
            kept = {r.doc_id: bytes(r.kept).decode(errors="ignore") for r in suffix_dedup.without_repeats(before).collect()}
            assert {r.doc_id: r.text for r in docs.collect()} == kept
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            kept = {r.doc_id for r in docs.collect()}
            for r in before.collect():
                if r.doc_id in kept:
                    assert not any(x in r.text for x in items)
                else:
                    held = {*r.text.lower().split()}
                    assert any(sum(w in held for w in x.lower().split()) >= 0.5 * len(x.split()) for x in items)
        elif name == "packing":
            packed_ok(docs.collect(), Tokenizer.from_file(pretokens.vocabulary_path("byte_bpe_50k.json")), {r.doc_id: r.text for r in texts})
        if n < 4:
            assert docs.columns == columns
            texts = docs.collect()
    assert sizes == sorted(sizes[:4], reverse=True) + sizes[4:]
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in texts}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "start", "ids_crc32").collect())) == sorted(map(tuple, docs.select("doc_id", "start", "ids_crc32").collect()))


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", ["op3_minhash_near_dedup", "op4_warc_round_trip", "op5_redirect_equivalence"])
def test_query_is_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("pages", "documents"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = __spark_entry__.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want))


def test_stages_on_nulls_repeats_and_nothing(spark):
    rows = [(None, None, None, None, None), (None, "", "en", "s", 0), (1, "one text", "en", "s", 8), (1, "one text", "en", "s", 8), (2, "word " * 50_000, "en", "s", 250_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS _spans", "2 AS component_id", "3 AS share")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        got = [(r.doc_id, r.text is None) for r in out.collect()]
        assert (None, True) in got and (None, False) in got and (1, False) in got and (2, False) in got
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.pack(spark, docs, SF).where("doc_id IS NULL").count() == 2


def test_run_frees_its_tables(spark):
    """Of what the stages store only the last output is left."""
    from corpusloom.llm import common

    before = common.made()
    out = corpus_pipeline.run(spark, SF)
    assert common.made() == before + 1 and common._made[-1] in out.inputFiles()[0]
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(common.shared_dir(spark))
    there = {x.getPath().getName() for x in folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)}
    assert not {p.rsplit("/", 1)[-1] for p in common._made[:-1]} - there and out.count() > 0
