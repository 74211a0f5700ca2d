"""Python workers are given small batches, and no task all keys of a table."""

import pytest

from corpusloom.functions import batches
from corpusloom.operators import clean, links, publish
from corpusloom.sources import ooxml

RUNS = {
    "clean_markdown": lambda spark: clean.clean_markdown(spark.createDataFrame([(1, "a")], "doc_id long, body string")),
    "docx_round_trip": lambda spark: ooxml.office_markdown(spark.createDataFrame([("a", b"")], "path string, content binary")),
    "html_to_markdown": lambda spark: publish.html_to_markdown(spark.createDataFrame([(1, "a")], "page_id long, html string")),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_batches_are_small(spark, name):
    given = {key: spark.conf.get(key) for key in batches.MOST}
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64MB")
        RUNS[name](spark)
        assert {key: int(spark.conf.get(key)) for key in batches.MOST} == batches.MOST
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
        RUNS[name](spark)
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10"
    finally:
        for key, value in given.items():
            spark.conf.set(key, value)


def test_table_sources_are_dealt(spark):
    markers = spark.createDataFrame([(1, 1, 1), (1, 2, 1), (2, 1, 1)], "document long, page long, table_no long")
    documents = spark.createDataFrame([(1, 2)], "document long, pages long")
    found = links.table_sources(markers, documents, markers.limit(1))
    assert found.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    assert sorted(r["status"] for r in found.collect()) == ["checked", "source_page_out_of_range", "source_table_not_redetected"]
