"""Names found by what they contain: against testing every name, with names that all begin alike."""

import random

from pyspark.sql import functions as F

from corpusloom.operators import links


def test_containing_is_the_brute_force_one(spark):
    rng = random.Random(4)
    letters = "ab.é_1"
    names = ["report_2024_" + "".join(rng.choice(letters) for _ in range(rng.randrange(8))) for _ in range(200)] + ["x", "ab", "", None, "report_2024_"]
    parts = [n[a : a + rng.randrange(1, 12)] for n in names[:120] for a in [rng.randrange(len(n))]] + ["rep", "report", "report_2024_", "nowhere", "zz", "", None, "report_2024_ab", "é", "x"]
    left = spark.createDataFrame(list(enumerate(parts)), "k long, part string")
    right = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.k: r.name for r in links.containing(left, "k", "part", right, "name").collect()}
    want = {k: min(n for n in names if n and p in n) for k, p in enumerate(parts) if p and any(n and p in n for n in names)}
    assert got == want
    assert links.containing(left.limit(0), "k", "part", right, "name").count() == links.containing(left, "k", "part", right.limit(0), "name").count() == 0


def test_a_common_beginning_brings_few_names_together(spark):
    """Ten thousand names that begin alike, and as many parts: the joins make rows in proportion, not in the square."""
    names = spark.range(10_000).select(F.concat(F.lit("report_of_the_year_"), F.format_string("%06d", "id")).alias("name"))
    parts = names.select(F.col("name").alias("k"), F.col("name").alias("part"))
    found = links.containing(parts, "k", "part", names, "name")
    assert found.where("k = name").count() == 10_000
