"""A bounded sample gives the class shares of the labels of the documents that there are."""

import numpy as np

from corpusloom.llm import toxicity


def test_a_sample_is_weighted_to_all_labels(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(3000):
        bad = i % 10 == 0
        rows.append((i, " ".join(["vileword" if rng.random() < (0.16 if bad else 0.1) else "plain" for _ in range(50)]), int(bad)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int")
    assert toxicity.class_weights(labels, 600) == (9.0, 1.0) and toxicity.class_weights(labels) == (1.0, 1.0)
    names = [b"f"]
    y = np.array([r[2] for r in rows])
    x = np.array([r[1].split().count("vileword") / 5 for r in rows])
    part = np.flatnonzero((y > 0) | (np.cumsum(y == 0) <= 300))
    fit = lambda at, weights=None: toxicity.fit(np.arange(len(at)), np.zeros(len(at), np.int64), x[at], y[at], names, weights=weights)
    share = lambda m: (x * m.weights[b"f"] > m.thresholds[0]).mean()
    whole, plain, weighted = fit(np.arange(3000)), fit(part), fit(part, np.where(y[part] > 0, 1.0, 9.0))
    assert share(plain) > 0.2 and abs(share(weighted) - share(whole)) < 0.03
    model = toxicity.fitted(docs, labels, 600)
    assert toxicity.severity(docs, model).where("toxic").count() < 0.1 * 3000


def test_a_part_of_a_corpus_is_sampled_from_its_own_labels(spark):
    """Labels of a hundred thousand documents, of which there are a thousand: the sample is drawn from these."""
    docs = spark.range(0, 100_000, 100).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(100_000).selectExpr("id AS doc_id", "1 AS quality", "CAST(id % 1000 = 0 AS INT) AS toxic")
    own = toxicity.labels_of(docs, labels)
    assert own.count() == 1000 and toxicity.class_weights(own, 400) == (4.5, 1.0)
    got = toxicity.labelled_sample(docs, own, 400).groupBy("grade").count().collect()
    assert {r.grade > 0: r["count"] for r in got} == {False: 200, True: 100}
