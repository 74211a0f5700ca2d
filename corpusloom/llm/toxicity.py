"""Operator 1, toxicity by cumulative-link ordinal regression.

A text's grade of severity is 0 (not toxic), 1 (toxic) or 2 (toxic and of low quality: the labels hold no other degree
of severity than these two marks). One weight vector over sparse features serves all thresholds:
P(grade > k) = sigmoid(score - threshold_k), thresholds rising. The features are the shares, among a text's words, of
words and of their beginnings and inner parts of 4 to 6 characters; so a word adds the weights of its own features,
which an automaton finds, once for each word met. The expected severity is the sum of P(grade > k).

The model is fitted on the driver on a bounded sample of labelled documents (at most SAMPLE, one row each), weighted to
the classes' shares among all labels; every document is scored."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, mapped, pieces, rows_where, stored, table

#: Most labelled rows that are fitted on, the most features kept, the fewest texts of the sample a feature must be in.
SAMPLE, FEATURES, LEAST_TEXTS = 8000, 1 << 14, 4
#: A feature is kept if its likelihood ratio (G squared) of toxic against other texts is at least this.
LEAST_GAIN = 25.0
GRADES = 3
PARTS = (4, 5, 6)

_GAPS = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters and of all bytes of other characters."""
    return (text or "").lower().encode().translate(_GAPS).split()


def features_of(word: bytes) -> set[bytes]:
    w = word.decode(errors="ignore")
    return {word} | {f"{n}{w[s : s + n]}".encode() for n in PARTS for s in range(len(w) - n + 1)}


@dataclass
class Model:
    weights: dict[bytes, float]
    thresholds: list[float]
    reject: float

    def word_weight(self, word: bytes) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features_of(word))


class Features(dict):
    """Word to the numbers of its features, remembered; emptied when it holds most entries.

    Parts are found by an automaton over all of them; the numbers are places in names."""

    most = 200_000

    def __init__(self, names: list[bytes]) -> None:
        super().__init__()
        self.whole: dict[bytes, int] = {}
        self.parts = ahocorasick.Automaton()
        for k, f in enumerate(names):
            if f[:1].isdigit():
                self.parts.add_word(f[1:].decode(), k)
            else:
                self.whole[f] = k
        self.parts.make_automaton()

    def of(self, word: bytes) -> list[int]:
        found = {k for _, k in self.parts.iter(word.decode(errors="ignore"))} if len(self.parts) else set()
        if (k := self.whole.get(word)) is not None:
            found.add(k)
        return sorted(found)

    def __missing__(self, word: bytes) -> list[int]:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = self.of(word)
        return found


class _Weights(dict):
    most = 200_000

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.features, self.values = Features(list(model.weights)), list(model.weights.values())

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = sum(self.values[k] for k in self.features.of(word))
        return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Likelihood:
    """Penalised mean log-likelihood of sparse rows in the cumulative-link model, and its gradient.

    Parameters: a weight for each feature, the first threshold, and the logarithms of the gaps between thresholds."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, n_features: int, grades_n: int, ridge: float, weights: np.ndarray | None) -> None:
        self.rows, self.cols, self.values, self.y, self.k, self.grades, self.ridge = rows, cols, values, y, n_features, grades_n, ridge
        n = len(y)
        self.each = np.ones(n) if weights is None else weights * (n / weights.sum())

    def thresholds(self, x: np.ndarray) -> np.ndarray:
        first, gaps = x[self.k], x[self.k + 1 :]
        return np.concatenate([[first], first + np.cumsum(np.exp(gaps))])

    def __call__(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        y, n, w = self.y, len(self.y), x[: self.k]
        at = np.arange(n)
        score = np.bincount(self.rows, self.values * w[self.cols], n)
        p = _sigmoid(score[:, None] - self.thresholds(x))  # P(grade > k)
        edge = np.concatenate([np.ones((n, 1)), p, np.zeros((n, 1))], 1)
        mass = np.maximum(1e-12, edge[at, y] - edge[at, y + 1])
        slope = np.concatenate([np.zeros((n, 1)), p * (1 - p), np.zeros((n, 1))], 1)
        upper, lower = self.each * slope[at, y] / mass, self.each * slope[at, y + 1] / mass  # d log mass / d score = upper - lower
        g_score = -(upper - lower) / n
        g_theta = np.array([(upper[y == k + 1].sum() - lower[y == k].sum()) / n for k in range(self.grades - 1)])
        tail = np.cumsum(g_theta[::-1])[::-1]
        grad = np.concatenate([np.bincount(self.cols, self.values * g_score[self.rows], self.k) + self.ridge * w, [tail[0]], tail[1:] * np.exp(x[self.k + 1 :])])
        return -(self.each * np.log(mass)).mean() + self.ridge / 2 * (w @ w), grad


#: Fitting ends when ten rounds lower the loss by less than this share of it.
SETTLED = 1e-4


def fit(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, names: list[bytes], grades_n: int = GRADES, rounds: int = 300, ridge: float = 3e-4, weights: np.ndarray | None = None) -> Model:
    """Cumulative-link fit of sparse rows by full-batch Adam with a ridge penalty; the same input gives the same model.
    weights: how many rows each row stands for, all alike if not given. Ends when it has SETTLED, after rounds at most.

    Without rows, or with one grade only, the model rejects nothing."""
    if len(y) == 0 or y.min() == y.max():
        return Model({}, [10.0 + k for k in range(grades_n - 1)], 0.5)
    loss = Likelihood(rows, cols, values, y, len(names), grades_n, ridge, weights)
    x = np.zeros(len(names) + grades_n - 1)
    x[len(names)] = 1.0
    mean, square = np.zeros(len(x)), np.zeros(len(x))
    before = np.inf
    for t in range(1, rounds + 1):
        now, grad = loss(x)
        if t % 10 == 0:
            if before - now < SETTLED * now:
                break
            before = now
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        x -= 0.05 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    return Model({f: float(v) for f, v in zip(names, x) if abs(v) > 1e-9}, loss.thresholds(x).tolist(), 0.5)


def _grades(labels: DataFrame) -> DataFrame:
    return labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.when(F.col("toxic") > 0, F.when(F.col("quality") > 0, 1).otherwise(2)).otherwise(0)).alias("grade"))


def class_weights(labels: DataFrame, sample: int = SAMPLE) -> tuple[float, float]:
    """How many labelled documents one of the sample stands for, of those not toxic and of the toxic ones."""
    toxic = F.col("grade") > 0
    other, hot = _grades(labels).agg(F.count_if(~toxic), F.count_if(toxic)).first()
    return max(1.0, other / (sample - sample // 2)), max(1.0, hot / (sample // 2))


def labels_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labels of documents that docs holds, so that a part of a corpus is sampled from what it has."""
    return stored(labels.select("doc_id", "quality", "toxic").join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi"), "labels")


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text, grade of at most so many labelled documents: half of them toxic, if there are enough, chosen by hash.

    Labels with null columns are left out; of labels that repeat an id the most severe counts, of rows of docs that repeat
    one the least text, so the sample is bounded whatever repeats."""
    grades = _grades(labels)
    order = [F.xxhash64("doc_id"), "doc_id"]
    some = grades.where("grade > 0").orderBy(*order).limit(sample // 2).unionAll(grades.where("grade = 0").orderBy(*order).limit(sample - sample // 2))
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(some), "doc_id")  # bounded by sample
    return rows.groupBy("doc_id", "grade").agg(F.min("text").alias("text")).select("doc_id", "text", "grade")


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features, the texts that they are in, and the toxic ones of these; the features of a word are made once for a batch."""
    for given in batches:
        texts, grades = given.column(1).to_pylist(), given.column(2).to_pylist()
        for a, b in pieces(texts, 1 << 21):
            numbers: dict[str | bytes, int] = {}  # parts as str, whole words as bytes
            known: dict[bytes, list[int]] = {}
            found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for t, g in zip(texts[a:b], grades[a:b]):
                own = {*words(t)}
                for w in [w for w in own if w not in known]:
                    x = w.decode(errors="ignore")
                    known[w] = [numbers.setdefault(f, len(numbers)) for n in PARTS for f in [x[s : s + n] for s in range(len(x) - n + 1)]]
                    known[w].append(numbers.setdefault(w, len(numbers)))
                found[g > 0].append(np.unique(np.fromiter(chain.from_iterable(map(known.__getitem__, own)), np.int64)))
            cold, hot = (np.bincount(np.concatenate(x).astype(np.int64), minlength=len(numbers)) for x in found)
            names = [f if isinstance(f, bytes) else f"{len(f)}{f}".encode() for f in numbers]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(cold + hot, pa.int64()), pa.array(hot, pa.int64())], names=["feature", "texts", "hot"])


def telling_features(sample: DataFrame, most: int = FEATURES) -> list[bytes]:
    """The features whose likelihood ratio is LEAST_GAIN or more, the highest first."""
    n, n1 = (int(x or 0) for x in sample.agg(F.count(F.lit(1)), F.sum((F.col("grade") > 0).cast("int"))).first())
    if n1 in (0, n):
        return []
    counts = sample.select("doc_id", "text", "grade").transform(mapped, _feature_counts, "feature binary, texts long, hot long").groupBy("feature").agg(F.sum("texts").alias("k"), F.sum("hot").alias("h"))
    part = lambda x, of: F.when(x > 0, x * F.log(x / of)).otherwise(0.0)
    k, h, all_, toxic = F.col("k"), F.col("h"), F.lit(float(n)), F.lit(float(n1))
    gain = 2 * (part(h, k) + part(k - h, k) + part(toxic - h, all_ - k) + part(all_ - toxic - k + h, all_ - k) - part(toxic, all_) - part(all_ - toxic, all_))
    kept = counts.where((k >= LEAST_TEXTS) & (k < all_)).withColumn("gain", gain).where(F.col("gain") >= LEAST_GAIN)
    return [bytes(r.feature) for r in kept.orderBy(F.desc("gain"), "feature").limit(most).collect()]


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Features and vectors of the sample are made on the executors; the driver gets at most FEATURES names and the
    sample's vectors over them."""
    labels = labels_of(docs, labels)
    some = stored(labelled_sample(docs, labels, sample), "sample")
    names = telling_features(some)
    sent = docs.sparkSession.sparkContext.broadcast(names)  # bounded by FEATURES

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Features(sent.value)
        for given in batches:
            cols, values = [], []
            for t in given.column(1).to_pylist():
                ws = words(t)
                x: Counter = Counter()
                for w, c in Counter(ws).items():
                    for k in index[w]:
                        x[k] += c
                cols.append(sorted(x)), values.append([100 * x[k] / len(ws) for k in sorted(x)])
            yield pa.RecordBatch.from_arrays([given.column(0), given.column(2), pa.array(cols, pa.list_(pa.int64())), pa.array(values, pa.list_(pa.float64()))], names=["doc_id", "grade", "cols", "vals"])

    rows = some.select("doc_id", "text", "grade").transform(mapped, vectors, "doc_id long, grade int, cols array<long>, vals array<double>").toPandas()
    rows = rows.sort_values(["doc_id", "grade"], kind="stable") if len(rows) else rows
    sizes = [len(c) for c in rows["cols"]]
    flat = lambda c, kind: np.concatenate([np.zeros(0, kind), *(np.asarray(x, kind) for x in rows[c])])
    y = rows["grade"].to_numpy(np.int64)
    weights = np.array(class_weights(labels, sample))[(y > 0).astype(np.int64)]
    return fit(np.repeat(np.arange(len(rows)), sizes).astype(np.int64), flat("cols", np.int64), flat("vals", np.float64), y, names, weights=weights)


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score_texts(texts: list[str | None], weight: _Weights) -> list[float]:
    get = weight.__getitem__
    out = []
    for t in texts:
        ws = words(t)
        out.append(100 * sum(map(get, ws)) / max(1, len(ws)))
    return out


def _graded(df: DataFrame, thresholds: list[float], reject: float) -> DataFrame:
    over = [1 / (1 + F.exp(F.lit(t) - F.col("score"))) for t in thresholds]
    df = df.withColumn("p_toxic", over[0]).withColumn("expected_severity", sum(over[1:], over[0]))
    grade = sum(((p >= 0.5).cast("int") for p in over[1:]), (over[0] >= 0.5).cast("int"))
    return df.withColumn("grade", grade).withColumn("toxic", F.col("p_toxic") >= reject).drop("score")


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, p_toxic, expected_severity, grade, toxic; one row per row of docs.

    A null or empty text scores zero. Null ids stay null, rows that repeat are scored each, very long texts whole; a
    probability that equals the threshold is over it; other columns are not looked at; without rows the result is empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by FEATURES

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = _Weights(sent.value)
        for given in batches:
            texts = given.column(1).to_pylist()
            for a, b in pieces(texts):
                yield batch(_SCORES, {"doc_id": given.column(0).slice(a, b - a), "score": score_texts(texts[a:b], weight)})

    out = docs.select(F.col("doc_id").cast("long"), "text").transform(mapped, scored, "doc_id long, score double")
    return _graded(out, model.thresholds, model.reject)


def not_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that are not toxic, all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    limit = float(np.log(model.reject / (1 - model.reject))) + model.thresholds[0]

    def decide():
        weight = _Weights(sent.value)
        return lambda texts: [x < limit for x in score_texts(texts, weight)]

    return rows_where(docs, decide)


def op1_ordinal_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return severity(docs, fitted(docs, table(spark, sf_dir, "labels")))
