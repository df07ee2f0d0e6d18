"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

A document's features are its distinct words, each as itself and by its first characters, hashed. One
weight vector gives a score, and ordered thresholds t(1) < ... < t(K-1) share it: P(grade >= k) is the
logistic function of score - t(k). The fit takes a bounded sample of labelled documents; scoring adds up
the weights of a document's features, each once, in one narrow pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import files_for, prepared, stored
from fleetlake.llm.decontaminate import words_of

#: Labelled documents of each given grade that the fit takes, those of the smallest hash, with all their words.
SAMPLE_PER_GRADE = 2_500
#: Bytes of a sampled document's text, by estimate.
SAMPLE_BYTES = 16 * 2**10
#: Grades to predict where the labels tell two only: the upper one is split at equal parts of its scores.
GRADES = 3
#: Hashed features, and lengths of the beginnings of longer words.
FEATURES = 2**20
BEGINNINGS = (4, 5, 6, 7, 8)
#: Features that the fit weighs, those that tell grades apart best, if enough documents have them.
WEIGHED, LEAST_DOCUMENTS = 20_000, 3
#: Steps of the fit, step size, and pull of weights towards zero.
STEPS, RATE, SHRINK = 300, 0.05, 1e-3
#: Words whose weights a task remembers.
KNOWN_WORDS = 200_000


def word_features(word: bytes) -> list[int]:
    """The word's features: itself, and its first characters where it has more of them."""
    text = word.decode()
    names = ["=" + text, *(text[:n] for n in BEGINNINGS if len(text) > n)]
    return [xxhash.xxh64_intdigest(n.encode(), 0) % FEATURES for n in names]


@dataclass
class Model:
    """Weights of the features that have one, and the thresholds between neighbouring grades."""

    weights: dict[int, float]
    thresholds: np.ndarray

    def score(self, features: set[int]) -> float:
        """The sum of a document's weights, each feature once; exact, as features come in no order."""
        return math.fsum(map(self.weights.__getitem__, features))

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 ..., a row for each score."""
        return _logistic(np.asarray(scores, float)[:, None] - self.thresholds)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _telling(rows: list[np.ndarray], grades: np.ndarray) -> np.ndarray:
    """The features whose documents' mean grade differs most from the rest's, in order."""
    documents, apart = np.zeros(FEATURES, np.int32), np.zeros(FEATURES)
    for features, off in zip(rows, grades - grades.mean(), strict=True):
        documents[features] += 1
        apart[features] += off
    apart = np.abs(apart) / np.sqrt(np.maximum(documents, 1))
    apart[documents < LEAST_DOCUMENTS] = 0
    least = np.partition(apart, -WEIGHED)[-WEIGHED]
    return np.flatnonzero((apart >= least) & (apart > 0))


def fit(
    rows: list[np.ndarray], grades: np.ndarray, levels: int, steps: int = STEPS, given: np.ndarray | None = None
) -> Model:
    """A model from documents' lists of distinct features and grades 0 .. levels-1, at least one document.

    Each of the ``given`` grades weighs the same, however many of its documents are in the sample and into how many
    of ``grades`` it is split; without ``given`` each of ``grades`` does.

    Proximal gradient steps with per-weight step sizes on the mean negative log likelihood, with an
    absolute-value penalty that leaves most weights at zero.
    """
    used = _telling(rows, grades)
    places = np.full(FEATURES, -1, np.int32)
    places[used] = np.arange(len(used))
    columns = [c[c >= 0] for c in (places[r] for r in rows)]
    column = np.concatenate(columns)
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(c) for c in columns])
    weights = np.zeros(len(used))
    shares = 1 - np.arange(1, levels) / levels
    first = np.log((1 - shares) / shares)
    # thresholds stay in order: the first, then logarithms of the distances
    free = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 0.1))])
    moments = [[np.zeros_like(v), np.zeros_like(v)] for v in (weights, free)]
    groups, sizes = (grades, np.bincount(grades, minlength=levels)) if given is None else (given, np.bincount(given))
    weight = 1 / (sizes[groups] * len(sizes))
    for step in range(1, steps + 1):
        thresholds = free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])
        scores = np.bincount(owner, weights[column], len(rows))
        above = _logistic(scores[:, None] - thresholds)
        bounds = np.concatenate([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))], axis=1)
        at = np.arange(len(rows))
        chance = np.maximum(bounds[at, grades] - bounds[at, grades + 1], 1e-12)
        slope = bounds * (1 - bounds)
        by_score = -(slope[at, grades] - slope[at, grades + 1]) / chance * weight
        by_bound = np.zeros((len(rows), levels + 1))
        by_bound[at, grades] = slope[at, grades] / chance * weight
        by_bound[at, grades + 1] -= slope[at, grades + 1] / chance * weight
        by_threshold = by_bound[:, 1:levels].sum(axis=0)
        tail = np.cumsum(by_threshold[::-1])[::-1]
        gradients = (
            np.bincount(column, by_score[owner], len(used)),
            np.concatenate([tail[:1], tail[1:] * np.exp(free[1:])]),
        )
        for value, gradient, (mean, square), shrink in zip((weights, free), gradients, moments, (SHRINK, 0), strict=True):
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient**2 - square)
            pace = RATE / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
            value -= pace * mean / (1 - 0.9**step)
            if shrink:
                value[:] = np.sign(value) * np.maximum(np.abs(value) - pace * shrink, 0)
    thresholds = free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])
    kept = np.flatnonzero(weights)
    return Model(dict(zip(used[kept].tolist(), weights[kept].tolist(), strict=True)), thresholds)


def train(docs: DataFrame, labels: DataFrame, per_grade: int = SAMPLE_PER_GRADE, grades: int = GRADES) -> Model:
    """A model from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, grade``, the higher the worse).

    Labels with a null id or grade, or without a document, don't count; of several for a document the
    highest does. Where the labels have two grades, a first fit scores the documents of the upper
    one, which is then split into ``grades - 1`` equal parts by score. With fewer than two grades
    among the documents found, every document gets the lowest.
    """
    graded = (
        labels.where(F.col("doc_id").isNotNull() & F.col("grade").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("grade").alias("grade"))
    )
    prepared(docs.sparkSession)
    chosen, most = None, 0
    key = F.xxhash64("doc_id")
    for grade, count in sorted(tuple(r) for r in graded.groupBy("grade").count().collect()):
        # about twice as many have a hash this low, so tasks send no more than that together
        low = key.cast("double") < 2.0**64 * min(2 * per_grade / count, 1.0) - 2.0**63
        some = graded.where((F.col("grade") == grade) & low).orderBy(key).limit(per_grade)
        most += min(count, per_grade)
        chosen = some if chosen is None else chosen.union(some)
    if chosen is None:
        return Model({}, np.array([np.inf]))
    sample = _features(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    files = files_for(SAMPLE_BYTES * most, docs.sparkSession.sparkContext.defaultParallelism)
    sample = stored(sample.coalesce(files), "toxicity-sample")  # a file for each core at least, as the texts are read here
    names = sorted(r.grade for r in sample.select("grade").distinct().collect())
    if len(names) < 2:
        return Model({}, np.array([np.inf]))
    given = F.array_position(F.array(*map(F.lit, names)), F.col("grade")).cast("int") - 1
    sample = sample.select("doc_id", given.alias("given"), "features")
    ids, rows, known, _ = _told(sample.withColumn("grade", F.col("given")))
    model = fit(rows, known, len(names))
    if len(names) == 2 and grades > 2:
        scores = np.array([model.score(model.weights.keys() & r.tolist()) for r in rows])
        parts = np.quantile(scores[known == 1], np.arange(1, grades - 1) / (grades - 1))
        finer = known * (1 + np.searchsorted(parts, scores, "right"))
        split = docs.sparkSession.createDataFrame(list(zip(ids, finer.tolist(), strict=True)), _SPLIT.format(_type(docs, "doc_id")))
        _, rows, finer, known = _told(sample.join(F.broadcast(split), "doc_id"))  # a row for each of the sample
        model = fit(rows, finer, grades, given=known)
    return model


_SPLIT = "doc_id {}, grade int"


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _told(sample: DataFrame) -> tuple[list, list[np.ndarray], np.ndarray, np.ndarray]:
    """Ids, features, grades and given grades of the sample, with the features that tell the grades apart best.

    Tasks count features and Spark adds them up; only the chosen ones come to the driver: as many as the fit weighs, for
    each document.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, total = np.zeros(FEATURES, np.int64), np.zeros(FEATURES, np.int64)
        for batch in batches:
            for features, grade in zip(batch["features"], batch["grade"].to_pylist(), strict=True):
                documents[found := np.asarray(features.values)] += 1
                total[found] += grade
        seen = np.flatnonzero(documents)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(documents[seen]), pa.array(total[seen])],
            ["feature", "documents", "total"],
        )

    mean = sample.agg(F.avg("grade")).first()[0]
    counted = sample.select("grade", "features").mapInArrow(count, "feature int, documents long, total long")
    counted = counted.groupBy("feature").agg(F.sum("documents").alias("documents"), F.sum("total").alias("total"))
    apart = F.abs(F.col("total") - mean * F.col("documents")) / F.sqrt("documents")
    chosen = counted.withColumn("apart", apart).where((F.col("documents") >= LEAST_DOCUMENTS) & (F.col("apart") > 0))
    used = [r.feature for r in chosen.orderBy(F.desc("apart"), "feature").limit(WEIGHED).collect()]
    used = np.sort(np.array(used, np.int32))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.asarray(r.values, np.int32) for r in batch["features"]]
            kept = pa.array([r[np.isin(r, used)].tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], kept], ["doc_id", "given", "grade", "features"])

    few = sample.select("doc_id", "given", "grade", "features").mapInArrow(
        keep, f"doc_id {_type(sample, 'doc_id')}, given int, grade int, features binary"
    )
    found = sorted(few.collect(), key=lambda r: r.doc_id)
    rows = [np.frombuffer(r.features, np.int32) for r in found]
    return [r.doc_id for r in found], rows, np.array([r.grade for r in found]), np.array([r.given for r in found])


def _features(docs: DataFrame) -> DataFrame:
    """``doc_id, grade, features`` of the sample: all distinct features, one row per id.

    Of several texts under one id that of the smallest hash counts.
    """

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch["text"].cast(pa.binary()).to_pylist()):
                found = {f for w in set(words_of(text)) for f in word_features(w)}
                features = pa.array([np.sort(np.fromiter(found, np.int32, len(found)))], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(i, 1), batch["grade"].slice(i, 1), features], ["doc_id", "grade", "features"]
                )

    one = docs.groupBy("doc_id", "grade").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.mapInArrow(featured, f"doc_id {_type(docs, 'doc_id')}, grade {_type(docs, 'grade')}, features array<int>")


class _Weighted(dict):
    """The features with a weight of the words seen so far, up to a number of them."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found = tuple(f for f in word_features(word) if f in self.model.weights)
        return found


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    weighted = _Weighted(model)
    for batch in batches:
        texts = batch["text"].cast(pa.binary()).to_pylist()
        scores = [model.score(set().union(*filter(None, map(weighted.__getitem__, set(words_of(t)))))) for t in texts]
        yield batch, model.at_least(np.array(scores))


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, expected_severity, severity, toxic``, one row for every row of ``docs``.

    ``expected_severity`` is the expected grade, from 0, to six decimals; ``severity`` the highest grade
    that is reached at even odds or better; ``toxic`` whether that is above 0. A null text, and one without words,
    has no features and the score 0. Repeated rows and null ids are scored each; other columns are
    ignored.
    """
    prepared(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, above in _scored(batches, shared.value):
            reached = (above >= 0.5).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(above.sum(axis=1).round(6), pa.float64()),
                    pa.array(reached, pa.int32()),
                    pa.array(reached > 0, pa.bool_()),
                ],
                ["doc_id", "expected_severity", "severity", "toxic"],
            )

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        score, f"doc_id {doc_type}, expected_severity double, severity int, toxic boolean"
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that :func:`severity` calls toxic; all columns stay."""
    prepared(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, above in _scored(batches, shared.value):
            yield batch.filter(pa.array((above < 0.5).all(axis=1), pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
