from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlake.llm import toxicity
from fleetlake.llm.common import table

SF_DIR = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, grade string, severity string"


def texts(n, seed):
    """Documents of grades 0 to 3: the more bad words, the higher."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        grade = i % 4
        words = rng.choices([f"plain{j}" for j in range(400)], k=rng.randint(20, 60))
        words += rng.sample(["vile", "foul", "nasty", "grim", "rotten", "cruel"], 2 * grade)
        rng.shuffle(words)
        rows.append((i, " ".join(words), "x", "y"))
    return rows


@pytest.fixture(scope="module")
def graded(spark):
    docs = spark.createDataFrame(texts(800, 1), DOCS)
    labels = docs.select("doc_id", (F.col("doc_id") % 4).alias("grade"))
    return docs, labels, toxicity.train(docs, labels)


def test_grades_are_predicted_in_order(spark, graded):
    _, _, model = graded
    assert len(model.thresholds) == 3 and (np.diff(model.thresholds) > 0).all()
    unseen = spark.createDataFrame(texts(400, 2), DOCS)
    out = {r.doc_id: r for r in toxicity.severity(unseen, model).collect()}
    assert np.mean([out[i].severity == i % 4 for i in range(400)]) > 0.9
    means = [np.mean([out[i].expected_severity for i in range(g, 400, 4)]) for g in range(4)]
    assert means == sorted(means) and means[0] < 0.5 and means[3] > 2.5


def test_thresholds_share_the_weights(graded):
    _, _, model = graded
    above = model.at_least(np.linspace(-5, 15, 50))
    assert (np.diff(above, axis=0) >= 0).all() and (np.diff(above, axis=1) <= 0).all()


def test_rows_with_nulls_repeats_and_long_texts(spark, graded):
    _, _, model = graded
    rows = [(1, None, "a", "b"), (2, "", "a", "b"), (3, "VILE, foul; nasty grim rotten cruel", "a", "b"), (3, "VILE, foul; nasty grim rotten cruel", "a", "b")]
    rows += [(None, "plain1 plain2", "a", "b"), (4, "plain3 " * 200_000, "a", "b")]
    docs = spark.createDataFrame(rows, DOCS)
    out = toxicity.severity(docs, model).collect()
    assert sorted((str(r.doc_id), r.toxic) for r in out) == [("1", False), ("2", False), ("3", True), ("3", True), ("4", False), ("None", False)]
    assert out[0].expected_severity == out[1].expected_severity
    kept = toxicity.without_toxic(docs, model)
    assert kept.schema == docs.schema and kept.count() == 4


def test_labels_that_do_not_count(spark, graded):
    docs, labels, model = graded
    odd = spark.createDataFrame([(0, None), (None, 3), (10**9, 2), (0, -1)], "doc_id long, grade long")
    again = toxicity.train(docs, labels.union(odd).union(labels))
    assert again.weights == model.weights and (again.thresholds == model.thresholds).all()


def test_too_few_grades(spark, graded):
    docs, labels, _ = graded
    for some in (labels.limit(0), labels.where("grade = 2")):
        out = toxicity.severity(docs, toxicity.train(docs, some)).collect()
        assert len(out) == 800 and not any(r.toxic or r.expected_severity for r in out)
    assert toxicity.severity(docs.limit(0), toxicity.train(docs.limit(0), labels)).collect() == []


def test_the_sample_is_bounded(spark, graded):
    docs, labels, _ = graded
    model = toxicity.train(docs, labels, per_grade=50)
    assert 0 < len(model.weights) and len(model.thresholds) == 3


def test_held_out_accuracy(spark):
    """Trained on half of the labels, told by the other half; some labels are noise."""
    docs = table(spark, SF_DIR, "documents")
    labels = table(spark, SF_DIR, "labels").select("doc_id", F.col("toxic").alias("grade"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = toxicity.train(docs, labels.where(half))
    assert len(model.thresholds) == toxicity.GRADES - 1
    rest = toxicity.severity(docs, model).join(labels.where(~half), "doc_id").collect()
    toxic = [r for r in rest if r.grade == 1]
    clean = [r for r in rest if r.grade == 0]
    assert np.mean([r.toxic for r in toxic]) > 0.9
    assert np.mean([r.toxic for r in clean]) < 0.04


def test_splitting_a_label_does_not_add_to_its_weight(spark):
    """Without a word that 60 % of the toxic and 30 % of the clean documents have, a document is rather clean."""
    hint = [i % 10 < (6 if i >= 200 else 3) for i in range(400)]
    docs = spark.createDataFrame([(i, "same hint" if h else "same", "x", "y") for i, h in enumerate(hint)], DOCS)
    labels = docs.select("doc_id", (F.col("doc_id") >= 200).cast("int").alias("grade"))
    model = toxicity.train(docs, labels)
    assert len(model.thresholds) == 2
    assert all(r.toxic == hint[r.doc_id] for r in toxicity.severity(docs, model).collect())


def words(text):
    return set(re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.lower()))


def test_scores_against_brute_force(spark, graded):
    """Every score, chance and grade recomputed from weights and thresholds, a feature at a time."""
    docs, _, model = graded
    found = {r.doc_id: r for r in toxicity.severity(docs, model).collect()}
    for row in docs.collect():
        features = {f for w in words(row.text) for f in toxicity.word_features(w.encode())}
        score = sum(model.weights.get(f, 0.0) for f in features)
        chances = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        got = found[row.doc_id]
        assert got.expected_severity == pytest.approx(sum(chances), abs=2e-6)
        assert got.severity == sum(c >= 0.5 for c in chances) and got.toxic == (got.severity > 0)


def test_the_fit_against_numeric_gradients():
    """At the fitted values the likelihood, recomputed document by document, has no slope along any threshold, and
    along a weight none beyond the penalty."""
    rng = np.random.default_rng(2)
    grades = np.arange(300) % 3
    rows = [np.unique(np.append(rng.integers(0, 30, 6), 30 + g) if rng.random() < 0.7 else rng.integers(0, 33, 6)) for g in grades]
    model = toxicity.fit([r.astype(np.int32) for r in rows], grades, 3, steps=4000)

    def loss(weights, thresholds):
        total = 0.0
        for features, grade in zip(rows, grades, strict=True):
            score = sum(weights.get(int(f), 0.0) for f in features)
            above = [1.0, *(1 / (1 + math.exp(t - score)) for t in thresholds), 0.0]
            total -= math.log(above[grade] - above[grade + 1])
        return total / len(rows)

    step = 1e-5
    for k in range(2):
        moved = [model.thresholds + d * np.eye(2)[k] for d in (step, -step)]
        assert abs(loss(model.weights, moved[0]) - loss(model.weights, moved[1])) / (2 * step) < 2e-3
    for feature, weight in list(model.weights.items())[:10]:
        moved = [loss({**model.weights, feature: weight + d}, model.thresholds) for d in (step, -step)]
        assert (moved[0] - moved[1]) / (2 * step) == pytest.approx(-math.copysign(toxicity.SHRINK, weight), abs=2e-3)


def test_one_id_with_two_texts_and_very_long_ones(spark):
    rows = texts(80, 3) + [(3, "another text of this id", "x", "y"), (1, None, "x", "y")]
    rows += [(1000, " ".join(f"w{i}" for i in range(30_000)), "x", "y")]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(r[0], r[0] % 4) for r in rows], "doc_id long, grade long")
    one, two = (toxicity.train(d, labels) for d in (docs, docs.orderBy(F.desc("doc_id"))))
    assert one.weights == two.weights and (one.thresholds == two.thresholds).all()
