"""The pipeline, stage by stage, against brute force on what the stage before kept."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from test_decontaminate import brute as benchmark_hits
from test_decontaminate import windows
from test_packing import check
from test_simhash import brute_components, brute_fingerprint
from test_suffix_dedup import brute as passages

import __spark_entry__ as entry_points
import corpus_pipeline
from fleetlake.llm import components, simhash, suffix_dedup, toxicity
from fleetlake.llm.common import stored, table


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage, and what comes out of the last."""
    docs, out = table(spark, SF_DIR, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = stored(stage(spark, docs, SF_DIR), name)
    return [*out, docs]


def test_stages_keep_the_columns(stages):
    for docs in stages[:-1]:
        assert docs.dtypes == stages[0].dtypes
        assert docs.where("n_chars <> length(text)").isEmpty()


def test_toxic_documents_go(spark, stages):
    labels = table(spark, SF_DIR, "labels").selectExpr("doc_id", "toxic AS grade")
    toxic = toxicity.severity(stages[0], toxicity.train(stages[0], labels)).where("toxic").count()
    assert 0 < toxic == stages[0].count() - stages[1].count() < 0.3 * stages[0].count()


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    prints = {i: brute_fingerprint(t) for i, t in rows}
    root = brute_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, _ in sorted(rows):
        least.setdefault(root[prints[i]], i)
    assert {(r.doc_id, r.text) for r in stages[2].collect()} == {r for r in rows if r[0] in least.values()}
    assert stages[2].count() == len(least) < len(rows)


def test_repeated_passages_go(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    gone = {i: set(removed) for (i, _), (removed, _) in passages(rows, suffix_dedup.MIN_WORDS).items()}
    out = {r.doc_id: r.text for r in stages[3].collect()}
    assert {i: t.split() for i, t in out.items()} == {
        i: [w for a, w in enumerate(t.split()) if a not in gone.get(i, ())] for i, t in rows
    }
    assert all(out[i] == t for i, t in rows if not gone.get(i))


def test_benchmark_passages_go(spark, stages):
    found = windows([(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()])
    before = {r.doc_id: r.text for r in stages[3].collect()}
    after = {r.doc_id: r.text for r in stages[4].collect()}
    assert before.keys() == after.keys()
    assert not any(benchmark_hits(t, found)[1] for t in after.values())
    assert all(after[i] == t for i, t in before.items() if not benchmark_hits(t, found)[1])


def test_every_token_is_packed(stages):
    share, _ = check([(r.doc_id, r.text) for r in stages[4].collect()], stages[5].collect())
    assert share < 0.015


def test_run_gives_the_last_stage(spark, stages):
    out = entry_points.queries()["pipeline"](spark, SF_DIR)
    assert out.columns == stages[5].columns and out.count() == stages[5].count()


def test_files_fit_their_rows_not_the_shuffle(spark, stages, monkeypatch):
    files, cores = {}, spark.sparkContext.defaultParallelism

    def noted(df, label, *size):
        out = stored(df, label, *size)
        files[label] = max(files.get(label, 0), len(out.inputFiles()))
        return out

    for module in (components, simhash, suffix_dedup, toxicity):
        monkeypatch.setattr(module, "stored", noted)
    settings = {"spark.sql.shuffle.partitions": str(10 * cores), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:3]):
            out = stage(spark, stages[i], SF_DIR)
            assert sorted(out.collect(), key=str) == sorted(stages[i + 1].collect(), key=str), name
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    del files["simhash-links"]  # the groups of one key each are the work there
    assert {"toxicity-sample", "simhash-found", "star-small", "suffix-runs"} < files.keys()
    assert max(files.values()) <= cores, files


@pytest.mark.parametrize("empty", [True, False])
def test_odd_rows_pass_every_stage(spark, empty):
    """Nulls, empty and very long texts, repeated rows and an extra column; and a table without rows."""
    long = " ".join(f"word{i}" for i in range(30_000))
    rows = [(1, None, "en", "s", None, 1), (2, "", None, None, 0, 1), (None, "text without an id", "en", "s", 18, 1), (None, None, None, None, None, None)]
    rows += [(3, long, "en", "s", len(long), 1), (4, "one short text", "en", "s", 14, 1), (4, "one short text", "en", "s", 14, 1), (5, "x" * 200_000, "en", "s", 200_000, 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, removed int"
    docs = spark.createDataFrame([] if empty else rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "removed"]
    kept = {(r.doc_id, r.text) for r in docs.collect()}
    # the texts without words are one group, of which the smallest id stays
    assert kept == (set() if empty else {(1, None), (None, "text without an id"), (3, long), (4, "one short text"), (5, "x" * 200_000)})
    check([] if empty else list(kept), corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect())
