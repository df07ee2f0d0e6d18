from __future__ import annotations

import random

import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlake.llm import suffix_dedup as s
from fleetlake.llm.common import table
from fleetlake.llm.queries import QUERIES

DOCS = "doc_id long, text string, removed string, cut_id long"


def brute(rows, n):
    """Removed and kept words of each (id, text)."""
    holders = {}
    for i, text, *_ in rows:
        words = (text or "").split()
        for a in range(len(words) - n + 1):
            if i is not None:
                holders.setdefault(tuple(words[a : a + n]), set()).add(i)
    out = {}
    for i, text, *_ in rows:
        words = (text or "").split()
        removed, kept = set(), set()
        for a in range(len(words) - n + 1):
            ids = holders.get(tuple(words[a : a + n]), ())
            if i is not None and len(ids) > 1:
                (kept if i == min(ids) else removed).update(range(a, a + n))
        if removed or kept:
            out[i, text] = (sorted(removed), sorted(kept - removed))
    return out


def words_in(spans):
    return [w for x in spans for w in range(x.start, x.end)]


def compare(spark, rows, n, partitions=3):
    docs = spark.createDataFrame(rows, DOCS).repartition(partitions)
    found = s.repeated_passages(docs, n)
    texts = docs.selectExpr("doc_id", "text", "xxhash64(text) AS mark").distinct()
    out = {(r.doc_id, r.text): (words_in(r.removed), words_in(r.kept)) for r in found.join(texts, ["doc_id", "mark"]).collect()}
    assert out == brute(rows, n) and found.count() == len(out)
    return docs


@settings(max_examples=200)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), st.integers(4, 20))
def test_every_passage_has_a_kept_suffix_in_its_first_words(words, n):
    kept, keys = s.suffixes(words, n)
    by_position = dict(zip(kept.tolist(), keys.tolist(), strict=True))
    window = n // 2
    for a in range(len(words) - n + 1):
        own, own_keys = s.suffixes(words[a : a + n], n)
        assert any(a + p in by_position and by_position[a + p] == k for p, k in zip(own.tolist(), own_keys.tolist(), strict=True) if p < window)
        assert any(a <= p < a + window for p in by_position)


def made(seed, n):
    rng = random.Random(seed)
    few = [f"w{i}" for i in range(rng.choice((3, 30, 2_000)))]
    passages = [rng.choices(few, k=rng.randint(n - 2, 3 * n)) for _ in range(6)]
    rows = []
    for i in range(50):
        words = rng.choices(few, k=rng.randint(0, 4 * n))
        for _ in range(rng.choice((0, 0, 1, 2))):
            at, p = rng.randint(0, len(words)), rng.choice(passages)
            a = rng.choice((0, 0, rng.randint(0, 5)))
            words[at:at] = p[a : len(p) - rng.choice((0, a))]
        rows.append((i, rng.choice((" ", "\n", " \t ")).join(words), "x", 7))
    rows += [(100 + i, rows[i][1], "x", 7) for i in range(0, 12, 2)]  # copies
    rows += [(3, rows[3][1], "x", 7), (3, rows[8][1], "x", 7), (None, rows[9][1], "x", 7), (201, None, "x", 7), (202, "", "x", 7), (203, "  ", "x", 7)]
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_against_brute_force(spark, seed):
    n = (12, 50)[seed % 2]
    rows = made(seed, n)
    docs = compare(spark, rows, n)
    cleaned = s.without_repeats(docs, n)
    assert cleaned.schema == docs.schema
    out = cleaned.collect()
    expected = brute(rows, n)

    def left(i, text):
        gone = set(expected.get((i, text), ((), ()))[0])
        return [w for a, w in enumerate(text.split()) if a not in gone]

    assert sorted(str((r.doc_id, (r.text or "").split())) for r in out) == sorted(str((r[0], left(r[0], r[1] or ""))) for r in rows)
    untouched = {(i, t) for i, t, *_ in rows if t and not expected.get((i, t), ((), ()))[0]}
    assert untouched <= {(r.doc_id, r.text) for r in out}


def test_one_passage_over_many_partitions(spark):
    """A run that fills several partitions of the sort is settled by their edges."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        passage = " ".join(f"p{i}" for i in range(14))
        rows = [(i, f"own{i} {passage} own{i}", "x", 7) for i in range(300)] + [(i, f"lone{i} " * 20, "x", 7) for i in range(300, 320)]
        compare(spark, rows, 12)
        compare(spark, rows[:1] * 50 + rows[300:], 12)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_joins_by_shuffle_and_very_long_texts(spark, monkeypatch):
    rng = random.Random(4)
    long = " ".join(str(rng.random()) for _ in range(60_000))
    rows = [(1, long, "x", 7), (2, "a " * 500 + " ".join(long.split()[20_000:50_000]), "x", 7), (3, "a " * 700, "x", 7), *made(8, 50)[4:]]
    monkeypatch.setattr(s, "SPAN_BYTES", 2**40)
    monkeypatch.setattr(s, "COPY_BYTES", 2**40)
    docs = compare(spark, rows, 50)
    assert s.without_repeats(docs, 50).count() == len(rows)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    expected = {i: (len(r), len(k)) for (i, _), (r, k) in brute(rows, s.MIN_WORDS).items()}
    out = QUERIES["op8_suffix_dedup"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_removed, r.n_kept) for r in out} == expected and len(out) == len(expected) > 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert s.repeated_passages(docs).collect() == [] and s.without_repeats(docs).collect() == []


def test_files_fit_their_rows_not_the_splits(spark, monkeypatch):
    files, store, cores = {}, s.stored, spark.sparkContext.defaultParallelism

    def noted(df, label, *size):
        out = store(df, label, *size)
        files.setdefault(label, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(s, "stored", noted)
    rows = made(5, 50)
    compare(spark, rows, 50, 10 * cores)
    assert files.keys() == {"suffix-signatures", "suffix-copies", "suffix-runs", "suffix-hits", "suffix-passages"}
    assert max(max(x) for x in files.values()) <= cores, files
    files.clear()
    text = sum(len(r[1] or "") for r in rows)
    monkeypatch.setattr(s, "WORDS_FILE_BYTES", text // s.TEXT_BYTES // (2 * cores))
    compare(spark, rows, 50, 10 * cores)
    assert cores < files["suffix-signatures"][0] <= 2 * cores + 1, files


def test_windows_are_counted_once(spark):
    words = " ".join(f"w{i}" for i in range(200))
    for at, count in (([60], 6), ([60, 61, 63], 9), ([100, 60], 12), ([60, 66], 12), ([60, 65], 11)):
        hits = spark.createDataFrame([(1, 2, at, words)], "doc_id long, mark long, at array<int>, text string")
        assert hits.select(s._window_count("at", 12)).first()[0] == count == s._windows(hits, 12).count(), at
