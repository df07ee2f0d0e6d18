from __future__ import annotations

import random
import re

import pytest

from fleetlake.llm import decontaminate as d
from fleetlake.llm.common import stored

DOCS = "doc_id long, text string, spans string, n_words long"
ITEMS = [(i, " ".join(random.Random(i).choices("alpha Beta gamma42 déjà omega the of".split(), k=14))) for i in range(6)]
ITEMS += [(6, "just three words"), (7, None), (8, " -- "), (9, "Solo!"), (None, "no id for this one"), (0, ITEMS[0][1])]


def documents():
    rng = random.Random(1)
    filler = "alpha beta gamma42 déjà omega the of x1 y2 z3".split()
    rows = []
    for i in range(60):
        words = rng.choices(filler, k=rng.randint(0, 60))
        if i % 2:
            text = rng.choice(ITEMS[:6])[1].split()
            a = rng.randint(0, 4)
            words[3:3] = [w.upper() if w.isascii() else w for w in text[a : a + rng.randint(9, 14)]]
        if i % 7 == 0:
            words[1:1] = "Just three WORDS".split()
        if i % 11 == 0:
            words[5:5] = ["solo"] + "no id for this one".split()
        rows.append((i, rng.choice((" ", ", ", "\n", "-"))[:2].join(words), "x", -1))
    return rows + [(100, None, "x", 0), (101, "", "x", 0), (None, ITEMS[2][1], "x", 0), (102, "w " * 50_000 + ITEMS[1][1], "x", 0), rows[1], rows[1]]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def windows(items):
    out = {}
    for i, text in items:
        w = words(text)
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if w else 0):
            out.setdefault(tuple(w[a : a + n]), set()).add("" if i is None else str(i))
    return out


def brute(text, found):
    w = words(text)
    hit, items = set(), set()
    for n in {len(k) for k in found}:
        for a in range(len(w) - n + 1):
            if (key := tuple(w[a : a + n])) in found:
                hit.update(range(a, a + n))
                items |= found[key]
    return len(w), sorted(hit), sorted(items)


@pytest.mark.parametrize("block", [d.BLOCK_BYTES, 100])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(d, "SCAN_BYTES", 500)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = d.benchmark_hits(spark.createDataFrame(documents(), DOCS).repartition(3), items, block_bytes=block).collect()
    found = windows(ITEMS)
    assert sorted(str((r.doc_id, r.n_words, [i for s in r.spans for i in range(s.start, s.end)], r.items)) for r in out) == sorted(
        str((i, *brute(text, found))) for i, text, *_ in documents()
    )


@pytest.mark.parametrize("block", [d.BLOCK_BYTES, 100])
def test_cuts_leave_nothing_and_clean_documents_alone(spark, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame(documents(), DOCS)
    found = windows(ITEMS)
    out = d.remove_spans(docs, items, block_bytes=block)
    assert out.schema == docs.schema
    rows = out.collect()
    assert len(rows) == len(documents())
    assert all(not brute(r.text, found)[1] for r in rows)
    clean = {r[:2] for r in documents() if not brute(r[1], found)[1]}
    assert clean <= {(r.doc_id, r.text) for r in rows}
    kept = {r.doc_id for r in d.drop_documents(docs, items, block_bytes=block).collect()}
    assert kept == {i for i, _ in clean}


def test_many_blocks_make_several_stages(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCKS_A_STAGE", 2)
    kept = []
    monkeypatch.setattr(d, "stored", lambda df, label: kept.append(label) or stored(df, label))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame(documents(), DOCS)
    size = sum(len((text or "").encode()) for _, text in ITEMS)
    blocks = -(-size // (size // 5))
    one, many = (
        sorted(map(str, d.benchmark_hits(docs, items, block_bytes=b).collect())) for b in (d.BLOCK_BYTES, size // 5)
    )
    assert one == many and len(kept) == (blocks - 1) // 2
    dropped = [sorted(map(str, d.drop_documents(docs, items, block_bytes=b).collect())) for b in (d.BLOCK_BYTES, size // 5)]
    assert dropped[0] == dropped[1]


def test_a_cut_that_joins_a_passage_is_cut_again(spark):
    item = "a b c d e f g h i j"
    docs = spark.createDataFrame([(1, f"x a b c d e {item} f g h i j y", "", 0)], DOCS)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [w for r in d.remove_spans(docs, items).collect() for w in r.text.split()] == ["x", "y"]


def test_empty_tables(spark):
    items, docs = spark.createDataFrame(ITEMS, "item_id long, text string"), spark.createDataFrame(documents(), DOCS)
    assert d.benchmark_hits(docs.limit(0), items).collect() == []
    assert all(r.spans == [] and r.items == [] for r in d.benchmark_hits(docs, items.limit(0)).collect())
    assert d.remove_spans(docs, items.limit(0)).count() == docs.count()
