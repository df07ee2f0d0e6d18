from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetlake.llm import packing
from fleetlake.llm.common import table
from fleetlake.llm.queries import QUERIES

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
WHOLE = Tokenizer.from_file(PATHS[0])
FAST = packing.Vocabulary(*PATHS)
PIECES = st.sampled_from(["a", "Word", " ", "  ", "\n", "\t", ".", "'s", "'", "é", "12", " ", "　", "漢", "<|endoftext|>", "😀", "!?", "\x1c"])


def ids_of(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=400)
@given(st.lists(PIECES, max_size=12).map("".join))
def test_ids_are_those_of_the_whole_text(text):
    assert np.frombuffer(FAST.encode(text), "<u4").tolist() == ids_of(text)


@pytest.mark.parametrize("segment", [1, 3, 10])
def test_ids_of_segments_are_those_of_the_whole_text(monkeypatch, segment):
    monkeypatch.setattr(packing, "SEGMENT", segment)

    @settings(max_examples=200, deadline=None)
    @given(st.lists(PIECES, max_size=20).map("".join))
    def same(text):
        assert np.frombuffer(FAST.encode(text), "<u4").tolist() == ids_of(text)
        assert "".join(FAST._segments(text)) == text

    same()
    assert len(list(FAST._segments("one two three four five six"))) > 1


def test_long_runs_of_white_space():
    for text in (" " * 1_000_000 + "a", "a" + "\n" * 5_000 + "b", "x" * 100_000):
        assert np.frombuffer(FAST.encode(text), "<u4").tolist() == ids_of(text)


def padding(lengths, length):
    return sum(0 if n & (n - 1) == 0 else length - n for n in lengths)


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_the_cheapest(seed):
    rng = random.Random(seed)
    places = np.array([0] + sorted(rng.sample(range(1, 200), rng.randint(3, 60))) + [200])
    places = np.unique(np.concatenate([places, np.arange(0, 200, 13)]))
    costs = np.array([rng.choice((0, 2, 8)) for _ in places])
    chosen = packing.best_cuts(places, costs, 32)
    cost = dict(zip(places.tolist(), costs.tolist(), strict=True))
    total = lambda cuts: padding(np.diff(cuts).tolist(), 32) + sum(cost[c] + packing.WINDOW_COST for c in cuts[1:])
    best = {0: 0}
    for j in places[1:].tolist():
        best[j] = min(best[i] + padding([j - i], 32) + cost[j] + packing.WINDOW_COST for i in best if j - i <= 32)
    assert total(chosen) == best[200] and chosen[0] == 0 and chosen[-1] == 200


def check(rows, pieces, length=1024):
    """Every id of every document in exactly one piece, sequences gapless and short enough."""
    tokens = [[*ids_of(t or ""), 0] for _, t in rows]
    by_doc = {}
    for p in pieces:
        assert 0 < p.sequence_length <= length and len(p.ids) == 4 * p.length
        by_doc.setdefault(p.doc_id, []).append(p)
    expected = {}
    for (i, _), t in zip(rows, tokens, strict=True):
        expected.setdefault(i, []).append(t)
    assert {i: sum(p.length for p in x) for i, x in by_doc.items()} == {i: sum(map(len, x)) for i, x in expected.items()}
    for i, texts in expected.items():
        if len(texts) == 1:
            parts = sorted(by_doc[i], key=lambda p: p.start)
            assert [p.start for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
            assert np.frombuffer(b"".join(p.ids for p in parts), "<u4").tolist() == texts[0]
            assert {p.doc_tokens for p in parts} == {len(texts[0])}
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
        assert {p.sequence_length for p in parts} == {sum(p.length for p in parts)}
    lengths = [x[0].sequence_length for x in by_sequence.values()]
    return padding(lengths, length) / max(sum(lengths), 1), len(lengths)


def test_pieces_of_odd_documents(spark):
    rows = [(1, None), (2, ""), (3, "one. two."), (4, "no end " * 3_000), (5, "x" * 20_000), (6, "same"), (6, "same"), (None, "id"), (7, "a <|endoftext|> b")]
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, start long, ids string")
    share, _ = check(rows, packing.pack(docs.repartition(2)).collect())
    assert share < 0.01


def test_whole_table_has_little_padding(spark):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    share, sequences = check(rows, packing.pack(docs).collect())
    assert share < 0.015
    assert sequences < 1.25 * sum(len(ids_of(text)) + 1 for _, text in rows) / 1024


def test_stretches_keep_all_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "STRETCH_BYTES", 3_000)
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text")
    check([tuple(r) for r in docs.collect()], packing.pack(docs).collect())


@pytest.mark.parametrize("most", [1, 700, 5_000])
def test_long_documents_go_through_several_stretches(spark, monkeypatch, most):
    monkeypatch.setattr(packing, "STRETCH_TOKENS", most)
    size = 40 if most == 1 else 4_000
    rows = [(1, "a few words. " * size), (2, ""), (3, "x " * size), (4, None), (5, "Another one.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    check(rows, packing.pack(docs).collect())


def test_query_digests(spark):
    docs = {r.doc_id: [*ids_of(r.text), 0] for r in table(spark, SF_DIR, "documents").collect()}
    for r in QUERIES["op2_packing"](spark, SF_DIR).collect():
        part = np.array(docs[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(docs[r.doc_id])


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
