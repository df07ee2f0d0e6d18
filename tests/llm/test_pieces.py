from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

from fleetlake.llm import pieces
from fleetlake.llm.queries import op13_pieces
from conftest import SF_DIR

SCHEMA = "doc_id {}, text string, ids string, word int, stretch string"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "abcd  ▁é\n\t1<>s/ ́　漢😀\x00\xa0"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def run(spark, rows, type="long"):
    docs = spark.createDataFrame([(*r, "x", 0, "y") for r in rows], SCHEMA.format(type)).repartition(3)
    found = pieces.decode(pieces.encode(docs))
    assert found.columns == ["doc_id", "ids", "text"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def check(spark, library, rows, type="long"):
    whole = [(i, library.encode(t or "")) for i, t in rows]
    assert run(spark, rows, type) == sorted(((i, ids, library.decode(ids)) for i, ids in whole), key=str)


@pytest.mark.parametrize("stretch, chunk", [(48 * 2**20, 4 * 2**20), (2000, 50), (50, 4 * 2**20)])
def test_like_the_library(spark, library, monkeypatch, stretch, chunk):
    monkeypatch.setattr(pieces, "STRETCH_CHARS", stretch)
    monkeypatch.setattr(pieces, "CHUNK_CHARS", chunk)
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(30)))) for i in range(300)]
    rows += [(1000 + i, "the same words again and again ") for i in range(50)]
    check(spark, library, rows)


def test_odd_rows(spark, library):
    rows = [(1, None), (2, ""), (3, " "), (4, "   "), (5, "a "), (6, " a"), (7, "▁"), (8, "a▁b"), (None, "x y"), (None, None)]
    check(spark, library, rows + [rows[4], rows[4], (9, "</s> <s> <unk> <0x0A>")])
    check(spark, library, [("a", "b c"), (None, "c")], "string")
    check(spark, library, [])


def test_very_long_texts(spark, library):
    check(spark, library, [(1, "word after word, é " * 60_000), (2, "x" * 300_000), (3, " " * 300_000), (4, "漢字" * 50_000)])


def test_words_of_the_given_model_are_separable():
    assert pieces.separable(MODEL)


def test_whole_texts_where_words_are_not_separable(spark, library, monkeypatch):
    monkeypatch.setattr(pieces, "separable", lambda model: False)
    check(spark, library, [(i, t) for i, t in enumerate(["a b  c", "", None, " x ", "a b  c", " "])])


def test_query(spark, library):
    import hashlib

    import pyarrow.parquet as pq

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = []
    for row in pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        ids = library.encode(row["text"] or "")
        expected.append((row["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(tuple(r) for r in op13_pieces(spark, SF_DIR).collect()) == sorted(expected)
