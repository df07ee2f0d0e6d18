"""Benchmark decontamination: a broadcast set of hashed test n-grams against training token windows.

Words are runs of digits, letters a-z (A-Z is lower-cased) and characters beyond ASCII. A benchmark
item's windows are its runs of ``WINDOW`` words, or the whole item where it has fewer. Documents are
scanned in one narrow pass: words become numbers of the benchmark's vocabulary, rolling hashes of
the runs of known words are looked up, and every hit is verified word by word.

What is broadcast is bounded: a benchmark with more text than ``BLOCK_BYTES`` is taken in blocks,
each with a pass of its own over the documents; a stage makes ``BLOCKS_A_STAGE`` passes and stores what it found,
so that no executor holds more window sets than that for a core.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import prepared, stored

WINDOW = 10
#: Most benchmark text that one broadcast window set is made from.
BLOCK_BYTES = 4 * 2**20
#: Passes of one stage, each of which has a worker and a window set of its own.
BLOCKS_A_STAGE = 4
#: Documents are scanned together up to this much text, to bound what one task holds.
SCAN_BYTES = 4 * 2**20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_FACTOR = 0x9E3779B97F4A7C15

SPANS = "array<struct<start:int,end:int>>"


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


@dataclass
class _Grams:
    """The windows of one length: hashes in order, word numbers, and the items that hold each."""

    hashes: np.ndarray
    words: np.ndarray
    items: list[list[str]]


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_PLAIN).split()


def _hashes(numbers: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    for j in range(length):
        out *= np.uint64(_FACTOR)
        out += numbers[starts + j].astype(np.uint64) + np.uint64(1)
    return out


class WindowSet:
    """The windows of some benchmark items, ready to scan documents."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.vocabulary = _Vocabulary()
        holders: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            numbers = [
                self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of((text or "").encode())
            ]
            length = min(window, len(numbers))
            for i in range(len(numbers) - length + 1 if numbers else 0):
                key = tuple(numbers[i : i + length])
                holders.setdefault(length, {}).setdefault(key, set()).add("" if item is None else str(item))
        self.grams = {}
        for length, found in holders.items():
            words = np.array(list(found), np.int64)
            hashes = _hashes(words.ravel(), np.arange(len(words)) * length, length)
            order = np.argsort(hashes, kind="stable")
            names = [sorted(x) for x in found.values()]
            self.grams[length] = _Grams(hashes[order], words[order], [names[i] for i in order])

    def scan(self, documents: list[list[bytes]]) -> list[list[tuple[int, int, list[str]]]]:
        """For each document its hits: first word, number of words, items."""
        bounds = np.cumsum([0] + [len(d) + 1 for d in documents])
        numbers = np.full(bounds[-1], -1, np.int64)
        for start, words in zip(bounds, documents, strict=False):
            numbers[start : start + len(words)] = np.fromiter(
                map(self.vocabulary.__getitem__, words), np.int64, len(words)
            )
        unknown = np.concatenate([[0], np.cumsum(numbers < 0)])
        out: list[list[tuple[int, int, list[str]]]] = [[] for _ in documents]
        for length, grams in self.grams.items():
            if len(numbers) < length:
                continue
            starts = np.flatnonzero(unknown[length:] == unknown[:-length])
            hashes = _hashes(numbers, starts, length)
            places = np.searchsorted(grams.hashes, hashes)
            near = np.flatnonzero(grams.hashes[np.minimum(places, len(grams.hashes) - 1)] == hashes)
            for k in near:
                start, at = starts[k], places[k]
                while at < len(grams.hashes) and grams.hashes[at] == hashes[k]:
                    if np.array_equal(grams.words[at], numbers[start : start + length]):
                        doc = int(np.searchsorted(bounds, start, "right")) - 1
                        out[doc].append((int(start - bounds[doc]), length, grams.items[at]))
                    at += 1
        return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, with touching ones made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _slices(texts: list[bytes | None]) -> Iterator[slice]:
    """Stretches of documents with about SCAN_BYTES of text, one document at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= SCAN_BYTES:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def window_sets(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator[WindowSet]:
    """The benchmark's windows in as many blocks as its counted size asks for; one at a time on the driver."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield WindowSet([(r.item_id, r.text) for r in rows], window)


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, n_words, spans, items``, one row for every row of ``docs``.

    ``spans`` are the stretches of words (first, behind the last) inside some occurrence of a
    window, in order and apart; ``items`` the ids, as sorted strings, of the items that have an
    occurring window. A null text, and one without words, has none. Repeated rows and ids are
    reported each. An item with a null text or without words has no windows; one with a null id is
    named by the empty string; equal items count once. Other columns are ignored.
    """
    prepared(docs.sparkSession)
    rows = docs.select(
        "doc_id",
        "text",
        F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast(SPANS).alias("spans"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}, text string, n_words long, spans {SPANS}, items array<string>"
    for b, windows in enumerate(window_sets(benchmark, window, block_bytes)):
        rows = _between(rows, b).mapInArrow(_reporter(docs.sparkSession.sparkContext.broadcast(windows)), schema)
    return rows.drop("text")


def _between(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` as they are, or stored if the block's pass begins a stage."""
    return stored(rows, "decontamination-blocks") if block and block % BLOCKS_A_STAGE == 0 else rows


def _reporter(windows):
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _bytes(batch["text"])
            for part in _slices(texts):
                rows = batch.slice(part.start, part.stop - part.start)
                documents = [words_of(t) for t in texts[part]]
                spans, items = [], []
                for hits, had, named in zip(
                    windows.value.scan(documents), rows["spans"].to_pylist(), rows["items"].to_pylist(), strict=True
                ):
                    before = [(s["start"], s["end"]) for s in had or ()]
                    spans.append(
                        [{"start": a, "end": b} for a, b in merged(before + [(a, a + n) for a, n, _ in hits])]
                    )
                    items.append(sorted(set(named or ()).union(*(x for _, _, x in hits))))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows["doc_id"],
                        rows["text"],
                        pa.array([len(d) for d in documents], pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    ["doc_id", "text", "n_words", "spans", "items"],
                )

    return report


def _cut(text: bytes, windows: WindowSet) -> bytes:
    """``text`` without hit words and what stands between them, until nothing is hit."""
    while hits := windows.scan([words_of(text)])[0]:
        places = [m.span() for m in _WORD.finditer(text.translate(_PLAIN))]
        kept, at = [], 0
        for start, end in merged([(a, a + n) for a, n, _ in hits]):
            kept.append(text[at : places[start][0]])
            at = places[end - 1][1]
        text = b"".join([*kept, text[at:]])
    return text


def remove_spans(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with every occurrence of a window cut out of ``text``; all rows and columns stay.

    The words on both sides of a cut may make a new occurrence; cuts go on until there is none. A
    text that is benchmark as a whole becomes what is left, possibly the empty text. Null texts stay
    null. A document without hits keeps its text as it is.
    """
    prepared(docs.sparkSession)
    sets = [docs.sparkSession.sparkContext.broadcast(w) for w in window_sets(benchmark, window, block_bytes)]
    while True:
        out = docs
        for b, windows in enumerate(sets):
            out = _between(out, b).mapInArrow(_cutter(windows), docs.schema)
        if len(sets) == 1:
            return out
        docs = stored(out, "decontaminated")  # a cut for a later block may bring one for an earlier block
        if benchmark_hits(docs, benchmark, window, block_bytes).where(F.size("spans") > 0).isEmpty():
            return docs


def _cutter(windows):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _bytes(batch["text"])
            for part in _slices(texts):
                found = windows.value.scan([words_of(t) for t in texts[part]])
                for i, hits in enumerate(found, part.start):
                    if hits:
                        texts[i] = _cut(texts[i], windows.value)
            cleaned = pa.array(texts, pa.binary()).cast(batch["text"].type)
            yield batch.set_column(batch.schema.get_field_index("text"), batch.schema.field("text"), cleaned)

    return cut


def drop_documents(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` without the documents that hold some window; rows with a null text stay."""
    out = docs
    prepared(docs.sparkSession)
    for b, windows in enumerate(window_sets(benchmark, window, block_bytes)):
        out = _between(out, b).mapInArrow(_dropper(docs.sparkSession.sparkContext.broadcast(windows)), docs.schema)
    return out


def _dropper(windows):
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _bytes(batch["text"])
            clean = []
            for part in _slices(texts):
                clean += [not hits for hits in windows.value.scan([words_of(t) for t in texts[part]])]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return drop
