"""Order-preserving packing of documents into training sequences.

The tokens of the documents of a stretch are one stream. Windows of at most ``length`` tokens are cut
from it at document ends, sentence ends, or, where a sentence is long, within it. Dynamic programming
over the allowed cuts minimises padding plus penalties for cuts within documents; a window's padding is
linear in its start, so the best start among those in reach is kept by a monotone queue, and windows
of a power of two, which are not padded, are looked up beside it. Documents keep their order, nothing is
shuffled, and a stretch is bounded, as one task packs what it reads: a document of more tokens than a stretch may
have goes through several, one after the other.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tiktoken.load import load_tiktoken_bpe
from tokenizers import Tokenizer

from fleetlake.llm.common import prepared

LENGTH = 1024
#: Id behind every document. Fixed value.
END_ID = 0
#: Costs in tokens of padding: of every window, and of cuts at a sentence end and within a sentence.
WINDOW_COST, SENTENCE_COST, INNER_COST = 16, 2, 8
#: Within a sentence, cuts are allowed at every so manieth token.
INNER_STEP = 64
#: Text bytes of the documents that are packed together, one document at least.
STRETCH_BYTES = 2 * 2**20
#: Tokens that are packed together at most.
STRETCH_TOKENS = 2**20
#: Characters of a text that are encoded at once, if it has a word that ends before a blank there.
SEGMENT = 2**20
_LONG_SPACE = re.compile(r"\s{1000}")
#: No token reaches over the end of a word into the blank behind it.
_WORD_END = re.compile(r"[^\W_](?= )")

PIECES = (
    "doc_id {doc_id}, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long"
)


class Vocabulary:
    """A byte-level BPE vocabulary: the file ``vocabulary`` for ``tokenizers`` and again as ``ranks``.

    Both libraries give the same ids. The one that reads ranks is several times as fast, and gets
    every text but those with a special token's string or a very long run of white space.
    """

    def __init__(self, vocabulary: str, ranks: str):
        self.whole = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.blanks = any(" " in s for s in self.special)
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(ranks), special_tokens={}
        )

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self._encode, self._segments(text)))

    def _segments(self, text: str) -> Iterator[str]:
        """The text in parts of about SEGMENT characters that have the same ids as the whole."""
        at = 0
        while len(text) - at > SEGMENT and not self.blanks and (end := _WORD_END.search(text, at + SEGMENT)):
            yield text[at : end.end()]
            at = end.end()
        yield text[at:] if at else text

    def _encode(self, text: str) -> bytes:
        if any(s in text for s in self.special) or _LONG_SPACE.search(text):
            ids = np.array(self.whole.encode(text, add_special_tokens=False).ids)
        else:
            ids = self.fast.encode_to_numpy(text, disallowed_special=())
        return ids.astype("<u4").tobytes()

    def sentence_ends(self) -> np.ndarray:
        """By id: whether a sentence may end behind the token."""
        size = self.whole.get_vocab_size()
        tokens = (self.whole.id_to_token(i) or "" for i in range(size))
        return np.fromiter((t.endswith((".", "!", "?")) or "Ċ" in t for t in tokens), bool, size)


@cache
def _loaded(vocabulary: str, ranks: str) -> tuple[Vocabulary, np.ndarray]:
    tokenizer = Vocabulary(vocabulary, ranks)
    return tokenizer, tokenizer.sentence_ends()


def allowed_cuts(ids: np.ndarray, document_ends: np.ndarray, ends_sentence: np.ndarray, length: int):
    """Positions behind which the stream may be cut, in order, and the cost of each."""
    size = len(ids)
    costs = np.full(size + 1, -1, np.int64)
    costs[1:][ends_sentence[ids]] = SENTENCE_COST
    costs[document_ends] = 0
    places = np.flatnonzero(costs >= 0)
    gaps = np.diff(places, prepend=0)
    wide = gaps > INNER_STEP
    steps = (gaps[wide] - 1) // INNER_STEP
    starts = np.repeat(places[wide] - gaps[wide], steps)
    inner = starts + INNER_STEP * (np.arange(len(starts)) - np.repeat(np.cumsum(steps) - steps, steps) + 1)
    costs[inner] = INNER_COST
    # the last window is seldom full: it may be cut anywhere, so that powers of two can make it up
    last = np.arange(max(size - length, 0) + 1, size + 1)
    costs[last[costs[last] < 0]] = INNER_COST
    costs[0] = 0
    places = np.flatnonzero(costs >= 0)
    return places, costs[places]


def best_cuts(places: np.ndarray, costs: np.ndarray, length: int) -> list[int]:
    """The chosen places, from 0 to the end."""
    links: list[list[int]] = [[] for _ in places]
    for e in range(length.bit_length()):
        if 2**e <= length:
            at = np.searchsorted(places, places - 2**e)
            for j in np.flatnonzero(places[at] == places - 2**e).tolist():
                links[j].append(int(at[j]))
    where, penalty = places.tolist(), costs.tolist()
    total, origin = [0] * len(where), [0] * len(where)
    value = [0] * len(where)  # a start's total and place: what a window adds to it depends on its end only
    queue = deque([0])
    for j in range(1, len(where)):
        end = where[j]
        while where[queue[0]] < end - length:
            queue.popleft()
        start = queue[0]
        best = value[start] + length - end
        for i in links[j]:
            if total[i] < best:
                best, start = total[i], i
        best += penalty[j] + WINDOW_COST
        total[j], origin[j], value[j] = best, start, best + end
        while queue and value[queue[-1]] >= best + end:
            queue.pop()
        queue.append(j)
    chosen, j = [], len(where) - 1
    while j:
        chosen.append(where[j])
        j = origin[j]
    return [0, *reversed(chosen)]


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    ranks: str | None = None,
    length: int = LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece of a document in a sequence: ``doc_id, start, length, ids, doc_tokens, sequence_id,
    offset, sequence_length``.

    A document's tokens are those of its text, then ``end_id``; ``start`` counts those before the piece,
    ``offset`` those before it in its sequence, ``ids`` has its ids as little-endian unsigned 32-bit integers,
    and ``doc_tokens`` counts the document's. A sequence is padded to ``length`` unless ``sequence_length``, the
    tokens in it, is a power of two. Documents are packed in the order in which a task reads them.

    A null text is empty, and an empty text is its end id alone. Repeated rows are packed each, null ids
    kept. Other columns are ignored. An empty table has no pieces. ``length`` is a power of two.
    ``vocabulary`` and ``ranks`` are files of one byte-level BPE vocabulary.
    """
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, ends_sentence = _loaded(vocabulary, ranks)
        end = np.array([end_id], "<u4").tobytes()
        made = 0
        for ids, part, documents in _stretches(batches):
            tokens = [tokenizer.encode(t or "") + end for t in documents]
            sizes = np.array([len(t) // 4 for t in tokens])
            for document, before, some in _portions(tokens):
                pieces = pack_stretch(some, ends_sentence, length)
                made, first = made + pieces["sequences"], (part << 33) + made
                portion = pieces["document"]
                document = document[portion]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(document)),
                        pa.array(pieces["start"] + before[portion]),
                        pa.array(pieces["length"]),
                        pa.array(pieces["ids"], pa.binary()),
                        pa.array(sizes[document]),
                        pa.array(pieces["sequence"] + first),
                        pa.array(pieces["offset"]),
                        pa.array(pieces["sequence_length"]),
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_length"],
                )

    prepared(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.spark_partition_id().alias("part"))
    return rows.mapInArrow(packed, PIECES.format(doc_id=docs.schema["doc_id"].dataType.simpleString()))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, int, list[str | None]]]:
    """Ids, the task's partition and texts of documents with about STRETCH_BYTES of text together."""
    ids, texts, size, part = [], [], 0, 0
    for batch in batches:
        part = batch["part"][0].as_py() if batch.num_rows else part
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch["text"]), 0).to_pylist()
        from_row = 0
        for row, length in enumerate(lengths):
            size += length
            if size >= STRETCH_BYTES:
                ids.append(batch["doc_id"].slice(from_row, row + 1 - from_row))
                texts += batch["text"].slice(from_row, row + 1 - from_row).to_pylist()
                yield pa.concat_arrays(ids), part, texts
                ids, texts, size, from_row = [], [], 0, row + 1
        ids.append(batch["doc_id"].slice(from_row))
        texts += batch["text"].slice(from_row).to_pylist()
    if texts:
        yield pa.concat_arrays(ids), part, texts


def _portions(tokens: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Consecutive tokens of documents, at most STRETCH_TOKENS at once: their documents, the tokens before them there, they."""
    held, room = [], STRETCH_TOKENS
    for document, ids in enumerate(tokens):
        at = 0
        while at < len(ids) // 4:
            part = ids[4 * at : 4 * (at + room)]
            held.append((document, at, part))
            at, room = at + len(part) // 4, room - len(part) // 4
            if not room:
                yield _columns(held)
                held, room = [], STRETCH_TOKENS
    if held:
        yield _columns(held)


def _columns(held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    documents, before, parts = zip(*held, strict=True)
    return np.array(documents), np.array(before), list(parts)


def pack_stretch(tokens: list[bytes], ends_sentence: np.ndarray, length: int) -> dict:
    """The pieces of some documents' tokens, in order."""
    stream = b"".join(tokens)
    ids = np.frombuffer(stream, "<u4")
    document_ends = np.cumsum([len(t) // 4 for t in tokens])
    cuts = np.array(best_cuts(*allowed_cuts(ids, document_ends, ends_sentence, length), length))
    bounds = np.union1d(cuts, document_ends)
    starts, ends = bounds[:-1], bounds[1:]
    document = np.searchsorted(document_ends, starts, "right")
    sequence = np.searchsorted(cuts, starts, "right") - 1
    return {
        "document": document,
        "start": starts - (document_ends - np.diff(document_ends, prepend=0))[document],
        "length": ends - starts,
        "ids": [stream[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)],
        "sequence": sequence,
        "offset": starts - cuts[sequence],
        "sequence_length": np.diff(cuts)[sequence],
        "sequences": len(cuts) - 1,
    }
