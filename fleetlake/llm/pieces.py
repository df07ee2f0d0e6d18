"""SentencePiece encoding by a table of distinct chunks, and decoding.

The library turns every space into a marker and sets one before the text. Where no piece of the model holds a
marker behind another character, no piece crosses the start of a marked word: a run of markers and what
follows up to the next one. Each marked word can then be segmented by itself.

1. Stretches of documents become numbers into the stretch's own list of distinct words. The numbers go to a file
   in the shared folder under a name that no other attempt uses; only files that a row names count. The
   list is divided into parts by a hash of the words;
2. parts are shuffled to the task of their hash, which so meets every occurrence of a word in any list and segments
   each distinct word once;
3. the ids go back to the stretches by another shuffle, where each number takes the ids of its word, by position.

Only distinct words of stretches are shuffled, so a word has one row for each stretch at most, however
frequent it is, and numbers and texts are not shuffled at all.
"""

from __future__ import annotations

import base64
import re
import uuid
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
import sentencepiece
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import prepared, scratch_dir

#: What the library writes for a space. Fixed value.
MARKER = "▁"
#: Characters of the documents that share a list of words, one document at least.
STRETCH_CHARS = 48 * 2**20
#: Characters of the documents whose numbers are in one row.
CHUNK_CHARS = 4 * 2**20
#: Parts of a list for each shuffle partition, so that partitions get about equal shares.
PARTS = 4

_WORD = re.compile(" *[^ ]+| +")

#: Rows of two kinds: a stretch, with the file of its numbers, and a part of its list of words.
SENT = "key long, stretch long, path string, part int, word_bytes binary, words binary"
#: The same with ids in place of words.
FOUND = "stretch long, path string, part int, spans binary, ids binary"


def _open(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder if ":/" not in folder or "://" in folder else folder.replace(":/", ":///", 1))


def _packed(values: np.ndarray | list[int]) -> bytes:
    """Whole numbers below 2^32, byte by byte of all of them, compressed."""
    planes = np.ascontiguousarray(np.asarray(values, "<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


@cache
def _loaded(model: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model)


@cache
def separable(model: str) -> bool:
    """Whether texts may be cut before markers: no piece holds one behind another character, and the library changes
    nothing but spaces."""
    library = _loaded(model)
    pieces = (library.id_to_piece(i) for i in range(library.get_piece_size()))
    same = "Ａ ́ \t x  "  # changed by the usual normalisers
    kept = library.normalize(same) == MARKER + same.replace(" ", MARKER)
    return kept and not any(re.search(f"[^{MARKER}]{MARKER}", p) for p in pieces)


def words_of(text: str, cut: bool = True) -> list[str]:
    """The marked words without their first marker, with spaces for the others; the whole text if it may not be cut."""
    if not text:
        return []
    if not cut:
        return [text]
    if MARKER in text:
        text = text.replace(MARKER, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [w[1:] for w in _WORD.findall(" " + text)]
    return text.split(" ")


def segmented(words: list[str], model: str) -> list[list[int]]:
    """The ids of marked words. The library adds a word's first marker itself, but not to nothing."""
    library = _loaded(model)
    lone = [library.piece_to_id(MARKER)]
    return [ids or lone for ids in library.encode(words, num_threads=1)]


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """Rows of one of the schemas above."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields]
    )


def _write(folder: str, chunks: list, known: list[str], parts: int) -> tuple[str, list[str], np.ndarray]:
    """Write the numbers of a stretch; returns the file's path, the words by number and the part of each.

    Words are numbered anew, frequent ones first, so that their numbers compress well.
    """
    counts = sum(np.bincount(np.concatenate(numbers), minlength=len(known)) for _, numbers in chunks)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(known), np.uint32)
    rank[order] = np.arange(len(known))
    words = [known[i].encode() for i in order.tolist()]
    part_of = np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))
    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)
    name = f"{uuid.uuid4().hex}.numbers"
    schema = pa.schema(
        [("doc_id", chunks[0][0][0].type), ("length", pa.int64())], {"parts": base64.b64encode(_packed(part_of))}
    )
    schema = schema.append(pa.field("numbers", pa.binary()))
    with fs.open_output_stream(f"{base}/{name}") as out, pa.ipc.new_stream(out, schema) as stream:
        for ids, numbers in chunks:
            packed = [_packed(rank[np.concatenate(numbers)]), *[None] * (len(ids) - 1)]
            columns = [pa.concat_arrays(ids), pa.array([len(n) for n in numbers]), pa.array(packed, pa.binary())]
            stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))
    return f"{folder}/{name}", words, part_of


def _sent(docs: DataFrame, cut: bool, parts: int) -> DataFrame:
    """The rows of all stretches and of the parts of their lists."""
    folder = scratch_dir(docs.sparkSession, "pieces-numbers")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, chunks, size, whole, task = 0, [], 0, 0, 0
        known: defaultdict[str, int] = defaultdict()
        known.default_factory = known.__len__

        def rows() -> Iterator[pa.RecordBatch]:
            path, words, part_of = _write(folder, chunks, list(known), parts)
            stretch = (task << 33) + made
            yield _batch(SENT, [(stretch, stretch, path, None, None, None)])
            grouped = np.argsort(part_of, kind="stable")
            bounds = np.searchsorted(part_of[grouped], np.arange(parts + 1)).tolist()
            for part, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                if a < b:
                    few = [words[i] for i in grouped[a:b].tolist()]
                    sent = zstandard.compress(b"".join(few))
                    yield _batch(SENT, [(-1 - part, stretch, None, part, _packed(list(map(len, few))), sent)])

        for batch in batches:
            for i in range(batch.num_rows):
                text = batch["text"][i].as_py() or ""
                task = batch["task"][i].as_py()
                words = words_of(text, cut)
                if not chunks or size >= CHUNK_CHARS:
                    chunks.append(([], []))
                    size = 0
                ids, numbers = chunks[-1]
                ids.append(batch["doc_id"].slice(i, 1))
                numbers.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
                size, whole = size + len(text), whole + len(text)
                if whole >= STRETCH_CHARS:
                    yield from rows()
                    made, chunks, whole = made + 1, [], 0
                    known.clear()
        if chunks:
            yield from rows()

    return docs.select("doc_id", "text", F.spark_partition_id().alias("task")).mapInArrow(number, SENT)


class _Stretch:
    """The numbers of a stretch, and the ids of its words as far as they have come."""

    def __init__(self, path: str, parts: int):
        folder, _, name = path.rpartition("/")
        fs, base = _open(folder)
        self.reader = pa.ipc.open_stream(fs.open_input_stream(f"{base}/{name}"))
        part_of = _unpacked(base64.b64decode(self.reader.schema.metadata[b"parts"]))
        self.grouped = np.argsort(part_of, kind="stable")
        self.bounds = np.searchsorted(part_of[self.grouped], np.arange(parts + 1))
        self.start_of, self.span_of = np.zeros(len(part_of), np.int64), np.zeros(len(part_of), np.int64)
        self.flat, self.size = [np.zeros(0, np.int32)], 0

    def add(self, part: int, spans: bytes, ids: bytes) -> None:
        mine, counts = self.grouped[self.bounds[part] : self.bounds[part + 1]], _unpacked(spans)
        self.start_of[mine], self.span_of[mine] = self.size + np.cumsum(counts) - counts, counts
        self.flat.append(_unpacked(ids).astype(np.int32))
        self.size += len(self.flat[-1])

    def documents(self) -> Iterator[pa.RecordBatch]:
        flat = np.concatenate(self.flat)
        for chunk in self.reader:
            numbers = _unpacked(chunk["numbers"][0].as_py())
            ids, ends = [], np.cumsum(chunk["length"].to_numpy())
            for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                starts, counts = self.start_of[numbers[a:b]], self.span_of[numbers[a:b]]
                ids.append(flat[np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())])
            offsets = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
            listed = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids), pa.int32()))
            yield pa.RecordBatch.from_arrays([chunk["doc_id"], listed], ["doc_id", "ids"])


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, ids``: the ids that the library gives for every whole text, without begin and end.

    ``model`` is a SentencePiece model file on every machine. If its pieces may cross markers or it normalises
    texts, the distinct chunks are whole texts. A null or empty text has no ids. Repeated rows are encoded
    each, null ids kept, other columns ignored. An empty table has no rows. A text is handled in one piece, in
    memory of about ten times its bytes.
    """
    model = model or public_tokenizers.path("piece_bpe_32k.model")
    cut = separable(model)
    spark = prepared(docs.sparkSession)
    parts = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bytes] = {}  # the distinct words of the task's parts
        for row in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
            if row["part"] is None:
                yield _batch(FOUND, [(row["stretch"], row["path"], None, None, None)])
                continue
            text = zstandard.decompress(row["words"])
            ends = np.cumsum(_unpacked(row["word_bytes"])).tolist()
            words = [text[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)]
            new = [w for w in words if w not in known]
            known.update(zip(new, [array("i", ids).tobytes() for ids in segmented(new, model)], strict=True))
            found = list(map(known.__getitem__, words))
            spans = np.fromiter(map(len, found), np.uint32, len(found)) // 4
            ids = _packed(np.frombuffer(b"".join(found), np.int32))
            yield _batch(FOUND, [(row["stretch"], None, row["part"], _packed(spans), ids)])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch = None
        for row in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
            if row["part"] is not None:
                stretch.add(row["part"], row["spans"], row["ids"])
                continue
            if stretch:
                yield from stretch.documents()
            stretch = _Stretch(row["path"], parts)
        if stretch:
            yield from stretch.documents()

    found = _sent(docs, cut, parts).repartition("key").mapInArrow(segment, FOUND)
    found = found.repartition("stretch").sortWithinPartitions("stretch", F.asc_nulls_first("part"))
    return found.mapInArrow(join, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encoded`` with a column ``text`` that the library decodes from ``ids``; null ids are none."""
    model = model or public_tokenizers.path("piece_bpe_32k.model")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _loaded(model)
        for batch in batches:
            found = [library.decode(ids.as_py() or []) for ids in batch["ids"]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "text"])

    prepared(encoded.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(texts, f"{schema}, text string")
