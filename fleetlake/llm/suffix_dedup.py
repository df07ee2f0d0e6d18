"""Repeated passages by sparse suffix arrays.

A passage of ``MIN_WORDS`` words or more that two documents share holds, within its first words, a
minimiser: a position whose next few words hash lowest among its neighbours'. Minimisers depend on the
words only, so both documents have it. Only the suffixes there are kept, a few percent of all.
Sorted over all documents, suffixes with an equal beginning are neighbours, and comparing neighbours finds
those that repeat. These are then extended to the left and right: every run of ``MIN_WORDS``
words that holds such a beginning is sorted and compared with its neighbours in the same way, and the
repeated runs of a document, joined where they touch, are its repeated passages, exactly.

A sort splits a hot passage over as many partitions as it needs; what reaches over a
partition's edge is settled by one summary row for each end of each partition. Documents that are
equal as a whole are compared as one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import checked_broadcast, files_for, prepared, stored

#: Words of the shortest passage that counts.
MIN_WORDS = 50
#: Words that a minimiser's hash covers.
GRAM = 8
#: Bytes of a copied text's digest and ids, and of a document's id with one span, when they are broadcast.
COPY_BYTES, SPAN_BYTES, POSITION_BYTES = 96, 64, 8
#: Bytes by which stored files are sized: of a row for :func:`repeated`, of a document with its spans, and of a hit's position.
RUN_BYTES, DOCUMENT_BYTES, HIT_BYTES = 36, 96, 8
#: Bytes of text to a byte of signatures: 12 bytes are kept of every 13 words or so.
TEXT_BYTES = 5
#: Bytes in a stored file of what grows with the words, larger than other steps' files.
WORDS_FILE_BYTES = 32 * 2**20
#: Windows that a task hands on at once.
WINDOWS_AT_ONCE = 50_000

SPANS = "array<struct<start:int,end:int>>"
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 2**64)
_WORD = re.compile(rb"\S+")
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse, modulo 2^64."""
    if len(_powers[0]) < size:
        for i, base in enumerate((_FACTOR, _INVERSE)):
            full = np.full(2 * size, base, np.uint64)
            full[0] = 1
            _powers[i] = np.multiply.accumulate(full)
    return _powers[0][:size], _powers[1][:size]


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """The best of every ``width`` neighbouring values, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = best(values[:-step], values[step:])
        done += step
    return values


def suffixes(words: list[bytes], min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the kept suffixes, and a hash of the beginning that any shared passage has in common there."""
    if len(words) < min_words:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    window = min_words // 2
    beginning = min_words - window + 1
    gram = min(GRAM, beginning)
    powers, inverse = _powers_to(len(words) + 1)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[:-1])])
    grams = (sums[gram:] - sums[:-gram]) * inverse[: len(words) - gram + 1]
    grams ^= grams >> np.uint64(31)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(29)
    least = _sliding(grams, window, np.minimum)
    # a position is kept if it is the least of some window: the largest of its windows' minima is its own
    edge = np.zeros(window - 1, np.uint64)
    kept = np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), window, np.maximum) == grams)
    kept = kept[kept + beginning <= len(words)]
    keys = (sums[kept + beginning] - sums[kept]) * inverse[kept]
    return kept.astype(np.int32), keys.view(np.int64)


def signatures(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, mark, digest, n_words, positions, keys`` of the documents with enough words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, positions, keys = [], [], []
            for text in batch["text"].cast(pa.binary()).to_pylist():
                words = text.split()
                where, key = suffixes(words, min_words)
                counts.append(len(words))
                positions.append(where)
                keys.append(key)
            signed = pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["mark"],
                    batch["digest"],
                    pa.array(counts, pa.int32()),
                    pa.array(positions, pa.list_(pa.int32())),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "mark", "digest", "n_words", "positions", "keys"],
            )
            yield signed.filter(pa.array([n >= min_words for n in counts], pa.bool_()))

    return (
        docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("mark"), F.unhex(F.md5("text")).alias("digest"), "text")
        .mapInArrow(
            sign,
            "doc_id long, mark long, digest binary, n_words int, positions array<int>, keys array<long>",
        )
    )


RUN = "high long, low long, doc_id long, mark long, start int"
_FIELDS = ("high", "low", "doc_id", "mark", "start")
_SETTLED, _OPEN, _EDGE = 0, 1, 2


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted partition, the rows whose key rows of two documents have, with the first document.

    Rows of the first key, and of the last if one document alone has it so far, are open: other
    partitions may have the key. For both a summary with the first and last document follows.
    """
    run: tuple[int, int] | None = None
    first = last = 0
    at_start = True  # the run is the partition's first
    waiting: list[np.ndarray] = []  # the run's rows so far, as long as they are of one document

    def out(rows: np.ndarray, firsts: np.ndarray, kind: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[i].astype(np.int32) if f == "start" else rows[i]) for i, f in enumerate(_FIELDS)]
            + [pa.array(firsts), pa.array(np.full(len(firsts), kind, np.int32))],
            [*_FIELDS, "first", "kind"],
        )

    def edge() -> pa.RecordBatch:
        row = np.array([[run[0]], [run[1]], [last], [0], [0]], np.int64)
        return out(row, np.array([first], np.int64), _EDGE)

    def whole(rows: list[np.ndarray], kind: int) -> pa.RecordBatch:
        joined = np.concatenate(rows, axis=1)
        return out(joined, np.full(joined.shape[1], first, np.int64), kind)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch[f].to_numpy(zero_copy_only=False).astype(np.int64) for f in _FIELDS])
        changes = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
        bounds = np.concatenate([[0], np.flatnonzero(changes) + 1, [rows.shape[1]]])
        key = (int(rows[0, 0]), int(rows[1, 0]))
        begin = 0
        if run == key:  # the run goes on
            begin = 1
            part = rows[:, : bounds[1]]
            last = int(part[2, -1])
            waiting.append(part)
            if last != first or at_start:
                yield whole(waiting, _OPEN if at_start else _SETTLED)
                waiting = []
        if begin < len(bounds) - 1:  # other runs follow
            if run is not None and at_start:
                yield edge()
            if run is not None:
                at_start = False
            waiting = []
            starts, ends = bounds[begin:-1], bounds[begin + 1 :]
            inner = starts[:-1], ends[:-1]
            if at_start and len(inner[0]):  # the partition's first run ends here
                run = (int(rows[0, starts[0]]), int(rows[1, starts[0]]))
                first, last = int(rows[2, starts[0]]), int(rows[2, ends[0] - 1])
                yield whole([rows[:, starts[0] : ends[0]]], _OPEN)
                yield edge()
                at_start = False
                inner = starts[1:-1], ends[1:-1]
            two = rows[2, inner[0]] != rows[2, inner[1] - 1] if len(inner[0]) else np.empty(0, bool)
            if two.any():
                a, b = inner[0][two], inner[1][two]
                sizes = b - a
                places = np.repeat(a - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                yield out(rows[:, places], np.repeat(rows[2, a], sizes), _SETTLED)
            part = rows[:, starts[-1] :]
            run = (int(part[0, 0]), int(part[1, 0]))
            first, last = int(part[2, 0]), int(part[2, -1])
            if last != first or at_start:
                yield whole([part], _OPEN if at_start else _SETTLED)
            else:
                waiting = [part]
    if run is not None:
        if waiting:
            yield whole(waiting, _OPEN)
        yield edge()


def repeated(rows: DataFrame, count: int) -> DataFrame:
    """The rows of ``high, low, doc_id, mark, start`` whose key, high and low, two documents have; stored.

    ``first`` is the smallest document of the key. ``count`` is the most rows there can be; files are as many as they fill,
    if these are work for every core.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    order = ["high", "low", "doc_id", "mark", "start"]
    ordered = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    files = files_for(RUN_BYTES * count, cores, WORDS_FILE_BYTES)
    # a task takes several partitions, one after the other: each keeps its own edges
    found = stored(ordered.mapInArrow(_neighbours, f"{RUN}, first long, kind int").coalesce(files), "suffix-runs")
    edges = (
        found.where(F.col("kind") == _EDGE)
        .groupBy("high", "low")
        .agg(F.min("first").alias("least"), F.max("doc_id").alias("most"))
        .where("least <> most")
        .select("high", "low", "least")
    )
    # at most two edges for each partition of the sort; a settled key that goes on elsewhere has the same first document there
    known = found.where(F.col("kind") != _EDGE).join(F.broadcast(edges), ["high", "low"], "left")
    return known.where((F.col("kind") == _SETTLED) | F.col("least").isNotNull()).select(
        *order, F.coalesce("least", "first").alias("first")
    )


def _windows(docs: DataFrame, min_words: int) -> DataFrame:
    """Every run of ``min_words`` words that holds the beginning of a repeated suffix, as rows for :func:`repeated`."""
    reach = min_words // 2 - 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("doc_id", "mark", "at")]
            for doc, mark, at, text in zip(*columns, batch["text"].cast(pa.binary()).to_pylist(), strict=True):
                words = text.split()
                joined = b" ".join(words)
                ends = np.cumsum([len(w) + 1 for w in words]) - 1
                begins = np.concatenate([[0], ends[:-1] + 1])
                wanted = np.zeros(len(words) + 1, np.int64)
                at = np.unique(np.array(at, np.int64))
                np.add.at(wanted, np.maximum(at - reach, 0), 1)
                np.add.at(wanted, at + 1, -1)
                starts = np.flatnonzero(np.cumsum(wanted)[: len(words) - min_words + 1] > 0)
                for some in np.split(starts, range(WINDOWS_AT_ONCE, len(starts), WINDOWS_AT_ONCE)):
                    a, b = begins[some].tolist(), ends[some + min_words - 1].tolist()
                    digests = b"".join(xxhash.xxh3_128_digest(joined[x:y]) for x, y in zip(a, b, strict=True))
                    parts = np.frombuffer(digests, ">i8").astype(np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(parts[:, 0]),
                            pa.array(parts[:, 1]),
                            pa.array(np.full(len(some), doc, np.int64)),
                            pa.array(np.full(len(some), mark, np.int64)),
                            pa.array(some.astype(np.int32)),
                        ],
                        list(_FIELDS),
                    )

    return docs.mapInArrow(cut, RUN)


def _window_count(at: str, min_words: int) -> Column:
    """The most windows that :func:`_windows` cuts for the positions: those of near ones overlap."""
    each = min_words // 2
    return F.aggregate(
        F.array_sort(at),
        F.struct(F.lit(-each).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda sofar, x: F.struct(x.alias("last"), (sofar["n"] + F.least(x - sofar["last"], F.lit(each))).alias("n")),
        lambda sofar: sofar["n"],
    )


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, mark, removed, kept`` of the documents that share a passage of at least ``min_words`` words; stored.

    Words are what stands between white space. ``removed`` and ``kept`` are stretches of words (first, behind
    the last), in order: runs of words that a document with a smaller id has too, and those that only documents with
    larger ids have. ``mark`` is a hash of the text, to tell rows of one id apart.

    Ids are whole numbers. Rows with a null id are not compared. Null, empty and shorter texts share nothing. Repeated rows, and other
    texts under one id, are one document: what they share among themselves doesn't count, nor
    does what one text repeats within itself. Other columns are ignored.
    """
    prepared(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # read once more for their size: a file for each split of the input would be many small ones where splits are small
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = files_for(text_bytes // TEXT_BYTES, docs.sparkSession.sparkContext.defaultParallelism, WORDS_FILE_BYTES)
    signed = stored(signatures(docs, min_words).coalesce(files), "suffix-signatures")
    documents, kept = signed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("positions")), F.lit(0))).first()
    copies = stored(
        signed.groupBy("digest")
        .agg(F.min("doc_id").alias("original"), F.max("doc_id").alias("last"))
        .where("original <> last")
        .drop("last"),
        "suffix-copies",
        DOCUMENT_BYTES * documents,
    )
    known = signed.join(checked_broadcast(copies, COPY_BYTES), "digest", "left")
    firsts = known.where(F.col("original").isNull() | (F.col("original") == F.col("doc_id")))
    beginnings = firsts.select(
        "doc_id", "mark", F.explode(F.arrays_zip("positions", "keys")).alias("suffix")
    ).select(
        F.col("suffix.keys").alias("high"),
        F.lit(0).cast("long").alias("low"),
        "doc_id",
        "mark",
        F.col("suffix.positions").alias("start"),
    )
    hits = stored(
        repeated(beginnings, kept).groupBy("doc_id", "mark").agg(F.collect_set("start").alias("at")),
        "suffix-hits",
        HIT_BYTES * kept,
        WORDS_FILE_BYTES,
    )
    n_windows = hits.agg(F.sum(_window_count("at", min_words))).first()[0] or 0
    few = checked_broadcast(hits, SPAN_BYTES + POSITION_BYTES * F.size("at"))
    texts = docs.join(
        few.withColumnRenamed("doc_id", "hit_id"),
        (F.col("doc_id") == F.col("hit_id")) & (F.xxhash64("text") == F.col("mark")),
    )
    windows = _windows(texts.select("doc_id", "mark", "at", "text"), min_words)
    spans = repeated(windows, n_windows).select(
        "doc_id", "mark", "start", (F.col("start") + min_words).alias("end"), "first"
    )
    whole = known.where(F.col("original").isNotNull()).select(
        "doc_id", "mark", F.lit(0).alias("start"), F.col("n_words").alias("end"), F.col("original").alias("first")
    )
    by_document = (
        spans.union(whole)
        .groupBy("doc_id", "mark")
        .agg(F.collect_set(F.struct("start", "end", (F.col("first") == F.col("doc_id")).alias("own"))).alias("all"))
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            bounds = batch["all"].offsets.to_numpy()
            bounds = bounds - bounds[0]
            found = batch["all"].flatten()
            start, end = (found.field(c).to_numpy() for c in ("start", "end"))
            own = found.field("own").to_numpy(zero_copy_only=False)
            removed, kept = [], []
            for a, b in zip(bounds, bounds[1:], strict=False):
                cut, rest = (_joined(start[a:b][which], end[a:b][which]) for which in (~own[a:b], own[a:b]))
                removed.append([{"start": x, "end": y} for x, y in cut])
                kept.append([{"start": x, "end": y} for x, y in _without(rest, cut)])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["mark"], pa.array(removed, spans_type), pa.array(kept, spans_type)],
                ["doc_id", "mark", "removed", "kept"],
            )

    return stored(
        by_document.mapInArrow(join, f"doc_id long, mark long, removed {SPANS}, kept {SPANS}"),
        "suffix-passages",
        DOCUMENT_BYTES * documents,
    )


def _joined(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Spans in order, with touching ones made one."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[0], np.flatnonzero(starts[1:] > reach[:-1]) + 1])
    last = np.concatenate([first[1:] - 1, [len(starts) - 1]])
    return list(zip(starts[first].tolist(), reach[last].tolist(), strict=True))


def _without(spans: list[tuple[int, int]], cut: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What of the spans lies outside the cuts; both in order and apart."""
    out, i = [], 0
    for start, end in spans:
        while i < len(cut) and cut[i][1] <= start:
            i += 1
        j = i
        while j < len(cut) and cut[j][0] < end:
            if cut[j][0] > start:
                out.append((start, cut[j][0]))
            start = max(start, cut[j][1])
            j += 1
        if start < end:
            out.append((start, end))
    return out


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with each repeated passage left in the document of the smallest id only; all rows and columns stay.

    Words that :func:`repeated_passages` removes are cut from ``text`` with the white space between
    them. A text of which only white space is left becomes empty.
    """
    cuts = repeated_passages(docs, min_words).where(F.size("removed") > 0).drop("kept")
    cuts = checked_broadcast(cuts, SPAN_BYTES + POSITION_BYTES * F.size("removed"))
    names = docs.columns
    # the spans travel as a last column with a name of its own
    last = "_".join(["removed", *names])
    marked = docs.join(
        cuts, (docs["doc_id"] == cuts["doc_id"]) & (F.xxhash64(docs["text"]) == cuts["mark"]), "left"
    ).select(*[docs[c] for c in names], cuts["removed"].alias(last))
    place = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            for i, spans in enumerate(batch.column(len(names)).to_pylist()):
                if spans:
                    texts[i] = _cut(texts[i], [(s["start"], s["end"]) for s in spans])
            columns = batch.columns[: len(names)]
            columns[place] = pa.array(texts, pa.binary()).cast(columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return marked.mapInArrow(cut, docs.schema)


def _cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    words = [m.span() for m in _WORD.finditer(text)]
    parts, at = [], 0
    for start, end in spans:
        parts.append(text[at : words[start][0]])
        at = words[end - 1][1]
    parts.append(text[at:])
    out = b"".join(parts)
    return out if out.strip() else b""
