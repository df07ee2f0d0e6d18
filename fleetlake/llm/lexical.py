"""Ranked lexical search of stated items over all documents, with a tree over each side.

A document's coordinate for a term is its tf part of the score, an item's is the term's weight, so a score is
an inner product. Both sides are trees whose nodes hold the maxima of their coordinates:

* documents are ordered by their strongest weighted coordinate and its size, so that neighbours are alike, and
  packed into stored leaves; a task puts nodes above the leaves that it reads;
* items are ordered by their heaviest term; nodes of eight, and of eight nodes, stand above them.

The product of two nodes' maxima bounds all scores between their documents and items. Every item first gets the
scores of the leaves of its highest bounds, which gives a k-th score that no answer falls below. Then tasks walk
both trees at once, from pairs of nodes to their children, and leave out every pair whose bound is below the
weakest of its items' k-th scores. What is left is scored in whole numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm.common import prepared, stored

#: Text bytes of the items that are searched for together, one item at least; further items take another pass.
BLOCK_BYTES = 4 * 2**20
#: Documents in a leaf, and coordinates from which on it is full; leaves below a node; items or nodes below a node.
LEAF_DOCUMENTS, LEAF_COORDINATES = 64, 32_768
LEAVES, ITEMS = 16, 8
#: Leaves that each item is scored on first.
FIRST_LEAVES = 4
#: Bytes of coordinates in a file of leaves, rows in a file of answers. A shuffle may have far more partitions than that
#: makes files, and a file for each costs more than what it holds: where Hadoop's native library is missing, an executor
#: even starts two processes a file to set permissions.
FILE_BYTES, FILE_ROWS = 8 * 2**20, 2**20

#: What terms are made of: 0-9, A-Z, a-z and every byte of a character beyond ASCII. Fixed values.
_LETTERS = b"0123456789abcdefghijklmnopqrstuvwxyz"
_PLAIN = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or c in _LETTERS else 0x20 for c in range(256))


def terms_of(data: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, only A-Z lower-cased."""
    return (data or b"").translate(_PLAIN).split()


@dataclass
class Level:
    """Nodes of the item tree with their coordinates by term: those of term t stand at ``at[t]`` to ``at[t + 1]``."""

    at: np.ndarray
    nodes: np.ndarray
    weights: np.ndarray
    size: int


class Items:
    """The tree over items, given each item's terms and every term's weight."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray):
        heavy = [t[weights[t] > 0] for t in terms]
        strongest = [(int(t[np.argmax(weights[t])]) if len(t) else -1) for t in heavy]
        # items without a weight have no answers
        order = sorted((i for i, t in enumerate(heavy) if len(t)), key=lambda i: (strongest[i], len(heavy[i])))
        self.order = np.array(order, np.int64)
        term = np.concatenate([heavy[i] for i in order]) if order else np.zeros(0, np.int64)
        node = np.repeat(np.arange(len(order)), [len(heavy[i]) for i in order])
        weight = weights[term]
        self.levels: list[Level] = []
        size = len(order)
        while True:
            self.levels.append(self._level(term, node, weight, size, len(weights)))
            if size <= 1:
                break
            node, size = node // ITEMS, -(-size // ITEMS)
        self.levels.reverse()

    @staticmethod
    def _level(term, node, weight, size: int, terms: int) -> Level:
        by = np.lexsort((node, term))
        term, node, weight = term[by], node[by], weight[by]
        first = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(node, prepend=-1))
        most = np.maximum.reduceat(weight, first) if len(first) else weight
        return Level(np.searchsorted(term[first], np.arange(terms + 1)), node[first], most, size)

    def least(self, kth: np.ndarray) -> list[np.ndarray]:
        """For every level the weakest of its nodes' k-th scores."""
        found = [kth]
        for level in self.levels[-2::-1]:
            found.append(np.minimum.reduceat(found[-1], np.arange(0, level.size * ITEMS, ITEMS)))
        return found[::-1]


def _products(level: Level, terms: np.ndarray, values: np.ndarray, rows: np.ndarray | None = None, size: int = 1):
    """The products of documents' coordinates with every node's, as whole numbers: a row for each of ``size`` documents."""
    counts = level.at[terms + 1] - level.at[terms]
    at = np.repeat(level.at[terms] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    place = level.nodes[at] if rows is None else np.repeat(rows, counts) * level.size + level.nodes[at]
    total = np.zeros(size * level.size, np.int64)
    np.add.at(total, place, np.repeat(values, counts) * level.weights[at])
    return total.reshape(size, level.size)


@dataclass
class Node:
    """A node of the document tree: its terms with their maxima, and its children or, in a leaf, its documents."""

    terms: np.ndarray
    most: np.ndarray
    children: list[Node]
    ids: pa.Array | None = None
    sizes: np.ndarray | None = None
    all_terms: np.ndarray | None = None
    values: np.ndarray | None = None

    def scores(self, level: Level) -> np.ndarray:
        rows = np.repeat(np.arange(len(self.sizes)), self.sizes)
        return _products(level, self.all_terms, self.values, rows, len(self.sizes))


def _maxima(terms: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    by = np.argsort(terms, kind="stable")
    terms, values = terms[by], values[by]
    first = np.flatnonzero(np.diff(terms, prepend=-1))
    return terms[first], np.maximum.reduceat(values, first)


def _leaf(ids: pa.Array, sizes: bytes, terms: bytes, values: bytes) -> Node:
    all_terms, amounts = np.frombuffer(terms, "<i4").astype(np.int64), np.frombuffer(values, "<i4").astype(np.int64)
    return Node(*_maxima(all_terms, amounts), [], ids, np.frombuffer(sizes, "<i4"), all_terms, amounts)


def _parent(children: list[Node]) -> Node:
    most = _maxima(np.concatenate([c.terms for c in children]), np.concatenate([c.most for c in children]))
    return Node(*most, children)


class Search:
    """The best ``k`` documents that a task has seen for each item, from given k-th scores on."""

    def __init__(self, items: Items, kth: np.ndarray, k: int):
        self.items, self.k, self.kth = items, k, kth.copy()
        self.least = items.least(self.kth)
        self.found: dict[int, tuple[np.ndarray, pa.Array]] = {}
        self.scored = 0

    def walk(self, node: Node, depth: int = 0, active: np.ndarray | None = None) -> None:
        """Search ``node`` for the items below the ``active`` nodes of a level, all by default."""
        while True:
            level = self.items.levels[depth]
            bounds = _products(level, node.terms, node.most)[0]
            active = np.arange(level.size) if active is None else active
            active = active[bounds[active] >= self.least[depth][active]]
            last = depth == len(self.items.levels) - 1
            if not len(active) or (last and node.children):
                break
            if last:
                return self._score(node, active)
            below = (active[:, None] * ITEMS + np.arange(ITEMS)).ravel()
            active, depth = below[below < self.items.levels[depth + 1].size], depth + 1
            if node.children:
                break
        if len(active):
            for child in node.children:
                self.walk(child, depth, active)

    def _score(self, leaf: Node, active: np.ndarray) -> None:
        scores = leaf.scores(self.items.levels[-1])
        self.scored += len(scores) * len(active)
        for item in active.tolist():
            rows = np.flatnonzero(scores[:, item] >= self.kth[item])
            if len(rows):
                self._add(item, scores[rows, item], leaf.ids.take(pa.array(rows)))
        self.least = self.items.least(self.kth)

    def _add(self, item: int, scores: np.ndarray, ids: pa.Array) -> None:
        if item in self.found:
            before, known = self.found[item]
            scores, ids = np.concatenate([before, scores]), pa.concat_arrays([known, ids])
        if len(scores) > self.k:
            keys = pa.table({"score": scores, "id": ids})
            order = pc.sort_indices(keys, [("score", "descending"), ("id", "ascending")])[: self.k]
            scores, ids = scores[order.to_numpy()], ids.take(order)
        if len(scores) == self.k:
            self.kth[item] = max(self.kth[item], scores.min())
        self.found[item] = (scores, ids)


def _counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document with a term: all its terms' number, and those of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            kept, sizes, terms, tfs = [], [], [], []
            for row, text in enumerate(batch["text"]):
                words = terms_of(text.as_py())
                if not words:
                    continue
                found = [(known[w], c) for w, c in Counter(words).items() if w in known]
                kept.append(row)
                sizes.append(len(words))
                terms.append([t for t, _ in found])
                tfs.append([c for _, c in found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(kept, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(tfs, pa.list_(pa.int32())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return stored(rows.mapInArrow(count, f"doc_id {doc_id}, n long, terms array<int>, tfs array<int>"), "lexical-terms")


def _weights(counted: DataFrame, terms: int, n: int) -> tuple[np.ndarray, int]:
    """Every term's weight, from the number of documents that hold it, and the sum of these numbers."""
    df = np.zeros(terms, np.int64)
    for term, count in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[term] = count
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    return weights, int(df.sum())


def _leaves(counted: DataFrame, weights: np.ndarray, n: int, length: int, files: int) -> DataFrame:
    """The leaves over all documents that can score, stored in so many files at most."""
    doc_id = counted.schema["doc_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, strongest, strength, all_terms, all_values = [], [], [], [], []
            for row in range(batch.num_rows):
                terms = np.asarray(batch["terms"][row].values, np.int64)
                tf = np.asarray(batch["tfs"][row].values, np.int64)
                terms, tf = terms[weights[terms] > 0], tf[weights[terms] > 0]
                if not len(terms):
                    continue
                m = 100 - 50 + 50 * batch["n"][row].as_py() * n // length
                values = 1_000_000_000 * tf // (1000 * tf + 20 * m)
                best = int(np.argmax(values * weights[terms]))
                kept.append(row)
                strongest.append(int(terms[best]))
                strength.append(int(values[best]))
                all_terms.append(terms.astype("<i4").tobytes())
                all_values.append(values.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(kept, pa.int64())),
                    pa.array(strongest, pa.int32()),
                    pa.array(strength, pa.int32()),
                    pa.array(all_terms, pa.binary()),
                    pa.array(all_values, pa.binary()),
                ],
                ["doc_id", "strongest", "strength", "terms", "amounts"],
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = 0, 0
        ids, terms, values, held = [], [], [], 0

        def row() -> pa.RecordBatch:
            sizes = np.array([len(t) // 4 for t in terms], "<i4").tobytes()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 33) + made], pa.int64()),
                    pa.ListArray.from_arrays([0, len(terms)], pa.concat_arrays(ids)),
                    *(pa.array([b], pa.binary()) for b in (sizes, b"".join(terms), b"".join(values))),
                ],
                ["leaf", "ids", "sizes", "terms", "amounts"],
            )

        for batch in batches:
            for i in range(batch.num_rows):
                part = batch["part"][i].as_py()
                ids.append(batch["doc_id"].slice(i, 1))
                terms.append(batch["terms"][i].as_py())
                values.append(batch["amounts"][i].as_py())
                held += len(terms[-1]) // 4
                if len(terms) >= LEAF_DOCUMENTS or held >= LEAF_COORDINATES:
                    yield row()
                    made += 1
                    ids, terms, values, held = [], [], [], 0
        if terms:
            yield row()

    columns = f"doc_id {doc_id}, strongest int, strength int, terms binary, amounts binary"
    placed = stored(counted.mapInArrow(place, columns), "lexical-coordinates")
    order = ("strongest", F.desc("strength"), "doc_id")
    dealt = placed.repartitionByRange(*order).coalesce(files).sortWithinPartitions(*order)
    leaf = f"leaf long, ids array<{doc_id}>, sizes binary, terms binary, amounts binary"
    return stored(dealt.withColumn("part", F.spark_partition_id()).mapInArrow(pack, leaf), "lexical-leaves")


def _nodes(batch: pa.RecordBatch) -> list[Node]:
    return [
        _leaf(batch["ids"][i].values, *(batch[c][i].as_py() for c in ("sizes", "terms", "amounts")))
        for i in range(batch.num_rows)
    ]


def _first_scores(leaves: DataFrame, items: Items, k: int) -> np.ndarray:
    """For every item a score that k documents reach, or 1: from the leaves of its highest bounds."""
    level = items.levels[-1]

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, at = np.zeros((0, level.size), np.int64), np.zeros((0, level.size), np.int64)
        for few in (b.slice(i, 64) for b in batches for i in range(0, b.num_rows, 64)):
            mine = np.array([_products(level, n.terms, n.most)[0] for n in _nodes(few)])
            names = np.repeat(np.asarray(few["leaf"])[:, None], level.size, axis=1)
            best, at = np.concatenate([best, mine]), np.concatenate([at, names])
            order = np.argsort(-best, axis=0, kind="stable")[:FIRST_LEAVES]
            best, at = np.take_along_axis(best, order, 0), np.take_along_axis(at, order, 0)
        row, item = np.nonzero(best)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(at[row, item]), pa.array(best[row, item])], ["item", "leaf", "bound"]
        )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leaf, asked in zip(_nodes(batch), batch["asked"].to_pylist(), strict=True):
                scores = -np.sort(-leaf.scores(level)[:, asked], axis=0)[:k]
                row, column = np.nonzero(scores)
                chosen = np.array(asked, np.int32)[column]
                yield pa.RecordBatch.from_arrays([pa.array(chosen), pa.array(scores[row, column])], ["item", "score"])

    by_item = Window.partitionBy("item")
    first = (
        leaves.mapInArrow(bounds, "item int, leaf long, bound long")
        .withColumn("rank", F.row_number().over(by_item.orderBy(F.desc("bound"), "leaf")))
        .where(F.col("rank") <= FIRST_LEAVES)
        .groupBy("leaf")
        .agg(F.collect_list("item").alias("asked"))
    )
    # broadcast: FIRST_LEAVES numbers for each item of a block
    kth = (
        leaves.join(F.broadcast(first), "leaf")
        .mapInArrow(score, "item int, score long")
        .withColumn("rank", F.row_number().over(by_item.orderBy(F.desc("score"))))
        .where(F.col("rank") == k)
        .select("item", "score")
    )
    found = np.ones(level.size, np.int64)
    for item, least in kth.collect():
        found[item] = least
    return found


def _search(docs: DataFrame, ids: list, texts: list[bytes | None], id_type: T.DataType, k: int) -> DataFrame | None:
    """The answers for a block of items, stored; None if there are none."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    terms = [np.array(sorted({vocabulary.setdefault(w, len(vocabulary)) for w in terms_of(t)}), np.int64) for t in texts]
    if not vocabulary:
        return None
    counted = _counted(docs, vocabulary)
    n, length = counted.agg(F.count("*"), F.sum("n")).first()
    if not n:
        return None
    weights, coordinates = _weights(counted, len(vocabulary), n)
    items = Items(terms, weights)
    if not len(items.order):
        return None
    files = max(spark.sparkContext.defaultParallelism, math.ceil(8 * coordinates / FILE_BYTES))  # work for every core
    leaves = _leaves(counted, weights, n, length, files)
    shared = spark.sparkContext.broadcast((items, _first_scores(leaves, items, k)))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, kth = shared.value
        search, held = Search(items, kth, k), []
        for batch in batches:
            for leaf in _nodes(batch):
                held.append(leaf)
                if len(held) == LEAVES:
                    search.walk(_parent(held))
                    held = []
        if held:
            search.walk(_parent(held))
        for item, (scores, found) in search.found.items():
            places = pa.array(np.full(len(scores), items.order[item]))
            yield pa.RecordBatch.from_arrays([places, found, pa.array(scores)], ["item", "doc_id", "score"])

    found = leaves.mapInArrow(walk, f"item long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    columns = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", id_type)])
    names = spark.createDataFrame(list(enumerate(ids)), columns)  # a block's
    named = ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
    return stored(named.repartition(math.ceil(len(items.order) * k / FILE_ROWS)), "lexical-found")


def _blocks(items: DataFrame) -> Iterator[tuple[list, list[bytes | None]]]:
    """Ids and texts of the items, in blocks of bounded text."""
    ids, texts, size = [], [], 0
    for item, text in items.select("item_id", F.col("text").cast("binary")).toLocalIterator():
        ids.append(item)
        texts.append(text)
        size += len(text or b"")
        if size >= BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def rank(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` its k documents of highest score above 0.

    A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), and a document with n terms scores the sum, over the
    item's distinct terms, of weight x (10^9 tf div (1000 tf + 20 m)) with m = 50 + (50 n N div L). N, L and df count
    over all documents with a term. Ranks start at 1; ties go to the smaller id, null ids last.
    Repeated rows of documents are documents each, and repeated rows of items are answered each.

    A null or empty text has no terms: such documents do not count, such items have no rows. Other
    columns are ignored. An empty table on either side gives no rows. A whole text is counted in one piece, in
    memory of about twenty times its bytes. Items come to the driver in blocks of BLOCK_BYTES of text, and every
    block passes over the documents once more.
    """
    spark = prepared(docs.sparkSession)
    item_id, doc_id = items.schema["item_id"].dataType, docs.schema["doc_id"].dataType
    found = None
    for ids, texts in _blocks(items):
        answers = _search(docs, ids, texts, item_id, k)
        if answers is not None:
            found = answers if found is None else found.unionByName(answers)
    if found is None:
        none = f"item_id {item_id.simpleString()}, rank int, doc_id {doc_id.simpleString()}, score long"
        return spark.createDataFrame([], none)
    return found
