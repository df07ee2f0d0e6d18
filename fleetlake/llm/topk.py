"""Exact top-k search by inner product, with a uniform threshold in three phases.

The dimensions are split into lists, which live apart: a task holds the components of one list
only, of a block of queries and a block of entries, and gives partial scores. An entry's score is the sum
of its partial scores over the lists.

1. Every list gives its best ``GATHERED`` entries for each query. Their missing partial scores are looked
   up, and the ``k``-th best of the whole scores is a safe cutoff.
2. The cutoff goes back to the lists. An entry that reaches it has a partial score of at least
   cutoff / lists in some list, so every list gives the entries from there on, and no others are needed.
   Blocks whose longest vectors are too short to reach that with any query of a block are not paired again.
3. Entries that all lists gave have their whole scores, which may raise the cutoff. What a list did not give is
   below the threshold there, which bounds the rest; the missing partial scores of those entries that may still
   reach the cutoff are looked up, and what does is ranked.

Equal vectors have equal scores, so they are searched as one, and only as many of their ids as can be
among the best are kept; a vector that a third of all rows repeat is one entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import checked_broadcast, stored

#: Lists that the dimensions are split into.
LISTS = 2
#: Entries that a list gives in phase 1, if not k of them are more.
GATHERED = 64
#: Vectors in a block of entries or queries, components in a block, and queries scored at once.
ENTRY_BLOCK = 16_384
QUERY_BLOCK = 512
BLOCK_VALUES = 2**20
STEP = 64
#: Whole numbers up to here are exact in the float64 products that score them.
EXACT = 2.0**53
#: Lengths of vectors are rounded; bounds made of them are taken this much wider.
SLACK = 1 + 1e-9
#: Bytes of a block's name with its length, when it is broadcast.
NAME_BYTES = 64
#: Bytes of a query's limits, when they are broadcast.
LIMIT_BYTES = 48

BLOCK = "width int, list int, block string, norm double, keys binary, ids binary, alone binary, kind string, data binary"
LOCAL = "query long, list int, entry long, partial long"


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """``vec_id, dims``: floor(scale * x) of every component x of ``embedding``, as doubles.

    Rows with a null id, a null vector, or a null or non-finite component are left out.
    """

    def floor(x: Column) -> Column:
        # doubles from 2^53 on are whole; the function gives 64-bit integers, which large ones are beyond
        return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)

    dims = F.transform("embedding", lambda x: floor(x.cast("double") * scale))
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole).select(
        F.col("vec_id").cast("long").alias("vec_id"), dims.alias("dims")
    )


def _keyed(rows: DataFrame, label: str) -> DataFrame:
    norm = F.sqrt(F.aggregate("dims", F.lit(0.0), lambda total, x: total + x * x))
    return stored(rows.withColumn("key", F.monotonically_increasing_id()).withColumn("norm", norm), label)


def _entries(vectors: DataFrame, k: int) -> DataFrame:
    """``key, norm, dims, id, alone, members``: the distinct vectors with the smallest ids that have them, stored.

    ``members`` are the k + 1 smallest ids with their numbers of rows, at most k; ``id`` is the
    smallest, and ``alone`` tells that no other id has the vector.
    """
    by_id = vectors.groupBy("dims", "vec_id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n"))
    place = F.row_number().over(Window.partitionBy("dims").orderBy("vec_id"))
    members = F.sort_array(F.collect_list(F.struct("vec_id", "n"))).alias("members")
    distinct = by_id.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("dims").agg(members)
    return _keyed(
        distinct.select(
            "dims", F.col("members")[0]["vec_id"].alias("id"), (F.size("members") == 1).alias("alone"), "members"
        ),
        "topk-entries",
    )


def _bounds(width: int) -> list[tuple[int, int]]:
    """The dimensions of each list."""
    edges = np.linspace(0, width, min(LISTS, max(width, 1)) + 1).astype(int).tolist()
    return list(zip(edges, edges[1:], strict=False))


def _blocks(rows: DataFrame, size: int, label: str) -> DataFrame:
    """The vectors of each list in stored blocks of one width, packed as bytes; vectors of like length lie together."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        part, made = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch["part"][0].as_py()
            keys, ids, alone = (batch[c].to_numpy(zero_copy_only=False) for c in ("key", "id", "alone"))
            flat = batch["dims"].flatten().to_numpy(zero_copy_only=False)
            widths = np.diff(batch["dims"].offsets.to_numpy())
            starts = np.cumsum(widths) - widths
            for width in map(int, np.unique(widths)):
                most = max(1, min(size, BLOCK_VALUES // max(width, 1)))
                at = np.flatnonzero(widths == width)
                for few in np.split(at, range(most, len(at), most)):
                    known = held.setdefault(width, [])
                    known.append((keys[few], ids[few], alone[few], flat[starts[few][:, None] + np.arange(width)]))
                    if sum(len(k[0]) for k in known) >= most:
                        yield _packed(width, f"{part}-{made}", held.pop(width))
                        made += 1
        for width, known in held.items():
            yield _packed(width, f"{part}-{made}", known)
            made += 1

    parts = max(1, -(-rows.count() // size))
    # the key parts vectors of one length
    dealt = rows.repartitionByRange(parts, "norm", "key").withColumn("part", F.spark_partition_id())
    return stored(dealt.select("part", "key", "id", "alone", "dims").mapInArrow(pack, BLOCK), label)


def _packed(width: int, block: str, parts: list[tuple]) -> pa.RecordBatch:
    keys, ids, alone, data = (np.concatenate(p) for p in zip(*parts, strict=True))
    rows = []
    for which, (a, b) in enumerate(_bounds(width)):
        some = data[:, a:b]
        most = np.abs(some).max(initial=0)
        kind = next((k for k, top in (("<i1", 2**7), ("<i2", 2**15), ("<i4", 2**31)) if most < top), "<f8")
        norm = float(np.sqrt((some * some).sum(axis=1)).max(initial=0))
        packed = (keys.astype("<i8"), ids.astype("<i8"), alone.astype("u1"))
        rows.append((width, which, block, norm, *(p.tobytes() for p in packed), kind, some.astype(kind).tobytes()))
    types = (pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.binary(), pa.binary(), pa.binary(), pa.string(), pa.binary())
    names = [c.split()[0] for c in BLOCK.split(", ")]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def _unpacked(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    keys, ids = (np.frombuffer(block[c], "<i8") for c in ("keys", "ids"))
    data = np.frombuffer(block["data"], block["kind"]).astype(np.float64).reshape(len(keys), -1)
    return keys, ids, np.frombuffer(block["alone"], "u1") > 0, data


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as they are if products of doubles add up exactly, else as Python's integers."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(a.shape[1], 1) < EXACT:
        return a, b
    whole = np.vectorize(int, otypes=[object])
    return whole(a), whole(b)


def _products(queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
    queries, entries = _exact(queries, entries)
    return queries @ entries.T


def _shares(partials: np.ndarray) -> np.ndarray:
    """Partial scores as 64-bit integers, small enough for the lists' sum to be one."""
    if len(partials) and max(abs(int(partials.max())), abs(int(partials.min()))) >= 2**63 // LISTS:
        raise OverflowError("a score is beyond 64 bits")
    return partials.astype(np.int64)


def _scan(pairs: DataFrame, most: int | None) -> DataFrame:
    """What each list gives for each pair of blocks: the best ``most`` entries, or without it those from ``least`` on."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = batch.slice(i, 1).to_pylist()[0]
                asked, asked_ids, _, queries = _unpacked(pair["query"])
                keys, ids, alone, entries = _unpacked(pair["entry"])
                least = {} if most else dict(zip(pair["asked"], pair["least"], strict=True))
                for at in range(0, len(asked), STEP):
                    partials = _products(queries[at : at + STEP], entries)
                    places, counts = [], []
                    for row, query, own in zip(partials, asked[at : at + STEP], asked_ids[at : at + STEP], strict=True):
                        wanted = ~(alone & (ids == own))
                        if not most:
                            wanted &= (row >= least[int(query)]).astype(bool)
                        found = np.flatnonzero(wanted)
                        if most and len(found) > most:
                            found = found[np.argpartition(-row[found], most - 1)[:most]]
                        places.append(found)
                        counts.append(len(found))
                    rows = np.repeat(np.arange(len(counts)), counts)
                    found = np.concatenate(places)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(asked[at + rows]),
                            pa.array(np.full(len(rows), pair["list"], np.int32)),
                            pa.array(keys[found]),
                            pa.array(_shares(partials[rows, found])),
                        ],
                        ["query", "list", "entry", "partial"],
                    )

    return pairs.mapInArrow(scan, LOCAL)


def _summed(local: DataFrame) -> DataFrame:
    """``query, entry, known, given``: the sum of the partial scores that lists gave, and a bit for each such list."""
    bit = F.expr("shiftleft(1L, list)")
    return local.groupBy("query", "entry").agg(F.sum("partial").alias("known"), F.sum(bit).alias("given"))


def _resolved(pairs: DataFrame, asked: DataFrame, entries: DataFrame) -> DataFrame:
    """``query, entry, score``: pairs of ``query, entry, known, given`` with the missing partial scores looked up."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, given = (batch[c].to_numpy() for c in ("known", "given"))
            widths = np.diff(batch["dims"].offsets.to_numpy())
            flats = [batch[c].flatten().to_numpy(zero_copy_only=False) for c in ("asked_dims", "dims")]
            starts = np.cumsum(widths) - widths
            scores = known.astype(np.int64)
            for width in map(int, np.unique(widths)):
                for which, (a, b) in enumerate(_bounds(width)):
                    rows = np.flatnonzero((widths == width) & (given >> which & 1 == 0))
                    parts = _exact(*(flat[starts[rows][:, None] + np.arange(a, b)] for flat in flats))
                    scores[rows] += _shares((parts[0] * parts[1]).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch["query"], batch["entry"], pa.array(scores)], ["query", "entry", "score"]
            )

    whole = pairs.join(asked.select(F.col("key").alias("query"), F.col("dims").alias("asked_dims")), "query").join(
        entries.select(F.col("key").alias("entry"), "dims"), "entry"
    )
    return whole.select("query", "entry", "known", "given", "asked_dims", "dims").mapInArrow(
        look_up, "query long, entry long, score long"
    )


def _kth(scores: DataFrame, k: int) -> DataFrame:
    """``query, cutoff``: each query's k-th best score, of those with so many."""
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    ranked = scores.withColumn("place", place).where(F.col("place") <= k)
    return ranked.where(F.col("place") == k).select("query", F.col("score").alias("cutoff"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k entries of highest inner product for each query.

    Both tables have ``vec_id, dims`` as made by :func:`quantised`; other columns are ignored. Ranks
    start at 1, ties go to the smaller id. Rows with the query's own id are not entries of its list;
    repeated rows of another id are entries each. A repeated query row is answered once; an id with
    two vectors is two queries. Only vectors of equal length meet; a query without entries, and an
    empty table, have no rows. Scores are 64-bit integers; a list's share beyond 2^63 / ``LISTS`` ends the query
    with an OverflowError.
    """
    entries = _entries(vectors.select("vec_id", "dims"), k)
    asked = _asked(queries.select("vec_id", "dims"))
    given = _blocks(entries, ENTRY_BLOCK, "topk-entry-blocks")
    wanted = _blocks(asked, QUERY_BLOCK, "topk-query-blocks")
    local = _scan(_pairs(given, wanted), max(k, GATHERED))
    place = F.row_number().over(Window.partitionBy("query", "list").orderBy(F.desc("partial")))
    local = local.withColumn("place", place).where(F.col("place") <= max(k, GATHERED))
    cutoffs = stored(_kth(_resolved(_summed(local), asked, entries), k), "topk-cutoffs")
    limits = _limits(wanted, cutoffs)
    sent = stored(_summed(_scan(_pairs(given, wanted, limits), None)), "topk-sent")
    return _ranked(_scores(sent, limits, asked, entries, k), asked, entries, k)


def _asked(queries: DataFrame) -> DataFrame:
    """``key, norm, dims, id, alone``: the distinct queries, stored."""
    distinct = queries.groupBy("vec_id", "dims").agg(F.lit(True).alias("alone"))
    return _keyed(distinct.select(F.col("vec_id").alias("id"), "alone", "dims"), "topk-queries")


def _pairs(given: DataFrame, wanted: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """``list, query, entry``: blocks of one list and width with their contents, and ``asked, least`` if limits are told.

    With limits, a pair of blocks is left out if no product of its vectors' lengths comes up to a threshold.
    """
    content = F.struct("keys", "ids", "alone", "kind", "data")
    names = wanted.select("width", "list", F.col("block").alias("query_block"), F.col("norm").alias("length"))
    told = wanted.select("list", F.col("block").alias("query_block"), content.alias("query"))
    if limits is not None:
        by_block = stored(
            limits.groupBy("query_block").agg(
                F.collect_list("query").alias("asked"),
                F.collect_list(F.coalesce("least", F.lit(-(2**63)))).alias("least"),
                F.min(F.coalesce("least", F.lit(-(2**63)))).alias("lowest"),
            ),
            "topk-thresholds",
        )
        names = names.join(by_block.select("query_block", "lowest"), "query_block")
        told = told.join(by_block.drop("lowest"), "query_block")
    # the names are stored tables' narrow columns
    grid = given.select("width", "list", F.col("block").alias("entry_block"), F.col("norm").alias("longest"))
    grid = grid.join(checked_broadcast(names, NAME_BYTES), ["width", "list"])
    if limits is not None:
        grid = grid.where((F.col("lowest") <= 0) | (F.col("longest") * F.col("length") * SLACK >= F.col("lowest")))
    entry = given.select("list", F.col("block").alias("entry_block"), content.alias("entry"))
    paired = grid.select("list", "entry_block", "query_block").join(told, ["list", "query_block"])
    return paired.join(entry, ["list", "entry_block"]).drop("entry_block", "query_block")


def _limits(wanted: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``query_block, query, lists, cutoff, least``: the threshold of a query's lists, null without a cutoff; stored."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, width, keys in zip(*(batch[c].to_pylist() for c in ("block", "width", "keys")), strict=True):
                found = np.frombuffer(keys, "<i8")
                lists = np.full(len(found), len(_bounds(width)), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(found), pa.string()), pa.array(found), pa.array(lists)],
                    ["query_block", "query", "lists"],
                )

    first = wanted.where(F.col("list") == 0).select("block", "width", "keys")
    known = first.mapInArrow(unpack, "query_block string, query long, lists int").join(cutoffs, "query", "left")
    # a whole number is at least cutoff / lists from the ceiling on
    least = F.expr("cutoff div lists + if(cutoff % lists > 0, 1, 0)")
    return stored(known.select("query_block", "query", "lists", "cutoff", least.alias("least")), "topk-limits")


def _scores(sent: DataFrame, limits: DataFrame, asked: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """``query, entry, score`` of all entries that can be among the best k; phase 3."""
    limits = checked_broadcast(limits.drop("query_block"), LIMIT_BYTES)
    known = sent.join(limits, "query")
    complete = F.col("given") == F.expr("shiftleft(1L, lists) - 1")
    whole = known.where(complete).select("query", "entry", F.col("known").alias("score"))
    raised = checked_broadcast(stored(_kth(whole, k), "topk-raised").withColumnRenamed("cutoff", "raised"), LIMIT_BYTES)
    known = known.join(raised, "query", "left").withColumn("bar", F.greatest("cutoff", "raised"))
    # a list that did not give an entry has it below its threshold
    most = F.expr("known + (lists - bit_count(given)) * (least - 1)")
    rest = known.where(~complete & (F.col("bar").isNull() | (most >= F.col("bar"))))
    found = _resolved(rest.select("query", "entry", "known", "given"), asked, entries).join(
        limits.select("query", "cutoff"), "query"
    )
    ready = known.where(complete & (F.col("bar").isNull() | (F.col("known") >= F.col("bar"))))
    return ready.select("query", "entry", F.col("known").alias("score")).union(
        found.where(F.col("cutoff").isNull() | (F.col("score") >= F.col("cutoff"))).select("query", "entry", "score")
    )


def _ranked(scores: DataFrame, asked: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """The rows of :func:`top_k`, the ids of equal vectors apart again."""
    own = checked_broadcast(asked.select(F.col("key").alias("query"), F.col("id").alias("query_id")), NAME_BYTES)
    held = entries.select(F.col("key").alias("entry"), "id", "members")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    # one of the vectors may be left with the query's own id only
    few = scores.join(held, "entry").withColumn("place", place).where(F.col("place") <= k + 1)
    each = few.join(own, "query").select("query", "query_id", "score", F.explode("members").alias("member"))
    rows = each.where("member.vec_id <> query_id").select(
        "query", "query_id", "score", "member.vec_id", F.explode(F.sequence(F.lit(1), "member.n"))
    )
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return (
        rows.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
