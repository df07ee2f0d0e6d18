"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in at most r bits if and only if some 64-bit value lies within ceil(r/2) bits of
the one and floor(r/2) of the other. So every distinct fingerprint emits all variants within that
radius, and fingerprints meet at equal variants. For r = 4 these are 2081 variants each; a variant
is shuffled by some of its bits, once for every choice of those bits, and the task that gets them
flips the remaining ones. That sends the same variants as one row per variant would, in a hundredth
of the bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import checked_broadcast, prepared, stored
from fleetlake.llm.components import components, local_forest

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BITS = 64
#: Variants that a task expands at once, and fingerprints that one group of them may have.
VARIANTS_AT_ONCE = 2 * 2**20
GROUP_ROWS = 1_000_000
#: Shingles whose bits are counted at once.
HASHES_AT_ONCE = 2**16
#: Bytes of a dropped document's id and mark when they are broadcast.
DROPPED_BYTES = 64
#: Bytes of a row of longs and marks that a step stores.
ROW_BYTES = 40

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """Of each bit, whether more than half of the shingles' hashes have it; 0 without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), HASHES_AT_ONCE):
        hashes = [
            digest(joined[a:b], SEED)
            for a, b in zip(starts[at : at + HASHES_AT_ONCE], ends[at : at + HASHES_AT_ONCE], strict=True)
        ]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, mark, fingerprint``, one row for every row of ``docs``; ``mark`` is a hash of the text.

    A null text has no words. The fingerprint is the 64 bits as a signed long.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["mark"], pa.array(found.view(np.int64))], ["doc_id", "mark", "fingerprint"]
            )

    prepared(docs.sparkSession)
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(
        hashed, f"doc_id {doc_type}, mark long, fingerprint long"
    )


def _masks(bits: list[int], most: int) -> list[int]:
    """All ways to flip at most so many of the bits."""
    return [sum(1 << b for b in some) for n in range(most + 1) for some in combinations(bits, n)]


def _meeting(values: np.ndarray, left: np.ndarray, bits: list[int], distance: int) -> Iterator[tuple]:
    """Links between values that have an equal variant, when ``left[i]`` of the bits may be flipped in ``values[i]``."""
    ways = [sum(math.comb(len(bits), n) for n in range(b + 1)) for b in range(int(left.max(initial=0)) + 1)]
    size = sum(w * int((left == b).sum()) for b, w in enumerate(ways))
    if len(values) < 2:
        return
    if size > VARIANTS_AT_ONCE and bits:
        bit, rest = np.uint64(1 << bits[0]), bits[1:]
        has = (values[:, 0] & bit) != 0
        for side in (False, True):  # those that have the bit so, and those that flip it
            flips = (has != side) & (left > 0)
            here = (has == side) | flips
            chosen = values[here].copy()
            chosen[flips[here], 0] ^= bit
            yield from _meeting(chosen, left[here] - flips[here], rest, distance)
        return
    variants, owners = [], []
    for budget in np.unique(left):
        rows = np.flatnonzero(left == budget)
        masks = np.array(_masks(bits, int(budget)), np.uint64)
        variants.append((values[rows, :1] ^ masks).ravel())
        owners.append(np.repeat(rows, len(masks)))
    variants, owners = np.concatenate(variants), np.concatenate(owners)
    ordered = np.sort(variants)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(shared):
        return
    places = np.minimum(np.searchsorted(shared, variants), len(shared) - 1)
    met = np.flatnonzero(shared[places] == variants)
    group, member = places[met], values[owners[met], 1]
    flipped = np.bitwise_count(variants[met] ^ member)
    order = np.lexsort((member, flipped, group))
    group, member = group[order], member[order]
    first = np.concatenate([[True], group[1:] != group[:-1]])
    centre = member[first][np.cumsum(first) - 1]
    linked = (centre != member) & (np.bitwise_count(centre ^ member) <= distance)
    pairs = np.unique(np.stack([centre[linked], member[linked]], axis=1), axis=0)
    yield pairs[:, 0], pairs[:, 1]


def links(distinct: DataFrame, distance: int = MAX_BITS) -> DataFrame:
    """``a, b``: enough pairs of the distinct values of ``fingerprint`` within the distance to connect all such pairs.

    In a group of equal variants, all values within floor(distance/2) of the variant are within the
    distance of each other and of the rest, so links from the nearest of them to the others suffice.
    ``distinct`` should be stored.
    """
    radius = -(-distance // 2)
    counts = distinct.agg(
        F.count(F.lit(1)).alias("all"),
        *[F.sum(F.shiftright("fingerprint", b).bitwiseAND(1)).alias(f"b{b}") for b in range(BITS)],
    ).first()
    total = counts["all"]
    # The most evenly set bits deal the variants out; more of them where one choice still gets too many.
    even = sorted(range(BITS), key=lambda b: abs((counts[f"b{b}"] or 0) * 2 - total))
    variants = total * sum(math.comb(BITS, n) for n in range(radius + 1))
    known = min(BITS, max(0, math.ceil(math.log2(max(variants / VARIANTS_AT_ONCE, 1)))))
    while True:
        key_bits, rest = sorted(even[:known]), sorted(even[known:])
        kept = sum(1 << b for b in key_bits)
        signed = lambda x: x - 2**64 if x >= 2**63 else x
        dealt = distinct.select(
            "fingerprint",
            F.explode(F.array(*[F.lit(signed(m)).cast("long") for m in _masks(key_bits, radius)])).alias("flipped"),
        ).select(
            F.col("fingerprint").bitwiseAND(F.lit(signed(kept))).bitwiseXOR(F.col("flipped")).alias("key"),
            "fingerprint",
            "flipped",
        )
        largest = dealt.groupBy("key").count().agg(F.max("count")).first()[0] or 0
        if largest <= GROUP_ROWS or known == BITS:
            break
        known = min(BITS, known + 4)

    def meet(group: pa.Table) -> pa.Table:
        found = group["fingerprint"].to_numpy().view(np.uint64)
        flipped = group["flipped"].to_numpy().view(np.uint64)
        values = np.stack([found ^ flipped, found], axis=1)
        left = radius - np.bitwise_count(flipped).astype(np.int64)
        pairs = list(_meeting(values, left, rest, distance))
        a, b = (np.concatenate([p[i] for p in pairs]) if pairs else np.empty(0, np.uint64) for i in (0, 1))
        a, b = local_forest(a.view(np.int64), b.view(np.int64))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("key").applyInArrow(meet, "a long, b long")


def near_duplicates(
    docs: DataFrame, distance: int = MAX_BITS, shingle: int = SHINGLE_WORDS
) -> DataFrame:
    """``doc_id, mark, fingerprint, component_id, root``, one row for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links of at most ``distance`` differing bits
    reach, the row's own included. Texts without words (null, empty, white space) have fingerprint 0,
    which links like any other. Repeated rows share everything; a row with a null id takes part,
    and its component has a null id only if no row of it has another. Other columns are ignored; an
    empty table gives no rows. ``mark`` is a hash of the text, to tell rows of one id apart, and
    ``root`` a fingerprint that names the component.
    """
    return _near_duplicates(docs, distance, shingle)[0]


def _near_duplicates(docs: DataFrame, distance: int, shingle: int) -> tuple[DataFrame, int]:
    """:func:`near_duplicates`, and the bytes of its rows by estimate."""
    rows = stored(fingerprints(docs, shingle), "simhash-rows")
    size = ROW_BYTES * rows.count()
    distinct = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-distinct", size)
    roots = components(stored(links(distinct.select("fingerprint"), distance), "simhash-links"))
    placed = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(
        placed.join(least, "root").select("fingerprint", "component_id", "root"), "simhash-components", size
    )
    return rows.join(named, "fingerprint").select("doc_id", "mark", "fingerprint", "component_id", "root"), size


def one_of_each(docs: DataFrame, distance: int = MAX_BITS, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one row of each component: the smallest ``doc_id``, of rows that share it the smallest mark.

    A null id counts as larger than any. Of rows with one id and text one stays. All columns stay.
    """
    found, size = _near_duplicates(docs, distance, shingle)
    found = stored(found, "simhash-found", size)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    # stored, so that the join shuffles both sides anew and can split a large component
    firsts = stored(found.groupBy("root").agg(F.min(rank).alias("first")), "simhash-firsts", size)
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    judged = found.join(firsts, "root").groupBy("doc_id", "mark").agg(
        F.every(is_first).alias("kept"), F.count(F.lit(1)).alias("copies")
    )
    judged = stored(judged.where(~F.col("kept") | (F.col("copies") > 1)), "simhash-judged", size)

    def same(other: DataFrame):
        return docs["doc_id"].eqNullSafe(other["doc_id"]) & (F.xxhash64(docs["text"]) == other["mark"])

    dropped = checked_broadcast(judged.where(~F.col("kept")), DROPPED_BYTES)
    repeated = judged.where("kept")
    if repeated.isEmpty():
        return docs.join(dropped, same(dropped), "left_anti")
    repeated = checked_broadcast(repeated, DROPPED_BYTES)
    every = checked_broadcast(judged, DROPPED_BYTES)
    once = docs.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "text"])
    return docs.join(every, same(every), "left_anti").union(once)
