"""Fill-in-the-middle transformation: documents cut at unit ends that are counted in 64-bit words.

A unit is a run of white space with the run of other characters behind it, or the white space at the
text's end. White space is ASCII, so units end at the same places in UTF-8. The bytes are viewed as
words of eight. Arithmetic on whole words sets the highest bit of every byte that ends a unit, a bit count
per word and its running sum tell units before any word, and the k-th unit's end is found by searching
that sum and then among the at most eight marks of one word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import prepared

#: Marks before prefix, suffix and middle. Fixed values.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Shares in percent: documents that are transformed, and those of them with the suffix first.
TRANSFORMED, SUFFIX_FIRST = 50, 80
SEED = 42

ROWS = "doc_id {doc_id}, n long, form string, prefix_chars long, middle_chars long, output string"


def _each(byte: int) -> np.uint64:
    """A word of eight equal bytes."""
    return np.uint64(byte * 0x0101010101010101)


_HIGH, _LOW = _each(0x80), _each(0x7F)


def _white(words: np.ndarray) -> np.ndarray:
    """The highest bit of every byte that is 0x20 or one of 0x09 to 0x0D.

    Sums of bytes below 0x80 stay within their byte, so each tells whether its own byte reaches a limit.
    """
    low = words & _LOW
    blank = ~((low ^ _each(0x20)) + _LOW)
    control = (low + _each(0x80 - 0x09)) & ~(low + _each(0x80 - 0x0E))
    return (blank | control) & ~words & _HIGH


class Units:
    """The unit ends of one text in UTF-8."""

    def __init__(self, data: bytes):
        words = np.frombuffer(data + b" " * (-len(data) % 8), "<u8")
        white = _white(words)
        behind = white >> np.uint64(8)
        behind[:-1] |= white[1:] << np.uint64(56)
        if len(behind):
            behind[-1] |= np.uint64(0x80 << 56)
        self.ends = ~white & _HIGH & behind
        if data and data[-1] in b" \t\n\v\f\r":
            last = len(data) - 1
            self.ends[last // 8] |= np.uint64(0x80 << 8 * (last % 8))
        self.before = np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)
        self.count = int(self.before[-1]) if len(words) else 0

    def end(self, k: int) -> int:
        """The number of bytes in the first ``k`` units."""
        if not k:
            return 0
        at = int(np.searchsorted(self.before, k))
        word = int(self.ends[at])
        for _ in range(k - (int(self.before[at - 1]) if at else 0) - 1):
            word &= word - 1
        return 8 * at + (word & -word).bit_length() // 8


def transform(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every document.

    ``n`` counts units. The digest of ``seed:doc_id`` chooses two of the n + 1 places between units and the
    form: ``plain`` is the text, ``psm`` prefix, suffix and middle, each behind its mark, ``spm`` suffix, prefix
    and middle. Texts that are empty or hold a mark stay plain; the counts of code points are null there.

    A null text is empty, a null id is hashed as an empty one. Repeated rows are transformed each, and
    other columns are ignored. An empty table has no rows. A text is handled in one piece, in memory of about six
    times its bytes.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, hashed in zip(batch["text"], batch["digest"], strict=True):
                data = text.as_py() or b""
                units = Units(data)
                one, two, three, four = (int(hashed.as_py()[i : i + 8], 16) for i in range(0, 32, 8))
                if not data or three % 100 >= TRANSFORMED or any(m in data for m in marks):
                    rows.append((units.count, "plain", None, None, data))
                    continue
                first, second = sorted((one % (units.count + 1), two % (units.count + 1)))
                a, b = units.end(first), units.end(second)
                parts = {PREFIX: data[:a], MIDDLE: data[a:b], SUFFIX: data[b:]}
                form, order = ("spm", (SUFFIX, PREFIX)) if four % 100 < SUFFIX_FIRST else ("psm", (PREFIX, SUFFIX))
                output = b"".join(m.encode() + parts[m] for m in (*order, MIDDLE))
                rows.append((units.count, form, len(parts[PREFIX].decode()), len(parts[MIDDLE].decode()), output))
            n, form, prefix, middle, output = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    prepared(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), digest.alias("digest"))
    return rows.mapInArrow(cut, ROWS.format(doc_id=docs.schema["doc_id"].dataType.simpleString()))


def restored(output: Column, form: Column) -> Column:
    """The text that :func:`transform` made ``output`` from; a null output or form gives null.

    No mark can arise where a part meets a mark, so the marks found are those that were set.
    """
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
    )
