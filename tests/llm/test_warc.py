from __future__ import annotations

import hashlib
import io

import pytest
import zstandard

from fleetlake.llm import warc

COLUMNS = "page_id long, url string, html string, digest string, first long"
SAME = "ab" * 60


def rows():
    pages = [(i, f"http://h/{i}", f"<p>{i} " + "text é " * (i % 40), "x", 0) for i in range(200)]
    pages += [(500 + i, "http://same", SAME, "x", 0) for i in range(50)]
    pages += [(499, None, SAME, "x", 0), (499, None, SAME, "x", 0), (None, "u\r\nX-Page-Id: 7", SAME, "x", 0)]
    pages += [(600, "http://short", "a" * 99, "x", 0), (601, "http://short", "a" * 99, "x", 0)]
    pages += [(602, "u", None, "x", 0), (603, "u", "", "x", 0), (604, "u", "long\r\n\r\n" * 100_000, "x", 0), (605, "u", "é" * 50, "x", 0), (606, "u", "é" * 50, "x", 0)]
    return pages


def expected(pages):
    payloads = [((html or "").encode(), i) for i, _, html, *_ in pages]
    firsts = {}
    for data, i in payloads:
        if len(data) >= 100 and i is not None:
            firsts[data] = min(i, firsts.get(data, i))
    return sorted(
        str((i, len(d), hashlib.sha256(d).hexdigest(), *(("response", None) if firsts.get(d, i) == i else ("revisit", firsts[d]))))
        for d, i in payloads
    )


@pytest.mark.parametrize("size", [warc.ARCHIVE_BYTES, 2_000])
@pytest.mark.parametrize("limit", [warc.FIRST_BYTES, 2**40])  # broadcast, and joined by shuffle
def test_round_trip(spark, monkeypatch, size, limit):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", size)
    monkeypatch.setattr(warc, "FIRST_BYTES", limit)
    index = warc.write_archives(spark.createDataFrame(rows(), COLUMNS).repartition(3))
    out = warc.read_archives(spark, index).collect()
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in out) == expected(rows())
    assert index.agg({"records": "sum"}).first()[0] == len(rows())
    by_id = {r.page_id: r for r in out}
    assert by_id[7].payload.decode() == rows()[7][2] and by_id[7].url == "http://h/7"
    assert by_id[None].url == "u%0D%0AX-Page-Id: 7" and by_id[499].url is None


def test_records_are_frames_behind_a_dictionary(spark):
    index = warc.write_archives(spark.createDataFrame(rows(), COLUMNS))
    for r in index.collect():
        fs, path = warc._open(r.path)
        data = fs.open_input_stream(path).read()
        magic, size = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little")
        assert magic == warc.DICTIONARY_MAGIC and len(data) == r.bytes
        dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        first = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj().decompress(data[8 + size :])
        assert first.startswith(b"WARC/1.1\r\n") and warc.parse(first)["record_type"] in ("response", "revisit")
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(data[:-5])))


def test_a_changed_payload_is_found():
    data = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert warc.parse(data)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r\n", b"paYload\r\n"))


def test_empty_table(spark):
    index = warc.write_archives(spark.createDataFrame([], COLUMNS))
    assert index.collect() == [] and warc.read_archives(spark, index).collect() == []
