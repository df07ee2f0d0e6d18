"""WARC archives, compressed record by record with a Zstandard dictionary.

A dictionary is trained on a bounded sample of the records. Each archive starts with a skippable
frame that holds it, and every record is a frame of its own, so that one record can be read by its
offset with nothing but the archive. Tasks write whole archives to the shared folder under names
that no other attempt uses; only archives named in the stored index count.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import checked_broadcast, prepared, stored
from fleetlake.session import scratch_dir

#: Payloads shorter than this are always written in full.
MIN_REVISIT_BYTES = 100
#: The dictionary is made from at most so many records, of each a stretch of at most so many characters at a hashed place.
SAMPLE_RECORDS = 1_000
SAMPLE_CHARS = 8 * 2**10
DICTIONARY_BYTES = 64 * 2**10
#: A task goes on with a new archive when one has so many bytes.
ARCHIVE_BYTES = 256 * 2**20
#: Payload bytes, or records, that a reading task hands on at once.
READ_BYTES = 8 * 2**20
READ_RECORDS = 5_000
#: Bytes of a digest, a page id and a count when they are broadcast.
FIRST_BYTES = 160

LEVEL = 3
#: Magic number of the skippable frame that holds a dictionary, and the form of records. Fixed values.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
INDEX = "path string, records long, bytes long"
RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary"
)


def _id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'page:{page_id}')}>"


def _header(value: str) -> str:
    """A value without control characters, so that it can't end its line."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _id(page_id)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _header(url)))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _id(refers_to))]
        fields.append(("X-Refers-To-Page-Id", str(refers_to)))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record's fields and payload; raises ValueError where lengths or digest don't agree."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    if version != VERSION or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"not a whole record: {version}, {len(rest)} bytes for {length}")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(http.rpartition(b"Content-Length: ")[2])
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not agree with its digest")
    number = lambda key: int(fields[key]) if key in fields else None
    return {
        "page_id": number("X-Page-Id"),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": number("X-Refers-To-Page-Id"),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def _train(samples: list[bytes]) -> bytes:
    """A dictionary from sample records; with too few for training, the records themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def classify(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, first``: ``first`` is null for responses, else the response's page id."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    firsts = stored(
        rows.where(F.octet_length("payload") >= MIN_REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n"),
        "warc-firsts",
    )
    revisits = ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(checked_broadcast(firsts, FIRST_BYTES), "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(revisits, F.col("first")).alias("first")
    )


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``page_id, url, html`` to archives; returns their stored index ``path, records, bytes``.

    One record per row: of equal payloads of at least ``MIN_REVISIT_BYTES``, the one with the
    smallest page id is a response and the others revisit it; repeated rows that tie for it are
    responses all. Smaller payloads are responses. A null html is an empty payload. A row with a
    null page id comes after all ids: it revisits where it can, else it is a response. A null url is left out; control
    characters in one are percent-encoded. Other columns are ignored. An empty table gives no archive.
    ``folder`` is a new one below the shared folder unless named.
    """
    spark = prepared(pages.sparkSession)
    folder = folder or scratch_dir(spark, "warc")
    rows = classify(pages)
    # Of all rows, about twice the sample have a hash this low; so tasks send no more than that together.
    share = 2 * SAMPLE_RECORDS / max(pages.count(), 1)
    key = F.xxhash64("page_id", "url")
    whole = F.coalesce("html", F.lit(""))
    places = F.greatest(F.length(whole) - SAMPLE_CHARS + 1, F.lit(1))
    place = F.pmod(F.xxhash64(F.lit("place"), "page_id", "url"), places).cast("int") + 1
    sample = (
        pages.where(key.cast("double") < 2.0**64 * min(share, 1.0) - 2.0**63)
        .select("page_id", "url", F.substr(whole, place, F.lit(SAMPLE_CHARS)).alias("html"))
        .orderBy(key)
        .limit(SAMPLE_RECORDS)
    )
    dictionary = _train([record(r.page_id, r.url, r.html.encode(), "0" * 64, None) for r in sample.collect()])
    shared = spark.sparkContext.broadcast(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = _dictionary(shared.value)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=True)
        fs, base = _open(folder)
        out = None
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "payload", "digest", "first")), strict=True):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    name, records, size = f"{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}")
                    if shared.value:
                        size += out.write(struct.pack("<II", DICTIONARY_MAGIC, len(shared.value)) + shared.value)
                size += out.write(compressor.compress(record(*row)))
                records += 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    yield _row(f"{folder}/{name}", records, size)
                    out = None
        if out is not None:
            out.close()
            yield _row(f"{folder}/{name}", records, size)

    return stored(rows.mapInArrow(write, INDEX), "warc-index")


def _row(path: str, records: int, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path if ":/" not in path or "://" in path else path.replace(":/", ":///", 1))


def read_records(stream) -> Iterator[bytes]:
    """The records of an open archive, one at a time."""
    start = stream.read(8)
    data = None
    if len(start) == 8 and struct.unpack("<II", start)[0] == DICTIONARY_MAGIC:
        data = _dictionary(stream.read(struct.unpack("<II", start)[1]))
        start = b""
    decompressor = zstandard.ZstdDecompressor(dict_data=data)
    rest = start or stream.read(2**20)
    while rest:
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not rest and not (rest := stream.read(2**20)):
                raise ValueError("the archive ends within a record")
            parts.append(frame.decompress(rest))
            rest = b""
        rest = frame.unused_data or stream.read(2**20)
        yield b"".join(parts)


def read_archives(spark: SparkSession, index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives in ``index``: page id, url, type, size and digest of the full
    payload, the page id that a revisit refers to, and the payload (null for revisits, or if not
    asked for). Every response's payload is checked against its digest."""
    prepared(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                fs, place = _open(path)
                with fs.open_input_stream(place) as stream:
                    rows, size = [], 0
                    for data in read_records(stream):
                        rows.append(parse(data))
                        size += len(data)
                        if not payloads:
                            rows[-1]["payload"] = None
                        if len(rows) >= READ_RECORDS or size >= READ_BYTES:
                            yield _batch(rows)
                            rows, size = [], 0
                    yield _batch(rows)

    return index.repartition(max(1, index.count())).mapInArrow(read, RECORD)


_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _ARROW)
