"""Token ids as length-delimited binary records, with an index of offsets.

A record is, in little-endian order: length of the payload (8 bytes), masked CRC-32 of those 8 bytes (4),
payload, masked CRC-32 of the payload (4), and one line feed, which Spark's text writer adds. The payload is
one byte for the width of an id in bytes, one byte that is 1 if the document has an id, its id (8, signed), then
the token ids. Records lie in ascending order of doc_id, rows without one first: inside a file, and from file
to file by name.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.tables import keep, ship
from headway.llm.tokens import END_ID, default_tokenizer, encoder

# Bounds the size of a file, as a reader takes one file at a time.
RECORDS_PER_FILE = 5_000
FRAME = 17  # bytes of a record besides its payload
_MASK = 0xA282EAD8  # fixed value of the masking rule
_HEAD = struct.Struct("<BBq")

_INDEX = "file string, offset long, n_bytes long, doc_id long, n_tokens long, in_file long, ids_crc32 long"


def masked(data: bytes) -> int:
    """CRC-32 turned by 15 bits and shifted by a constant, so that data holding checksums stays safe."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def payload_of(doc_id: int | None, ids: bytes) -> bytes:
    """The payload for 32-bit ids; two bytes an id if they are all small enough."""
    values = np.frombuffer(ids, "<u4")
    narrow = not len(values) or values.max() < 1 << 16
    head = _HEAD.pack(2 if narrow else 4, doc_id is not None, doc_id or 0)
    return head + (values.astype("<u2").tobytes() if narrow else ids)


def parse(data: memoryview, offset: int) -> tuple[int | None, bytes, int]:
    """The record at an offset: doc_id, 32-bit ids, offset of the next. Raises ValueError if damaged."""
    start = offset + 12
    if start > len(data):
        raise ValueError(f"record at {offset} is cut off")
    (length,), (check,) = struct.unpack_from("<Q", data, offset), struct.unpack_from("<I", data, offset + 8)
    if masked(data[offset:offset + 8]) != check:
        raise ValueError(f"length of the record at {offset} is damaged")
    if start + length + 5 > len(data):
        raise ValueError(f"record at {offset} is cut off")
    payload = data[start:start + length]
    if masked(payload) != struct.unpack_from("<I", data, start + length)[0]:
        raise ValueError(f"record at {offset} is damaged")
    width, known, doc_id = _HEAD.unpack_from(payload)
    ids = np.frombuffer(payload, f"<u{width}", offset=_HEAD.size).astype("<u4").tobytes()
    return doc_id if known else None, ids, start + length + 5


def _framed(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(tokenizer).encode
    for batch in batches:
        for at in range(0, len(batch), 256):
            keys = batch.column(0)[at:at + 256].to_pylist()
            ids = encode(batch.column(1)[at:at + 256].to_pylist(), end_id)
            records = [frame(payload_of(key, x)) for key, x in zip(keys, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])


def write(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
          end_id: int = END_ID) -> None:
    """Encode every whole text and write its record under ``path``, in ascending order of doc_id.

    A null or empty text gives the end id alone. Rows that repeat a doc_id each get a record, in any order
    among themselves; their place in the input is part of the sort key, so no id is too frequent for one
    task. An empty table gives a folder without records. Other columns are ignored. A very long text makes one long
    record; files end after 5,000 records, so only files of such texts grow beyond the usual.
    """
    ship(docs.sparkSession)
    tokenizer = tokenizer or default_tokenizer()
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.monotonically_increasing_id().alias("place"))
    records = (rows.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
               .select("doc_id", "text").mapInArrow(lambda b: _framed(b, tokenizer, end_id), "record binary"))
    (records.select(F.col("record").cast("string")).write.option("maxRecordsPerFile", RECORDS_PER_FILE)
     .option("compression", "none").text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [column.split()[0] for column in _INDEX.split(", ")]
    types = [pa.string()] + [pa.int64()] * 6
    for batch in batches:
        for file, content in zip(batch.column(0), batch.column(1), strict=True):
            data, offset, before, rows = memoryview(content.as_buffer()), 0, 0, []
            while offset < len(data):
                doc_id, ids, after = parse(data, offset)
                rows.append((file.as_py(), offset, after - offset, doc_id, len(ids) // 4, before, zlib.crc32(ids)))
                before, offset = before + len(ids) // 4, after
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index of the records under ``path``, made from the files themselves and stored apart.

    Per record: file, offset, n_bytes, doc_id, n_tokens, ids_crc32 and start, the number of ids in all records
    before it. Every checksum is verified; a damaged file raises. Starts are added up per file and then over
    one row per file.
    """
    ship(spark)
    records = keep(_files(spark, path).mapInArrow(_indexed, _INDEX), "record-index")
    sizes = records.groupBy("file").agg(F.sum("n_tokens").alias("in_all"))
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.withColumn("part", F.regexp_extract("file", r"part-(\d+)-", 1).cast("int"))
              .withColumn("piece", F.regexp_extract("file", r"-c(\d+)\.", 1).cast("int"))
              .select("file", F.coalesce(F.sum("in_all").over(before), F.lit(0)).alias("file_start")))
    return (records.join(starts, "file")
            .withColumn("start", F.col("file_start") + F.col("in_file")).drop("file_start", "in_file"))


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content, offsets in zip(batch.column(0), batch.column(1), strict=True):
            data = memoryview(content.as_buffer())
            found = [parse(data, offset)[:2] for offset in offsets.as_py()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int64()),
                 pa.array([np.frombuffer(x, "<u4").astype("i8") for _, x in found], pa.list_(pa.int64()))],
                ["doc_id", "ids"])


def fetch(spark: SparkSession, path: str, chosen: DataFrame) -> DataFrame:
    """doc_id and ids of the records that ``chosen``, rows of the index in any order, points at."""
    ship(spark)
    wanted = chosen.groupBy("file").agg(F.collect_list("offset").alias("offsets"))
    return (_files(spark, path).join(wanted, "file").select("content", "offsets")
            .mapInArrow(_fetched, "doc_id long, ids array<long>"))
