"""Binary token records: length-delimited, check-summed, with a separate offset index.

A record file is a run of frames, each with

    length of the payload       unsigned 64-bit
    masked CRC-32 of the length unsigned 32-bit
    payload
    masked CRC-32 of the payload unsigned 32-bit

all little-endian. The mask rotates the sum right by 15 bits and adds ``MASK``, so that a sum over data that hold
sums stays sound. A payload is one byte of flags (1: it has a document id), the document id (signed 64-bit), one
byte with the width of an id, and the ids. The index is a Parquet table with a row for each record: its file, offset
and length, so a training job can read the records in any order.

Files are written by tasks, each attempt to a file of its own name. Only files that the index names count, and Spark's
commit puts into the index what the successful attempt of each task returned: a lost executor or a second attempt
leaves at most a file that nothing refers to.

Defined cases: a null text is an empty one; every document has the end id, so none is empty. Rows with a null id come
first. Repeated rows are records of their own, ordered by id, then by a hash of the text, then by the text. An empty
table gives an index without rows. Columns other than the two named ones are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankdrift.llm.common import batches_of, rows_of, shared_folder, small_batches, table
from rankdrift.llm.tokens import END_ID, REMEMBERED, WordEncoder

MASK = 0xA282EAD8
#: Files that a task which reads records in any order keeps open.
OPEN_FILES = 32
_LENGTH, _SUM, _HEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<BqB")
_INDEX = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.int32()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
    + [("start_in_file", pa.int64()), ("n_tokens", pa.int64())]
)
_INDEX_DDL = "doc_id long, part int, file string, offset long, length long, start_in_file long, n_tokens long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = _LENGTH.pack(len(payload))
    return b"".join((length, _SUM.pack(masked_crc(length)), payload, _SUM.pack(masked_crc(payload))))


def unframe(record: bytes) -> bytes:
    """The payload of one whole frame; an error if a length or sum is wrong."""
    length = record[:8]
    if len(record) < 16 or _SUM.unpack(record[8:12])[0] != masked_crc(length):
        raise ValueError("the length of a record is damaged")
    payload = record[12:-4]
    if _LENGTH.unpack(length)[0] != len(payload) or _SUM.unpack(record[-4:])[0] != masked_crc(payload):
        raise ValueError("a record is damaged")
    return payload


def pack_document(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return _HEAD.pack(doc_id is not None, doc_id or 0, width) + ids


def unpack_document(payload: bytes) -> tuple[int | None, np.ndarray]:
    """The document id and the ids as unsigned 32-bit integers."""
    has_id, doc_id, width = _HEAD.unpack_from(payload)
    return (doc_id if has_id else None), np.frombuffer(payload, f"<u{width}", offset=_HEAD.size).astype("<u4")


@cache
def _encoder() -> WordEncoder:
    """The one encoder of a worker: what it learnt in a task serves the next. Its memory is bounded."""
    return WordEncoder(remembered=2 * REMEMBERED)


def write_records(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Encode all documents and write them in ascending id order: files in ``folder``/data, the index in ``folder``/index."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(records(batches), _INDEX)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encoder, part = _encoder(), TaskContext.get().partitionId()
        files, root = pyarrow.fs.FileSystem.from_uri(f"{folder}/data")
        name, out, offset, start = f"{part:06d}-{uuid.uuid4().hex}.rec", None, 0, 0
        try:
            for doc_id, text in rows_of(batches):
                if out is None:
                    files.create_dir(root, recursive=True)
                    out = files.open_output_stream(f"{root}/{name}")
                ids = encoder.encode_document(text, end_id)
                record = frame(pack_document(doc_id, ids, encoder.width))
                out.write(record)
                n = len(ids) // encoder.width
                yield doc_id, part, name, offset, len(record), start, n
                offset, start = offset + len(record), start + n
        finally:
            if out is not None:
                out.close()

    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    # Each task closes its file before its last index rows are committed, so an index never names an unfinished file.
    # Rows of one id are ranged by their hash, so that an id with many of them fills several files.
    by_id = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")
    by_id.mapInArrow(write, _INDEX_DDL).write.parquet(f"{folder}/index")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The offset index, with ``start``: the number of ids of all records before it."""
    index = spark.read.schema(_INDEX_DDL).parquet(f"{folder}/index")
    # One row for each file.
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("in_file"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = files.select("part", F.coalesce(F.sum("in_file").over(before), F.lit(0)).alias("base"))
    return index.join(base, "part").withColumn("start", F.col("base") + F.col("start_in_file"))


def read_records(index: DataFrame, folder: str, keep: tuple[str, ...] = ("start",)) -> DataFrame:
    """The documents of index rows, in whatever order these come: id, the ``keep`` columns and the ids."""
    kept = {c: index.schema[c].dataType.simpleString() for c in keep}
    schema = ", ".join(["doc_id long", *(f"{c} {t}" for c, t in kept.items()), "ids array<int>"])
    return index.select("file", "offset", "length", *keep).mapInArrow(
        lambda batches: _read(batches, folder, len(keep), False), schema
    )


def record_digests(index: DataFrame, folder: str) -> DataFrame:
    """As read back from the files: doc_id, start, n_tokens, and the CRC-32 of the ids as unsigned 32-bit integers."""
    return index.select("file", "offset", "length", "start").mapInArrow(
        lambda batches: _read(batches, folder, 1, True), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _read(batches: Iterator[pa.RecordBatch], folder: str, n_kept: int, digest: bool) -> Iterator[pa.RecordBatch]:
    files, root = pyarrow.fs.FileSystem.from_uri(f"{folder}/data")
    opened: dict[str, pyarrow.NativeFile] = {}  # the file used last at the end
    for batch in batches:
        out = []
        for row in rows_of([batch]):
            if (data := opened.pop(row[0], None)) is None:
                if len(opened) >= OPEN_FILES:
                    opened.pop(next(iter(opened))).close()
                data = files.open_input_file(f"{root}/{row[0]}")
            opened[row[0]] = data
            data.seek(row[1])
            doc_id, ids = unpack_document(unframe(data.read(row[2])))
            out.append((doc_id, *row[3 : 3 + n_kept], *((len(ids), zlib.crc32(ids.tobytes())) if digest else (ids,))))
        kept = batch.schema.names[3 : 3 + n_kept]
        names = ["doc_id", *kept, *(("n_tokens", "ids_crc32") if digest else ("ids",))]
        types = [pa.int64(), *(batch.schema.field(c).type for c in kept)]
        types += [pa.int64(), pa.int64()] if digest else [pa.list_(pa.int32())]
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)
    for data in opened.values():
        data.close()


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "records")
    write_records(table(spark, sf_dir, "documents"), folder)
    return record_digests(read_index(spark, folder), folder)
