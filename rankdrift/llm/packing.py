"""Harmonic packing of documents into training sequences.

A sequence holds ``CAPACITY`` tokens. A piece of length r belongs to class j = CAPACITY // r, and a bin of class j takes
exactly j pieces, so a worker fills bins by counting, without knowing of other workers. Documents are cut into whole
sequences and a rest. A rest whose class would leave more than 1/``SLACK`` of a bin empty gives up a piece of length
CAPACITY // (j + 1), which fills a bin of class j + 1 almost wholly, until the last piece fits well enough.

What a worker has left over, fewer than j pieces of each class, goes to a second round, where the pieces of all workers
are numbered class by class. Each class then has one bin that isn't full. That bin is cut into sequences whose lengths
are powers of two, which need no padding. Every other sequence is padded to the capacity.

Defined cases: a null text is an empty one, which has the end id alone. A null id is kept. Repeated rows are packed as
rows of their own. An empty table gives no sequences. Columns other than the two named ones are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankdrift.llm.common import batches_of, rows_of, small_batches, table, written
from rankdrift.llm.tokens import END_ID, WordEncoder

CAPACITY, SLACK = 2048, 64
_LISTS = ("doc_ids", "starts", "lengths", "doc_tokens")
_PACKED = pa.schema(
    [("sequence_id", pa.int64()), ("class", pa.int32()), ("part", pa.int32()), ("rank", pa.int32())]
    + [(c, pa.list_(pa.int64())) for c in _LISTS]
    + [("ids", pa.binary())]
)
_SEQUENCE = pa.schema([f for f in _PACKED if f.name not in ("class", "part", "rank")])
_SEQUENCE_DDL = f"sequence_id long, {', '.join(f'{c} array<bigint>' for c in _LISTS)}, ids binary"
_PACKED_DDL = _SEQUENCE_DDL.replace("sequence_id long,", "sequence_id long, class int, part int, rank int,")


def cut(n: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """Lengths of the pieces, in order, into which a document of ``n`` tokens is cut."""
    pieces = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        j = capacity // rest
        piece = rest if (capacity - j * rest) * slack <= capacity else capacity // (j + 1)
        pieces.append(piece)
        rest -= piece
    return pieces


def powers_of_two(n: int) -> list[int]:
    """The powers of two that add up to ``n``, largest first."""
    return [1 << k for k in reversed(range(n.bit_length())) if n >> k & 1]


def _pack_part(batches: Iterator[pa.RecordBatch], end_id: int, capacity: int) -> Iterator[tuple]:
    """Sequences that this task fills (rank null), then the pieces it has left over (sequence id null)."""
    encoder, part, made = WordEncoder(), TaskContext.get().partitionId(), 0
    open_bins: dict[int, list[tuple]] = {}
    for doc_id, text in rows_of(batches):
        ids = encoder.encode_document(text, end_id)
        n, start = len(ids) // encoder.width, 0
        for length in cut(n, capacity):
            piece = (doc_id, start, length, n, ids[start * encoder.width : (start + length) * encoder.width])
            j = capacity // length
            pieces = open_bins.setdefault(j, [])
            pieces.append(piece)
            if len(pieces) == j:
                *lists, content = zip(*open_bins.pop(j), strict=True)
                yield part << 32 | made, j, part, None, *lists, b"".join(content)
                made += 1
            start += length
    for j, pieces in open_bins.items():
        for rank, (*lists, content) in enumerate(pieces):
            yield None, j, part, rank, *([x] for x in lists), content


def _close_bins(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    """Sequences of the bins of the second round; a bin with fewer pieces than its class takes is cut."""
    for j, number, pieces in rows_of(batches):
        sequence_id = 1 << 62 | j << 48 | number << 4
        pieces = [tuple(p[c] for c in ("doc_id", "start", "length", "tokens", "ids")) for p in pieces]
        if len(pieces) == j:
            *lists, content = zip(*pieces, strict=True)
            yield sequence_id, *lists, b"".join(content)
            continue
        pieces.reverse()
        for k, room in enumerate(powers_of_two(sum(p[2] for p in pieces))):
            taken = []
            while room:
                doc_id, start, length, tokens, ids = pieces.pop()
                own = min(length, room)
                taken.append((doc_id, start, own, tokens, ids[: own * width]))
                room -= own
                if own < length:
                    pieces.append((doc_id, start + own, length - own, tokens, ids[own * width :]))
            *lists, content = zip(*taken, strict=True)
            yield sequence_id | k, *lists, b"".join(content)


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, capacity: int = CAPACITY
) -> DataFrame:
    """Sequences: sequence_id, the pieces' doc_ids, starts, lengths and doc_tokens in order, and the ids as bytes.

    Offsets within a sequence follow from the lengths. ``padded_length`` says how long the sequence is to be.
    """
    small_batches(docs.sparkSession)
    width = WordEncoder().width
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    first = written(
        rows.mapInArrow(lambda b: batches_of(_pack_part(b, end_id, capacity), _PACKED), _PACKED_DDL), "packed"
    )
    left = first.where("sequence_id IS NULL").withColumnRenamed("class", "j")
    # A row for each task and class.
    counts = left.groupBy("j", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("j").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("j", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    at = F.col("base") + F.col("rank")
    piece = F.struct(
        (at % F.col("j")).alias("slot"),
        *(F.col(c)[0].alias(n) for c, n in zip(_LISTS, ("doc_id", "start", "length", "tokens"), strict=True)),
        "ids",
    )
    bins = (
        left.join(base, ["j", "part"])
        .select("j", F.expr("(base + rank) div j").alias("number"), piece.alias("piece"))
        .groupBy("j", "number")
        .agg(F.sort_array(F.collect_list("piece")).alias("pieces"))  # the pieces of one bin: a sequence at most
    )
    second = bins.mapInArrow(lambda b: batches_of(_close_bins(b, width), _SEQUENCE), _SEQUENCE_DDL)
    sequences = first.where("sequence_id IS NOT NULL").drop("class", "part", "rank").unionByName(second)
    used = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    return sequences.withColumn("padded_length", F.when(F.bit_count(used) == 1, used).otherwise(F.lit(capacity)))


def piece_digests(sequences: DataFrame, width: int) -> DataFrame:
    """A row for each piece, its CRC-32 taken from the ids that stand in the sequence."""
    schema = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for sequence_id, *lists, ids in rows_of(batches):
            ids, offset = np.frombuffer(ids, f"<u{width}").astype("<u4"), 0
            for doc_id, start, length, tokens in zip(*lists, strict=True):
                crc = zlib.crc32(ids[offset : offset + length].tobytes())
                yield doc_id, start, length, crc, tokens, sequence_id, offset
                offset += length

    return sequences.select("sequence_id", *_LISTS, "ids").mapInArrow(
        lambda b: batches_of(digests(b), schema, 20_000), ", ".join(f"{c} long" for c in schema.names)
    )


def op7_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(pack_documents(table(spark, sf_dir, "documents")), WordEncoder().width)
