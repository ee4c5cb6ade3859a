"""Best-fit packing by exact complements: as few sequences as possible, only documents beyond the capacity cut.

Documents longer than ``CAPACITY`` are cut into whole sequences and a rest; the others stay whole. So there is at most one
length for each token up to the capacity, and all that matters about the pieces is how many there are of each length.

``plan`` fills sequences from such counts. It takes the longest length left and looks for lengths that fill the gap
exactly: one, then two, then three of them, longest first, from an index of the sums of two lengths that are
available. Where none do, the longest length that fits goes in (best fit) and the gap that is left is looked up again. A
filling is repeated as often as the counts allow, which uses up a length nearly every time. So a plan has a few
fillings for each length, however many pieces there are.

Spark packs in two rounds. Each task packs blocks of ``BLOCK`` bytes of its pieces and keeps only sequences that are exactly
full, which no other choice can beat. What it can't fill waits for more of its pieces, and what is left at its end
goes to the second round, which sees the pieces of all tasks: Spark counts them by length, the driver plans these counts (at
most ``CAPACITY`` numbers), and each piece, numbered within its length, looks up its sequence in the plan.

Defined cases: a null text is an empty one, which has the end id alone. A null id is kept. Repeated rows are packed as
rows of their own. An empty table gives no sequences. Columns other than the two named ones are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankdrift.llm.common import batches_of, rows_of, small_batches, table, written
from rankdrift.llm.tokens import END_ID, WordEncoder

CAPACITY = 4096
#: Bytes of ids that a task packs at once, and that it keeps for a later block; beyond that they go to the second round.
BLOCK, KEPT = 8 << 20, 16 << 20
_LISTS = ("doc_ids", "pieces", "starts", "lengths")
_PACKED = pa.schema(
    [("sequence_id", pa.int64()), ("part", pa.int32()), ("length", pa.int32()), ("rank", pa.int32())]
    + [(c, pa.list_(pa.int64())) for c in _LISTS]
    + [("ids", pa.binary())]
)
_SEQUENCE_DDL = f"sequence_id long, {', '.join(f'{c} array<bigint>' for c in _LISTS)}, ids binary"
_PACKED_DDL = _SEQUENCE_DDL.replace("sequence_id long,", "sequence_id long, part int, length int, rank int,")


class _Lengths:
    """How many pieces of each length there are, and which sums they can make."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.number = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.number[length] = n
        self.there = self.number > 0
        #: Bit s: two lengths may add up to s. Lengths only get fewer, so a sum that fails is struck out for good.
        self._pairs, singles = 0, 0
        available = np.flatnonzero(self.there).tolist()
        for length in available:
            singles |= 1 << length
        for length in available:
            self._pairs |= singles << length
        self._pairs &= (1 << capacity + 1) - 1

    def take(self, length: int, n: int = 1) -> None:
        self.number[length] -= n
        self.there[length] = self.number[length] > 0

    def pair(self, total: int) -> tuple[int, int] | None:
        """The two available lengths, the first as long as possible, that add up to ``total``."""
        if not self._pairs >> total & 1:
            return None
        least = (total + 1) // 2
        both = self.there[least:total] & self.there[total - least : 0 : -1]
        if total % 2 == 0 and self.number[least] < 2:
            both[:1] = False
        found = np.flatnonzero(both)
        return (least + int(found[-1]), total - least - int(found[-1])) if len(found) else None

    def strike(self, total: int) -> None:
        self._pairs &= ~(1 << total)

    def triple(self, total: int) -> tuple[int, int, int] | None:
        for a in np.flatnonzero(self.there[: total - 1])[::-1].tolist():
            if 3 * a < total:
                return None
            if not self._pairs >> (total - a) & 1:
                continue
            self.take(a)
            rest = self.pair(total - a)
            self.take(a, -1)
            if rest and rest[0] <= a:
                return a, *rest
        return None

    def exactly(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that fill the gap."""
        if self.there[gap]:
            return (gap,)
        return self.pair(gap) or self.triple(gap)


def plan(counts: dict[int, int], capacity: int = CAPACITY, only_full: bool = False) -> Iterator[tuple[dict[int, int], int]]:
    """Fillings, as lengths with their numbers, and how many sequences to fill that way.

    With ``only_full`` just those that leave no gap; lengths that aren't used up are left over.
    """
    left = _Lengths(counts, capacity)
    for longest in sorted(counts, reverse=True):
        while left.number[longest] > 0:
            filling: dict[int, int] = {}

            def put(length: int) -> None:
                left.take(length)
                filling[length] = filling.get(length, 0) + 1

            put(longest)
            gap = capacity - longest
            while gap:
                lengths = left.exactly(gap)
                if lengths is None:
                    fitting = np.flatnonzero(left.there[: gap + 1])
                    if not len(fitting):
                        break
                    lengths = (int(fitting[-1]),)
                for length in lengths:
                    put(length)
                gap -= sum(lengths)
            if gap and only_full:
                for length, n in filling.items():
                    left.take(length, -n)
                break
            again = min(int(left.number[length]) // n for length, n in filling.items())
            for length, n in filling.items():
                left.take(length, n * again)
            yield filling, again + 1


def _pack_part(batches: Iterator[pa.RecordBatch], end_id: int, capacity: int, block: int, kept: int) -> Iterator[tuple]:
    """Full sequences of this task, then the pieces it has left over (sequence id null)."""
    encoder, part = WordEncoder(), TaskContext.get().partitionId()
    width = encoder.width
    waiting: dict[int, list[tuple]] = {}
    held = fresh = made = 0
    ranks: dict[int, int] = {}

    def sequence(pieces: list[tuple]) -> tuple:
        nonlocal made
        *lists, content = zip(*pieces, strict=True)
        made += 1
        return part << 32 | made - 1, part, None, None, *lists, b"".join(content)

    def full() -> Iterator[tuple]:
        nonlocal held
        for filling, n in plan({length: len(pieces) for length, pieces in waiting.items()}, capacity, only_full=True):
            for _ in range(n):
                yield sequence([waiting[length].pop() for length, m in filling.items() for _ in range(m)])
            held -= capacity * width * n
        for length in [length for length, pieces in waiting.items() if not pieces]:
            del waiting[length]

    def given_up() -> Iterator[tuple]:
        nonlocal held
        for length, pieces in waiting.items():
            for piece in pieces:
                ranks[length] = ranks.get(length, -1) + 1
                *facts, content = piece
                yield None, part, length, ranks[length], *([x] for x in facts), content
        waiting.clear()
        held = 0

    for doc_id, text in rows_of(batches):
        ids = encoder.encode_document(text, end_id)
        n = len(ids) // width
        for number, start in enumerate(range(0, n, capacity)):
            length = min(capacity, n - start)
            piece = (doc_id, number, start, length, ids[start * width : (start + length) * width])
            if length == capacity:
                yield sequence([piece])
                continue
            waiting.setdefault(length, []).append(piece)
            held, fresh = held + length * width, fresh + length * width
        if fresh >= block:
            yield from full()
            fresh = 0
            if held > kept:
                yield from given_up()
    yield from full()
    yield from given_up()


class Placement:
    """Where the pieces of a plan go, by length and number; as large as the plan."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self._from: dict[int, list[int]] = {}
        self._to: dict[int, list[tuple[int, int, int]]] = {}
        used, sequences = dict.fromkeys(counts, 0), 0
        for filling, n in plan(counts, capacity):
            slot = 0
            for length, m in filling.items():
                self._from.setdefault(length, []).append(used[length])
                self._to.setdefault(length, []).append((sequences, slot, m))
                used[length] += n * m
                slot += m
            sequences += n
        self.sequences = sequences

    def of(self, length: int, number: int) -> tuple[int, int]:
        """The sequence and the place in it of the piece with this number among those of its length."""
        k = bisect_right(self._from[length], number) - 1
        first, slot, m = self._to[length][k]
        sequence, copy = divmod(number - self._from[length][k], m)
        return first + sequence, slot + copy


def pack_by_complements(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    block: int = BLOCK,
    kept: int = KEPT,
) -> DataFrame:
    """Sequences: sequence_id, the pieces' doc_ids, pieces (numbers within their documents), starts and lengths in order, and the ids as bytes.

    Offsets within a sequence follow from the lengths.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    first = written(
        rows.mapInArrow(lambda b: batches_of(_pack_part(b, end_id, capacity, block, kept), _PACKED), _PACKED_DDL), "full"
    )
    left = first.where("sequence_id IS NULL")
    # A row for each task and length.
    counts = written(left.groupBy("length", "part").agg(F.count("*").alias("n")), "left")
    # A row for each length.
    by_length = {r["length"]: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    placement = spark.sparkContext.broadcast(Placement(by_length, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = placement.value.of
        for batch in batches:
            numbers = zip(batch.column("length").to_pylist(), batch.column("number").to_pylist(), strict=True)
            at = [where(length, number) for length, number in numbers]
            ids = pa.array([1 << 62 | s for s, _ in at], pa.int64())
            slots = pa.array([slot for _, slot in at], pa.int32())
            rest = [batch.column(c) for c in (*_LISTS, "ids")]
            yield pa.RecordBatch.from_arrays([ids, slots, *rest], ["sequence_id", "slot", *_LISTS, "ids"])

    numbered = left.join(base, ["length", "part"]).select("length", (F.col("base") + F.col("rank")).alias("number"), *_LISTS, "ids")
    pieces = numbered.mapInArrow(placed, _SEQUENCE_DDL.replace("sequence_id long,", "sequence_id long, slot int,"))
    # The pieces of one sequence.
    gathered = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("slot", *(F.col(c)[0].alias(c) for c in _LISTS), "ids"))).alias("p"))
    joined = F.aggregate("p.ids", F.lit(b""), lambda a, x: F.concat(a, x))
    second = gathered.select("sequence_id", *(F.col(f"p.{c}").alias(c) for c in _LISTS), joined.alias("ids"))
    return first.where("sequence_id IS NOT NULL").select("sequence_id", *_LISTS, "ids").unionByName(second)


def piece_digests(sequences: DataFrame, width: int) -> DataFrame:
    """A row for each piece, its CRC-32 taken from the ids that stand in the sequence."""
    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    schema = pa.schema([(c, pa.int64()) for c in columns])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for sequence_id, *lists, ids in rows_of(batches):
            ids, offset = np.frombuffer(ids, f"<u{width}").astype("<u4"), 0
            for doc_id, piece, start, length in zip(*lists, strict=True):
                crc = zlib.crc32(ids[offset : offset + length].tobytes())
                yield doc_id, piece, start, length, crc, sequence_id, offset
                offset += length

    found = sequences.select("sequence_id", *_LISTS, "ids").mapInArrow(
        lambda b: batches_of(digests(b), schema, 20_000), ", ".join(f"{c} long" for c in columns)
    )
    return found.withColumn("piece", F.col("piece").cast("int"))


def op13_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(pack_by_complements(table(spark, sf_dir, "documents")), WordEncoder().width)
