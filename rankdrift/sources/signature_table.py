"""The signature table: partial signatures that are merged when read.

Every batch of rank facts adds its own small part, in the folder ``part=<name>`` and there by date. Because a signature is a
minimum, parts may overlap, repeat or arrive late without changing the result, and a batch that is run again just
replaces its own part. Each row says with which settings it was made; signatures of different settings can't be
merged, and reading them together is an error.

A stream's parts are numbered: ``<stream>~<first batch>~<last batch>``. When ``fan`` parts of about the same size stand at
its end they are merged into one, and so on upwards, so that n batches leave about ``fan`` * log n parts, and each
signature is written again log n times. A part counts once its write is committed (Spark's ``_SUCCESS`` file), and one
that lies within another isn't read any more. It is removed when the stream merges next, so readers that had
already started can finish.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankdrift.functions.hashing import coefficients
from rankdrift.operators.cleaning import date_range
from rankdrift.operators.minhash import K, merge_signature_rows
from rankdrift.schema import SIGNATURE_SCHEMA
from rankdrift.session import exists, folder_names, remove

SETTINGS, PART = "settings", "part"
TABLE_SCHEMA = T.StructType(
    [*SIGNATURE_SCHEMA, T.StructField(SETTINGS, T.StringType(), False), T.StructField(PART, T.StringType(), False)]
)


def signature_settings(
    k: int | None = None,
    pairs: Sequence[tuple[int, int]] | None = None,
    element_id: str = "xxhash64",
    method: str = "functions",
) -> str:
    """The settings of ``minhash_signatures`` as text, coefficients by their fingerprint."""
    k = len(pairs) if pairs is not None else K if k is None else k
    used = [] if method == "bins" else list(map(tuple, coefficients(k) if pairs is None else pairs))
    fingerprint = hashlib.md5(repr(used).encode()).hexdigest()[:12]
    return f"k={k} id={element_id} method={method} coefficients={fingerprint}"


@dataclass(frozen=True)
class Part:
    """A part of the table; ``stream``, ``first`` and ``last`` are None for one that isn't a stream's."""

    name: str
    stream: str | None = None
    first: int | None = None
    last: int | None = None

    @classmethod
    def of(cls, name: str) -> Part:
        numbered = re.fullmatch(r"(.+)~(\d{12})~(\d{12})", name)
        return cls(name, numbered[1], int(numbered[2]), int(numbered[3])) if numbered else cls(name)

    @classmethod
    def of_stream(cls, stream: str, first: int, last: int) -> Part:
        return cls(f"{stream}~{first:012d}~{last:012d}", stream, first, last)

    def holds(self, other: Part) -> bool:
        """Whether the other one's batches are all in this part."""
        return self.stream is not None and self.stream == other.stream and self.first <= other.first and other.last <= self.last

    def tier(self, fan: int) -> int:
        """How often the number of batches can be divided by ``fan``, about."""
        batches, tier = self.last - self.first + 1, 0
        while batches >= fan:
            batches, tier = batches // fan, tier + 1
        return tier


def committed_parts(spark: SparkSession, path: str) -> list[Part]:
    """All parts whose write is complete; there are few, as parts are merged."""
    names = [name.removeprefix(f"{PART}=") for name in folder_names(spark, path) if name.startswith(f"{PART}=")]
    return [Part.of(name) for name in names if exists(spark, f"{path}/{PART}={name}/_SUCCESS")]


def live_parts(parts: Sequence[Part]) -> list[Part]:
    """The parts to be read: those that don't lie within another."""
    return [p for p in parts if not any(other != p and other.holds(p) for other in parts)]


def write_signature_part(signatures: DataFrame, path: str, part: str, settings: str | None = None) -> None:
    """Add the part named ``part``, or replace it as a whole. A date has one file in a part."""
    if not re.fullmatch(r"[\w.~+-]+", part):
        raise ValueError("the name of a part has letters, digits and . ~ + - _ only")
    rows = signatures.withColumn(SETTINGS, F.lit(settings or signature_settings()))
    # A date has a row for each device. The marker says that a part is complete.
    writer = rows.repartition("crawl_date").write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    writer.partitionBy("crawl_date").parquet(f"{path}/{PART}={part}")


def _stored(spark: SparkSession, path: str, parts: Sequence[Part]) -> DataFrame:
    """The rows of these parts."""
    if not parts:
        return spark.createDataFrame([], TABLE_SCHEMA)
    reader = spark.read.schema(TABLE_SCHEMA).option("basePath", path)
    return reader.parquet(*(f"{path}/{PART}={p.name}" for p in parts))


def _merged(rows: DataFrame, k: int, wanted: str) -> DataFrame:
    stop = F.raise_error(F.concat(F.lit(f"signatures made with other settings than {wanted}: "), F.col(SETTINGS)))
    same = rows.where(F.when(F.col(SETTINGS) == wanted, True).otherwise(stop.cast("boolean")))
    return merge_signature_rows(same.select(*SIGNATURE_SCHEMA.names), k)


def read_signatures(
    spark: SparkSession, path: str, k: int = K, start=None, end=None, settings: str | None = None
) -> DataFrame:
    """One merged signature per date and device, of the given or default settings.

    A bound on the dates prunes partitions. A row of other settings within the bounds is an error.
    """
    parts = live_parts(committed_parts(spark, path))
    return _merged(date_range(_stored(spark, path, parts), start, end), k, settings or signature_settings(k))


def append_batch(signatures: DataFrame, path: str, stream: str, number: int, k: int = K, settings: str | None = None, fan: int = 4) -> None:
    """Add the signatures of a stream's batch ``number`` and merge parts that have become many.

    A batch that is already there, also within a merged part, is left alone: a stream gives a batch the same rows again.
    """
    spark, part = signatures.sparkSession, Part.of_stream(stream, number, number)
    if any(p.holds(part) for p in committed_parts(spark, path)):
        return
    write_signature_part(signatures, path, part.name, settings)
    merge_parts(spark, path, stream, k, settings, fan)


def merge_parts(spark: SparkSession, path: str, stream: str, k: int = K, settings: str | None = None, fan: int = 4) -> None:
    """Merge the last parts of a stream as long as ``fan`` of them are of about the same size."""
    if fan < 2:
        raise ValueError("merge two parts at least")
    while True:
        parts = [p for p in committed_parts(spark, path) if p.stream == stream]
        live = sorted(live_parts(parts), key=lambda p: p.first)
        last = live[-fan:]
        if len(last) < fan or len({p.tier(fan) for p in last}) > 1:
            return
        whole = Part.of_stream(stream, last[0].first, last[-1].last)
        merged = _merged(_stored(spark, path, last), k, settings or signature_settings(k))
        write_signature_part(merged, path, whole.name, settings or signature_settings(k))
        for part in set(parts) - set(live):  # within another part since the merge before
            remove(spark, f"{path}/{PART}={part.name}")


def compact_signatures(
    spark: SparkSession, path: str, new_path: str, k: int = K, settings: str | None = None
) -> None:
    """Write the merged signatures as the only part of a new table.

    To swap it in while a stream writes to the old table: stop the stream, compact, start the stream again on the new
    table with the same checkpoint. Parts that were written meanwhile can also be copied over afterwards, as merging
    the same signatures twice changes nothing.
    """
    merged = read_signatures(spark, path, k, settings=settings)
    write_signature_part(merged, new_path, "merged", settings or signature_settings(k))
