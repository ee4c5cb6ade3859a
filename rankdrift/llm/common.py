"""Folders and tables that the operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdrift.session import remove


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which all machines of a cluster share.

    Only a local session without that setting gets a folder of its own; a cluster session gets an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="rankdrift-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Bytes in an Arrow batch, so that long texts don't fill a worker.
MOST_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Let the session send at most ``MOST_BYTES`` to Python workers at once; a lower setting stays."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(setting, None)
    if now is None or not now.rstrip("b").isdigit() or int(now.rstrip("b")) > MOST_BYTES:
        spark.conf.set(setting, MOST_BYTES)


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: computed once, and safe from lost executors.

    Without ``keep`` it is removed at the end of a ``tables_removed`` block that it was written in.
    """
    path = shared_folder(df.sparkSession, name)
    made = _made.get()
    if made is not None and not keep:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def tables_removed(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that ``written`` made within the block, whose results must have been written by its end."""
    token = _made.set([])
    try:
        yield
    finally:
        for folder in _made.get():
            remove(spark, folder)
        _made.reset(token)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of record batches as tuples. Few of them are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from zip(*(column.to_pylist() for column in batch.slice(at, 256).columns), strict=True)


def batches_of(rows: Iterator[tuple], schema: pa.Schema, most: int = 2000, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of ``rows``, each with ``most`` rows or about ``most_bytes`` of strings and bytes at most."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (str, bytes)))
        if len(held) >= most or size >= most_bytes:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, lower-cased from A to Z and parted by ASCII white space."""
    return (text or "").encode().lower().split()


#: A key is frequent from this share of the rows and this number of rows on: fewer than 1,000 keys are.
FREQUENT, LEAST_FREQUENT = 1000, 256


def looked_up(rows: DataFrame, key: str, other: str, values: DataFrame) -> DataFrame:
    """``rows`` with the value of their ``key`` as column value. ``values`` has a row (node, value, degree) for each key.

    Frequent keys, by degree, are looked up in a broadcast of fewer than ``FREQUENT`` rows. In the join their rows are
    dealt by ``other``, so no task gets all rows of one key.
    """
    most = max(rows.count() // FREQUENT, LEAST_FREQUENT)
    frequent = values.where(F.col("degree") > most).select(F.col("node").alias(key), F.col("value").alias("of_frequent"))
    rows = rows.join(F.broadcast(frequent), key, "left")
    rows = rows.withColumn("node", F.when(F.col("of_frequent").isNull(), F.col(key)).otherwise(F.col(other)))
    rows = rows.join(values.select("node", "value"), "node", "left")
    return rows.withColumn("value", F.coalesce("of_frequent", "value")).drop("node", "of_frequent")


def components(links: DataFrame) -> DataFrame:
    """The connected components of ``links`` (a, b: long): a row (node, component) for each node, component its least node.

    Each round every node takes the least label within two steps, and the graph is contracted to these labels. Labels
    are hashed anew each round (one-to-one, as the hash of a 64-bit number is), so chains of rising ids, too, shrink by
    a constant factor. Rounds are tables in the shared folder; nothing but a count comes to the driver. Hubs, and labels of
    many nodes, are spread (``looked_up``).
    """
    hashed = lambda c: F.xxhash64(F.col(c))
    degree = F.count("*").alias("degree")
    links = links.where("a <> b")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nodes = written(both.distinct(), "links")
    edges = nodes.select(hashed("a").alias("u"), hashed("b").alias("v"))
    steps = []
    while not edges.isEmpty():
        one = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("value"), degree)
        one = written(one.withColumn("value", F.least("node", "value")), "least")
        two = looked_up(edges, "v", "u", one).groupBy(F.col("u").alias("node")).agg(F.min("value").alias("value"), degree)
        steps.append(step := written(two, "step"))
        step = step.withColumn("value", hashed("value"))
        half = written(looked_up(edges, "u", "v", step).select("v", F.col("value").alias("u")), "half")
        moved = looked_up(half, "v", "u", step).select("u", F.col("value").alias("v"))
        edges = written(moved.where("u <> v").distinct(), "edges")
    label = nodes.select(F.col("a").alias("node")).distinct().select(F.col("node").alias("id"), hashed("node").alias("label"))
    label = written(label, "labels")
    for step in steps:
        sizes = label.groupBy(F.col("label").alias("node")).agg(degree)
        values = sizes.join(step.select("node", "value"), "node", "left").withColumn("value", F.xxhash64(F.coalesce("value", "node")))
        label = written(looked_up(label, "label", "id", values).select("id", F.col("value").alias("label")), "labels")
    least = label.groupBy(F.col("label").alias("node")).agg(F.min("id").alias("value"), degree)
    return looked_up(label, "label", "id", least).select(F.col("id").alias("node"), F.col("value").alias("component"))
