"""Keeping the signature table up to date while report files arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rankdrift.operators.minhash import K, minhash_signatures
from rankdrift.schema import RANK_COLUMNS, RankColumns
from rankdrift.sources.signature_table import append_batch, signature_settings


def maintain_signatures(
    facts: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    k: int | None = None,
    pairs: Sequence[tuple[int, int]] | None = None,
    element_id: str = "xxhash64",
    method: str = "functions",
    once: bool = False,
    fan: int = 4,
    cols: RankColumns = RANK_COLUMNS,
) -> StreamingQuery:
    """Add one part to the signature table at ``path`` per micro-batch of ``facts``.

    Each batch is aggregated on its own and merged on reading, so the query keeps no state and needs no watermark.
    Every ``fan`` parts of about the same size are merged, so a day has a few files however many batches there were.
    A stream's parts are named after the query's id, which its checkpoint keeps, and the batch: a batch that is
    replayed after a failure is found to be there, and a stream that starts again with a new checkpoint doesn't touch
    earlier parts. ``once`` stops when the input is used up.
    """
    k = len(pairs) if pairs is not None else K if k is None else k
    settings = signature_settings(k, pairs, element_id, method)

    def add_part(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        signatures = minhash_signatures(batch, k, pairs, element_id, method, cols)
        append_batch(signatures, path, f"{name}-{query}", number, k, settings, fan)

    writer = facts.writeStream.foreachBatch(add_part).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
