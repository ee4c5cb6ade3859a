import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from rankdrift.llm import records
from rankdrift.llm.common import shared_folder
from rankdrift.llm.tokens import vocabulary_path
from tests.llm.conftest import ODD_TEXTS, SF

WHOLE = Tokenizer.from_file(vocabulary_path())


def ids_of(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 1]


def test_digests_against_whole_texts(spark):
    got = sorted(map(tuple, records.op1_token_records(spark, SF).collect()))
    want, start = [], 0
    for doc_id, text in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall():
        ids = ids_of(text)
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_odd_rows_and_shuffled_reads(spark, odd_documents):
    folder = shared_folder(spark, "records")
    records.write_records(odd_documents, folder)
    index = records.read_index(spark, folder)
    rows = records.read_records(index.orderBy("length"), folder).collect()
    assert sorted(len(r.ids) for r in rows) == sorted(len(ids_of(t)) for t in [*ODD_TEXTS, "no id", ODD_TEXTS[6]])
    by_start = sorted(rows, key=lambda r: r.start)
    assert by_start[0].doc_id is None and [r.doc_id for r in by_start[1:]] == [0, 1, 2, 3, 4, 5, 6, 6, 7, 8, 9]
    assert all(b.start == a.start + len(a.ids) for a, b in zip(by_start, by_start[1:]))
    assert by_start[5].ids == ids_of(ODD_TEXTS[4])


def test_empty_table(spark, no_documents):
    folder = shared_folder(spark, "records")
    records.write_records(no_documents, folder)
    assert records.record_digests(records.read_index(spark, folder), folder).count() == 0


def test_a_worker_has_one_encoder():
    """Not one for each task, which would load the vocabulary and learn frequent words anew."""
    records._encoder.cache_clear()
    try:
        encoder = records._encoder()
        encoder.encode("some words")
        assert records._encoder() is encoder
    finally:
        records._encoder.cache_clear()


def test_damage_is_found():
    record = records.frame(b"payload")
    assert records.unframe(record) == b"payload"
    for at in (0, 9, 13, len(record) - 1):
        with pytest.raises(ValueError):
            records.unframe(record[:at] + bytes([record[at] ^ 1]) + record[at + 1 :])
    with pytest.raises(ValueError):
        records.unframe(record[:-1])


def test_an_id_with_many_rows_fills_several_files(spark, tmp_path):
    docs = spark.range(4000).selectExpr("cast(7 AS long) AS doc_id", "concat('text ', id) AS text")
    folder = f"file://{tmp_path}/records"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if rows were large
    try:
        records.write_records(docs, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    index = records.read_index(spark, folder)
    assert index.select("file").distinct().count() > 2
    rows = index.orderBy("start").collect()
    assert rows[0].start == 0 and all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))
    back = records.read_records(index.repartition(3), folder).count()
    assert back == 4000
