import zlib
from collections import defaultdict

import duckdb
import numpy as np
from tokenizers import Tokenizer

from rankdrift.llm import packing
from rankdrift.llm.tokens import vocabulary_path
from tests.llm.conftest import ODD_TEXTS, SF

WHOLE = Tokenizer.from_file(vocabulary_path())


def ids_of(text):
    return np.array([*WHOLE.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check(pieces, texts):
    """Every id lies in one piece, sequences are gapless; returns the share of padding."""
    per_doc, per_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        per_doc[p.doc_id].append(p)
        per_sequence[p.sequence_id].append(p)
    assert set(per_doc) == set(texts)
    for doc_id, own in per_doc.items():
        ids, at = ids_of(texts[doc_id]), 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    used = padded = 0
    for own in per_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        used += at
        padded += at if at & (at - 1) == 0 else 2048
    return 1 - used / max(padded, 1)


def test_pieces_of_whole_table(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    assert check(packing.op7_harmonic_packing(spark, SF).collect(), texts) < 0.02


def test_odd_rows(spark, odd_documents):
    docs = odd_documents.dropDuplicates(["doc_id"])
    texts = dict(enumerate(ODD_TEXTS)) | {None: "no id"}
    assert check(packing.piece_digests(packing.pack_documents(docs), 2).collect(), texts) < 0.02
    whole = packing.pack_documents(odd_documents)
    assert packing.piece_digests(whole, 2).where("doc_id = 6 AND start = 0").count() == 2
    assert whole.where("padded_length NOT IN (2048, 1024, 512, 256, 128, 64, 32, 16, 8, 4, 2, 1)").count() == 0


def test_empty_table(spark, no_documents):
    assert packing.pack_documents(no_documents).count() == 0


def test_cut():
    for n in range(1, 5000):
        pieces = packing.cut(n)
        assert sum(pieces) == n and min(pieces) > 0
        assert all(2048 - 2048 // p * p <= 32 + 2048 // p for p in pieces)
    assert packing.powers_of_two(13) == [8, 4, 1]
