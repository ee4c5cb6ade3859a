"""Queries of the operators, one for each, and their SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankdrift.llm.centroids import OP11_SQL, op11_ptolemaic_clusters
from rankdrift.llm.chat import OP6_SQL, op6_chat_format
from rankdrift.llm.complement_packing import op13_complement_packing
from rankdrift.llm.decontamination import op4_pigeonhole_edits
from rankdrift.llm.embeddings import OP10_SQL, op10_itq_hamming
from rankdrift.llm.fill_in_middle import OP12_SQL, op12_wavelet_middle
from rankdrift.llm.language import op2_language_fusion
from rankdrift.llm.main_text import op5_min_cut_text
from rankdrift.llm.near_duplicates import OP9_SQL, op9_minhash_tensored
from rankdrift.llm.packing import op7_harmonic_packing
from rankdrift.llm.pseudonyms import op3_feistel_pseudonyms
from rankdrift.llm.quality import op8_neighbour_quality
from rankdrift.llm.records import op1_token_records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_records": op1_token_records,
    "op2_language_fusion": op2_language_fusion,
    "op3_feistel_pseudonyms": op3_feistel_pseudonyms,
    "op4_pigeonhole_edits": op4_pigeonhole_edits,
    "op5_min_cut_text": op5_min_cut_text,
    "op6_chat_format": op6_chat_format,
    "op7_harmonic_packing": op7_harmonic_packing,
    "op8_neighbour_quality": op8_neighbour_quality,
    "op9_minhash_tensored": op9_minhash_tensored,
    "op10_itq_hamming": op10_itq_hamming,
    "op11_ptolemaic_clusters": op11_ptolemaic_clusters,
    "op12_wavelet_middle": op12_wavelet_middle,
    "op13_complement_packing": op13_complement_packing,
}
#: SQL expresses neither tokens, records and bins nor Feistel networks, fits, cuts and edit distances.
ORACLES: dict[str, str] = {
    "op6_chat_format": OP6_SQL,
    "op9_minhash_tensored": OP9_SQL,
    "op10_itq_hamming": OP10_SQL,
    "op11_ptolemaic_clusters": OP11_SQL,
    "op12_wavelet_middle": OP12_SQL,
}
