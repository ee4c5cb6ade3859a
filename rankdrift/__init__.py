"""Analyses of daily search-rank reports as plain Spark DataFrame jobs."""

from rankdrift.functions.signatures import merge_signatures, signature_similarity
from rankdrift.operators.cleaning import (
    clean_ranks,
    date_range,
    drop_duplicate_keys,
    duplicate_keys,
    fill_location,
)
from rankdrift.operators.compare import estimate_error, estimate_vs_exact
from rankdrift.operators.exact import (
    distinct_elements,
    exact_similarity,
    pairwise_exact_similarity,
    sketch_similarity,
)
from rankdrift.operators.minhash import (
    compat_modulus,
    compat_signatures,
    merge_signature_rows,
    minhash_signatures,
    minhash_similarity,
    pairwise_signature_similarity,
    signature_pairs,
)
from rankdrift.operators.top_spot import (
    departure_counts,
    departure_days,
    departure_days_anti_join,
    prev_day_url,
    top_spot_changes,
    top_spot_departures,
)
from rankdrift.operators.urls import top_urls, url_counts
from rankdrift.plans.report import analyses, report_lines, run_report, similarity_report
from rankdrift.schema import DEVICES, RANK_COLUMNS, RANK_SCHEMA, SIGNATURE_SCHEMA, RankColumns
from rankdrift.session import tune
from rankdrift.sources.csv_report import bad_rows, good_rows, read_rank_csv, stream_rank_csv
from rankdrift.sources.rank_table import (
    load_ranks,
    read_rank_table,
    upsert_rank_table,
    write_rank_table,
)
from rankdrift.sources.signature_table import (
    compact_signatures,
    read_signatures,
    signature_settings,
    write_signature_part,
)
from rankdrift.streaming.signatures import maintain_signatures
from rankdrift.operators.compare import estimate_intervals
from rankdrift.operators.similar_sets import SimilarSets, every_pair, similar_sets
from rankdrift.operators.top_spot import crawl_days, top_spot_runs
from rankdrift.sources.batch_table import read_batch_table, remove_superseded, upsert_batch
from rankdrift.sources.rank_table import LoadCounts, find_ranks, load_rank_table
from rankdrift.sources.sketch_table import day_sketches, distinct_estimate, frequent_urls, read_day_sketches, write_day_sketches

__all__ = [
    "DEVICES",
    "LoadCounts",
    "RANK_COLUMNS",
    "RANK_SCHEMA",
    "RankColumns",
    "SIGNATURE_SCHEMA",
    "SimilarSets",
    "analyses",
    "bad_rows",
    "clean_ranks",
    "compact_signatures",
    "compat_modulus",
    "compat_signatures",
    "crawl_days",
    "date_range",
    "day_sketches",
    "departure_counts",
    "departure_days",
    "departure_days_anti_join",
    "distinct_elements",
    "distinct_estimate",
    "drop_duplicate_keys",
    "duplicate_keys",
    "estimate_error",
    "estimate_intervals",
    "estimate_vs_exact",
    "every_pair",
    "exact_similarity",
    "fill_location",
    "find_ranks",
    "frequent_urls",
    "good_rows",
    "load_rank_table",
    "load_ranks",
    "maintain_signatures",
    "merge_signature_rows",
    "merge_signatures",
    "minhash_signatures",
    "minhash_similarity",
    "pairwise_exact_similarity",
    "pairwise_signature_similarity",
    "prev_day_url",
    "read_batch_table",
    "read_day_sketches",
    "read_rank_csv",
    "read_rank_table",
    "read_signatures",
    "remove_superseded",
    "report_lines",
    "run_report",
    "signature_pairs",
    "signature_settings",
    "signature_similarity",
    "similar_sets",
    "similarity_report",
    "sketch_similarity",
    "stream_rank_csv",
    "top_spot_changes",
    "top_spot_departures",
    "top_spot_runs",
    "top_urls",
    "tune",
    "upsert_batch",
    "upsert_rank_table",
    "url_counts",
    "write_day_sketches",
    "write_rank_table",
    "write_signature_part",
]
