"""

The queries read the ``events`` table, and some ``lineitem``, as rank facts
(``plans/views.py``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdrift.functions.hashing import (
    COMPAT_COEFFICIENTS,
    coefficients,
    compat_hash,
    element_text,
    md5_id,
    string_hash32,
)
from rankdrift.functions.signatures import merge_signatures
from rankdrift.operators import cleaning, compare, exact, minhash, similar_sets, top_spot, urls
from rankdrift.plans import report
from rankdrift.plans.views import (
    DAY_LEADERS,
    PARTS_BY_YEAR,
    RESULT_LISTS,
    SHIPMENTS_BY_DAY,
    SHIPMENTS_BY_MONTH,
    WEEKLY,
    day_leaders,
    part_sales,
    rank_facts,
    rank_facts_of,
    result_lists,
    shipments,
    wide_rank_facts,
)
from rankdrift.schema import RANK_COLUMNS, RANK_TABLE_NAME, SIGNATURE_TABLE_NAME, RankColumns
from rankdrift.session import scratch_dir, tune
from rankdrift.sources import batch_table, csv_report, rank_table, signature_table, sketch_table
from rankdrift.streaming.signatures import maintain_signatures

# The training-data operators and their pipeline may be absent; everything else works without them.
try:
    from rankdrift.llm import queries as llm
except ImportError:
    llm = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

COLS = RANK_COLUMNS.all
K = minhash.K
COMPAT_MODULUS = 1009
START, END = "2024-01-08", "2024-01-14"
# Keywords as the compared sets: more than two of them, unlike devices.
BY_KEYWORD = RankColumns(subject=("market", "loc"), group="keyword")
DEVICES = ("desktop", "smartphone")
# Percent points by which an estimate may differ from the exact similarity: four standard errors of 100 hash functions,
# or of a sketch of 256 entries, and one for cutting off.
LEAST_SIMILAR = 50
MINHASH_BOUND, SKETCH_ENTRIES, SKETCH_BOUND = 21, 8, 14
# Four standard errors of a HyperLogLog sketch of 2 ** 14 registers.
DISTINCT_BOUND = 0.026


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_ranks(rank_facts(spark, sf_dir), ["event_id"])


def _signature_text(signatures: DataFrame) -> DataFrame:
    return signatures.select("crawl_date", "device", F.array_join("sig", ",").alias("sig"))


def _csv_copy(spark: SparkSession, sf_dir: str) -> str:
    """The rank facts as CSV report files with padded ranks and URLs."""
    path = scratch_dir(spark, "csv")
    padded = rank_facts(spark, sf_dir).select(
        F.col("keyword").alias("Keyword"),
        F.col("market").alias("Market"),
        F.col("loc").alias("Location"),
        F.col("device").alias("Device"),
        F.col("crawl_date").alias("Crawl Date"),
        F.concat(F.lit(" "), "rank").alias("Rank"),
        F.concat(F.lit(" "), "url", F.lit(" ")).alias("URL"),
    )
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    padded.write.options(header=True, **options).csv(path)
    return path


# Sources and the rank table


def csv_report_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_table.load_ranks(spark, csv=_csv_copy(spark, sf_dir))


# By event_id % 8: a year for a date, a date without zeros, rank 0, an eighth field, a line break within quotes.
_REPORT_LINE = """
  concat(if(event_id % 8 = 4, '"', ''), keyword, if(event_id % 8 = 4, '\\n"', ''), ',', market, ',', coalesce(loc, ''), ',', device, ',',
    CASE event_id % 8 WHEN 0 THEN date_format(crawl_date, 'yyyy') WHEN 1 THEN date_format(crawl_date, 'yyyy-M-d')
                      ELSE cast(crawl_date AS string) END, ',',
    if(event_id % 8 = 2, 0, rank), ',', url, if(event_id % 8 = 3, ',x', ''))"""


def _judged_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank facts as report lines, of which five in eight are bad, read again."""
    path = scratch_dir(spark, "lines")
    header = spark.range(1).selectExpr("'Keyword,Market,Location,Device,Crawl Date,Rank,URL' AS line")
    header.write.text(f"{path}/0")
    rank_facts(spark, sf_dir).selectExpr(f"{_REPORT_LINE} AS line").write.text(f"{path}/1")
    options = csv_report.CSV_OPTIONS | {"header": "false"}
    text = spark.read.options(**options).schema(csv_report.TEXT_SCHEMA).csv(f"{path}/*")
    return csv_report.parse_rows(text, on_bad="keep")


def csv_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_report.good_rows(_judged_report(spark, sf_dir))


def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of which one has keywords of two lines and quotes, read whole, and the others split."""
    path, facts = scratch_dir(spark, "reports"), rank_facts(spark, sf_dir)
    broken = F.concat("keyword", F.lit('\n"'), "market", F.lit('"'))
    for name, rows, keyword in (("0", "event_id % 3 = 0", broken), ("1", "event_id % 3 > 0", F.col("keyword"))):
        some = facts.where(rows).select(*(keyword.alias(c) if c == "keyword" else c for c in COLS))
        some.write.options(header=True, escape='"').csv(f"{path}/{name}")
    return csv_report.read_rank_csv(spark, f"{path}/*", line_breaks=True)


def csv_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many bad rows there are, the header among them."""
    return csv_report.bad_rows(_judged_report(spark, sf_dir)).agg(F.count("*").alias("n"))


def csv_bad_row_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bad rows as they stand in the files, the header among them."""
    return csv_report.bad_rows(_judged_report(spark, sf_dir)).select(F.col(csv_report.BAD_ROW).alias("line"))


def rank_table_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_dir(spark, RANK_TABLE_NAME)
    rank_table.write_rank_table(_clean(spark, sf_dir), table)
    return rank_table.load_ranks(spark, table=table)


def date_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_dir(spark, RANK_TABLE_NAME)
    rank_table.write_rank_table(_clean(spark, sf_dir), table)
    return rank_table.read_rank_table(spark, table, START, END)


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Morning crawls first, then the afternoon ones of every other day on top of them."""
    return _upserted(spark, rank_facts(spark, sf_dir))


def _upserted(spark: SparkSession, facts: DataFrame) -> DataFrame:
    table = scratch_dir(spark, RANK_TABLE_NAME)
    rank_table.upsert_rank_table(facts.where("hour(ts) < 12"), table, ["event_id"])
    rank_table.upsert_rank_table(facts.where("hour(ts) >= 12 AND day(ts) % 2 = 0"), table, ["event_id"])
    return rank_table.read_rank_table(spark, table)


def batch_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same crawls, in batches that are never overwritten, after a batch that was given up."""
    table, facts = scratch_dir(spark, RANK_TABLE_NAME), rank_facts(spark, sf_dir)
    batch_table.upsert_batch(facts.where("hour(ts) < 12"), table, ["event_id"])
    batch_table.write_rows(_clean(spark, sf_dir), table, batch_table.next_batch(spark, table))
    batch_table.upsert_batch(facts.where("hour(ts) >= 12 AND day(ts) % 2 = 0"), table, ["event_id"])
    return batch_table.read_batch_table(spark, table)


def batch_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_dir(spark, RANK_TABLE_NAME)
    batch_table.upsert_batch(_clean(spark, sf_dir), table)
    return batch_table.read_batch_table(spark, table, START, END)


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a report with bad rows and repeated keys left in the table, counted while it was written."""
    counts = rank_table.load_rank_table(_judged_report(spark, sf_dir), scratch_dir(spark, RANK_TABLE_NAME))
    return spark.createDataFrame(
        [counts], "rows long, bad_rows long, days long, first_day date, last_day date, keys long, repeated_keys long"
    )


def loaded_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_dir(spark, RANK_TABLE_NAME)
    rank_table.load_rank_table(wide_rank_facts(spark, sf_dir), table, ["event_id"])
    return rank_table.read_rank_table(spark, table)


def _lookup_table(spark: SparkSession, sf_dir: str) -> str:
    table = scratch_dir(spark, RANK_TABLE_NAME)
    clean = cleaning.clean_ranks(wide_rank_facts(spark, sf_dir), ["event_id"])
    rank_table.write_rank_table(clean, table, lookup=("keyword", "url"))
    return table


def keyword_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_table.find_ranks(spark, _lookup_table(spark, sf_dir), keywords=("kw7", "kw11"), start=START)


def url_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_table.find_ranks(spark, _lookup_table(spark, sf_dir), urls=("site3.example/4",))


def _some_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank facts without every fourth day, on which nothing was crawled."""
    return rank_facts(spark, sf_dir).where("day(crawl_date) % 4 <> 0")


def departure_days_crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _some_days(spark, sf_dir)
    return top_spot.departure_days(facts, calendar=top_spot.crawl_days(facts))


def departure_counts_crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _some_days(spark, sf_dir)
    return top_spot.departure_counts(facts, calendar=top_spot.crawl_days(facts))


def top_spot_runs_crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _some_days(spark, sf_dir)
    return top_spot.top_spot_runs(facts, calendar=top_spot.crawl_days(facts))


def prev_url_crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _some_days(spark, sf_dir)
    return top_spot.prev_day_url(cleaning.clean_ranks(facts, ["event_id"]), calendar=top_spot.crawl_days(facts))


# Similarity


def element_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = element_text(RANK_COLUMNS.element, separator="")
    elements = rank_facts(spark, sf_dir).select(text.alias("element")).distinct()
    seeds = elements.select("element", string_hash32(F.col("element")).alias("seed"))
    a, b = COMPAT_COEFFICIENTS[0]
    return seeds.withColumn("hash", F.expr(compat_hash("seed", a, b, COMPAT_MODULUS)))


def element_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = rank_facts(spark, sf_dir).select(*RANK_COLUMNS.element, md5_id(RANK_COLUMNS.element).alias("id"))
    return ids.distinct()


def minhash_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return _signature_text(minhash.minhash_signatures(_clean(spark, sf_dir), K, element_id="md5"))


def minhash_signatures_xxhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return _signature_text(minhash.minhash_signatures(_clean(spark, sf_dir), K))


def minhash_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return minhash.minhash_similarity(_clean(spark, sf_dir), element_id="md5")


def minhash_signatures_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _clean(spark, sf_dir)
    return _signature_text(minhash.minhash_signatures(facts, K, element_id="md5", method="bins"))


def minhash_similarity_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _clean(spark, sf_dir)
    return minhash.minhash_similarity(facts, element_id="md5", method="bins")


def pairwise_minhash_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    signatures = minhash.minhash_signatures(
        rank_facts(spark, sf_dir), element_id="md5", cols=BY_KEYWORD
    )
    return minhash.pairwise_signature_similarity(signatures, cols=BY_KEYWORD)


def minhash_similarity_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    facts = rank_facts(spark, sf_dir)
    return minhash.minhash_similarity(facts, modulus=COMPAT_MODULUS, semantics="compat")


def compat_modulus(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = wide_rank_facts(spark, sf_dir)
    return exact.distinct_elements(facts).withColumn("modulus", F.lit(minhash.compat_modulus(facts)).cast("long"))


def wide_similarity_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compat signatures as earlier jobs made them: the modulus follows from the number of distinct elements."""
    tune(spark)
    facts = wide_rank_facts(spark, sf_dir)
    modulus = minhash.compat_modulus(facts)
    return minhash.minhash_similarity(facts, DEVICES, modulus=modulus, semantics="compat")


def _half_signatures(spark: SparkSession, sf_dir: str, half: str) -> DataFrame:
    tune(spark)
    facts = rank_facts(spark, sf_dir).where(half)
    return minhash.minhash_signatures(facts, K, element_id="md5")


def signature_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures of the morning and the afternoon crawls and of none, merged."""
    parts = _half_signatures(spark, sf_dir, "hour(ts) < 12").unionByName(
        _half_signatures(spark, sf_dir, "hour(ts) >= 12")
    )
    days = rank_facts(spark, sf_dir).select("crawl_date", "device").distinct()
    parts = parts.unionByName(days.withColumn("sig", F.array().cast("array<bigint>")))
    return _signature_text(minhash.merge_signature_rows(parts, K))


def signature_merge_pairwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge of a signature table with one new batch."""
    table = _half_signatures(spark, sf_dir, "hour(ts) < 12").withColumnRenamed("sig", "old")
    batch = _half_signatures(spark, sf_dir, "hour(ts) >= 12").withColumnRenamed("sig", "new")
    both = table.join(batch, ["crawl_date", "device"], "full_outer")
    merged = merge_signatures(F.col("old"), F.col("new"))
    return _signature_text(both.select("crawl_date", "device", merged.alias("sig")))


def signature_table_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parts written to a signature table, compacted and read back."""
    path, compacted = (scratch_dir(spark, SIGNATURE_TABLE_NAME) for _ in range(2))
    settings = signature_table.signature_settings(K, element_id="md5")
    for part, half in (("am", "hour(ts) < 12"), ("pm", "hour(ts) >= 12")):
        signature_table.write_signature_part(_half_signatures(spark, sf_dir, half), path, part, settings)
    signature_table.compact_signatures(spark, path, compacted, K, settings)
    return _signature_text(signature_table.read_signatures(spark, compacted, K, settings=settings))


def signature_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over files that arrive one after the other: afternoons, evenings, late mornings, and afternoons again."""
    tune(spark)
    names = (SIGNATURE_TABLE_NAME, "checkpoint", "arriving")
    path, checkpoint, arriving = (scratch_dir(spark, name) for name in names)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for first, last in ((12, 18), (18, 24), (0, 12), (12, 18)):
        events.where(f"hour(ts) >= {first} AND hour(ts) < {last}").write.mode("append").parquet(arriving)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    query = maintain_signatures(
        rank_facts_of(stream), path, checkpoint, "events", K, element_id="md5", once=True
    )
    query.awaitTermination()
    settings = signature_table.signature_settings(K, element_id="md5")
    return _signature_text(signature_table.read_signatures(spark, path, K, settings=settings))


def _within(estimate: DataFrame, exactly: DataFrame, bound: int, cols: RankColumns) -> DataFrame:
    """Per date the exact similarity and if the estimate is within the bound."""
    compared = compare.estimate_vs_exact(estimate, exactly, cols)
    return compared.select(cols.date, "exact", (F.col("difference") <= bound).alias("within"))


def wide_minhash_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default estimate (xxhash64, hash functions) against the exact similarity."""
    tune(spark)
    facts = wide_rank_facts(spark, sf_dir)
    estimate = minhash.minhash_similarity(facts, DEVICES, cols=WEEKLY)
    return _within(estimate, exact.exact_similarity(facts, DEVICES, cols=WEEKLY), MINHASH_BOUND, WEEKLY)


def wide_interval_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per week the exact similarity, and if it lies within the bounds of the estimate."""
    tune(spark)
    facts = wide_rank_facts(spark, sf_dir)
    bounds = compare.estimate_intervals(minhash.minhash_signatures(facts, cols=WEEKLY), DEVICES, 0.999, cols=WEEKLY)
    exactly = exact.exact_similarity(facts, DEVICES, cols=WEEKLY)
    both = bounds.join(exactly, "crawl_week")
    return both.select("crawl_week", F.col("similarity").alias("exact"), F.expr("similarity BETWEEN low AND high").alias("within"))


def wide_distinct_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements per device in a part of the month, from stored sketches of days, against the exact number."""
    path, facts = scratch_dir(spark, "sketches"), wide_rank_facts(spark, sf_dir)
    sketch_table.write_day_sketches(sketch_table.day_sketches(facts), path)
    about = sketch_table.distinct_estimate(sketch_table.read_day_sketches(spark, path, START, END), "device")
    some = cleaning.date_range(facts, START, END).groupBy("device")
    exactly = some.agg(F.count_distinct(element_text(RANK_COLUMNS.element)).alias("exact"))
    near = F.abs(F.col("n") - F.col("exact")) <= F.col("exact") * DISTINCT_BOUND
    return about.join(exactly, "device").select("device", "exact", near.alias("within"))


def shipments_frequent_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent suppliers by sketches of months, with what others may have at most."""
    path, facts = scratch_dir(spark, "sketches"), shipments(spark, sf_dir)
    cols = SHIPMENTS_BY_MONTH
    sketch_table.write_day_sketches(sketch_table.day_sketches(facts, 3, cols=cols), path, cols)
    sketches = sketch_table.read_day_sketches(spark, path, cols=cols)
    return sketch_table.frequent_urls(sketches, facts, 3, k=10, cols=cols)


def wide_sketch_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of sets that are far larger than these."""
    sales = part_sales(spark, sf_dir)
    estimate = exact.sketch_similarity(sales, log_entries=SKETCH_ENTRIES, cols=PARTS_BY_YEAR)
    return _within(estimate, exact.exact_similarity(sales, cols=PARTS_BY_YEAR), SKETCH_BOUND, PARTS_BY_YEAR)


def estimate_vs_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    clean = _clean(spark, sf_dir)
    estimate = minhash.minhash_similarity(clean, element_id="md5")
    return compare.estimate_vs_exact(estimate, exact.exact_similarity(clean))


def rank_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report from CSV files to text lines, by way of the rank table."""
    table = scratch_dir(spark, RANK_TABLE_NAME)
    loaded = rank_table.load_ranks(spark, csv=_csv_copy(spark, sf_dir))
    rank_table.write_rank_table(cleaning.clean_ranks(loaded), table)
    ranks = rank_table.read_rank_table(spark, table)
    return report.report_lines(report.analyses(ranks, element_id="md5"))


# Shipments: the same operators on other columns


def shipments_prev_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = shipments(spark, sf_dir).select(*SHIPMENTS_BY_DAY.all)
    clean = cleaning.drop_duplicate_keys(facts, cols=SHIPMENTS_BY_DAY)
    return top_spot.prev_day_url(clean, SHIPMENTS_BY_DAY)


def shipments_prev_leader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_spot.prev_day_url(day_leaders(spark, sf_dir), DAY_LEADERS)


def shipments_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    signatures = minhash.minhash_signatures(
        shipments(spark, sf_dir), element_id="md5", cols=SHIPMENTS_BY_MONTH
    )
    return minhash.pairwise_signature_similarity(signatures, cols=SHIPMENTS_BY_MONTH)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: estimated similarity of desktop and smartphone per day."""
    return minhash_similarity(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _own_queries() | (llm.QUERIES if llm else {}) | ({"pipeline": corpus_pipeline.run} if corpus_pipeline else {})


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "rank_table_scan": lambda s, d: rank_facts(s, d).select(*COLS),
        "csv_report_read": csv_report_read,
        "rank_table_clean": _clean,
        "duplicate_keys": lambda s, d: cleaning.duplicate_keys(rank_facts(s, d)),
        "rank_table_rewrite": rank_table_rewrite,
        "upsert_latest": upsert_latest,
        "date_range_scan": date_range_scan,
        "batch_upsert": batch_upsert,
        "batch_date_range": batch_date_range,
        "load_counts": load_counts,
        "loaded_table": loaded_table,
        "keyword_lookup": keyword_lookup,
        "url_lookup": url_lookup,
        "departure_days_crawled": departure_days_crawled,
        "departure_counts_crawled": departure_counts_crawled,
        "top_spot_runs": lambda s, d: top_spot.top_spot_runs(rank_facts(s, d)),
        "top_spot_runs_crawled": top_spot_runs_crawled,
        "prev_url_crawled": prev_url_crawled,
        "url_counts": lambda s, d: urls.url_counts(_clean(s, d), 10),
        "top_url_past_rank": lambda s, d: urls.top_urls(_clean(s, d), 10),
        "prev_day_url": lambda s, d: top_spot.prev_day_url(_clean(s, d)),
        "departure_days": lambda s, d: top_spot.departure_days(rank_facts(s, d)),
        "departure_days_anti_join": lambda s, d: top_spot.departure_days_anti_join(rank_facts(s, d)),
        "departure_counts": lambda s, d: top_spot.departure_counts(rank_facts(s, d)),
        "top_spot_departures": lambda s, d: top_spot.top_spot_departures(_clean(s, d), k=5),
        "top_spot_departures_compat": lambda s, d: top_spot.top_spot_departures(
            rank_facts(s, d), k=5, semantics="compat"
        ),
        "departure_counts_compat": lambda s, d: top_spot.departure_counts(
            rank_facts(s, d), semantics="compat"
        ),
        "top_spot_changes": lambda s, d: top_spot.top_spot_changes(_clean(s, d)),
        "exact_similarity": lambda s, d: exact.exact_similarity(rank_facts(s, d)),
        "exact_similarity_hashed": lambda s, d: exact.exact_similarity(
            rank_facts(s, d), element_key="hash"
        ),
        "exact_similarity_compat": lambda s, d: exact.exact_similarity(
            rank_facts(s, d), semantics="compat"
        ),
        "pairwise_similarity": lambda s, d: exact.pairwise_exact_similarity(
            rank_facts(s, d), cols=BY_KEYWORD
        ),
        "similar_set_pairs": lambda s, d: similar_sets.similar_sets(
            result_lists(s, d), LEAST_SIMILAR, cols=RESULT_LISTS
        ).pairs,
        "similar_set_members": lambda s, d: similar_sets.similar_sets(
            result_lists(s, d), LEAST_SIMILAR, cols=RESULT_LISTS
        ).members,
        "csv_good_rows": csv_good_rows,
        "csv_bad_rows": csv_bad_rows,
        "csv_bad_row_texts": csv_bad_row_texts,
        "csv_line_breaks": csv_line_breaks,
        "wide_clean": lambda s, d: cleaning.clean_ranks(wide_rank_facts(s, d), ["event_id"]),
        "wide_upsert": lambda s, d: _upserted(s, wide_rank_facts(s, d)),
        "wide_prev_day_url": lambda s, d: top_spot.prev_day_url(
            cleaning.clean_ranks(wide_rank_facts(s, d), ["event_id"])
        ),
        "wide_departures": lambda s, d: top_spot.departure_counts(wide_rank_facts(s, d)),
        "wide_similarity": lambda s, d: exact.exact_similarity(
            wide_rank_facts(s, d), DEVICES, cols=WEEKLY
        ),
        "wide_missing_devices": lambda s, d: exact.exact_similarity(
            wide_rank_facts(s, d).where("day(crawl_date) % 2 = 0 OR device = 'tablet'"), DEVICES
        ),
        "wide_pairwise_similarity": lambda s, d: exact.pairwise_exact_similarity(
            wide_rank_facts(s, d), cols=WEEKLY
        ),
        "wide_minhash_within": wide_minhash_within,
        "wide_sketch_within": wide_sketch_within,
        "wide_interval_within": wide_interval_within,
        "wide_distinct_within": wide_distinct_within,
        "similarity_sketch": lambda s, d: exact.sketch_similarity(rank_facts(s, d)),
        "distinct_elements": lambda s, d: exact.distinct_elements(rank_facts(s, d)),
        "element_hashes": element_hashes,
        "element_ids": element_ids,
        "minhash_signatures": minhash_signatures,
        "minhash_signatures_xxhash": minhash_signatures_xxhash,
        "minhash_similarity": minhash_similarity,
        "minhash_similarity_compat": minhash_similarity_compat,
        "compat_modulus": compat_modulus,
        "wide_similarity_compat": wide_similarity_compat,
        "minhash_signatures_binned": minhash_signatures_binned,
        "minhash_similarity_binned": minhash_similarity_binned,
        "pairwise_minhash_similarity": pairwise_minhash_similarity,
        "signature_merge": signature_merge,
        "signature_merge_pairwise": signature_merge_pairwise,
        "signature_table_parts": signature_table_parts,
        "signature_stream": signature_stream,
        "estimate_vs_exact": estimate_vs_exact,
        "estimate_error": lambda s, d: compare.estimate_error(estimate_vs_exact(s, d)),
        "similarity_report": lambda s, d: report.similarity_report(
            exact.exact_similarity(rank_facts(s, d))
        ),
        "rank_report": rank_report,
        "shipments_top_suppliers": lambda s, d: urls.top_urls(
            shipments(s, d), 3, k=10, cols=SHIPMENTS_BY_DAY
        ),
        "shipments_frequent_suppliers": shipments_frequent_suppliers,
        "shipments_departures": lambda s, d: top_spot.departure_counts(
            shipments(s, d), cols=SHIPMENTS_BY_DAY
        ),
        "shipments_prev_supplier": shipments_prev_supplier,
        "shipments_prev_leader": shipments_prev_leader,
        "shipments_similarity": lambda s, d: exact.pairwise_exact_similarity(
            shipments(s, d), cols=SHIPMENTS_BY_MONTH
        ),
        "shipments_minhash": shipments_minhash,
    }


# Oracles. ``r`` are the raw rank facts, ``cl`` the clean ones.

_R = """
r AS (
  SELECT 'kw' || (user_id % 5) AS keyword,
         CASE WHEN event_type IN ('signup', 'click') THEN 'US-en' ELSE 'CA-en' END AS market,
         CASE WHEN event_type IN ('signup', 'view') THEN NULL ELSE event_type END AS loc,
         CASE WHEN event_id % 2 = 0 THEN 'desktop' ELSE 'smartphone' END AS device,
         CAST(ts AS DATE) AS crawl_date,
         CAST(CAST(props->>'k' AS INTEGER) % 20 + 1 AS INTEGER) AS "rank",
         'site' || (CASE WHEN CAST(props->>'k' AS INTEGER) >= 50 THEN 1 ELSE 0 END) || '.example/p' AS url,
         event_id, ts
  FROM events)"""


_W = """
w AS (
  SELECT 'kw' || user_id AS keyword,
         CASE WHEN event_type IN ('signup', 'click') THEN 'US-en' ELSE 'CA-en' END AS market,
         CASE WHEN event_type IN ('signup', 'view') THEN NULL ELSE event_type END AS loc,
         CASE WHEN user_id % 10 = 0 THEN 'tablet' WHEN event_id % 2 = 0 THEN 'desktop' ELSE 'smartphone' END AS device,
         CAST(ts AS DATE) AS crawl_date, CAST(date_trunc('week', ts) AS DATE) AS crawl_week,
         CAST(CAST(props->>'k' AS INTEGER) % 20 + 1 AS INTEGER) AS "rank",
         'site' || user_id || '.example/' || (CAST(props->>'k' AS INTEGER) // 10) AS url,
         event_id, ts
  FROM events)"""
_LATEST = "hour(ts) >= 12 DESC, event_id DESC"
_UPSERTED = "(SELECT * FROM {0} WHERE hour(ts) < 12 OR day(ts) % 2 = 0)"


def _every_two(date: str, group: str, sets: str) -> str:
    """Every two sets of a date, and a row of its own for a date with one set."""
    return f"""
    SELECT a.{date}, a.{group} AS ga, b.{group} AS gb FROM {sets} a JOIN {sets} b ON a.{date} = b.{date} AND a.{group} < b.{group}
    UNION ALL SELECT {date}, min({group}), NULL FROM {sets} GROUP BY {date} HAVING count(*) = 1"""


def _pairwise(start: str, source: str, date: str, group: str, element: str) -> str:
    """Similarity of every two sets of a date."""
    return f"""{start},
    sets AS (SELECT DISTINCT {date}, {group} AS g, row({element}) AS e FROM {source}),
    sizes AS (SELECT {date}, g, count(*) AS n FROM sets GROUP BY ALL),
    both_in AS (SELECT a.{date}, a.g AS ga, b.g AS gb, count(*) AS n
                FROM sets a JOIN sets b ON a.{date} = b.{date} AND a.e IS NOT DISTINCT FROM b.e AND a.g < b.g GROUP BY ALL),
    every AS ({_every_two(date, 'g', 'sizes')})
    SELECT w.{date}, w.ga AS {group}_a, w.gb AS {group}_b, CAST(coalesce(p.n * 100 // (a.n + b.n - p.n), 0) AS INTEGER) AS similarity
    FROM every w LEFT JOIN both_in p ON p.{date} = w.{date} AND p.ga = w.ga AND p.gb = w.gb
    LEFT JOIN sizes a ON a.{date} = w.{date} AND a.g = w.ga LEFT JOIN sizes b ON b.{date} = w.{date} AND b.g = w.gb"""


def _two_sets(source: str, date: str) -> str:
    """Similarity of desktop and smartphone on every date, 0 where one has no rows."""
    return f"""
    SELECT {date}, CAST(coalesce(count(*) FILTER (WHERE n = 2) * 100 // nullif(count(*) FILTER (WHERE n > 0), 0), 0) AS INTEGER) AS similarity
    FROM (SELECT {date}, keyword, market, loc, "rank", url,
                 count(DISTINCT device) FILTER (WHERE device IN ('desktop', 'smartphone')) AS n
          FROM {source} GROUP BY ALL)
    GROUP BY {date}"""


def _kept(order: str, name: str = "cl", source: str = "r") -> str:
    return f"""
{name} AS (
  SELECT keyword, market, coalesce(loc, '') AS loc, device, crawl_date, "rank", url
  FROM (SELECT *, row_number() OVER (
          PARTITION BY keyword, market, coalesce(loc, ''), device, crawl_date, "rank"
          ORDER BY {order}) AS nth FROM {source})
  WHERE nth = 1)"""


_COLUMNS = 'keyword, market, loc, device, crawl_date, "rank", url'
_LIST = "keyword, market, loc, device"
_HOLDER = "keyword, market, loc, device, url"
_CLEAN = f"WITH {_R}, {_kept('event_id, url')}"
_RAW = f"WITH {_R}"


def _departures(source: str) -> str:
    return f"""
days AS (SELECT {_HOLDER}, crawl_date, count(*) AS copies FROM {source} WHERE "rank" = 1 GROUP BY ALL),
gone AS (
  SELECT * FROM (
    SELECT *, lead(crawl_date) OVER (PARTITION BY {_HOLDER} ORDER BY crawl_date) AS following
    FROM days)
  WHERE following IS NULL OR following <> crawl_date + 1)"""


# Days by number: of the calendar of crawled days, or as they come.
_SOME = f"""some_days AS (SELECT * FROM r WHERE day(crawl_date) % 4 <> 0),
calendar AS (SELECT crawl_date, row_number() OVER (ORDER BY crawl_date) AS d FROM (SELECT DISTINCT crawl_date FROM some_days))"""


def _runs(source: str, number: str = "date_diff('day', DATE '1970-01-01', crawl_date)", extra: str = "") -> str:
    """Stays at rank 1 by comparing each day with the one before."""
    return f"""
held AS (SELECT DISTINCT {_HOLDER}, crawl_date, {number} AS d FROM {source} {extra} WHERE "rank" = 1),
marked AS (SELECT *, CASE WHEN lag(d) OVER (PARTITION BY {_HOLDER} ORDER BY d) = d - 1 THEN 0 ELSE 1 END AS fresh FROM held),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY {_HOLDER} ORDER BY d) AS run FROM marked),
runs AS (SELECT {_HOLDER}, run, min(crawl_date) AS first_day, max(crawl_date) AS last_day, count(*) AS days FROM numbered GROUP BY ALL)"""


# Each row once under its own day and once under the next one; what meets nothing has left.
_TALLY = f"""
marks AS (
  SELECT {_HOLDER}, crawl_date AS day, 0 AS yesterday FROM r WHERE "rank" = 1
  UNION ALL
  SELECT {_HOLDER}, CAST(crawl_date + 1 AS DATE), 1 FROM r WHERE "rank" = 1),
tally AS (
  SELECT {_HOLDER}, count(*) AS n FROM (
    SELECT {_HOLDER}, day FROM marks GROUP BY ALL HAVING count(*) = 1 AND max(yesterday) = 1)
  GROUP BY ALL)"""


def _exact(source: str, name: str = "ex") -> str:
    return f"""
{name} AS (
  SELECT crawl_date, CAST((sum(nd) - count(*)) * 100 // count(*) AS INTEGER) AS similarity
  FROM (SELECT crawl_date, keyword, market, loc, "rank", url, count(DISTINCT device) AS nd
        FROM {source} GROUP BY ALL)
  GROUP BY crawl_date)"""


_ELEMENT = """concat_ws(chr(1), keyword, market, coalesce(loc, ''), CAST("rank" AS VARCHAR), url)"""
_ELEMENT_PLAIN = """keyword || market || coalesce(loc, '') || "rank" || url"""
_MD5_ID = f"CAST('0x' || substr(md5({_ELEMENT}), 1, 15) AS BIGINT)"
_STRING_HASH = """
  CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS seed
  FROM (SELECT *, list_reduce(
          list_prepend(CAST(0 AS BIGINT), [CAST(ord(c) AS BIGINT) FOR c IN string_split(element, '')]),
          lambda s, c: (s * 31 + c) % 4294967296) AS h"""


_MINIMA = ", ".join(
    f"min(((x >> 29) * {a} + {b}) % 2147483647 * 536870912 + (x & 536870911))"
    for a, b in coefficients(K)
)


def _signatures(source: str, name: str = "sigs") -> str:
    return f"""
{name} AS (
  SELECT crawl_date, device, [{_MINIMA}] AS sig
  FROM (SELECT crawl_date, device, {_MD5_ID} AS x FROM {source})
  GROUP BY crawl_date, device)"""


# Empty bins hold the largest BIGINT.
_BINNED = f"""
bins AS (
  SELECT crawl_date, device, x % {K} AS bin, min(x) AS low
  FROM (SELECT crawl_date, device, {_MD5_ID} AS x FROM cl) GROUP BY ALL),
sigs AS (
  SELECT d.crawl_date, d.device, list(coalesce(low, 9223372036854775807) ORDER BY i) AS sig
  FROM (SELECT DISTINCT crawl_date, device FROM bins) d, range({K}) r(i)
  LEFT JOIN bins b ON b.crawl_date = d.crawl_date AND b.device = d.device AND b.bin = r.i
  GROUP BY ALL)"""


def _signature_rows(source: str) -> str:
    return (
        f"WITH {_R}, {_kept('event_id, url')}, {_signatures(source)} "
        "SELECT crawl_date, device, array_to_string(sig, ',') AS sig FROM sigs"
    )


_PAIRED = """
  SELECT d.crawl_date, a.sig AS a, b.sig AS b
  FROM (SELECT DISTINCT crawl_date FROM sigs) d
  LEFT JOIN sigs a ON a.crawl_date = d.crawl_date AND a.device = 'desktop'
  LEFT JOIN sigs b ON b.crawl_date = d.crawl_date AND b.device = 'smartphone'"""

_ESTIMATE = f"""
est AS (
  SELECT crawl_date, CAST(coalesce(
    len(list_filter(list_zip(a, b), lambda p: p[1] = p[2])) * 100 // {K}, 0) AS INTEGER) AS similarity
  FROM ({_PAIRED}))"""

_BINNED_ESTIMATE = f"""
est AS (
  SELECT crawl_date, CAST(coalesce(
    len(list_filter(list_zip(a, b), lambda p: p[1] = p[2] AND p[1] < 9223372036854775807)) * 100
    // len(list_filter(list_zip(a, b), lambda p: least(p[1], p[2]) < 9223372036854775807)), 0)
    AS INTEGER) AS similarity
  FROM ({_PAIRED}))"""

_KEYWORD_ELEMENT = """concat_ws(chr(1), market, coalesce(loc, ''), CAST("rank" AS VARCHAR), url)"""
_KEYWORD_PAIRS = f"""
sigs AS (
  SELECT crawl_date, keyword, [{_MINIMA}] AS sig
  FROM (SELECT crawl_date, keyword, CAST('0x' || substr(md5({_KEYWORD_ELEMENT}), 1, 15) AS BIGINT) AS x FROM r)
  GROUP BY crawl_date, keyword),
pairs AS (
  SELECT w.crawl_date, ga AS keyword_a, gb AS keyword_b, a.sig AS a, b.sig AS b
  FROM ({_every_two('crawl_date', 'keyword', 'sigs')}) w
  LEFT JOIN sigs a ON a.crawl_date = w.crawl_date AND a.keyword = ga LEFT JOIN sigs b ON b.crawl_date = w.crawl_date AND b.keyword = gb)"""


# Every two lists of a week, compared element by element.
_LISTS = """
l AS (
  SELECT DISTINCT CAST(date_trunc('week', ts) AS DATE) AS crawl_week, 'kw' || user_id || twin AS keyword,
         row(event_type IN ('signup', 'click'), CAST(props->>'k' AS INTEGER) % 20, CAST(props->>'k' AS INTEGER) // 25) AS e
  FROM events, (VALUES (''), ('+'), ('~')) t(twin)
  WHERE (twin = '' OR user_id % 5 = 0) AND (twin <> '~' OR CAST(props->>'k' AS INTEGER) % 7 <> 0)),
sets AS (SELECT crawl_week, keyword, count(*) AS n, list(e ORDER BY e) AS es FROM l GROUP BY ALL),
same AS (SELECT crawl_week, es, min(keyword) AS representative FROM sets GROUP BY ALL),
members AS (SELECT crawl_week, keyword, representative, n FROM sets JOIN same USING (crawl_week, es))"""


_S = """
s AS (
  SELECT l_linestatus, l_returnflag, l_linenumber, l_suppkey, CAST(l_shipdate AS DATE) AS ship_date,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month
  FROM lineitem)"""
_SHIPMENT_ID = """CAST('0x' || substr(md5(concat_ws(chr(1), l_linestatus, CAST(l_linenumber AS VARCHAR),
  CAST(l_suppkey AS VARCHAR))), 1, 15) AS BIGINT)"""


def _shipments() -> dict[str, str]:
    holder, slot = "l_linestatus, l_returnflag, l_suppkey", "l_linestatus, l_returnflag, l_linenumber"
    return {
        "shipments_top_suppliers": f"""WITH {_S} SELECT l_suppkey, count(*) AS n FROM s
            WHERE l_linenumber > 3 GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 10""",
        "shipments_frequent_suppliers": f"""WITH {_S},
            past AS (SELECT l_suppkey FROM s WHERE l_linenumber > 3),
            total AS (SELECT 2 * CAST(ceil(3.5 * count(*) / 16384) AS BIGINT) AS bound FROM past)
            SELECT l_suppkey, n, bound, n > bound AS certain
            FROM (SELECT l_suppkey, count(*) AS n FROM past GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 10), total""",
        "shipments_departures": f"""WITH {_S},
            days AS (SELECT DISTINCT {holder}, ship_date FROM s WHERE l_linenumber = 1)
            SELECT {holder}, count(*) AS n FROM (
              SELECT *, lead(ship_date) OVER (PARTITION BY {holder} ORDER BY ship_date) AS following FROM days)
            WHERE following IS NULL OR following <> ship_date + 1 GROUP BY ALL""",
        "shipments_prev_supplier": f"""WITH {_S},
            clean AS (SELECT {slot}, ship_date, min(l_suppkey) AS l_suppkey FROM s GROUP BY ALL)
            SELECT *, CASE WHEN lag(ship_date) OVER w = ship_date - 1 THEN lag(l_suppkey) OVER w END AS prev_l_suppkey
            FROM clean WINDOW w AS (PARTITION BY {slot} ORDER BY ship_date)""",
        "shipments_prev_leader": f"""WITH leaders AS (
              SELECT * EXCLUDE (nth) FROM (
                SELECT {slot}, CAST(l_shipdate AS DATE) AS ship_date, l_suppkey, row_number() OVER (
                  PARTITION BY {slot}, CAST(l_shipdate AS DATE) ORDER BY l_extendedprice DESC, l_orderkey) AS nth
                FROM lineitem)
              WHERE nth = 1)
            SELECT *, CASE WHEN lag(ship_date) OVER w = ship_date - 1 THEN lag(l_suppkey) OVER w END AS prev_l_suppkey
            FROM leaders WINDOW w AS (PARTITION BY {slot} ORDER BY ship_date)""",
        "shipments_similarity": _pairwise(f"WITH {_S}", "s", "ship_month", "l_returnflag", "l_linestatus, l_linenumber, l_suppkey"),
        "shipments_minhash": f"""WITH {_S},
            sigs AS (SELECT ship_month, l_returnflag, [{_MINIMA}] AS sig
                     FROM (SELECT ship_month, l_returnflag, {_SHIPMENT_ID} AS x FROM s) GROUP BY ALL)
            SELECT w.ship_month, ga AS l_returnflag_a, gb AS l_returnflag_b, CAST(coalesce(
              len(list_filter(list_zip(a.sig, b.sig), lambda p: p[1] = p[2])) * 100 // {K}, 0) AS INTEGER) AS similarity
            FROM ({_every_two('ship_month', 'l_returnflag', 'sigs')}) w
            LEFT JOIN sigs a ON a.ship_month = w.ship_month AND a.l_returnflag = ga
            LEFT JOIN sigs b ON b.ship_month = w.ship_month AND b.l_returnflag = gb""",
    }


# The first prime from the number of distinct elements on.
_MODULUS = """
distinct_elements AS (SELECT count(DISTINCT element) AS n FROM (SELECT *, {element} AS element FROM {source})),
modulus AS (
  SELECT n, (SELECT min(p) FROM (SELECT unnest(range(greatest(n, 2), 2 * n + 3)) AS p)
             WHERE NOT EXISTS (SELECT 1 FROM (SELECT unnest(range(2, CAST(sqrt(2 * n + 3) AS BIGINT) + 1)) AS q)
                               WHERE q * q <= p AND p % q = 0)) AS modulus
  FROM distinct_elements)"""


def _compat_similarity(start: str = _R, source: str = "r", modulus: str = str(COMPAT_MODULUS), sized: str = "") -> str:
    wrapped = "(CASE WHEN {0} % 4294967296 >= 2147483648 THEN {0} % 4294967296 - 4294967296 ELSE {0} % 4294967296 END)"
    # Adding a multiple of 2^32 first keeps the remainder positive.
    minima = ", ".join(
        "min(abs(" + wrapped.format(f"(seed * {a} + {b} + 1099511627776)") + f" % {modulus}))"
        for a, b in COMPAT_COEFFICIENTS
    )
    return f"""WITH {start},
seeds AS (SELECT crawl_date, device, {_STRING_HASH} FROM (SELECT *, {_ELEMENT_PLAIN} AS element FROM {source}))),
sigs AS (SELECT crawl_date, device, [{minima}] AS sig FROM seeds{sized} GROUP BY crawl_date, device)
SELECT crawl_date, CAST(coalesce(
  len(list_intersect(list_distinct(a), list_distinct(b))) * 100 // len(list_distinct(list_concat(a, b))), 0) AS INTEGER) AS similarity
FROM ({_PAIRED})"""


def _report() -> str:
    def top(section: int, title: str, columns: str, source: str, order: str) -> str:
        return (
            f"SELECT {section} AS section, '' AS item, '{title}: ' || concat_ws(', ', {columns}) "
            f"|| ' (' || n || ' times)' AS line FROM (SELECT * FROM {source} ORDER BY n DESC, {order} LIMIT 1)"
        )

    def bars(section: int, title: str, source: str) -> str:
        return (
            f"SELECT {section}, strftime(crawl_date, '%Y-%m-%d'), '{title} ' || strftime(crawl_date, '%Y-%m-%d') "
            f"|| ': ' || similarity || '% ' || repeat('.', similarity) FROM {source}"
        )

    return f"""WITH {_R}, {_kept('url')}, {_departures('cl')}, {_signatures('cl')}, {_ESTIMATE}, {_exact('cl')},
counts AS (SELECT url, count(*) AS n FROM cl WHERE "rank" > 10 GROUP BY url),
left_most AS (SELECT {_HOLDER}, count(*) AS n FROM gone GROUP BY ALL),
{_CHANGES}
{top(1, 'Most frequent URL', 'url', 'counts', 'url')}
UNION ALL {top(2, 'Left rank 1 most', _HOLDER, 'left_most', _HOLDER)}
UNION ALL {top(3, 'Rank 1 changed most', _LIST, 'changes', _LIST)}
UNION ALL {bars(4, 'Estimated', 'est')}
UNION ALL {bars(5, 'Exact', 'ex')}"""


_CHANGES = f"""
changes AS (
  SELECT {_LIST}, count(*) AS n FROM (
    SELECT *, lag(url) OVER w AS held, lag(crawl_date) OVER w AS seen FROM cl WHERE "rank" = 1
    WINDOW w AS (PARTITION BY {_LIST} ORDER BY crawl_date))
  WHERE seen = crawl_date - 1 AND held <> url
  GROUP BY ALL)"""


def oracle_sql() -> dict[str, str]:
    piped = corpus_pipeline.ORACLE_SQL if corpus_pipeline else None
    return _own_oracles() | (llm.ORACLES if llm else {}) | ({"pipeline": piped} if piped else {})


def _own_oracles() -> dict[str, str]:
    clean_rows = f"{_CLEAN} SELECT * FROM cl"
    modulus = _MODULUS.format(element=_ELEMENT_PLAIN, source="w")
    days = f"SELECT {_HOLDER}, crawl_date FROM gone"
    left = f"SELECT {_HOLDER}, count(*) AS n FROM gone GROUP BY ALL"
    top_left = f"ORDER BY n DESC, {', '.join(c + ' NULLS FIRST' for c in _HOLDER.split(', '))} LIMIT 5"
    exact_rows = f"{_RAW}, {_exact('r')} SELECT * FROM ex"
    compared = f"""{_CLEAN}, {_signatures('cl')}, {_ESTIMATE}, {_exact('cl')},
compared AS (
  SELECT crawl_date, est.similarity AS estimate, ex.similarity AS exact,
         abs(est.similarity - ex.similarity) AS difference
  FROM est JOIN ex USING (crawl_date))"""
    return {
        "rank_table_scan": f"{_RAW} SELECT {_COLUMNS} FROM r",
        "csv_report_read": f"{_RAW} SELECT {_COLUMNS} FROM r",
        "rank_table_clean": clean_rows,
        "duplicate_keys": f"""{_RAW} SELECT keyword, market, loc, device, crawl_date, "rank", count(*) AS n
            FROM r GROUP BY ALL HAVING count(*) > 1""",
        "rank_table_rewrite": clean_rows,
        "upsert_latest": f"WITH {_R}, {_kept(_LATEST, source=_UPSERTED.format('r'))} SELECT * FROM cl",
        "batch_upsert": f"WITH {_R}, {_kept(_LATEST, source=_UPSERTED.format('r'))} SELECT * FROM cl",
        "batch_date_range": f"{clean_rows} WHERE crawl_date BETWEEN DATE '{START}' AND DATE '{END}'",
        "date_range_scan": f"{clean_rows} WHERE crawl_date BETWEEN DATE '{START}' AND DATE '{END}'",
        "url_counts": f'{_CLEAN} SELECT url, count(*) AS n FROM cl WHERE "rank" > 10 GROUP BY url',
        "top_url_past_rank": f"""{_CLEAN} SELECT url, count(*) AS n FROM cl WHERE "rank" > 10
            GROUP BY url ORDER BY n DESC, url LIMIT 1""",
        "prev_day_url": f"""{_CLEAN} SELECT {_COLUMNS},
              CASE WHEN lag(crawl_date) OVER w = crawl_date - 1 THEN lag(url) OVER w END AS prev_url
            FROM cl WINDOW w AS (PARTITION BY {_LIST}, "rank" ORDER BY crawl_date)""",
        "load_counts": f"""{_RAW},
            keys AS (SELECT keyword, market, coalesce(loc, '') AS l, device, crawl_date, "rank", count(*) AS n
                     FROM r WHERE event_id % 8 > 4 GROUP BY ALL)
            SELECT CAST(sum(n) AS BIGINT) AS rows,
                   (SELECT 1 + count(*) + count(*) FILTER (WHERE event_id % 8 = 4) FROM r WHERE event_id % 8 <= 4) AS bad_rows,
                   count(DISTINCT crawl_date) AS days, min(crawl_date) AS first_day, max(crawl_date) AS last_day,
                   count(*) AS keys, count(*) FILTER (WHERE n > 1) AS repeated_keys FROM keys""",
        "loaded_table": f"WITH {_W}, {_kept('event_id, url', source='w')} SELECT * FROM cl",
        "keyword_lookup": f"""WITH {_W}, {_kept('event_id, url', source='w')}
            SELECT * FROM cl WHERE keyword IN ('kw7', 'kw11') AND crawl_date >= DATE '{START}'""",
        "url_lookup": f"WITH {_W}, {_kept('event_id, url', source='w')} SELECT * FROM cl WHERE url = 'site3.example/4'",
        "departure_days_crawled": f"""{_RAW}, {_SOME}, {_runs('some_days', 'd', 'JOIN calendar USING (crawl_date)')}
            SELECT {_HOLDER}, last_day AS crawl_date FROM runs""",
        "departure_counts_crawled": f"""{_RAW}, {_SOME}, {_runs('some_days', 'd', 'JOIN calendar USING (crawl_date)')}
            SELECT {_HOLDER}, count(*) AS n FROM runs GROUP BY ALL""",
        "top_spot_runs": f"{_RAW}, {_runs('r')} SELECT {_HOLDER}, first_day, last_day, days FROM runs",
        "top_spot_runs_crawled": f"""{_RAW}, {_SOME}, {_runs('some_days', 'd', 'JOIN calendar USING (crawl_date)')}
            SELECT {_HOLDER}, first_day, last_day, days FROM runs""",
        "prev_url_crawled": f"""{_RAW}, {_SOME}, {_kept('event_id, url', source='some_days')}
            SELECT {_COLUMNS}, CASE WHEN lag(d) OVER w = d - 1 THEN lag(url) OVER w END AS prev_url
            FROM cl JOIN calendar USING (crawl_date) WINDOW w AS (PARTITION BY {_LIST}, "rank" ORDER BY crawl_date)""",
        "departure_days": f"{_RAW}, {_departures('r')} {days}",
        "departure_days_anti_join": f"{_RAW}, {_departures('r')} {days}",
        "departure_counts": f"{_RAW}, {_departures('r')} {left}",
        "top_spot_departures": f"{_CLEAN}, {_departures('cl')} {left} {top_left}",
        "top_spot_departures_compat": f"{_RAW}, {_TALLY} SELECT * FROM tally {top_left}",
        "departure_counts_compat": f"{_RAW}, {_TALLY} SELECT * FROM tally",
        "top_spot_changes": f"{_CLEAN}, {_CHANGES} SELECT * FROM changes",
        "exact_similarity": exact_rows,
        "exact_similarity_hashed": exact_rows,
        "exact_similarity_compat": f"""{_RAW}
            SELECT crawl_date, CAST((sum(c) - count(*)) * 100 // count(*) AS INTEGER) AS similarity
            FROM (SELECT crawl_date, keyword, market, loc, "rank", url, count(*) AS c FROM r GROUP BY ALL)
            GROUP BY crawl_date""",
        "pairwise_similarity": _pairwise(_RAW, "r", "crawl_date", "keyword", 'market, loc, "rank", url'),
        "similar_set_pairs": f"""WITH {_LISTS},
            reps AS (SELECT crawl_week, representative, min(n) AS n FROM members GROUP BY ALL),
            mine AS (SELECT l.* FROM l JOIN reps r ON r.crawl_week = l.crawl_week AND r.representative = l.keyword),
            shared AS (SELECT a.crawl_week, a.keyword AS ka, b.keyword AS kb, count(*) AS n
                       FROM mine a JOIN mine b ON a.crawl_week = b.crawl_week AND a.e = b.e AND a.keyword < b.keyword GROUP BY ALL)
            SELECT s.crawl_week, ka AS keyword_a, kb AS keyword_b, CAST(s.n * 100 // (a.n + b.n - s.n) AS INTEGER) AS similarity
            FROM shared s JOIN reps a ON a.crawl_week = s.crawl_week AND a.representative = ka
            JOIN reps b ON b.crawl_week = s.crawl_week AND b.representative = kb
            WHERE s.n * 100 >= (a.n + b.n - s.n) * {LEAST_SIMILAR}""",
        "similar_set_members": f"WITH {_LISTS} SELECT crawl_week, keyword, representative, n FROM members",
        "csv_good_rows": f"{_RAW} SELECT {_COLUMNS} FROM r WHERE event_id % 8 > 4",
        "csv_bad_rows": f"{_RAW} SELECT 1 + count(*) + count(*) FILTER (WHERE event_id % 8 = 4) AS n FROM r WHERE event_id % 8 <= 4",
        "csv_bad_row_texts": f"""{_RAW},
            lines AS (SELECT *, concat(',', market, ',', coalesce(loc, ''), ',', device, ',') AS middle,
                             strftime(crawl_date, '%Y-%m-%d') AS day FROM r)
            SELECT 'Keyword,Market,Location,Device,Crawl Date,Rank,URL' AS line
            UNION ALL SELECT concat(keyword, middle, year(crawl_date), ',', "rank", ',', url) FROM lines WHERE event_id % 8 = 0
            UNION ALL SELECT concat(keyword, middle, strftime(crawl_date, '%Y-%-m-%-d'), ',', "rank", ',', url) FROM lines WHERE event_id % 8 = 1
            UNION ALL SELECT concat(keyword, middle, day, ',0,', url) FROM lines WHERE event_id % 8 = 2
            UNION ALL SELECT concat(keyword, middle, day, ',', "rank", ',', url, ',x') FROM lines WHERE event_id % 8 = 3
            UNION ALL SELECT '"' || keyword FROM lines WHERE event_id % 8 = 4
            UNION ALL SELECT concat('"', middle, day, ',', "rank", ',', url) FROM lines WHERE event_id % 8 = 4""",
        "csv_line_breaks": f"""{_RAW}
            SELECT * EXCLUDE (event_id, ts) REPLACE (keyword || CASE WHEN event_id % 3 = 0 THEN chr(10) || chr(34) || market || chr(34) ELSE '' END AS keyword) FROM r""",
        "wide_clean": f"WITH {_W}, {_kept('event_id, url', source='w')} SELECT * FROM cl",
        "wide_upsert": f"WITH {_W}, {_kept(_LATEST, source=_UPSERTED.format('w'))} SELECT * FROM cl",
        "wide_prev_day_url": f"""WITH {_W}, {_kept('event_id, url', source='w')} SELECT {_COLUMNS},
              CASE WHEN lag(crawl_date) OVER s = crawl_date - 1 THEN lag(url) OVER s END AS prev_url
            FROM cl WINDOW s AS (PARTITION BY {_LIST}, "rank" ORDER BY crawl_date)""",
        "wide_departures": f"WITH {_W}, {_departures('w')} {left}",
        "wide_similarity": f"WITH {_W} {_two_sets('w', 'crawl_week')}",
        "wide_missing_devices": f"""WITH {_W},
            part AS (SELECT * FROM w WHERE day(crawl_date) % 2 = 0 OR device = 'tablet') {_two_sets('part', 'crawl_date')}""",
        "wide_pairwise_similarity": _pairwise(f"WITH {_W}", "w", "crawl_week", "device", 'keyword, market, loc, "rank", url'),
        "wide_minhash_within": f"WITH {_W} SELECT crawl_week, similarity AS exact, true AS within FROM ({_two_sets('w', 'crawl_week')})",
        "wide_interval_within": f"WITH {_W} SELECT crawl_week, similarity AS exact, true AS within FROM ({_two_sets('w', 'crawl_week')})",
        "wide_distinct_within": f"""WITH {_W} SELECT device, count(DISTINCT {_ELEMENT}) AS exact, true AS within
            FROM w WHERE crawl_date BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY device""",
        "wide_sketch_within": """
            SELECT ship_year, CAST(count(*) FILTER (WHERE n = 2) * 100 // count(*) AS INTEGER) AS exact, true AS within
            FROM (SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS ship_year, l_linestatus, l_linenumber, l_partkey,
                         count(DISTINCT l_returnflag = 'N') AS n
                  FROM lineitem GROUP BY ALL)
            GROUP BY ship_year""",
        "similarity_sketch": exact_rows,
        "distinct_elements": f"{_RAW} SELECT count(DISTINCT {_ELEMENT_PLAIN}) AS n FROM r",
        "element_hashes": f"""{_RAW},
            seeds AS (SELECT element, {_STRING_HASH} FROM (SELECT DISTINCT {_ELEMENT_PLAIN} AS element FROM r)))
            SELECT element, seed, abs((CASE WHEN w >= 2147483648 THEN w - 4294967296 ELSE w END) % {COMPAT_MODULUS}) AS hash
            FROM (SELECT *, (seed * 62 + 92 + 1099511627776) % 4294967296 AS w FROM seeds)""",
        "element_ids": f'{_RAW} SELECT DISTINCT keyword, market, loc, "rank", url, {_MD5_ID} AS id FROM r',
        "minhash_signatures": _signature_rows("cl"),
        "minhash_similarity": f"{_CLEAN}, {_signatures('cl')}, {_ESTIMATE} SELECT * FROM est",
        "minhash_similarity_compat": _compat_similarity(),
        "compat_modulus": f"WITH {_W}, {modulus} SELECT n, modulus FROM modulus",
        "wide_similarity_compat": _compat_similarity(f"{_W}, {modulus}", "w", "modulus", ", modulus"),
        "minhash_signatures_binned": f"""{_CLEAN}, {_BINNED}
            SELECT crawl_date, device, array_to_string(sig, ',') AS sig FROM sigs""",
        "minhash_similarity_binned": f"{_CLEAN}, {_BINNED}, {_BINNED_ESTIMATE} SELECT * FROM est",
        "pairwise_minhash_similarity": f"""{_RAW}, {_KEYWORD_PAIRS}
            SELECT crawl_date, keyword_a, keyword_b, CAST(coalesce(
              len(list_filter(list_zip(a, b), lambda p: p[1] = p[2])) * 100 // {K}, 0) AS INTEGER) AS similarity
            FROM pairs""",
        "signature_merge": _signature_rows("r"),
        "signature_merge_pairwise": _signature_rows("r"),
        "signature_table_parts": _signature_rows("r"),
        "signature_stream": _signature_rows("r"),
        "estimate_vs_exact": f"{compared} SELECT * FROM compared",
        "estimate_error": f"""{compared} SELECT count(*) AS dates, avg(difference) AS mean_error,
            max(difference) AS max_error FROM compared""",
        "similarity_report": f"""{_RAW}, {_exact('r')}
            SELECT strftime(crawl_date, '%Y-%m-%d') AS crawl_date, similarity,
                   repeat('.', similarity) AS bar FROM ex""",
        "rank_report": _report(),
        **_shipments(),
    }
