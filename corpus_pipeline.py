"""From raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return
the columns of ``documents``. ``run`` writes what a stage returns as Parquet to the shared folder and reads it again;
what the stage itself wrote there on its way is then removed.

Defined cases are those of the operators: rows with null ids and with empty or null texts go through all stages. Rows
are judged one by one, also if they share an id; of repeated rows with words one stays. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdrift.llm import decontamination, near_duplicates, packing, pseudonyms, quality
from rankdrift.llm.common import looked_up, table, tables_removed, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' votes don't reject."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.scorer(spark, model)(F.col("text").cast("string")) >= 0.5)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the least id; rows without an id come last.

    Groups are of rows: of several rows with one id those with other texts are judged by these.
    """
    row = "_row" + "_" * max((len(c) for c in docs.columns), default=0)  # no column's name
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates.near_duplicates(numbered.select(row, "text"), row)
    grouped = found.select(F.col("doc_id").alias(row), "component_id").join(numbered.select(row, "doc_id"), row)
    grouped = written(grouped, "grouped")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row))
    first = grouped.groupBy(F.col("component_id").alias("node")).agg(least[row].alias("value"), F.count("*").alias("degree"))
    removed = written(looked_up(grouped, "component_id", row, first).where(F.col(row) != F.col("value")).select(row), "removed")
    return numbered.join(removed, row, "left_anti").select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in place of personal data."""
    out = pseudonyms.pseudonymised(docs, pseudonyms.key_of(spark))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: SQL expresses none of the stages; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with tables_removed(spark):
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return docs
