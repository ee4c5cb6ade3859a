"""From a CSV report to the four answers and their text form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdrift.functions.text import day_text, dot_bar
from rankdrift.operators.cleaning import clean_ranks
from rankdrift.operators.compare import estimate_vs_exact
from rankdrift.operators.exact import exact_similarity
from rankdrift.operators.minhash import K, minhash_similarity
from rankdrift.operators.top_spot import top_spot_changes, top_spot_departures
from rankdrift.operators.urls import top_urls
from rankdrift.schema import RANK_COLUMNS, RANK_TABLE_NAME, RankColumns
from rankdrift.session import scratch_dir, tune
from rankdrift.sources.csv_report import read_rank_csv
from rankdrift.sources.rank_table import read_rank_table, write_rank_table


def similarity_report(similarity: DataFrame, cols: RankColumns = RANK_COLUMNS) -> DataFrame:
    """Date as text, percent, and a bar of one dot per percent, in date order."""
    return similarity.select(
        day_text(F.col(cols.date)).alias(cols.date),
        "similarity",
        dot_bar(F.col("similarity")).alias("bar"),
    ).orderBy(cols.date)


def analyses(
    ranks: DataFrame, cutoff: int = 10, k: int = K, element_id: str = "xxhash64"
) -> dict[str, DataFrame]:
    """The answers of the report over a clean rank table; nothing runs yet."""
    tune(ranks.sparkSession)
    estimate = minhash_similarity(ranks, k=k, element_id=element_id)
    exact = exact_similarity(ranks)
    changes = top_spot_changes(ranks)
    list_columns = [*RANK_COLUMNS.subject, RANK_COLUMNS.group]
    return {
        "top_urls": top_urls(ranks, cutoff),
        "top_spot_departures": top_spot_departures(ranks),
        "top_spot_changes": changes.orderBy(F.desc("n"), *list_columns).limit(1),
        "estimated_similarity": estimate,
        "exact_similarity": exact,
        "estimate_vs_exact": estimate_vs_exact(estimate, exact),
    }


def report_lines(answers: dict[str, DataFrame]) -> DataFrame:
    """The report as text: ``section``, ``item`` (sort key in a section) and ``line``."""

    def lines(section: int, df: DataFrame, item: Column, line: Column) -> DataFrame:
        return df.select(F.lit(section).alias("section"), item.alias("item"), line.alias("line"))

    def times(n: str) -> Column:
        return F.concat(F.lit(" ("), F.col(n).cast("string"), F.lit(" times)"))

    def listed(columns: list[str]) -> Column:
        return F.concat_ws(", ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])

    def bars(section: int, name: str, title: str) -> DataFrame:
        day = F.col("crawl_date")
        text = F.format_string("%s %s: %d%% %s", F.lit(title), day, "similarity", "bar")
        return lines(section, similarity_report(answers[name]), day, text)

    def top(section: int, name: str, title: str, columns: list[str]) -> DataFrame:
        text = F.concat(F.lit(f"{title}: "), listed(columns), times("n"))
        return lines(section, answers[name], F.lit(""), text)

    result_list = [*RANK_COLUMNS.subject, RANK_COLUMNS.group]
    return (
        top(1, "top_urls", "Most frequent URL", [RANK_COLUMNS.entity])
        .union(top(2, "top_spot_departures", "Left rank 1 most", RANK_COLUMNS.holder))
        .union(top(3, "top_spot_changes", "Rank 1 changed most", result_list))
        .union(bars(4, "estimated_similarity", "Estimated"))
        .union(bars(5, "exact_similarity", "Exact"))
        .orderBy("section", "item")
    )


def run_report(
    spark: SparkSession, csv: str, table: str | None = None, out: str | None = None
) -> dict[str, DataFrame]:
    """Load a CSV report into the rank table and answer all questions from it.

    A ``table`` that is already there is replaced by the rows of this report.
    Cleaning runs once, when the table is written; every answer then reads only
    the columns and rows it needs. With ``out`` the text report is written too.
    """
    table = table or scratch_dir(spark, RANK_TABLE_NAME)
    write_rank_table(clean_ranks(read_rank_csv(spark, csv)), table)
    answers = analyses(read_rank_table(spark, table))
    if out is not None:
        report_lines(answers).select("line").write.mode("overwrite").text(out)
    return answers
