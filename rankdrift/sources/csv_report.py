"""Daily search-rank reports in CSV files: a header and seven columns by position."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankdrift.schema import RANK_SCHEMA

BAD_ROW = "_bad_row"
CORRUPT = "_corrupt_record"

# Fields are read as text and parsed below: Spark's own CSV type errors are only
# noticed in columns that the query happens to use.
TEXT_SCHEMA = T.StructType(
    [*(T.StructField(f.name, T.StringType()) for f in RANK_SCHEMA), T.StructField(CORRUPT, T.StringType())]
)
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    # Rows with more or fewer fields; only known if all fields are parsed.
    "columnNameOfCorruptRecord": CORRUPT,
    "columnPruning": "false",
}
# The forms of a date and of a rank.
FORMS = {"crawl_date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "rank": "^[0-9]+$"}


def _parsed(field: T.StructField) -> Column:
    value = F.trim(field.name) if field.name == "url" else F.col(field.name)
    if field.name in FORMS:
        value = F.when(value.rlike(FORMS[field.name]), value)
    return value.try_cast(field.dataType).alias(field.name)


def _good(whole_fields: bool) -> Column:
    good = F.lit(True)
    for field in RANK_SCHEMA:
        if not field.nullable:
            good = good & _parsed(field).isNotNull()
        if whole_fields:
            continue
        # Half of a quoted field that went over two lines.
        marks = F.length(field.name) - F.length(F.replace(F.col(field.name), F.lit('"'), F.lit("")))
        good = good & (F.coalesce(marks, F.lit(0)) % 2 == 0)
    return good & (F.col("rank").try_cast("int") >= 1)


def parse_rows(text: DataFrame, on_bad: str = "fail", whole_fields: bool = False) -> DataFrame:
    """Typed rank facts from seven text columns, and ``_corrupt_record`` if there is one.

    A row is bad if its date isn't a day written as yyyy-MM-dd, its rank isn't a number from 1 on, a required field is
    missing, or it has more or fewer than seven fields. Both halves of a row with a line break within quotes are bad,
    and so is a field with a single quote in it, unless fields are known to be whole. ``on_bad="fail"`` stops at the first bad row; ``"keep"`` returns its text in ``_bad_row``, which
    ``good_rows`` and ``bad_rows`` tell apart.
    """
    if on_bad not in ("fail", "keep"):
        raise ValueError(f"unknown way with bad rows: {on_bad}")
    good, original = F.coalesce(_good(whole_fields), F.lit(False)), F.to_csv(F.struct(*RANK_SCHEMA.names))
    if CORRUPT in text.columns:
        good, original = good & F.col(CORRUPT).isNull(), F.coalesce(CORRUPT, original)
    fields = [_parsed(field) for field in RANK_SCHEMA]
    if on_bad == "keep":
        return text.select(*fields, F.when(~good, original).alias(BAD_ROW))
    stop = F.raise_error(F.concat(F.lit("bad row in rank report: "), original))
    return text.where(F.when(good, True).otherwise(stop.cast("boolean"))).select(*fields)


def read_rank_csv(
    spark: SparkSession, path: str, on_bad: str = "fail", line_breaks: bool = False
) -> DataFrame:
    """Rank facts of one or more report files, with the header names replaced.

    Give Spark uncompressed files: a gzip file is read by a single task. So is a file with line breaks within quotes,
    which needs ``line_breaks``: a first pass over the lines then tells such files from the others, which are still
    split. In them a quote that is never closed makes one bad row of all that follows.
    """
    if not line_breaks:
        return parse_rows(spark.read.options(**CSV_OPTIONS).schema(TEXT_SCHEMA).csv(path), on_bad)
    whole, split = files_with_line_breaks(spark, path)
    reader = spark.read.options(**CSV_OPTIONS).schema(TEXT_SCHEMA)
    facts = [parse_rows(reader.csv(split), on_bad)] if split or not whole else []
    if whole:
        facts.append(parse_rows(reader.option("multiLine", "true").csv(whole), on_bad, whole_fields=True))
    return facts[0] if len(facts) == 1 else facts[0].unionByName(facts[1])


def files_with_line_breaks(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The report files in which a field goes over several lines, and the others.

    Such a file has a line with an odd number of quotes. The driver holds names of files, as it does for any read.
    """
    lines = spark.read.text(path)
    odd = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    found = lines.where(odd % 2 == 1).select(F.input_file_name().alias("file")).distinct()
    whole = {unquote(row.file) for row in found.toLocalIterator()}
    every = [unquote(file) for file in lines.inputFiles()]
    return [f for f in every if f in whole], [f for f in every if f not in whole]


def stream_rank_csv(
    spark: SparkSession, folder: str, files_per_batch: int = 1000, on_bad: str = "fail"
) -> DataFrame:
    """``read_rank_csv`` for report files that keep arriving in a folder."""
    reader = spark.readStream.options(**CSV_OPTIONS).schema(TEXT_SCHEMA)
    return parse_rows(reader.option("maxFilesPerTrigger", files_per_batch).csv(folder), on_bad)


def good_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(BAD_ROW).isNull()).drop(BAD_ROW)


def bad_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(BAD_ROW).isNotNull())
