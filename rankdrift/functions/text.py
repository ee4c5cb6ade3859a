"""Text columns of the report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def dot_bar(percentage: Column) -> Column:
    """One dot per percent."""
    return F.repeat(F.lit("."), percentage)
