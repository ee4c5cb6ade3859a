"""Column names and fixed schemas of the rank-report data model.

One rank fact says: on ``crawl_date``, for a keyword in a market, location and
device, ``url`` was at position ``rank``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

RANK_SCHEMA = T.StructType(
    [
        T.StructField("keyword", T.StringType(), False),
        T.StructField("market", T.StringType(), False),
        T.StructField("loc", T.StringType(), True),
        T.StructField("device", T.StringType(), False),
        T.StructField("crawl_date", T.DateType(), False),
        T.StructField("rank", T.IntegerType(), False),
        T.StructField("url", T.StringType(), False),
    ]
)

SIGNATURE_SCHEMA = T.StructType(
    [
        T.StructField("crawl_date", T.DateType(), False),
        T.StructField("device", T.StringType(), False),
        T.StructField("sig", T.ArrayType(T.LongType(), False), False),
    ]
)

RANK_TABLE_NAME = "rank_table"
SIGNATURE_TABLE_NAME = "signature_table"


@dataclass(frozen=True)
class RankColumns:
    """Names the columns an operator works on, so it also runs on other tables.

    ``subject`` are the columns that say what is ranked (who asked, where),
    ``group`` is the column whose values are compared as sets (the device).
    """

    subject: tuple[str, ...] = ("keyword", "market", "loc")
    group: str = "device"
    date: str = "crawl_date"
    rank: str = "rank"
    entity: str = "url"

    @property
    def key(self) -> list[str]:
        """Primary key of the rank table."""
        return [*self.subject, self.group, self.date, self.rank]

    @property
    def slot(self) -> list[str]:
        """A place in the results that is followed from day to day."""
        return [*self.subject, self.group, self.rank]

    @property
    def holder(self) -> list[str]:
        """An entity within one result list."""
        return [*self.subject, self.group, self.entity]

    @property
    def element(self) -> list[str]:
        """A member of a daily result set, leaving out the group."""
        return [*self.subject, self.rank, self.entity]

    @property
    def all(self) -> list[str]:
        return [*self.key, self.entity]


RANK_COLUMNS = RankColumns()
DEVICES = ("desktop", "smartphone")
