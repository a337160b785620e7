"""An inclusive range of feed days."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.schemas import FEED_DATE


@dataclass(frozen=True)
class Period:
    """Feed days from ``start`` to ``end``, both included."""

    start: date
    end: date

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError(f"empty period: {self.start} is after {self.end}")

    @classmethod
    def parse(cls, start: str, end: str) -> Period:
        return cls(date.fromisoformat(start), date.fromisoformat(end))

    @property
    def num_days(self) -> int:
        return (self.end - self.start).days + 1

    def __iter__(self) -> Iterator[date]:
        return (self.start + timedelta(days=i) for i in range(self.num_days))

    def days(self, spark: SparkSession) -> DataFrame:
        """One row per day, whether or not a feed exists for it."""
        return spark.range(0, 1, 1, 1).select(
            F.explode(F.sequence(F.lit(self.start), F.lit(self.end))).alias(FEED_DATE)
        )

    def has_day(self, day: Column) -> Column:
        """Predicate on a DATE; on the partition column it prunes directories."""
        return day.between(F.lit(self.start), F.lit(self.end))

    def has_time(self, moment: Column) -> Column:
        """Predicate on a TIMESTAMP_NTZ, as a half-open range so that it reaches the Parquet scan."""
        begin = F.lit(self.start.isoformat()).cast("timestamp_ntz")
        stop = F.lit((self.end + timedelta(days=1)).isoformat()).cast("timestamp_ntz")
        return (moment >= begin) & (moment < stop)
