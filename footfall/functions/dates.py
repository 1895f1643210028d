"""Date windows and the Sunday-start reporting calendar."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DateWindow:
    """Inclusive range of calendar dates; resolved once per run so that a job never straddles midnight."""

    first: date
    last: date

    @classmethod
    def relative(cls, as_of: date, begin_offset: int, end_offset: int) -> "DateWindow":
        return cls(as_of + timedelta(days=begin_offset), as_of + timedelta(days=end_offset))

    def days(self) -> list[date]:
        return [self.first + timedelta(days=i) for i in range((self.last - self.first).days + 1)]

    def whole_weeks(self) -> "DateWindow":
        """The Sunday-start weeks that the window touches."""
        return DateWindow(
            self.first - timedelta(days=self.first.isoweekday() % 7), self.last + timedelta(days=6 - self.last.isoweekday() % 7)
        )

    def whole_months(self) -> "DateWindow":
        """The months that the window touches."""
        after = self.last.replace(day=28) + timedelta(days=4)
        return DateWindow(self.first.replace(day=1), after - timedelta(days=after.day))

    def has_date(self, col: Column) -> Column:
        return col.between(F.lit(self.first), F.lit(self.last))

    def has_time(self, col: Column) -> Column:
        """Half-open range on the raw timestamp, which reaches the Parquet scan as a pushed filter."""
        return (col >= F.lit(self.first)) & (col < F.lit(self.last + timedelta(days=1)))


def sunday_week(day: Column) -> Column:
    """ISO week number of the following day, so that weeks run Sunday to Saturday."""
    return F.weekofyear(F.date_add(day, 1))


@dataclass(frozen=True)
class Years:
    """Years that a report covers; earlier and later ones are shown as its first and last. None leaves an end open."""

    first: int | None = None
    last: int | None = None


ALL_YEARS = Years()


def reporting_year(day: Column, years: Years = ALL_YEARS) -> Column:
    """Year that owns the Sunday-start week, clamped to the years the report covers."""
    first, last = years.first, years.last
    year = F.extract(F.lit("YEAROFWEEK"), F.date_add(day, 1))
    if first is not None:
        year = F.greatest(year, F.lit(first))
    if last is not None:
        year = F.least(year, F.lit(last))
    return year


def calendar_columns(day: Column, years: Years = ALL_YEARS) -> dict[str, Column]:
    """Calendar columns of the summary tables, stored as strings."""
    return {
        "week": sunday_week(day).cast("string"),
        "month": F.month(day).cast("string"),
        "reporting_wk_yr": reporting_year(day, years).cast("string"),
    }
