"""Reporting periods: literal days, shortcuts, and the filters built from them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The period names a user may type instead of a day.
SHORTCUTS = ("today", "yesterday", "this-week", "last-week", "this-month", "last-month")


def timestamp(value: datetime) -> Column:
    """A constant without time zone; written as text, so no session or driver zone touches it."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _as_date(value: date | str) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return datetime.strptime(value, "%Y-%m-%d").date()


@dataclass(frozen=True)
class Period:
    """Whole days ``start`` to ``end``.

    The default upper bound is 23:59:59 inclusive, so a row in the last
    fraction of a second of the last day is outside. ``exclusive_end=True``
    takes everything before the next midnight.
    """

    start: date
    end: date
    exclusive_end: bool = False

    def __post_init__(self) -> None:
        object.__setattr__(self, "start", _as_date(self.start))
        object.__setattr__(self, "end", _as_date(self.end))
        if self.start > self.end:
            raise ValueError("period starts after it ends")

    @classmethod
    def parse(cls, name: str, ref_date: date | str | None = None) -> "Period":
        """A shortcut relative to ``ref_date`` (default: today), or a literal day."""
        if name not in SHORTCUTS:
            return cls(name, name)
        ref = _as_date(ref_date) if ref_date is not None else date.today()
        day, monday, first = timedelta(days=1), ref - timedelta(days=ref.weekday()), ref.replace(day=1)
        last_of_month = (first + timedelta(days=31)).replace(day=1) - day
        return {
            "today": cls(ref, ref),
            "yesterday": cls(ref - day, ref - day),
            "this-week": cls(monday, monday + 6 * day),
            "last-week": cls(monday - 7 * day, monday - day),
            "this-month": cls(first, last_of_month),
            "last-month": cls((first - day).replace(day=1), first - day),
        }[name]

    @classmethod
    def yesterday(cls, ref_date: date | str | None = None) -> "Period":
        return cls.parse("yesterday", ref_date)

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1

    @property
    def label(self) -> str:
        return f"{self.start} ~ {self.end}"

    def contains(self, col: Column | str) -> Column:
        """Range test on a raw timestamp column; reaches the scan as pushed filters."""
        c = F.col(col) if isinstance(col, str) else col
        lo = timestamp(datetime.combine(self.start, time.min))
        if self.exclusive_end:
            hi = datetime.combine(self.end + timedelta(days=1), time.min)
            return (c >= lo) & (c < timestamp(hi))
        return c.between(lo, timestamp(datetime.combine(self.end, time(23, 59, 59))))


def in_period(df: DataFrame, period: Period | None, col: str = "created_at") -> DataFrame:
    """Rows inside the period; ``None`` keeps every row.

    A table partitioned by ``created_date`` is pruned as well.
    """
    if period is None:
        return df
    if "created_date" in df.columns:
        df = df.filter(F.col("created_date").between(F.lit(period.start), F.lit(period.end)))
    return df.filter(period.contains(col))


def day(col: Column | str) -> Column:
    return F.to_date(col)


def loaded_since(df: DataFrame, since: date | str, col: str = "batch_created_at") -> DataFrame:
    """Rows loaded on or after a day, as a plain timestamp comparison that pushes down."""
    return df.filter(F.col(col) >= timestamp(datetime.combine(_as_date(since), time.min)))


def loaded_on(df: DataFrame, on: date | str, col: str = "batch_created_at") -> DataFrame:
    """Rows loaded on one day, as a half-open timestamp range."""
    lo = datetime.combine(_as_date(on), time.min)
    return df.filter((F.col(col) >= timestamp(lo)) & (F.col(col) < timestamp(lo + timedelta(days=1))))


def day_spine(spark: SparkSession, period: Period) -> DataFrame:
    """One row per day of the period."""
    return spark.range(period.days).select(
        F.date_add(F.lit(period.start), F.col("id").cast("int")).alias("date")
    )


def data_day_spine(df: DataFrame, col: str = "created_at") -> DataFrame:
    """One row per day between the first and last day found in ``df``."""
    bounds = df.agg(F.min(day(col)).alias("lo"), F.max(day(col)).alias("hi")).filter("lo IS NOT NULL")
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))


def shortcut_bounds(name: str, ref: Column | str) -> Column:
    """``struct(start_date, end_date)`` of a shortcut, for a column of reference days."""
    r = F.to_date(ref)
    monday, first = F.to_date(F.date_trunc("week", r)), F.to_date(F.date_trunc("month", r))
    bounds = {
        "today": (r, r),
        "yesterday": (F.date_sub(r, 1), F.date_sub(r, 1)),
        "this-week": (monday, F.date_add(monday, 6)),
        "last-week": (F.date_sub(monday, 7), F.date_sub(monday, 1)),
        "this-month": (first, F.last_day(r)),
        "last-month": (F.add_months(first, -1), F.date_sub(first, 1)),
    }
    if name not in bounds:
        raise ValueError(f"unknown period name: {name}")
    start, end = bounds[name]
    return F.struct(start.alias("start_date"), end.alias("end_date"))


def shortcut_table(df: DataFrame, ref: str = "ref_date") -> DataFrame:
    """Every shortcut's bounds for each distinct reference day of ``df``."""
    days = df.select(F.to_date(ref).alias("ref_date")).distinct()
    named = F.array(*[F.struct(F.lit(n).alias("shortcut"), shortcut_bounds(n, "ref_date").alias("b")) for n in SHORTCUTS])
    return days.select("ref_date", F.explode(named).alias("s")).select(
        "ref_date", "s.shortcut", "s.b.start_date", "s.b.end_date"
    )
