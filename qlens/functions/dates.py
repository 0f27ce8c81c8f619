"""Days and durations as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_day(col: Column | str, is_text: bool = True) -> Column:
    """``yyyy-MM-dd`` text from a date, a timestamp or mixed date text."""
    c = F.col(col) if isinstance(col, str) else col
    if not is_text:
        return F.date_format(c, "yyyy-MM-dd")
    head = F.substring(c, 1, 10)
    dashes = F.length(head) - F.length(F.replace(head, F.lit("-"), F.lit("")))
    short = F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}\z"), c.try_cast("date"))
    return F.when((F.length(c) >= 10) & (dashes == 2), head).otherwise(
        F.coalesce(F.date_format(short, "yyyy-MM-dd"), head)
    )


def _whole(seconds: Column) -> Column:
    return F.floor(seconds).cast("bigint")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def duration_ms(seconds: Column | str) -> Column:
    """Minutes and seconds, however long."""
    s = _whole(F.col(seconds) if isinstance(seconds, str) else seconds)
    return _text(F.floor(s / 60).cast("bigint"), "분 ", s % 60, "초")


def duration_hms(seconds: Column | str) -> Column:
    """Hours, minutes and seconds without leading zero parts."""
    s = _whole(F.col(seconds) if isinstance(seconds, str) else seconds)
    h, m = F.floor(s / 3600).cast("bigint"), F.floor((s % 3600) / 60).cast("bigint")
    return (
        F.when(h > 0, _text(h, "시간 ", m, "분 ", s % 60, "초"))
        .when(m > 0, _text(m, "분 ", s % 60, "초"))
        .otherwise(_text(s % 60, "초"))
    )
