"""Date windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def windows(start: Column, end: Column, days: int = 90) -> Column:
    """Consecutive windows of that many days that cover start to end, the last one cut at the end."""
    steps = F.sequence(start.cast("date"), end.cast("date"), F.expr(f"interval {days} days"))
    return F.transform(steps, lambda d: F.struct(d.alias("begin"), F.least(F.date_add(d, days - 1), end.cast("date")).alias("end")))


def within(day: Column, anchor: Column, before: int = 7, after: int = 365) -> Column:
    return day.between(F.date_sub(anchor, before), F.date_add(anchor, after))
