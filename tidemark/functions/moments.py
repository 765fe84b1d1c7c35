"""Time expressions. The session zone must be UTC (see tidemark.session)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(text: Column) -> Column:
    """ISO-8601 text, fraction optional, to timestamp; NULL where it is not one."""
    return F.try_to_timestamp(text)


def stamp(as_of: datetime | None = None) -> Column:
    """The run's own time, one value per batch; `as_of` pins it."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp")


def hour_of_day(moment: Column) -> Column:
    return F.hour(moment)


def day_of_week(moment: Column) -> Column:
    """1 is Sunday, 7 is Saturday."""
    return F.dayofweek(moment)
