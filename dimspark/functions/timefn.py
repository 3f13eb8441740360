"""Time expressions.

All built on Spark SQL functions so they stay inside whole-stage codegen;
none needs a Python UDF. Sessions run in UTC (see ``dimspark.session``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimspark.functions.common import as_col

# Fixed value: SAS stores dates as days since this day.
SAS_EPOCH = "1960-01-01"

WEEKDAY_STYLES = ("number", "name", "short")


def epoch_ms_to_timestamp(ms) -> Column:
    """Milliseconds since the epoch -> timestamp, milliseconds kept."""
    return F.timestamp_millis(F.floor(as_col(ms)).cast("long"))


def epoch_ms_to_second(ms) -> Column:
    """Milliseconds since the epoch -> timestamp cut to the second.

    Integer division, like ``epoch + ts/1000 * interval '1 second'`` on an
    integer column; ``ts / 1000`` in Spark would be a double and keep the
    milliseconds.
    """
    return F.timestamp_seconds(F.floor(as_col(ms) / F.lit(1000)).cast("long"))


def cut_to_second(ts) -> Column:
    """T2 for a column that already is a timestamp."""
    return F.date_trunc("second", as_col(ts))


def weekday(ts, style: str = "number") -> Column:
    """T8 in the three encodings found in the reference.

    ``number``: 0 = Sunday ... 6 = Saturday; ``name``: full English day
    name; ``short``: three-letter day name.
    """
    c = as_col(ts)
    if style == "number":
        return (F.dayofweek(c) - 1).cast("int")
    if style == "name":
        return F.date_format(c, "EEEE")
    if style == "short":
        return F.date_format(c, "E")
    raise ValueError(f"weekday style must be one of {WEEKDAY_STYLES}, got {style!r}")


def time_parts(ts, weekday_style: str = "number") -> list[Column]:
    """Hour, day, week (ISO), month, year, weekday as named columns."""
    c = as_col(ts)
    return [
        F.hour(c).alias("hour"),
        F.dayofmonth(c).alias("day"),
        F.weekofyear(c).alias("week"),
        F.month(c).alias("month"),
        F.year(c).alias("year"),
        weekday(c, weekday_style).alias("weekday"),
    ]


def sas_days_to_date(days) -> Column:
    """SAS day number -> date; NULL and 0 give NULL.

    Fractional days are cut downwards, as adding a fractional timedelta
    and keeping the date part does.
    """
    c = as_col(days)
    return F.when(
        c.isNotNull() & (c != 0),
        F.date_add(F.lit(SAS_EPOCH).cast("date"), F.floor(c).cast("int")),
    )


def date_to_sas_days(d) -> Column:
    """Inverse of T12 (used to lay out test inputs)."""
    return F.datediff(as_col(d).cast("date"), F.lit(SAS_EPOCH).cast("date"))
