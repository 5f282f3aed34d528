"""Zone-free date arithmetic on ``timestamp_ntz`` columns.

All helpers return Columns built from JVM expressions (whole-stage codegen);
none depends on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SECOND_INTERVAL = T.DayTimeIntervalType(T.DayTimeIntervalType.SECOND, T.DayTimeIntervalType.SECOND)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c) -> Column:
    """Text (or timestamp) to ``timestamp_ntz``; unparseable text becomes NULL (F1)."""
    return _c(c).try_cast(T.TimestampNTZType())


def seconds_between(start, end) -> Column:
    """Exact seconds from ``start`` to ``end`` as double.

    The difference of two ``timestamp_ntz`` values is a day-time interval; cast
    to a single-unit SECOND interval it converts exactly to a decimal.  Unlike
    ``timestampdiff`` this never consults the session time zone.
    """
    diff = (_c(end) - _c(start)).cast(_SECOND_INTERVAL)
    return diff.cast("decimal(20,6)").cast("double")


def whole_days_between(start, end) -> Column:
    """Floor of the day difference (pandas ``Timedelta.days`` semantics)."""
    return F.floor(seconds_between(start, end) / F.lit(86400.0))


def hours_between(start, end) -> Column:
    return seconds_between(start, end) / F.lit(3600.0)


def month_start(c) -> Column:
    """First day of the month as a ``date`` (zone-free, unlike ``date_trunc``)."""
    return F.trunc(_c(c).cast("date"), "MM")


def month_label(c) -> Column:
    """``Jan 2024``."""
    return F.date_format(_c(c).cast("date"), "MMM yyyy")


def quarter_label(c) -> Column:
    """``2024Q1``."""
    d = _c(c).cast("date")
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def iso_date(c) -> Column:
    """Date as ``yyyy-MM-dd`` text, for stable comparisons and CSV output."""
    return F.date_format(_c(c).cast("date"), "yyyy-MM-dd")
