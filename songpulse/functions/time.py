"""Epoch conversions and the hourly label, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds_from_ntz(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ, built from its fields (zone-free); NULL
    beyond the range of an int."""
    t = _col(ts)
    secs = (
        F.unix_date(F.to_date(t)).cast("bigint") * 86400
        + F.hour(t) * 3600
        + F.minute(t) * 60
        + F.second(t)
    )
    return secs.try_cast("int")


def epoch_ms_from_ntz(ts: Column | str) -> Column:
    """Milliseconds since 1970-01-01 of a TIMESTAMP_NTZ (zone-free, fraction floored)."""
    t = _col(ts)
    whole = (
        F.unix_date(F.to_date(t)).cast("bigint") * 86400
        + F.hour(t) * 3600
        + F.minute(t) * 60
    ) * 1000
    millis = F.floor(F.extract(F.lit("SECOND"), t) * 1000).cast("bigint")
    return whole + millis


def epoch_seconds(ms: Column | str) -> Column:
    """Epoch milliseconds (a string or number) to whole seconds, floored; bad input, or a time
    beyond the range of an int, -> NULL."""
    m = _col(ms).try_cast("bigint")
    return F.floor(m / F.lit(1000)).try_cast("int")


def hour_start(t: Column | str) -> Column:
    """Start of the UTC hour holding epoch second ``t``, as epoch seconds (int)."""
    x = _col(t).cast("bigint")
    return (x - F.pmod(x, F.lit(3600))).cast("int")


def hour_label(t: Column | str) -> Column:
    """``DD Mon YYYY-HH`` of epoch second ``t`` in UTC, e.g. ``01 Jan 2024-00``.

    The calendar date comes from ``date_from_unix_date`` (a DATE has no zone) and the hour from
    integer arithmetic, so the session time zone never enters.
    """
    x = _col(t).cast("bigint")
    day = F.date_from_unix_date(F.floor(x / F.lit(86400)).cast("int"))
    hour = F.pmod(F.floor(x / F.lit(3600)), F.lit(24))
    return F.concat(
        F.date_format(day, "dd MMM yyyy"),
        F.lit("-"),
        F.lpad(hour.cast("string"), 2, "0"),
    )
