"""Column expressions for dates and times. Set the session time zone to UTC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms of dates in the raw data beside ISO 8601, month first.
DATE_FORMATS = ("MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy")


def from_epoch(col: Column, unit: str) -> Column:
    """Whole seconds (``s``), milliseconds (``ms``) or nanoseconds (``ns``) since 1970 as a timestamp."""
    count = col.cast("bigint")
    if unit == "s":
        return F.timestamp_seconds(count)
    if unit == "ms":
        return F.timestamp_millis(count)
    if unit == "ns":
        return F.timestamp_micros(F.floor(count / F.lit(1000).cast("decimal(4,0)")).cast("bigint"))
    raise ValueError(f"unsupported unit {unit!r}: use 's', 'ms' or 'ns'")


def parse_first(col: Column, formats: Sequence[str]) -> Column:
    """Text as a timestamp by the first format that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in formats])


def parse_time(
    col: Column, *, format: str | None = None, unit: str | None = None,
    formats: Sequence[str] | None = None, strict: bool = True,
) -> Column:
    """Text or epoch count as a timestamp.

    Give at most one of ``format``, ``formats`` and ``unit``; without any, ISO 8601 and
    then the other formats of the raw data are tried. ``strict`` raises on text that fits none, otherwise it is null.
    """
    if sum(x is not None for x in (format, unit, formats)) > 1:
        raise ValueError("give only one of format, formats and unit")
    if unit is not None:
        return from_epoch(col, unit)
    if format or formats:
        parsed = parse_first(col, [format] if format else formats)
    else:
        parsed = F.coalesce(col.try_cast("timestamp"), parse_first(col, DATE_FORMATS))
    if not strict:
        return parsed
    complaint = F.raise_error(F.concat(F.lit("not a date: "), col.cast("string")))
    return F.coalesce(parsed, F.when(col.isNotNull(), complaint))


def whole_days(earlier: Column, later: Column) -> Column:
    """Whole days elapsed, not the difference of the calendar dates."""
    return F.timestamp_diff("DAY", earlier, later)
