"""UTC timestamps rendered as ISO-8601 text, as ``datetime.isoformat()`` writes them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _render(wall: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00`` of the wall clock as displayed."""
    frac = F.date_format(wall, "SSSSSS")
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(frac != "000000", F.concat(F.lit("."), frac)).otherwise(F.lit("")),
                    F.lit("+00:00"))


def iso_utc(ts: Column) -> Column:
    """An instant (``TIMESTAMP``) as ``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00``; the fraction
    is omitted when zero.

    Rendered in UTC whatever the session time zone (the value is shifted first).
    """
    return _render(F.to_utc_timestamp(ts, F.current_timezone()))


def iso_utc_naive(ts: Column) -> Column:
    """A naive ``TIMESTAMP_NTZ`` that holds a UTC wall clock, rendered like ``iso_utc``
    (no time-zone shift, so the session time zone does not matter)."""
    return _render(ts)
