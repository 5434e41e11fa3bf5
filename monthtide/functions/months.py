"""Month keys. They follow the session time zone, which must be UTC."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Partition that collects rows without a timestamp, so that they still meet.
NO_MONTH = "000000"


def _yyyymm(ts: Column) -> Column:
    return F.year(ts) * 100 + F.month(ts)


def month_key(ts: Column) -> Column:
    """``'YYYYMM'`` of a timestamp; NULL goes to ``'000000'``."""
    return F.lpad(F.coalesce(_yyyymm(ts), F.lit(0)).cast("string"), 6, "0")


def month_label(ts: Column) -> Column:
    """``'YYYY-MM'``, the form used in landing file names."""
    return F.date_format(ts, "yyyy-MM")


def month_in_zone(ts: Column, zone: str) -> Column:
    """``'YYYYMM'`` of a UTC timestamp as seen on a wall clock in ``zone``."""
    return month_key(F.from_utc_timestamp(ts, zone))


def in_month(ts: Column, month: str) -> Column:
    """Whether ``ts`` lies in ``'YYYYMM'``.

    The same as comparing its year and month, but a range of the bare column,
    which reaches the Parquet reader and skips row groups.
    """
    parts = re.fullmatch(r"(\d{4})(0[1-9]|1[0-2])", month)
    if not parts:
        raise ValueError(f"not a month: {month!r}")
    year, number = map(int, parts.groups())
    following = f"{year + number // 12:04d}-{number % 12 + 1:02d}-01"
    # Text literals take the type of the column, with a zone or without.
    return (ts >= F.lit(f"{year:04d}-{number:02d}-01")) & (ts < F.lit(following))
