"""Rolling time windows and elapsed-time arithmetic."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_literal(as_of: _dt.datetime | str | None) -> Column:
    """``as_of`` as a TIMESTAMP_NTZ literal; ``None`` means the query's now.

    A literal keeps the window bounds foldable, so they reach the Parquet scan
    as pushed filters.
    """
    if as_of is None:
        return F.localtimestamp()
    return F.lit(str(as_of)).cast("timestamp_ntz")


def in_last(ts: Column | str, interval: str, as_of: _dt.datetime | str | None = None) -> Column:
    """``ts`` lies in [as_of - interval, as_of], both ends inclusive.

    ``interval`` is a Spark interval body such as ``"1 HOUR"``, ``"7 DAY"`` or
    ``"1 MONTH"`` (a calendar month: 31 March minus one month is 29 February
    in a leap year).
    """
    return F.expr(in_last_sql(ts, interval, as_of)) if isinstance(ts, str) else \
        ts.between(as_of_literal(as_of) - F.expr(f"INTERVAL {interval}"), as_of_literal(as_of))


def as_of_sql(as_of: _dt.datetime | str | None) -> str:
    """``as_of`` as SQL text: a TIMESTAMP_NTZ literal, or the query's now."""
    return "localtimestamp()" if as_of is None else f"TIMESTAMP_NTZ '{as_of}'"


def in_last_sql(ts: str, interval: str, as_of: _dt.datetime | str | None = None) -> str:
    """SQL text of ``in_last`` for a column name (one expression to build)."""
    end = as_of_sql(as_of)
    return f"(`{ts}` BETWEEN {end} - INTERVAL {interval} AND {end})"


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Fractional hours from ``start`` to ``end`` (negative if end is earlier)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("MICROSECOND", s, e) / F.lit(3_600_000_000.0)
