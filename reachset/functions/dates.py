"""Date parameters and date columns.

Window bounds are resolved once, in Python, from parameters; they enter
the plan as typed literals so that Catalyst folds them and pushes the range
to the Parquet scan (and to partition pruning on a date-partitioned table).
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

_REL = re.compile(r"^\s*(\d+)\s*([dwy])\s*$", re.IGNORECASE)


def _minus_years(day: dt.date, n: int) -> dt.date:
    try:
        return day.replace(year=day.year - n)
    except ValueError:  # 29 February in a non-leap year
        return day.replace(year=day.year - n, day=28)


def resolve_date(value: str | dt.date | dt.datetime, as_of: dt.date | None = None) -> dt.date:
    """``'20d'``, ``'2w'``, ``'1y'``, ``'today'``, ISO ``'2019-12-28'`` or a date.

    Relative values count back from ``as_of`` (default: today), so ``'0d'``
    is ``as_of`` itself.  ``as_of`` is explicit so that a run can be repeated.
    A ``datetime`` keeps its time of day; one at midnight is its date.
    """
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            raise ValueError(f"a bound is a wall-clock time, without a zone: {value!r}")
        return value.date() if value.time() == dt.time() else value
    if isinstance(value, dt.date):
        return value
    base = as_of or dt.date.today()
    text = str(value).strip()
    if text.lower() == "today":
        return base
    if text.lower() == "yesterday":
        return base - dt.timedelta(days=1)
    m = _REL.match(text)
    if m:
        n, unit = int(m.group(1)), m.group(2).lower()
        if unit == "d":
            return base - dt.timedelta(days=n)
        if unit == "w":
            return base - dt.timedelta(weeks=n)
        return _minus_years(base, n)
    try:
        return dt.date.fromisoformat(text)
    except ValueError as exc:
        raise ValueError(f"not a date or relative offset: {value!r}") from exc


def _stamp(day: dt.date | dt.datetime) -> dt.datetime:
    if isinstance(day, dt.datetime):
        return day
    return dt.datetime(day.year, day.month, day.day)


def window_bounds(
    start: str | dt.date, end: str | dt.date, as_of: dt.date | None = None
) -> tuple[dt.date, dt.date]:
    """Resolve a scan range ``[start, end)`` (D1).  ``start`` must not be later."""
    lo, hi = resolve_date(start, as_of), resolve_date(end, as_of)
    if _stamp(lo) > _stamp(hi):
        raise ValueError(f"window start {lo} is after its end {hi}")
    return lo, hi


def days_before(day: str | dt.date, n: int) -> dt.date:
    """Date minus ``n`` days."""
    if n < 0:
        raise ValueError("n must be >= 0")
    return resolve_date(day) - dt.timedelta(days=int(n))


def typed_bound(day: dt.date | dt.datetime, data_type) -> Column:
    """A literal of the column's own type, so no cast lands on the column.

    A cast on the column side would block Parquet pushdown; a literal of the
    same type is folded and pushed.
    """
    stamp = _stamp(day)
    if not isinstance(data_type, (TimestampNTZType, TimestampType)) and stamp.time() != dt.time():
        raise ValueError(f"{day} has a time of day, but the column holds whole days")
    if isinstance(data_type, TimestampNTZType):
        return F.lit(stamp.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(data_type, TimestampType):
        return F.lit(stamp.isoformat(sep=" ")).cast("timestamp")
    if isinstance(data_type, DateType):
        return F.lit(stamp.date().isoformat()).cast("date")
    # dates stored as 'yyyy-MM-dd' text compare correctly as strings
    return F.lit(stamp.date().isoformat())


def date_text(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Date or timestamp column as text (D3)."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, fmt)
