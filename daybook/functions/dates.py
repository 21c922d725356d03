"""Date and timestamp column expressions.

All timestamps are ``TIMESTAMP_NTZ`` (wall clock, no zone).  Spark's
``date_trunc`` and ``date + interval`` return zoned ``TIMESTAMP``; the
helpers here stay in NTZ so results do not depend on the session zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.constants import CLOSE_OFFSET, OPEN_UNTIL, PASSPORT_GRACE

DateLike = str | _dt.date | Column


def as_date(d: DateLike) -> Column:
    if isinstance(d, Column):
        return d.cast("date")
    if isinstance(d, _dt.datetime):
        d = d.date()
    if isinstance(d, _dt.date):
        d = d.isoformat()
    return F.lit(d).cast("date")


def as_ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def ntz_lit(ts: _dt.datetime) -> Column:
    """A wall-clock literal.  Built from text: a Python ``datetime`` literal is
    a zoned TIMESTAMP, and casting it to NTZ would shift it by the session zone."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def date_start(d: DateLike) -> Column:
    """Midnight at the start of ``d`` as TIMESTAMP_NTZ."""
    return as_ntz(as_date(d))


def open_until() -> Column:
    """The open-validity sentinel (2999-12-31 00:00:00)."""
    return ntz_lit(OPEN_UNTIL)


def close_ts(batch_date: DateLike) -> Column:
    """End of validity for rows closed by ``batch_date``: the day before, 23:59:59."""
    return date_start(batch_date) - F.expr(CLOSE_OFFSET)


def passport_expired(valid_to: Column, ts: Column) -> Column:
    """Passport is valid through 23:59:59 of ``valid_to``; a NULL date never expires."""
    return (as_ntz(valid_to) + F.expr(PASSPORT_GRACE)) < ts


def contract_ended(valid_to: Column, ts: Column) -> Column:
    """A contract ends at midnight at the *start* of ``valid_to``."""
    return as_ntz(valid_to) < ts


def clock_hour(ts: Column) -> tuple[Column, Column]:
    """(day, hour of day) of a wall-clock timestamp: a zone-free hour bucket."""
    return F.to_date(ts).alias("tx_day"), F.hour(ts).alias("tx_hour")
