"""Dates are ``yyyyMMdd`` strings, instants are epoch milliseconds.

Everything is computed in UTC from integers and dates, so the result does not
depend on the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from .numeric import as_col

DAY = "yyyyMMdd"
DAY_MS = 86_400_000
HOUR_MS = 3_600_000
MINUTE_MS = 60_000


def day_shift(day: str, n: int) -> str:
    """Driver-side shift of a date argument."""
    return (dt.datetime.strptime(day, "%Y%m%d") + dt.timedelta(days=n)).strftime("%Y%m%d")


def day_span(start: str, end: str) -> list[str]:
    days = (dt.datetime.strptime(end, "%Y%m%d") - dt.datetime.strptime(start, "%Y%m%d")).days
    return [day_shift(start, i) for i in range(days + 1)]


def to_day(c) -> Column:
    return F.to_date(as_col(c), DAY)


def shift(c, n) -> Column:
    return F.date_format(F.date_add(to_day(c), n), DAY)


def gap(a, b) -> Column:
    """Days from a to b, signed."""
    return F.date_diff(to_day(b), to_day(a))


def sequence_up(start, end) -> Column:
    days = F.sequence(to_day(start), to_day(end))
    return F.transform(days, lambda d: F.date_format(d, DAY))


def sequence_down(end, n: int) -> Column:
    """The end date and the n days before it, newest first."""
    days = F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.date_sub(to_day(end), i))
    return F.transform(days, lambda d: F.date_format(d, DAY))


def hour_of(ms) -> Column:
    return F.floor(F.pmod(as_col(ms), F.lit(DAY_MS)) / HOUR_MS).cast("int")


def minute_of(ms) -> Column:
    return F.floor(F.pmod(as_col(ms), F.lit(HOUR_MS)) / MINUTE_MS).cast("int")


def quarter_of_day(ms) -> Column:
    """0 … 95, the quarter hour of the day."""
    return F.floor(F.pmod(as_col(ms), F.lit(DAY_MS)) / (15 * MINUTE_MS)).cast("int")


def date_of(ms) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(as_col(ms) / DAY_MS).cast("int"))


def day_of(ms) -> Column:
    return F.date_format(date_of(ms), DAY)


def stamp_of(ms) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of an instant."""
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    second = F.floor(F.pmod(as_col(ms), F.lit(MINUTE_MS)) / 1000).cast("int")
    clock = F.concat_ws(":", two(hour_of(ms)), two(minute_of(ms)), two(second))
    return F.concat_ws(" ", F.date_format(date_of(ms), "yyyy-MM-dd"), clock)


def day_start_ms(c) -> Column:
    return F.unix_date(to_day(c)).cast("long") * F.lit(DAY_MS)


def stamp_to_ms(c) -> Column:
    """``yyyyMMddHHmmss`` to epoch milliseconds."""
    c = as_col(c)
    number = lambda start: F.substring(c, start, 2).cast("long")
    return (day_start_ms(F.substring(c, 1, 8)) + number(9) * HOUR_MS + number(11) * MINUTE_MS + number(13) * 1000)


def ntz_ms(c) -> Column:
    """Epoch milliseconds of a zone-less timestamp read as UTC."""
    c = as_col(c)
    within = (F.hour(c).cast("long") * HOUR_MS + F.minute(c).cast("long") * MINUTE_MS
              + F.floor(F.date_part(F.lit("SECOND"), c) * 1000).cast("long"))
    return F.unix_date(c.cast("date")).cast("long") * F.lit(DAY_MS) + within


def iso_weekday(c) -> Column:
    """Monday 1 … Sunday 7, as double."""
    return (F.weekday(to_day(c)) + 1).cast("double")


def dashed(c) -> Column:
    c = as_col(c)
    return F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))


def path_of(c) -> Column:
    """``/year=yyyy/month=MM/day=dd`` folder of a date."""
    c = as_col(c)
    return F.concat(F.lit("/year="), F.substring(c, 1, 4), F.lit("/month="), F.substring(c, 5, 2),
                    F.lit("/day="), F.substring(c, 7, 2))
