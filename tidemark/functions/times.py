"""Date bounds, stored high-water marks and the predicates that follow from them."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the form of a mark or bound, ISO-8601 with seconds and an offset.
ISO_8601 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})$"


def instant(text: Column) -> Column:
    """The instant of a well-formed timestamp string with a real calendar date; null for anything else."""
    return F.when(text.rlike(ISO_8601), text.try_cast("timestamp"))


def is_iso(text: Column) -> Column:
    return F.coalesce(instant(text).isNotNull(), F.lit(False))


def parse_iso(value: str) -> datetime:
    if not re.fullmatch(ISO_8601[1:-1], value):
        raise ValueError(f"not an ISO-8601 timestamp with seconds and offset: {value!r}")
    return datetime.fromisoformat(value).astimezone(UTC)


@dataclass(frozen=True)
class Bounds:
    """An optional inclusive start and end, compared as instants."""

    start: str | None = None
    end: str | None = None

    def __post_init__(self):
        ends = [parse_iso(v) for v in (self.start, self.end) if v is not None]
        if len(ends) == 2 and ends[0] > ends[1]:
            raise ValueError(f"start {self.start} must not be after end {self.end}")

    def __bool__(self) -> bool:
        return self.start is not None or self.end is not None

    def window(self) -> str:
        return f"[{self.start or '-∞'}, {self.end or '+∞'}]"


NO_BOUNDS = Bounds()


def window_text(start: Column, end: Column) -> Column:
    """The text of a window from its ends, as :meth:`Bounds.window` writes it."""
    return F.concat(F.lit("["), F.coalesce(start, F.lit("-∞")), F.lit(", "), F.coalesce(end, F.lit("+∞")), F.lit("]"))


def in_order(start: Column, end: Column) -> Column:
    """Whether a start is not after an end, as instants in milliseconds; a missing side is in order, a malformed one is not."""
    fits = lambda text: text.isNull() | is_iso(text)
    return fits(start) & fits(end) & F.coalesce(F.unix_millis(instant(start)) <= F.unix_millis(instant(end)), F.lit(True))


def as_instant(date: Column, kind: T.DataType) -> Column:
    """A date column as an instant that no session's time zone moves: dates, and timestamps without a zone, are in UTC."""
    if isinstance(kind, T.StringType):
        return instant(date)
    if isinstance(kind, T.TimestampNTZType):
        return F.make_timestamp_ltz(F.year(date), F.month(date), F.dayofmonth(date), F.hour(date), F.minute(date), F.date_part(F.lit("SECOND"), date), F.lit("UTC"))
    if isinstance(kind, T.DateType):
        none = F.lit(0)
        return F.make_timestamp_ltz(F.year(date), F.month(date), F.dayofmonth(date), none, none, none.cast("decimal(16,6)"), F.lit("UTC"))
    return date


def utc_text(at: Column) -> Column:
    """An instant as ISO-8601 text in UTC, to the second, in any session's time zone."""
    seconds = F.floor(F.unix_micros(at) / F.lit(1_000_000)).cast("decimal(18,6)")
    wall = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.concat(F.replace(wall.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def micros_text(micros: int) -> str:
    """Microseconds since 1970 as a mark: ISO-8601 in UTC."""
    return (datetime(1970, 1, 1) + timedelta(microseconds=micros)).isoformat(timespec="microseconds") + "Z"


def earlier(mark: str, by: timedelta) -> str:
    """The mark that lies so much before another."""
    return (parse_iso(mark) - by).replace(tzinfo=None).isoformat(timespec="microseconds") + "Z"


def _compared(date: Column, kind: T.DataType, sign: str, value: str) -> Column:
    """``date`` against an instant, as a literal of the column's own type, so that the comparison can be pushed to the scan."""
    at = parse_iso(value)
    if isinstance(kind, T.StringType):
        date, literal = instant(date), F.lit(at)
    elif isinstance(kind, T.TimestampNTZType):
        literal = F.lit(at.replace(tzinfo=None).isoformat(" ")).cast("timestamp_ntz")
    elif isinstance(kind, T.DateType):
        literal = F.lit(at.date())
        if sign == ">=" and at.time() != at.min.time():  # a date is its first instant, so it is past an instant within it only if it is a later date
            sign = ">"
    else:
        literal = F.lit(at)
    return date >= literal if sign == ">=" else date > literal if sign == ">" else date <= literal


def lower_bound(date: Column, kind: T.DataType, bounds: Bounds, mark: str | None, with_mark: bool = False) -> Column | None:
    """``>= start`` if the bounds have a start, else ``> mark`` (``with_mark``: ``>= mark``) if there is one."""
    if bounds.start is not None:
        return _compared(date, kind, ">=", bounds.start)
    return _compared(date, kind, ">=" if with_mark else ">", mark) if mark is not None else None


def upper_bound(date: Column, kind: T.DataType, bounds: Bounds) -> Column | None:
    return _compared(date, kind, "<=", bounds.end) if bounds.end is not None else None


def bounds_class(start: Column, end: Column, mark: Column, appends: Column) -> Column:
    """How bounds meet a mark, as instants in milliseconds; the first that holds."""
    s, e, m = F.unix_millis(start), F.unix_millis(end), F.unix_millis(mark)
    return F.when(s < m, "REWIND").when(s > m, "HOLE").when((s == m) & appends, "BOUNDARY").when(e < m, "EMPTY")


def first_run_class(start: Column, end: Column, mark: Column, kind: Column) -> Column:
    """Why a first run deserves a warning: no mark, no start, and either an end or all of an event log's history."""
    first = mark.isNull() & start.isNull() & (kind != "csv")
    return F.when(first & end.isNotNull(), "FRESH_END_ONLY").when(first & (kind == "elf"), "FIRST_RUN_ELF")
