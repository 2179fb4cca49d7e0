"""Local time parts, holiday flags and time ranges.

Times are UTC instants in ``timestamp_ntz`` columns. Every local value takes the zone as an
argument, so results do not depend on the session zone or on the clock.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, date, datetime, time, timedelta
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------------------------
LOCAL_TZ = "Europe/Berlin"
SUMMER_HOLIDAYS = "Sommerferien"
WINTER_OFFSET_HOURS = 1
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# ----------------------------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_time(ts: Column | str, tz: str = LOCAL_TZ) -> Column:
    """Wall-clock time in ``tz`` of a UTC instant."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _col(ts))


def utc_instant(ts: Column | str, tz: str = LOCAL_TZ) -> Column:
    """UTC instant of a wall-clock time in ``tz``."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _col(ts))


def day_of_week(ts: Column | str, tz: str = LOCAL_TZ) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(local_time(ts, tz)) + 1


def is_winter_time(ts: Column | str, tz: str = LOCAL_TZ, hours: int = WINTER_OFFSET_HOURS) -> Column:
    """True where the zone is ``hours`` ahead of UTC. Both sides are zone-free timestamps, so the
    difference is exact whatever the session zone does."""
    return (local_time(ts, tz) - _col(ts)) == F.make_dt_interval(hours=F.lit(hours))


def local_date(ts: Column | str, tz: str = LOCAL_TZ) -> Column:
    return F.to_date(local_time(ts, tz))


def summer_holidays(kind: Column | str) -> Column:
    return F.coalesce(_col(kind) == SUMMER_HOLIDAYS, F.lit(False))


def other_school_holidays(kind: Column | str) -> Column:
    return F.coalesce(_col(kind) != SUMMER_HOLIDAYS, F.lit(False))


def format_timestamp(ts: Column | str) -> Column:
    return F.date_format(_col(ts), TIMESTAMP_FORMAT)


def time_part_columns(ts: Column | str, tz: str = LOCAL_TZ) -> dict[str, Column]:
    return {
        "day_of_week": day_of_week(ts, tz),
        "year": F.year(local_time(ts, tz)),
        "hour": F.hour(local_time(ts, tz)),
        "winter_time": is_winter_time(ts, tz),
    }


def time_parts(df: DataFrame, ts: str = "date_time", tz: str = LOCAL_TZ) -> DataFrame:
    return df.withColumns(time_part_columns(ts, tz))


def _to_utc(local: datetime, tz: str) -> datetime:
    return local.replace(tzinfo=ZoneInfo(tz)).astimezone(UTC).replace(tzinfo=None)


def _as_datetime(value: str | date | datetime) -> datetime:
    if isinstance(value, str):
        return datetime.fromisoformat(value)
    if isinstance(value, datetime):
        return value
    return datetime.combine(value, time())


def _local_now(as_of: datetime, tz: str) -> datetime:
    return as_of.replace(tzinfo=UTC).astimezone(ZoneInfo(tz)).replace(tzinfo=None)


@dataclass(frozen=True)
class TimeRange:
    """Bounds on a UTC column, held as plain values so that the filter reaches the scan.

    ``as_of`` in the constructors is the UTC instant that stands for "now".
    """

    start: datetime | None = None
    end: datetime | None = None
    include_start: bool = True
    include_end: bool = True

    @classmethod
    def closed(cls, start, end, tz: str = LOCAL_TZ) -> TimeRange:
        return cls(_to_utc(_as_datetime(start), tz), _to_utc(_as_datetime(end), tz))

    @classmethod
    def half_open(cls, start, end, tz: str = LOCAL_TZ) -> TimeRange:
        return cls(_to_utc(_as_datetime(start), tz), _to_utc(_as_datetime(end), tz), include_end=False)

    @classmethod
    def local_year(cls, year: int, tz: str = LOCAL_TZ) -> TimeRange:
        return cls.half_open(datetime(year, 1, 1), datetime(year + 1, 1, 1), tz)

    @classmethod
    def since(cls, start, as_of: datetime, weeks: int = 16, tz: str = LOCAL_TZ) -> TimeRange:
        """From ``start`` to the same wall-clock time ``weeks`` after ``as_of``."""
        end = _to_utc(_local_now(as_of, tz) + timedelta(weeks=weeks), tz)
        return cls(_to_utc(_as_datetime(start), tz), end)

    @classmethod
    def around_today(
        cls, as_of: datetime, days_back: int = 1, weeks: int = 16, tz: str = LOCAL_TZ
    ) -> TimeRange:
        """From midnight ``days_back`` days ago to midnight ``weeks`` ahead, both included."""
        today = datetime.combine(_local_now(as_of, tz).date(), time())
        return cls(
            _to_utc(today - timedelta(days=days_back), tz), _to_utc(today + timedelta(weeks=weeks), tz)
        )

    @classmethod
    def until(cls, as_of: datetime, weeks: int = 12, tz: str = LOCAL_TZ) -> TimeRange:
        """Up to midnight ``weeks`` after today."""
        today = datetime.combine(_local_now(as_of, tz).date(), time())
        return cls(None, _to_utc(today + timedelta(weeks=weeks), tz))

    def predicate(self, ts: Column | str = "date_time") -> Column:
        c = _col(ts)
        parts = []
        if self.start is not None:
            low = _ntz(self.start)
            parts.append(c >= low if self.include_start else c > low)
        if self.end is not None:
            high = _ntz(self.end)
            parts.append(c <= high if self.include_end else c < high)
        return reduce(lambda a, b: a & b, parts, F.lit(True))

    def hours(self) -> int:
        """Number of full hours in the range."""
        if self.start is None or self.end is None:
            raise ValueError("an open range has no hour count")
        first = self.start if self.include_start else self.start + timedelta(seconds=1)
        last = self.end if self.include_end else self.end - timedelta(seconds=1)
        n_first = -((datetime(1970, 1, 1) - first) // timedelta(hours=1))
        n_last = (last - datetime(1970, 1, 1)) // timedelta(hours=1)
        return max(0, n_last - n_first + 1)


def _ntz(value: datetime) -> Column:
    return F.to_timestamp_ntz(F.lit(value.isoformat(sep=" ")))
