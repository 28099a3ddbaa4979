"""Time-of-day expressions on UTC wall times (TIMESTAMP_NTZ).

The expressions are SQL text so that the DataFrame operators and the persistent
staging views share one definition.  None of them depends on the session time zone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampType


def _minutes(time_of_day: str) -> int:
    hour, minute = time_of_day.split(":")
    return int(hour) * 60 + int(minute)


@dataclass(frozen=True)
class TradingSession:
    """Opening and closing time of day.

    The default is a fixed 14:30-21:00 UTC session and keeps bars from the start of
    the hour of the open (so minutes -30 to -1 appear).  ``strict_open`` starts at the
    open itself.  With ``zone`` the times are local to it, which follows daylight time.
    """

    open_time: str = "14:30"
    close_time: str = "21:00"
    zone: str | None = None
    strict_open: bool = False

    @property
    def wall_time(self) -> str:
        return f"convert_timezone('UTC', '{self.zone}', bar_time)" if self.zone else "bar_time"

    @property
    def minute_of_day(self) -> str:
        return f"(hour({self.wall_time}) * 60 + minute({self.wall_time}))"

    @property
    def first_minute(self) -> int:
        opened = _minutes(self.open_time)
        return opened if self.strict_open else opened // 60 * 60

    @property
    def slot_range(self) -> tuple[int, int]:
        """First and last possible minutes_since_open."""
        opened = _minutes(self.open_time)
        return self.first_minute - opened, _minutes(self.close_time) - 1 - opened

    def columns(self) -> dict[str, str]:
        """Derived column -> SQL text.  Both ends of the minute difference lie on one
        date, so counting minute boundaries is a difference of minutes of the day."""
        return {
            "trade_date": f"cast({self.wall_time} as date)",
            "bar_hour": f"hour({self.wall_time})",
            "bar_minute": f"minute({self.wall_time})",
            "minutes_since_open": f"cast({self.minute_of_day} - {_minutes(self.open_time)} as bigint)",
            "day_of_week": f"weekday(cast({self.wall_time} as date)) + 1",
        }

    def contains(self) -> str:
        """Condition on the bar.  One look at the hour decides; the minute only matters
        where the session does not start or end on the hour."""
        first, end = self.first_minute, _minutes(self.close_time)
        hours = ", ".join(str(hour) for hour in range(first // 60, (end - 1) // 60 + 1))
        parts = [f"hour({self.wall_time}) in ({hours})"]
        if first % 60:
            parts.append(f"{self.minute_of_day} >= {first}")
        if end % 60:
            parts.append(f"{self.minute_of_day} < {end}")
        return " and ".join(parts)


UTC_SESSION = TradingSession()
NEW_YORK_SESSION = TradingSession("09:30", "16:00", "America/New_York")

# A time of day followed by a sign or a letter: an offset, Z or the name of a zone.
_HAS_ZONE = r"\d:\d{2}(:\d{2}(\.\d+)?)?\s*[A-Za-z+-]\S*\s*$"


def utc_wall_time(value: Column, kind: DataType) -> Column:
    """TIMESTAMP_NTZ in UTC from a text, an instant or a wall time.

    Text with an offset or zone names an instant; text without one is taken as UTC.
    """
    def from_instant(instant: Column) -> Column:
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)

    if isinstance(kind, TimestampType):
        return from_instant(value)
    if isinstance(kind, StringType):
        return F.when(value.rlike(_HAS_ZONE), from_instant(value.cast("timestamp"))).otherwise(
            value.cast("timestamp_ntz")
        )
    return value.cast("timestamp_ntz")
