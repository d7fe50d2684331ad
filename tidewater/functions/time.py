"""Time parsing and time-of-day helpers as Column expressions.

Instants (timestamps) are read in UTC whatever the session's time zone is;
wall-clock times come from ``to_zone`` as if they were UTC (see ``session.py``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: spreadsheet serial days count from 1899-12-30, which is day
# 25569 before the Unix epoch.
SERIAL_EPOCH_OFFSET_DAYS = 25569
MICROS_PER_DAY = 86400 * 1_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: Column | str) -> Column:
    """ISO-8601 UTC text (``2023-01-05T10:20:30.123Z``, 0-6 fraction digits) to timestamp.

    Unparseable text gives NULL instead of failing the job.
    """
    return F.try_to_timestamp(_col(c))


def iso_text(ts: Column | str) -> Column:
    """Timestamp to the API's text form with millisecond fraction and ``Z``."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def local_hour(ts: Column | str, shift: int = -5) -> Column:
    """Hour of day after a fixed hour shift, wrapped into 0..23 (date is not moved)."""
    hours = F.floor(micros_of_day(ts) / F.lit(3_600_000_000)).cast("int")
    return F.pmod(hours + F.lit(shift), F.lit(24)).cast("long")


def zone_hour(ts: Column | str, tz: str) -> Column:
    """Hour of day in a real time zone (daylight saving aware)."""
    return local_hour(to_zone(ts, tz), 0)


def serial_to_ts(c: Column | str) -> Column:
    """Spreadsheet serial days (days since 1899-12-30, UTC) to a timestamp."""
    micros = F.round((_col(c) - F.lit(SERIAL_EPOCH_OFFSET_DAYS)) * F.lit(float(MICROS_PER_DAY)))
    return F.timestamp_micros(micros.cast("long"))


def ts_to_serial(ts: Column | str) -> Column:
    """Timestamp to spreadsheet serial days (inverse of ``serial_to_ts``)."""
    return F.unix_micros(_col(ts).cast("timestamp")) / F.lit(float(MICROS_PER_DAY)) + F.lit(SERIAL_EPOCH_OFFSET_DAYS)


def to_zone(ts: Column | str, tz: str) -> Column:
    """UTC instant to wall-clock time of ``tz`` (a zone-less local timestamp)."""
    return F.from_utc_timestamp(_col(ts), tz)


def micros_of_day(ts: Column | str) -> Column:
    """Microseconds since midnight UTC of a timestamp."""
    return F.pmod(F.unix_micros(_col(ts).cast("timestamp")), F.lit(MICROS_PER_DAY))


def _hms_micros(text: str) -> int:
    parts = [float(p) for p in text.split(":")]
    while len(parts) < 3:
        parts.append(0.0)
    h, m, s = parts
    return int(round((h * 3600 + m * 60 + s) * 1_000_000))


def between_time(ts: Column | str, lo: str = "09:30:00", hi: str = "16:00:00") -> Column:
    """Time-of-day range predicate, inclusive at both ends."""
    mod = micros_of_day(ts)
    return (mod >= F.lit(_hms_micros(lo))) & (mod <= F.lit(_hms_micros(hi)))


# Fixed values (our own; the source keeps no bounds): day parts by local hour,
# morning [6, 12), afternoon [12, 18), night otherwise; "night" is the base level.
DAY_PARTS = (("morning", 6, 12), ("afternoon", 12, 18))


def day_part_dummies(hour: Column | str, prefix: str = "tweet_period_") -> list[Column]:
    """0/1 columns per day part against the base level (night)."""
    h = _col(hour)
    return [((h >= F.lit(lo)) & (h < F.lit(hi))).cast("int").alias(prefix + name) for name, lo, hi in DAY_PARTS]
