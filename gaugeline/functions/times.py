"""Event time, date parts and day/hour buckets (UTC session)."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Years 0001 to 9999; outside them timestamps wrap or print as another year.
MIN_EVENT_MS = -62_135_596_800_000
MAX_EVENT_MS = 253_402_300_799_999


def in_event_range(ms: Column) -> Column:
    return ms.between(MIN_EVENT_MS, MAX_EVENT_MS)


def event_time(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp cut toward zero to whole seconds."""
    return F.when(in_event_range(ms), F.timestamp_seconds((ms / 1000).cast("bigint")))


def date_parts(when: Column, *names: str) -> dict[str, Column]:
    parts = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}
    return {name: parts[name](when) for name in names}


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def hour_text(hour: Column) -> Column:
    return F.date_format(hour, "yyyy-MM-dd HH:00")


def partition_day(frame: DataFrame) -> Column:
    """The day a row's partition stands for; only partition columns are read."""
    return F.make_date(frame["year"], frame["month"], frame["day"])


def typed_time(frame: DataFrame, name: str) -> DataFrame:
    """Parse ``name`` where it is text (unreadable text becomes NULL).

    A typed column is left alone, so filters on it still reach the files.
    """
    if isinstance(frame.schema[name].dataType, T.StringType):
        return frame.withColumn(name, F.try_to_timestamp(F.col(name)))
    return frame


def as_utc(moment: datetime | None) -> datetime:
    """``None`` is now; a time without zone is taken as UTC."""
    if moment is None:
        return datetime.now(timezone.utc)
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def timestamp_literal(moment: datetime) -> Column:
    micros = (as_utc(moment) - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def iso_text(when: Column) -> Column:
    """ISO-8601 with offset; the fraction is written only where there is one."""
    fraction = F.when(F.unix_micros(when) % 1_000_000 != 0, F.date_format(when, ".SSSSSS"))
    return F.concat(
        F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss"),
        F.coalesce(fraction, F.lit("")),
        F.date_format(when, "xxx"),
    )
