"""Event time: lenient parsing, ISO output, windows, freshness and relative times.  Session time zone: UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(x: Column) -> Column:
    """A timestamp in milliseconds, null where a string is none (or has no date)."""
    return F.date_trunc("millisecond", F.when(x.rlike(r"^\d{4}"), F.try_to_timestamp(x)))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def in_window(ts: Column, now: Column, minutes: float, future_seconds: int = 60) -> Column:
    """Both bounds inclusive."""
    back = F.make_dt_interval(secs=F.lit(float(minutes) * 60))
    return ts.isNotNull() & (ts >= now - back) & (ts <= now + F.make_dt_interval(secs=F.lit(float(future_seconds))))


def age_seconds(ts: Column, now: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.floor((F.unix_millis(now) - F.unix_millis(ts)) / 1000))


def time_ago(ts: Column, now: Column) -> Column:
    s = age_seconds(ts, now)
    m = F.floor(s / 60)
    return F.when(s < 60, F.concat(s.cast("string"), F.lit("秒前"))).when(m < 60, F.concat(m.cast("string"), F.lit("分前"))).otherwise(F.concat(F.floor(m / 60).cast("string"), F.lit("時間前")))


def is_fresh(ts: Column, now: Column, minutes: int = 10) -> Column:
    return F.unix_millis(now) - F.unix_millis(ts) < minutes * 60_000


def clock(ts: Column) -> Column:
    return F.date_format(ts, "H:mm:ss")
