"""Which records count as recent: local calendar windows, with fallbacks for missing publication times."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import urls
from tidewire.functions.instants import at_clock, written_time

LEAST_CHARS = 200


def day_window(day: str, zone: str, days: int = 1) -> tuple[int, int, list[str]]:
    """(start, end, days) of the local days ending on ``day``: half-open instants in microseconds, and the days' names."""
    last, tz = date.fromisoformat(day), ZoneInfo(zone)
    first = last - timedelta(days=max(1, days) - 1)
    at = lambda d: int(datetime(d.year, d.month, d.day, tzinfo=tz).timestamp()) * 1_000_000
    return at(first), at(last + timedelta(days=1)), [(last - timedelta(days=i)).isoformat() for i in range(max(1, days))]


def published_micros(text: Column) -> Column:
    """The instant a publication text names, local times read as UTC; null where it names none."""
    t = written_time(text, F.lit("dmy"))
    return F.coalesce(t["micros"], at_clock(t, F.lit("UTC")))


def _micros(ntz: Column) -> Column:
    return F.unix_micros(F.to_timestamp(F.concat(F.date_format(ntz, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("Z"))))


def recent(articles: DataFrame, day: str, zone: str, days: int = 2) -> DataFrame:
    """Articles published in the window; without a readable publication time, those extracted in it whose URL names one of
    its days or whose text is long enough. A readable time outside the window excludes, whenever the row was extracted.
    """
    start, end, names = day_window(day, zone, days)
    pub, ext = published_micros(F.col("published_at")), _micros(F.col("extracted_at"))
    inside = lambda c: (c >= start) & (c < end)
    likely = urls.names_recent_day(F.col("url"), names) | (F.coalesce("content_length", F.lit(0)) >= LEAST_CHARS)
    return articles.filter(F.when(pub.isNotNull(), inside(pub)).otherwise(F.coalesce(inside(ext) & likely, F.lit(False))))


def local_day(micros: Column, zone: str) -> Column:
    """The local day of an instant as yyyy-mm-dd, whatever the session's zone."""
    # a local clock is the instant shifted by the zone's offset; read back as UTC days
    shifted = F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(micros), zone)) if zone != "UTC" else micros
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(shifted / 86_400_000_000).cast("int")).cast("string")


def fresh_by_day(articles: DataFrame, day: str, zone: str, days: int, as_of: str, hours: int) -> DataFrame:
    """Articles whose publication day is one of the window's; without one, those extracted within ``hours`` before ``as_of``
    on one of its days."""
    _, _, names = day_window(day, zone, days)
    ext = _micros(F.col("extracted_at"))
    pub_day = local_day(published_micros(F.col("published_at")), zone)
    since = int(datetime.fromisoformat(as_of).replace(tzinfo=ZoneInfo("UTC")).timestamp() - 3600 * hours) * 1_000_000
    late = (ext >= since) & local_day(ext, zone).isin(names)
    return articles.filter(F.when(pub_day.isNotNull(), pub_day.isin(names)).otherwise(F.coalesce(late, F.lit(False))))
