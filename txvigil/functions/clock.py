"""Time expressions on zone-less timestamps; none of them depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_minute(at: Column) -> Column:
    """Whole minutes since 1970-01-01 00:00."""
    return F.unix_date(at.cast("date")).cast("long") * 1440 + F.hour(at) * 60 + F.minute(at)


def epoch_us(at: Column) -> Column:
    """Microseconds since 1970-01-01 00:00."""
    micros = (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("long")
    return epoch_minute(at) * 60_000_000 + micros


def parse_timestamp(text: Column, pattern: str | None = None) -> Column:
    """Text to a zone-less timestamp, with a Spark datetime pattern or in ISO form."""
    if pattern is None:
        return text.cast("timestamp_ntz")
    return F.to_timestamp_ntz(text, F.lit(pattern))


def stamp(day: Column, pattern: str = "yyyyMMdd") -> Column:
    """Date to the text used in drop names."""
    return F.date_format(day, pattern)
