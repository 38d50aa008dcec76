"""Timestamps. Text without an offset means UTC, and text is written in UTC, in any session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


_FULL_DATE = r"^\d{4}-\d{2}-\d{2}([T ]\d{1,2}:\d{2}.*)?$"
_OFFSET = r"(?i)(Z|UTC|GMT|[+-]\d{1,2}(:?\d{2}){0,2}|[a-z_]+/[a-z_/]+)$"


def parse_iso(text: Column | str) -> Column:
    """ISO-8601 text to a timestamp; NULL (not the current time) where it cannot be read.

    A full date is asked for: a bare time would become today and a bare year its first day.
    """
    whole = F.trim(_c(text))
    clock = F.substring(whole, 11, 100)  # what follows the date, whose own dashes are no offset
    dated = F.when(F.length(whole) == 10, F.concat(whole, F.lit("T00:00:00"))).otherwise(whole)
    zoned = F.when(clock.rlike(_OFFSET), dated).otherwise(F.concat(dated, F.lit("Z")))
    return F.when(whole.rlike(_FULL_DATE), F.try_to_timestamp(zoned))


def micros(ts: Column | str) -> Column:
    return F.unix_micros(_c(ts).cast("timestamp"))


def elapsed_ms(start: Column | str, end: Column | str) -> Column:
    return (micros(end) - micros(start)) / F.lit(1000.0)


def elapsed_sec(start: Column | str, end: Column | str) -> Column:
    return (micros(end) - micros(start)) / F.lit(1000000.0)


def from_ntz(ts: str) -> Column:
    """A zone-less timestamp, which means UTC, as a moment; the session zone has no say."""
    past = f"({ts} - TIMESTAMP_NTZ'1970-01-01 00:00:00')"
    whole = f"extract(DAY FROM {past}) * 86400L + extract(HOUR FROM {past}) * 3600"
    whole += f" + extract(MINUTE FROM {past}) * 60"
    part = f"CAST(extract(SECOND FROM {past}) * 1000000 AS BIGINT)"
    return F.expr(f"timestamp_micros(({whole}) * 1000000L + {part})")


def _utc(ts: Column | str) -> Column:
    """The UTC clock as a zone-less timestamp."""
    seconds = (micros(ts).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


def iso_text(ts: Column | str) -> Column:
    """UTC timestamp as ISO text with microseconds and no offset, as request messages carry it."""
    clock = _utc(ts).cast("string")
    part = F.lpad(F.pmod(micros(ts), F.lit(1_000_000)).cast("string"), 6, "0")
    day, time = F.substring(clock, 1, 10), F.substring(clock, 12, 8)
    return F.concat(day, F.lit("T"), time, F.lit("."), part)


def long_date(ts: Column | str) -> Column:
    return F.date_format(_utc(ts).cast("date"), "MMMM dd, yyyy")


def run_stamp(ts: Column | str) -> Column:
    clock = F.translate(F.substring(_utc(ts).cast("string"), 1, 19), "-:", "")
    return F.translate(clock, " ", "_")
