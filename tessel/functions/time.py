"""Timestamps as texts with an explicit offset of +02:00, to the second."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFSET = "+02:00"
_SHAPE = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}):(\d{2})(?::(\d{2}))?(?:\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"


def rendered(ts: Column) -> Column:
    """A timestamp's wall clock at +02:00. Needs the session's time zone to be UTC."""
    return F.concat(F.date_format(F.from_utc_timestamp(ts, OFFSET), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(OFFSET))


def instant(text: Column) -> Column:
    """The instant that a text with an offset names; null if it names none."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))


def normalised(text: Column) -> Column:
    """ISO date or date and time, any offset (none: +02:00), to +02:00; null for anything else, or no real date."""
    v = F.trim(text)
    part = lambda i: F.regexp_extract(v, _SHAPE, i)
    or_zero = lambda c: F.when(c == "", "00").otherwise(c)
    zone = part(5)
    zone = F.when(zone == "", OFFSET).when(zone == "Z", "+00:00").when(F.length(zone) == 5, F.concat(F.substr(zone, F.lit(1), F.lit(3)), F.lit(":"), F.substr(zone, F.lit(4), F.lit(2)))).otherwise(zone)
    iso = F.concat(part(1), F.lit("T"), or_zero(part(2)), F.lit(":"), or_zero(part(3)), F.lit(":"), or_zero(part(4)), zone)
    real = v.rlike(_SHAPE) & F.try_to_date(part(1), "yyyy-MM-dd").isNotNull() & (or_zero(part(2)) <= "23") & (or_zero(part(3)) <= "59") & (or_zero(part(4)) <= "59")
    return F.when(real, rendered(instant(iso)))


def local_date(text: Column) -> Column:
    return F.substr(text, F.lit(1), F.lit(10))


def clock(text: Column) -> Column:
    """HH:MM of a normalised text."""
    return F.substr(text, F.lit(12), F.lit(5))


def plus_months(ts: Column, months: int) -> Column:
    """Months later; a day that the month lacks rolls over into the next (add_months would clamp)."""
    first = F.trunc(ts, "month")
    days = F.datediff(F.to_date(ts), first)
    day = F.date_add(F.add_months(first, months), days)
    return F.timestamp_micros(F.unix_micros(day.cast("timestamp")) + F.unix_micros(ts) - F.unix_micros(F.to_date(ts).cast("timestamp")))
