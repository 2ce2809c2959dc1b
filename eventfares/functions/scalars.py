"""Column functions shared by the operators. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventfares.settings import DAYS_BEFORE, PRESENCE_THRESHOLD

ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
COMPACT_STAMP = "yyyyMMddHHmmss"


def city_name(city: Column) -> Column:
    """Text before the first comma, not trimmed: `Dublin, Ireland` -> `Dublin`."""
    return F.split_part(city, F.lit(","), F.lit(1))


def zero_below(value: Column, threshold: float = PRESENCE_THRESHOLD) -> Column:
    """Values under the threshold become 0; the rest, null included, stay."""
    return F.when(value < threshold, F.lit(0)).otherwise(value)


def day_range(first: Column, days: Column) -> Column:
    """The `days` dates from `first` on, as an array; empty if there are none."""
    none = F.array().cast("array<date>")
    return F.when(days < 1, none).otherwise(F.sequence(first, F.date_add(first, days - 1)))


def days_before(event_date: Column, days: int = DAYS_BEFORE) -> Column:
    """The dates from `days` before the event up to the day before it, as an array."""
    return day_range(F.date_sub(event_date, days), F.lit(days))


def days_after(flight_date: Column, days: int = DAYS_BEFORE) -> Column:
    """The event dates a flight on `flight_date` serves: the mirror image of `days_before`."""
    return day_range(F.date_add(flight_date, 1), F.lit(days))


def in_window(flight_date: Column, event_date: Column, days: int = DAYS_BEFORE) -> Column:
    """True from `days` before the event to the day before; both ends of the range are open."""
    return (flight_date > F.date_sub(event_date, days + 1)) & (flight_date < event_date)


def whole_price(price: Column) -> Column:
    """Price rounded to a whole number, halves to the even neighbour."""
    return F.bround(price, 0).cast("long")


def instant_text(moment: Column) -> Column:
    """ISO text of a date or timestamp, with milliseconds and zone."""
    return F.date_format(moment.cast("timestamp"), ISO_INSTANT)


def compact_stamp(moment: Column) -> Column:
    """`yyyyMMddHHmmss` text of a timestamp."""
    return F.date_format(moment, COMPACT_STAMP)


def once(costly: Column) -> Column:
    """The value of a costly expression, worked out once per row.

    A filter on a plain projection is moved below it together with a copy of the expression, once
    for every mention. It cannot be moved below a generator; this is one with a single element.
    """
    return F.explode(F.array(costly))
