"""Clock-time and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_to_decimal(clock: Column) -> Column:
    """``"HH:MM"`` to decimal hours; text that is not a time gives NULL."""
    parts = F.split(clock, ":")
    return F.get(parts, F.lit(0)).try_cast("double") + F.get(parts, F.lit(1)).try_cast("double") / 60.0


def decimal_to_time(hours: Column) -> Column:
    """Decimal hours to ``"HH:MM"``; minute 60 carries over, NULL stays NULL."""
    whole = F.floor(hours)
    minutes = (whole * 60 + F.round((hours - whole) * 60)).cast("int")
    return F.when(
        hours.isNotNull(),
        F.format_string("%02d:%02d", F.floor(minutes / 60).cast("int"), minutes % 60),
    )


def parse_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to DATE; text that does not fit the pattern gives NULL."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def iso_weekday(day: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(day) + 1


def months_spanned(first_year: Column, first_month: Column, last_year: Column, last_month: Column) -> Column:
    """Number of months from the first to the last period, both included."""
    return (last_year - first_year) * 12 + (last_month - first_month + 1)


def load_stamp(moment: Column | None = None) -> Column:
    """Load time as ISO text. Pass a fixed moment where runs must repeat."""
    moment = F.current_timestamp() if moment is None else moment
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
