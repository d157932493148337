"""Time expressions. Labels follow the session time zone, which the settings fix to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywood.functions.numbers import round_half_even

# An epoch above MILLIS_ABOVE counts milliseconds; years 1 to 9999 are valid.
MILLIS_ABOVE = 1_000_000_000_000
FIRST_SECOND = -62_135_596_800
LAST_SECOND = 253_402_300_799
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"

SECONDS_PER_DAY = 86_400


def epoch_year(epoch: Column) -> Column:
    """UTC year of an epoch in seconds or milliseconds; null outside the years 1 to 9999."""
    seconds = F.when(epoch > MILLIS_ABOVE, F.floor(epoch / 1000)).otherwise(epoch)
    in_range = seconds.between(FIRST_SECOND, LAST_SECOND)
    day = F.when(in_range, F.floor(seconds / SECONDS_PER_DAY).cast("int"))
    return F.year(F.date_from_unix_date(day))


def minute_of(epoch_seconds: Column) -> Column:
    """Whole minutes since the epoch, to group by."""
    return F.floor(epoch_seconds / 60).cast("bigint")


def minute_label(minutes: Column) -> Column:
    """Whole minutes since the epoch to a ``yyyy-MM-dd HH:mm`` label."""
    return F.date_format(F.timestamp_seconds(minutes * 60), MINUTE_FORMAT)


def in_year(moment: Column, year: int) -> Column:
    """Half-open range on the column itself, so that file and row-group statistics prune."""
    return (moment >= F.make_date(F.lit(year), F.lit(1), F.lit(1))) & (
        moment < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))
    )


def day_difference(end: Column, start: Column) -> Column:
    """Whole calendar days from ``start`` to ``end``."""
    return F.datediff(end, start)


def elapsed_ms(start_seconds: Column, end_seconds: Column) -> Column:
    return round_half_even((end_seconds - start_seconds) * 1000, 2)
