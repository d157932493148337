"""Bands and status labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (label, highest age in the band); None marks the open last band.
FOUR_BANDS = (("0-18", 18), ("18-35", 35), ("35-50", 50), ("50+", None))
SEVEN_BANDS = (
    ("<18", 17),
    ("18-24", 24),
    ("25-34", 34),
    ("35-44", 44),
    ("45-49", 49),
    ("50-55", 55),
    ("56+", None),
)
EARLY, ON_TIME, LATE = "early", "on time", "late"


def band_of(age: Column, bands: tuple[tuple[str, int | None], ...]) -> Column:
    """Label of the first band whose upper end is not below ``age``; null for a null age."""
    label = F.lit(None).cast("string")
    for name, highest in reversed(bands):
        label = F.lit(name) if highest is None else F.when(age <= highest, name).otherwise(label)
    return F.when(age.isNotNull(), label)


def band_conditions(
    age: Column, bands: tuple[tuple[str, int | None], ...]
) -> dict[str, Column]:
    """One condition per band; at most one of them holds."""
    conditions, above = {}, None
    for name, highest in bands:
        parts = [] if above is None else [age > above]
        parts += [] if highest is None else [age <= highest]
        conditions[name] = parts[0] if len(parts) == 1 else parts[0] & parts[1]
        above = highest
    return conditions


def delivery_status(days: Column) -> Column:
    """Early, on time or late; an unknown difference counts as late."""
    return F.when(days < 0, EARLY).when(days == 0, ON_TIME).otherwise(LATE)


def label_or(name: Column, prefix: str, key: Column, suffix: str = "") -> Column:
    """``name``, or a label made from the key where the lookup found none."""
    return F.coalesce(name, F.concat(F.lit(prefix), key.cast("string"), F.lit(suffix)))


def same_letter(value: Column, letter: str) -> Column:
    """Equality that ignores case."""
    return F.upper(value) == letter.upper()
