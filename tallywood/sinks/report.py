"""Fixed-width report lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.functions.numbers import fixed_half_even


def left(value: Column, width: int) -> Column:
    """Padded on the right; a longer value keeps its length."""
    return F.format_string(f"%-{width}s", value.cast("string"))


def right(value: Column, width: int) -> Column:
    return F.format_string(f"%{width}s", value.cast("string"))


def cut(value: Column, width: int) -> Column:
    return F.substring(value, 1, width)


def two_digits(value: Column, width: int) -> Column:
    return right(fixed_half_even(value, 2), width)


def report_lines(df: DataFrame, cells: list[Column], sep: str = " ") -> DataFrame:
    """One text line per row, in the order of ``df``."""
    return df.select(F.concat_ws(sep, *cells).alias("line"))


def heading(titles: list[str], widths: list[int], rule: str, length: int) -> list[str]:
    """Column titles between two rules; a negative width aligns to the right."""
    cells = [t.ljust(w) if w > 0 else t.rjust(-w) for t, w in zip(titles, widths)]
    return [rule * length, " ".join(cells), rule * length]


def report_text(head: list[str], lines: DataFrame, foot: DataFrame | None = None) -> DataFrame:
    """Heading, lines and closing lines in order; ``lines`` and ``foot`` keep their own order.

    A union lists the partitions of its parts one after another, so nothing is sorted again.
    """
    top = lines.sparkSession.range(1).select(F.explode(F.lit(head).cast("array<string>")).alias("line"))
    whole = top.unionByName(lines)
    return whole if foot is None else whole.unionByName(foot)


def write_report(lines: DataFrame, path: str) -> None:
    """Ordered lines to text files; the order of the part files is the order of the lines."""
    lines.write.text(path)
