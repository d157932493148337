"""Text outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_value_lines(df: DataFrame, key: str, value: str, sep: str = "\t") -> DataFrame:
    line = F.concat(F.col(key).cast("string"), F.lit(sep), F.col(value).cast("string"))
    return df.select(line.alias("line"))


def write_key_value(df: DataFrame, path: str, key: str, value: str, sep: str = "\t") -> None:
    key_value_lines(df, key, value, sep).write.text(path)


def bag_text(bag: Column, fields: list[str]) -> Column:
    """An array of structs as ``{(a,b),(c,d)}``."""
    rows = F.transform(
        bag, lambda r: F.concat(F.lit("("), _joined([r[f] for f in fields], ","), F.lit(")"))
    )
    return F.concat(F.lit("{"), F.concat_ws(",", rows), F.lit("}"))


def _joined(columns: list[Column], sep: str) -> Column:
    """Unquoted fields; a null is an empty field."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def delimited_lines(df: DataFrame, sep: str = ",") -> DataFrame:
    """One unquoted line per row; arrays of structs in their bag form."""
    columns = []
    for f in df.schema.fields:
        element = getattr(f.dataType, "elementType", None)
        nested = getattr(element, "fieldNames", None)
        columns.append(bag_text(F.col(f.name), nested()) if nested else F.col(f.name))
    return df.select(_joined(columns, sep).alias("line"))


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    delimited_lines(df, sep).write.text(path)


def write_header_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    df.write.options(header=True, sep=sep).csv(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    return df.limit(n)
