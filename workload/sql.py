"""Pieces of SQL used by several statements."""

from __future__ import annotations


def half_even(value: str) -> str:
    """Two digits, rounded on the exact binary value."""
    return f"CAST(printf('%.2f', {value}) AS DOUBLE)"


def half_up(value: str, digits: int = 2) -> str:
    """Rounded on the shortest decimal form of the value, ties away from zero."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,15)), {digits}) AS DOUBLE)"


def half_up_text(value: str) -> str:
    return f"CAST(CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,15)), 2) AS DECIMAL(18,2)) AS VARCHAR)"


NUMBER_WITH_UNIT = r"(^|[^\p{L}\p{N}_])\p{N}+\p{L}*($|[^\p{L}\p{N}_])"


def tokens(table: str, id_column: str, text_column: str = "text") -> str:
    """``id, word`` of a text column. Neighbouring matches share a boundary: replaced twice."""
    line = rf"regexp_replace(lower({text_column}), '[\r\n]+', ' ', 'g')"
    for _ in range(2):
        line = rf"regexp_replace({line}, '{NUMBER_WITH_UNIT}', '\1\2', 'g')"
    letters = rf"regexp_replace({line}, '[^\p{{L}}\s]', '', 'g')"
    return (
        f"(SELECT id, word FROM (SELECT {id_column} AS id, "
        f"unnest(regexp_split_to_array({letters}, '[ \",()*]+')) AS word FROM {table}) WHERE word <> '')"
    )
