"""Fields of delimited text lines. All of it stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters a field is stripped of, U+0000 to U+0020.
BLANKS = "".join(chr(code) for code in range(33))


def strip(field: Column) -> Column:
    return F.btrim(field, F.lit(BLANKS))


# A failing cast builds an exception, so fields are matched before they are cast.
_INTEGER = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"
_DECIMAL = r"^[\x00-\x20]*[+-]?[0-9.]+([eE][+-]?[0-9]+)?[\x00-\x20]*$"


def to_int(field: Column) -> Column:
    """The integer in ``field``, or null. The cast ignores blanks around it."""
    return F.when(field.rlike(_INTEGER), field.try_cast("int"))


def to_double(field: Column) -> Column:
    """The finite number in ``field``, or null. The cast ignores blanks around it."""
    number = F.when(field.rlike(_DECIMAL), field.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def fields(line: Column) -> Column:
    return F.split(line, ",", -1)


def middle(parts: Column, before: int, after: int) -> Column:
    """The free-text field between ``before`` leading and ``after`` trailing fields.

    Its pieces are joined with nothing between them and lose their double quotes.
    """
    length = F.greatest(F.size(parts) - (before + after), F.lit(0))
    return F.replace(
        F.array_join(F.slice(parts, F.lit(before + 1), length), ""), F.lit('"'), F.lit("")
    )
