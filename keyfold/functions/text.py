"""Taking ``station;temp`` lines apart, and putting them together."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = ";"


def before_sep(line: Column, sep: str = SEP) -> Column:
    return F.substring_index(line, sep, 1)


def after_sep(line: Column, sep: str = SEP) -> Column:
    return F.substring_index(line, sep, -1)


def has_one_sep(line: Column, before: Column, after: Column, sep: str = SEP) -> Column:
    """Whether the text before the first and after the last separator make up the line.

    Compares byte lengths, which are at hand; the line is not searched again.
    """
    return F.octet_length(before) + F.octet_length(after) + len(sep.encode()) == F.octet_length(line)


# What Java trims from a number, and what makes a line blank.
BLANKS = "".join(map(chr, range(33)))


def is_java_number(text: Column) -> Column:
    """Whether a text is of a form that only Java reads as a number: ``1.0d``, ``1.0f ``, ``0x1p3``."""
    bare = F.btrim(text, F.lit(BLANKS))
    suffix = bare.endswith("d") | bare.endswith("D") | bare.endswith("f") | bare.endswith("F")
    return suffix | text.contains("x") | text.contains("X")


def number_of(text: Column) -> Column:
    """The number a text stands for, NULL for anything else. All scans read numbers so."""
    return F.when(~is_java_number(text), text.try_cast("double"))


def finite_number(text: Column) -> Column:
    """``number_of``, with NULL for NaN and infinities too."""
    number = number_of(text)
    return F.when(is_finite(number), number)


def is_blank(line: Column, sep: str = SEP) -> Column:
    """Whether a line has nothing but white space. Lines with a separator are not searched."""
    return (F.octet_length(line) == 0) | (~line.contains(sep) & (F.btrim(line, F.lit(BLANKS)) == ""))


def is_finite(number: Column) -> Column:
    # NaN sorts above every number, so one comparison rules out all three.
    return F.abs(number) < F.lit(float("inf"))


def number_text(value: Column, scale: int) -> Column:
    """Plain decimal text, never in exponent form."""
    return value.cast(f"decimal(18,{scale})").cast("string")


def join_fields(station: Column, temp: Column, scale: int, sep: str = SEP) -> Column:
    return F.concat(station, F.lit(sep), number_text(temp, scale))
