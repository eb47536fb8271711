"""Text cleaning as Column expressions."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip removes; Spark's one-argument trim removes spaces only.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# A decimal number without type suffix, hexadecimal, underscore, NaN or infinity.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
PLAIN_INTEGER = r"^[+-]?[0-9]{1,18}$"
LONG_INTEGER = r"^[+-]?[0-9]+$"

LABEL_PREFIX = r"^\s*\d+\s*-?\s*"


def strip(column: Column) -> Column:
    """Remove whitespace of any kind from both ends."""
    return F.btrim(column, F.lit(WHITESPACE))


def blank_to_null(column: Column) -> Column:
    """Strip, then turn an empty cell into null."""
    return F.nullif(strip(column), F.lit(""))


def is_number(column: Column) -> Column:
    """True for text that is a plain decimal number; null stays null."""
    return column.rlike(NUMBER)


def to_number(column: Column) -> Column:
    """The number in a text cell, or null if it holds anything else."""
    text = strip(column)
    return F.when(is_number(text), text.try_cast("double"))


def is_whole_number(column: Column) -> Column:
    """True if the stripped cell is digits only; a missing cell is false."""
    return F.coalesce(strip(column).rlike("^[0-9]+$"), F.lit(False))


def strip_label_prefix(label: Column) -> Column:
    """Drop the code that starts a value label: ``1 - Male`` becomes ``Male``."""
    return strip(F.regexp_replace(label, LABEL_PREFIX, ""))


def clean_column_name(name: str) -> str:
    """Lower snake case without a byte-order mark."""
    words = re.findall(r"[0-9a-z]+", name.replace("\ufeff", "").lower())
    return "_".join(words)


def clean_name(text: Column) -> Column:
    """The column form of :func:`clean_column_name`."""
    lowered = F.lower(F.replace(text, F.lit("\ufeff"), F.lit("")))
    return F.btrim(F.regexp_replace(lowered, "[^0-9a-z]+", "_"), F.lit("_"))
