"""Coded answers as Column expressions: flags, bands, scores and lookups."""

from functools import reduce
from itertools import chain
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_flag(code: Column, yes, no) -> Column:
    """True for codes in ``yes``, false for codes in ``no``, null for anything else."""
    return F.when(code.isin(list(yes)), True).when(code.isin(list(no)), False)


def yes_no(code: Column) -> Column:
    """Survey convention: 1 is yes, 2 is no, the rest is missing."""
    return code_flag(code, [1], [2])


def sentinel_to_null(value: Column, sentinel) -> Column:
    """A code that stands for "unknown" becomes null."""
    return F.nullif(value, F.lit(sentinel))


def band(value: Column, bands, top) -> Column:
    """Label of the half-open band ``[lower, next lower)`` that holds the value.

    The tests run from the highest band down, so each needs only its lower bound.
    """
    label = F.when((value >= top) | (value < bands[0][0]), F.lit(None).cast("string"))
    for lower, name in reversed(bands):
        label = label.when(value >= lower, F.lit(name))
    return label


def any_flag(*flags: Column) -> Column:
    """Three-valued OR: true wins, then missing, then false."""
    return reduce(or_, flags)


def complete_sum(*flags: Column) -> Column:
    """Number of true flags; null as soon as one flag is missing."""
    return reduce(add, [flag.cast("long") for flag in flags])


def lookup(key: Column, mapping: dict) -> Column:
    """Value of ``key`` in a small literal mapping, null if it is not there."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = F.create_map(*[F.lit(item) for item in chain.from_iterable(mapping.items())])
    return F.try_element_at(pairs, key)
