"""Column expressions on words, shared by the native operators.

A word is a longest run of characters other than space, tab, line feed, vertical tab, form
feed and carriage return.
"""

from pyspark.sql import functions as F

# The six characters that part words, as a class for regular expressions.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def whole(text):
    """The text; a null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def word_count(text):
    """Number of words of a text as a long; null and empty texts have none."""
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def words(text):
    """Words of a text in order; an empty array for null and empty texts."""
    return F.array_remove(F.split(whole(text), GAP, -1), "")
