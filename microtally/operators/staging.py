"""Raw to staging: clean, type and de-duplicate one text table."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from microtally.errors import DuplicateShareError, SourceError
from microtally.functions.text import LONG_INTEGER, PLAIN_INTEGER, blank_to_null, is_number
from microtally.session import scratch_path
from microtally.settings import MAX_DUPLICATE_SHARE
from microtally.sources import datasets
from microtally.sources.text_tables import clean_names

FILE_ORDER = ["source_file", "source_line"]

# Whole numbers are compared and cast by way of these types, which keep every digit.
EXACT = "decimal(38,6)"
WIDE = "decimal(38,0)"
LONG_MIN, LONG_MAX = "-9223372036854775808", "9223372036854775807"

# From here on a double no longer tells every whole number from its neighbours.
DOUBLE_EXACT = 2.0**53


def standardise(df: DataFrame) -> DataFrame:
    """Lower snake case names; cells stripped, blank cells null."""
    names = clean_names(df.columns)
    return df.select(*[blank_to_null(F.col(f"`{old}`")).alias(new) for old, new in zip(df.columns, names)])


# What a cell holds; a missing cell is of no kind. ``BIG`` is a whole number beyond a long.
PLAIN, WHOLE, FRACTION, TEXT, BIG = 1, 2, 3, 4, 5


KINDS = {"plain": PLAIN, "whole": WHOLE, "fraction": FRACTION, "text": TEXT, "big": BIG}


def _fits_long(number):
    return number.between(F.lit(LONG_MIN).cast(WIDE), F.lit(LONG_MAX).cast(WIDE))


def cell_kind(cell):
    """Plain integer, whole number in another form, whole number beyond a long, other number, or text.

    Patterns decide what can be cast: a failing ``try_cast`` costs far more than a match. Whole
    numbers are never judged by their double: large ones are cast to decimals, and one with more
    than 32 digits before the point is text.
    """
    number = cell.try_cast("double")
    digits, exact = cell.try_cast(WIDE), cell.try_cast(EXACT)
    small = F.when(number == F.floor(number), WHOLE).otherwise(FRACTION)
    large = (
        F.when(exact.isNull(), TEXT)
        .when(exact != F.floor(exact), FRACTION)
        .when(_fits_long(exact), WHOLE)
        .otherwise(BIG)
    )
    return (
        F.when(cell.isNull(), 0)
        .when(cell.rlike(PLAIN_INTEGER), PLAIN)
        .when(~is_number(cell), TEXT)
        .when(cell.rlike(LONG_INTEGER), F.when(digits.isNull(), TEXT).when(_fits_long(digits), PLAIN).otherwise(BIG))
        .when(F.abs(number) < DOUBLE_EXACT, small)
        .otherwise(large)
    )


def with_kinds(df: DataFrame, columns) -> DataFrame:
    """Replace text columns by the kinds of their cells; other columns stay."""
    kinds = [cell_kind(F.col(f"`{name}`")).alias(f"{name}|kind") for name in columns]
    return df.select(*kinds, *[F.col(f"`{name}`") for name in df.columns if name not in set(columns)])


def type_counters(columns) -> list:
    """Aggregates over the kinds that decide the type of each column, all in one pass."""
    return [
        F.count_if(F.col(f"`{name}|kind`") == code).alias(f"{name}|{kind}")
        for name in columns for kind, code in KINDS.items()
    ]


def add_up(counts: DataFrame) -> DataFrame:
    """Totals of the type counters over partial counts, such as one row per file block."""
    return counts.agg(*[F.sum(f"`{name}`").alias(name) for name in counts.columns if "|" in name])


def decide_types(totals: dict, columns) -> dict[str, str]:
    """``integer``, ``exponent`` (integers not all written as plain digits), ``wide`` or ``double``.

    A column with text in it, or without any value, is left out and stays text. So does one that
    mixes fractions with whole numbers beyond a long, which no number type here can hold exactly.
    """
    types = {}
    for name in columns:
        found = {kind: totals[f"{name}|{kind}"] or 0 for kind in KINDS}
        if found["text"] or not any(found.values()) or found["big"] and found["fraction"]:
            continue
        if found["fraction"]:
            types[name] = "double"
        elif found["big"]:
            types[name] = "wide"
        else:
            types[name] = "exponent" if found["whole"] else "integer"
    return types


def infer_types(df: DataFrame, keep_text=()) -> dict[str, str]:
    """Types of the text columns of a cleaned table, from one scan."""
    columns = [name for name in df.columns if name not in keep_text]
    counted = with_kinds(df.select(*[F.col(f"`{name}`") for name in columns]), columns).agg(*type_counters(columns))
    return decide_types(counted.first().asDict(), columns)


def apply_types(df: DataFrame, types: dict) -> DataFrame:
    """Cast the columns named in ``types``; the others pass through."""
    def whole(cell, kind):
        return F.when(cell.rlike(LONG_INTEGER), cell.cast(kind)).otherwise(cell.cast(EXACT).cast(kind))

    casts = {
        "integer": lambda cell: cell.cast("long"),
        "exponent": lambda cell: whole(cell, "long"),
        "wide": lambda cell: whole(cell, WIDE),
        "double": lambda cell: cell.cast("double"),
    }
    return df.select(
        *[casts[types[name]](F.col(f"`{name}`")).alias(name) if name in types else F.col(f"`{name}`")
          for name in df.columns]
    )


COLUMN_TYPES = {"integer": "long", "exponent": "long", "wide": WIDE, "double": "double"}


def convert_types(df: DataFrame, keep_text=()) -> tuple[DataFrame, dict[str, str]]:
    """Type a cleaned text table: whole numbers long or, beyond it, decimal; other numbers double; the rest text."""
    types = infer_types(df, keep_text)
    return apply_types(df, types), {name: COLUMN_TYPES[kind] for name, kind in types.items()}


def keep_first(df: DataFrame, key, order) -> DataFrame:
    """One row per key, the first in ``order``.

    An aggregate instead of a window: rows of a key are reduced before the shuffle, so a
    key that holds a third of the table costs no more than any other. Nulls in a key are
    equal to each other.
    """
    rest = [name for name in df.columns if name not in {*key, *order}]
    first = F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("_first")
    return df.groupBy(*key).agg(first).select(*_restore(df.columns, key))


def _restore(columns, key):
    return [F.col(name) if name in key else F.col(f"_first.{name}").alias(name) for name in columns]


@dataclass
class Deduplicated:
    """Lazy results of a de-duplication.

    ``keyed`` has one row per key: its first row, the number of distinct rows ``sharing``
    it and of all ``copies``. ``firsts`` moves a row once instead of twice: it knows of a key
    its first row, its ``copies`` and whether distinct rows share it, but not how many.
    """

    keyed: DataFrame
    firsts: DataFrame
    rejects: DataFrame
    key: list
    columns: list
    source: DataFrame
    data_columns: list
    order: list

    @property
    def kept(self) -> DataFrame:
        """Surviving rows."""
        return self.survivors(self.firsts)

    @property
    def stats(self) -> DataFrame:
        """The counts, in one row."""
        return self.keyed.agg(*dedup_counters())

    def survivors(self, keyed: DataFrame) -> DataFrame:
        return keyed.select(*_restore(self.columns, self.key))

    def parts(self) -> list["Deduplicated"]:
        """The same work cut by its keys: no key is in two parts, and the parts add up to the whole.

        A shuffled row is several times as large as a written one, and shuffle files last as long as
        a job. A large table is therefore worked on in a few jobs, one after another; each reads the
        source again. One part if the source is small.
        """
        if scanned_bytes(self.source) < PART_FROM_BYTES or "collate" in self.source.select(*self.key).schema.simpleString():
            return [self]
        part = F.pmod(F.xxhash64(*self.key), F.lit(PARTS))
        return [deduplicate(self.source.where(part == i), self.key, self.data_columns, self.order) for i in range(PARTS)]

    def stored(self) -> DataFrame:
        """Surviving rows, written part by part into the scratch folder and read from there."""
        path = scratch_path(self.source.sparkSession, "kept")
        datasets.write_parts([part.kept for part in self.parts()], path)
        return self.source.sparkSession.read.parquet(path)


# Parts a large table is de-duplicated in, and the size of the files it is read from that makes it large.
PARTS = 4
PART_FROM_BYTES = 64 << 20


def scanned_bytes(df: DataFrame) -> int:
    """Estimated size of all that a frame reads, in bytes, however its rows are joined later on."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def drop_exact_copies(df: DataFrame, data_columns, order=FILE_ORDER) -> DataFrame:
    """Distinct rows over the data columns, each with its first place and its ``copies``.

    Aggregated before the shuffle; rows copied many times collapse in their own task.
    """
    place = F.min(F.struct(*order)).alias("_place")
    others = [F.col(f"_place.{name}").alias(name) for name in order]
    distinct = df.groupBy(*data_columns).agg(place, F.count("*").alias("copies"))
    return distinct.select(*data_columns, *others, "copies")


def deduplicate(df: DataFrame, key, data_columns, order=FILE_ORDER) -> Deduplicated:
    """Remove exact copies, then rows that repeat a key; the first in ``order`` stays.

    Rejects are all rows still sharing a key after the first step, the kept one included.
    """
    missing = [name for name in key if name not in df.columns]
    if missing:
        raise SourceError(f"key columns {missing} not found")
    distinct = drop_exact_copies(df, data_columns, order)
    columns = [name for name in df.columns if name in {*data_columns, *order}]
    rest = [name for name in columns if name not in {*key, *order}]
    firsts = first_rows(df.select(*columns), key, data_columns, order)
    keyed = distinct.groupBy(*key).agg(
        F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("_first"),
        F.count("*").alias("sharing"),
        F.sum("copies").alias("copies"),
    )
    rejects = _rows_sharing_a_key(distinct, key).select(*columns)
    return Deduplicated(keyed, firsts, rejects, list(key), columns, df, list(data_columns), list(order))


def first_rows(df: DataFrame, key, data_columns, order) -> DataFrame:
    """One row per key: its first row, the number of its ``copies``, and whether they differ in the data columns.

    All in one aggregate: copies of a row have the same smallest and largest row. Of rows in the same
    place the smallest is the first.
    """
    rest = [name for name in df.columns if name not in {*key, *order}]
    plain = df.withColumns({  # no negative zeros, as after grouping by the data columns
        name: F.col(name) + F.lit(0).cast(kind) for name, kind in df.dtypes if kind in ("float", "double") and name in data_columns})
    compared = F.struct(*[name for name in data_columns if name not in key])
    differ = F.min(compared) != F.max(compared) if {*data_columns} - {*key} else F.lit(False)
    return plain.groupBy(*key).agg(
        F.min(F.struct(*order, *rest)).alias("_first"), F.count("*").alias("copies"), differ.alias("shared"))


def dedup_counters() -> list:
    """Counts over the keys of a de-duplicated table."""
    shared = F.when(F.col("sharing") > 1, F.col("sharing"))
    return [
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum(F.col("copies") - F.col("sharing")), F.lit(0)).alias("exact_duplicates_removed"),
        F.coalesce(F.sum(shared), F.lit(0)).alias("rows_sharing_a_key"),
        F.coalesce(F.sum(F.col("sharing") - 1), F.lit(0)).alias("key_duplicates_removed"),
        F.count("*").alias("rows_out"),
    ]


def first_counters() -> list:
    """What the first rows of the keys of a table tell about it."""
    return [
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_in"),
        F.count_if("shared").alias("shared_keys"),
        F.count("*").alias("rows_out"),
    ]


def _rows_sharing_a_key(distinct: DataFrame, key) -> DataFrame:
    """Rows of the repeated keys, null keys included.

    The keys are counted on their own columns; rows of keys that occur once meet the few repeated
    keys and go no further. Adaptive execution splits a key shared by most of the rows.
    """
    repeated = distinct.groupBy(*key).count().where("count > 1").select(*[F.col(name).alias(f"_key_{name}") for name in key])
    same = [F.col(name).eqNullSafe(F.col(f"_key_{name}")) for name in key]
    return distinct.join(repeated, same, "left_semi")


def check_duplicate_share(table: str, stats: dict, limit: float = MAX_DUPLICATE_SHARE) -> float:
    """Part of the rows that de-duplication took away; above ``limit`` the table is refused."""
    lost = stats["rows_in"] - stats["rows_out"]
    part = lost / max(stats["rows_in"], 1)
    if part <= limit:
        return part
    raise DuplicateShareError(
        f"de-duplication took {lost:,} of {stats['rows_in']:,} rows of {table}, {part:.2%} where {limit:.2%} are allowed: "
        "does its key identify a row, and is the source complete?"
    )
