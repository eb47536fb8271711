"""Equi-joins that hold what their caller declares: unique keys, no lost rows.

A broken promise fails the job through ``raise_error`` in the plan. Uniqueness is proved on the key
columns alone, beside a plain join of the whole rows.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from microtally.errors import JoinContractError


# Bytes a lookup table may have, counted over its cells as text and eight for each, to be sent to every executor.
BROADCAST_BYTES = 32 << 20

# Tasks a hot key is spread over.
SALTS = 32


def _require(condition, message: str):
    return F.when(condition, True).otherwise(F.raise_error(F.lit(message)).cast("boolean"))


def key_is_unique(df: DataFrame, key, name: str = "table"):
    """Condition that holds for every row; the job fails if two rows of ``df`` share a key.

    The proof is a subquery that reads and moves the key columns alone, counted in each task first, so whole
    rows are neither aggregated nor moved for it. Null keys are equal to each other.
    """
    key = list(key)
    repeated = df.groupBy(*key).count().where("count > 1").agg(F.count("*"))
    return _require(repeated.scalar() == 0, f"{name}: key {key} is not unique")


def unique_by(df: DataFrame, key, name: str = "table") -> DataFrame:
    """The same rows; the job fails if two of them share a key."""
    return df.where(key_is_unique(df, key, name))


def join_one_to_one(left: DataFrame, right: DataFrame, key, keep_all: bool = False) -> DataFrame:
    """Join on a key that is unique on both sides; each side moves once.

    By default it is an inner join that fails if a left row finds no partner; with
    ``keep_all`` it is a left join.
    """
    left, right = unique_by(left, key, "left side"), unique_by(right, key, "right side")
    if keep_all:
        return left.join(right, key, "left")
    joined = left.join(right.withColumn("_matched", F.lit(True)), key, "left")
    found = _require(F.col("_matched").isNotNull(), f"join on {list(key)} lost rows of the left side")
    return joined.where(found).drop("_matched")


def join_many_to_one(child: DataFrame, parent: DataFrame, key) -> DataFrame:
    """Left join to a parent with a unique key: exactly one output row per child row.

    It is a plain join whose skewed child keys Spark can split while it runs.
    """
    key = list(key)
    return child.where(key_is_unique(parent, key, "parent")).join(parent.dropna(subset=key), key, "left")


def small_enough(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a table is known to fit into ``limit`` bytes.

    Its rows are measured: estimates of the optimiser take every text for twenty bytes, and know
    nothing of rows that a generator multiplies. The result of a join does not depend on it, only
    the way it is carried out.
    """
    cells = [F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(1)) + 8 for name in table.columns]
    return (table.agg(F.sum(sum(cells[1:], cells[0]))).first()[0] or 0) <= limit


def lookup_join(df: DataFrame, table: DataFrame, on, how: str = "left") -> DataFrame:
    """Join to a lookup table whose size is checked first; null keys never match.

    A small one is broadcast; a larger one is joined by salted keys. ``on`` lists columns both
    sides have.
    """
    if small_enough(table):
        return df.join(F.broadcast(table), on, how)
    return salted_join(df, table, on, how)


def salted_join(df: DataFrame, table: DataFrame, on, how: str = "left", salts: int = SALTS) -> DataFrame:
    """Equi-join that spreads each key of ``df`` over ``salts`` tasks; null keys never match.

    ``table`` is repeated once per salt. The salt comes from the row itself, so a task
    that runs again gives the same rows.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumn(
        "_salt", F.col("_salt").cast("long")
    )
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def orphan_keys(child: DataFrame, columns, parent: DataFrame, parent_columns) -> DataFrame:
    """Distinct child keys the parent lacks; a key with a null in it is not checked.

    Both sides are reduced to distinct keys before they move.
    """
    keys = child.select(*columns).dropna().distinct()
    known = parent.select(*[F.col(old).alias(new) for old, new in zip(parent_columns, columns)]).distinct()
    return keys.join(known, list(columns), "left_anti")


def band_join(df: DataFrame, value: str, bands: DataFrame, out: str, width: int) -> DataFrame:
    """Left join to the band ``[lower, upper)`` that holds the value; one output row per input row.

    ``bands`` has ``lower``, ``upper`` and ``label``; the job fails if two of them overlap. Each band
    is cut into the cells of ``width`` it touches, which makes this an equi-join on the cell; a cell
    on the edge of a band may belong to several, so the bounds are compared too. They need not be
    multiples of ``width``, which only says how finely bands are cut.
    """
    before = F.max("upper").over(Window.orderBy("lower", "upper").rowsBetween(Window.unboundedPreceding, -1))
    apart = bands.select("lower", "upper", F.col("label").alias(out)).where("lower < upper").withColumn("_before", before)
    apart = apart.where(_require(F.coalesce(F.col("_before") <= F.col("lower"), F.lit(True)), "bands overlap"))
    touched = F.explode(F.sequence(F.floor(F.col("lower") / width), F.ceil(F.col("upper") / width) - 1))
    cells = apart.select(touched.alias("_band"), "lower", "upper", out)
    number = F.col(value)
    inside = (F.floor(number / width) == F.col("_band")) & (number >= F.col("_lower")) & (number < F.col("_upper"))
    cells = cells.withColumnsRenamed({"lower": "_lower", "upper": "_upper"})
    if small_enough(cells):
        cells = F.broadcast(cells)
    return df.join(cells, inside, "left").drop("_band", "_lower", "_upper")


def check_counts(name: str, expected: int, found: int) -> None:
    """Row-count invariant of a join, from counts observed while writing."""
    if expected != found:
        raise JoinContractError(f"{name} has {found:,} rows, expected {expected:,}")
