"""Column profiles of an all-text table.

Everything per column follows from one frame of distinct values with their counts, built by
one aggregation over all columns; a frequent value collapses before the shuffle.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from microtally.functions.text import is_number, strip
from microtally.session import checkpointed

TOP_VALUES = 5
MAX_EXAMPLES = 5
MOSTLY_MISSING_PCT = 50


def value_counts(df: DataFrame, columns=None) -> DataFrame:
    """``column, value, n`` of every distinct cell, blank ones included."""
    columns = list(columns or df.columns)
    texts = df.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in columns])
    return (
        texts.unpivot([], columns, "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def _blank():
    return F.col("value").isNull() | (strip(F.col("value")) == "")


def _number():
    text = strip(F.col("value"))
    return F.when(is_number(text), text.try_cast("double"))


def profile_columns(counts: DataFrame) -> DataFrame:
    """Type, missing cells, distinct values and number range of each column.

    ``counts`` comes from :func:`value_counts`. A column is numeric if every filled cell is
    a number, empty if none is filled, else text.
    """
    filled, number, n = ~_blank(), _number(), F.col("n")
    facts = counts.select(
        "column", "n", filled.alias("filled"), F.when(filled, number).alias("number")
    ).groupBy("column").agg(
        F.sum("n").alias("cells"),
        F.sum(F.when(F.col("filled"), 0).otherwise(n)).alias("missing"),
        F.count_if("filled").alias("distinct"),
        F.count("number").alias("numbers"),
        F.min("number").alias("low"),
        F.max("number").alias("high"),
        F.sum(F.col("number") * n).alias("total"),
        F.sum(F.when(F.col("number").isNotNull(), n)).alias("counted"),
    )
    numeric = (F.col("distinct") > 0) & (F.col("numbers") == F.col("distinct"))
    kind = F.when(numeric, "numeric").when(F.col("distinct") == 0, "empty").otherwise("text")
    return facts.select(
        "column",
        kind.alias("inferred_type"),
        "missing",
        F.round(F.try_divide(100.0 * F.col("missing"), F.col("cells")), 2).alias("missing_pct"),
        "distinct",
        F.when(numeric, F.col("low")).alias("min"),
        F.when(numeric, F.col("high")).alias("max"),
        F.when(numeric, F.round(F.try_divide("total", "counted"), 3)).alias("mean"),
    )


def top_values(counts: DataFrame, limit: int = TOP_VALUES) -> DataFrame:
    """The most frequent values of each column, equal counts in value order.

    Spark keeps only ``limit`` rows per column in each task before it shuffles them.
    """
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    ranked = counts.where(~_blank()).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= limit).select("column", "rank", "value", "n")


def non_numeric_examples(counts: DataFrame, limit: int = MAX_EXAMPLES) -> DataFrame:
    """The first text values of columns that mix numbers and text."""
    filled = counts.where(~_blank()).withColumn("_number", _number())
    mixed = (
        filled.groupBy("column")
        .agg(F.count("_number").alias("numbers"), F.count_if(F.col("_number").isNull()).alias("texts"))
        .where("numbers > 0 and texts > 0")
    )
    order = Window.partitionBy("column").orderBy("value")
    texts = filled.where(F.col("_number").isNull()).withColumn("rank", F.row_number().over(order))
    return texts.where(F.col("rank") <= limit).join(mixed.select("column"), "column").select("column", "rank", "value")


def profile_flags(counts: DataFrame) -> DataFrame:
    """Per column: is it mostly blank, does it mix numbers and text."""
    filled = counts.withColumn("_filled", ~_blank()).withColumn("_number", F.when(F.col("_filled"), _number()))
    missing = F.sum(F.when(F.col("_filled"), 0).otherwise(F.col("n")))
    numbers, known = F.count("_number"), F.count_if("_filled")
    return filled.groupBy("column").agg(
        (F.round(100.0 * missing / F.sum("n"), 2) >= MOSTLY_MISSING_PCT).alias("mostly_missing"),
        ((numbers > 0) & (numbers < known)).alias("mixed"),
    )


def profile_table(df: DataFrame) -> DataFrame:
    """Rows, columns and fully duplicated rows of a table, one aggregation over its rows."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("exact_duplicate_rows"),
    ).select("rows", F.lit(len(df.columns)).alias("columns"), "exact_duplicate_rows")


def full_profile(df: DataFrame, table: str, file: str) -> DataFrame:
    """The profile of one file as a single nested row, ready to be written as JSON.

    The table is read twice: once for its distinct cells, which are written down for the four parts
    that follow from them, and once for repeated rows.
    """
    counts = checkpointed(value_counts(df))
    tops = top_values(counts).groupBy("column").agg(
        F.array_sort(F.collect_list(F.struct("rank", "value", "n"))).alias("top_values")
    )
    examples = non_numeric_examples(counts).groupBy("column").agg(
        F.array_sort(F.collect_list("value")).alias("non_numeric_examples")
    )
    columns = profile_columns(counts).join(tops, "column", "left").join(examples, "column", "left")
    whole = profile_table(df).select(F.struct("*").alias("whole"), F.lit(None).alias("profile"))
    parts = columns.select(F.lit(None).alias("whole"), F.struct("*").alias("profile"))
    both = whole.unionByName(parts).agg(F.max("whole").alias("whole"), F.collect_list("profile").alias("column_profiles"))
    return both.select(F.lit(table).alias("table"), F.lit(file).alias("file"), "whole.*", "column_profiles")


