"""Codebooks: value labels from a tabular sheet export, and decoding with them."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from microtally.functions.coded import lookup
from microtally.functions.text import clean_name, strip, strip_label_prefix
from microtally.operators.joins import lookup_join
from microtally.operators.ordered import fill_down

# A variable with more labels than this is decoded by a join instead of a literal map.
INLINE_LABELS = 64


def parse_codebook(sheets: DataFrame) -> DataFrame:
    """One row per source, value set, code range and label.

    ``sheets`` has ``source``, ``row`` (order within the source), the text cells ``c0`` to ``c4``
    and, if there are several sources, ``volume`` (order of the sources). A filled ``c0`` starts a value set (name, title); the rows below it hold
    label, from and to.
    """
    header = F.when(
        F.col("c0").isNotNull(),
        F.struct(strip("c0").alias("value_set"), strip(F.coalesce("c1", F.lit(""))).alias("variable_label")),
    )
    filled = fill_down(sheets.withColumn("_set", header), "source", "row", "_set")
    start = F.col("c3").cast("double").cast("long")
    return filled.where(
        F.col("c0").isNull() & (F.col("_set.value_set") != "") & F.col("c3").isNotNull()
    ).select(
        *[name for name in ("volume",) if name in sheets.columns],
        "source",
        "row",
        F.col("_set.value_set").alias("value_set"),
        clean_name(F.split("_set.value_set", "_VS")[0]).alias("variable"),
        F.col("_set.variable_label").alias("variable_label"),
        start.alias("value_from"),
        F.coalesce(F.col("c4").cast("double").cast("long"), start).alias("value_to"),
        strip("c2").alias("value_label"),
    )


def union_sheets(sheets: dict) -> DataFrame:
    """Sheets of several sources as one frame; ``volume`` is the place of the source in ``sheets``."""
    tagged = [
        sheet.withColumn("source", F.lit(source)).withColumn("volume", F.lit(place))
        for place, (source, sheet) in enumerate(sheets.items())
    ]
    return reduce(DataFrame.unionByName, tagged)


def codebook_summary(codebook: DataFrame) -> DataFrame:
    return codebook.agg(
        F.count("*").alias("value_labels"), F.countDistinct("variable").alias("variables")
    )


def code_labels(codebook: DataFrame) -> DataFrame:
    """``variable, code, label`` of single codes; the last entry of a code wins.

    Entries stand in the order of their volume and row. A codebook without volumes has one, or its
    sources count in the order of their names.
    """
    order = [name for name in ("volume", "source", "row") if name in codebook.columns]
    usable = (F.col("value_from") == F.col("value_to")) & (F.col("value_label") != "")
    return (
        codebook.where(usable)
        .groupBy("variable", F.col("value_from").alias("code"))
        .agg(strip_label_prefix(F.max_by("value_label", F.struct(*order))).alias("label"))
    )


def label_maps(codebook: DataFrame, variables) -> dict[str, dict[int, str]]:
    """Labels of the variables few enough to be written into the plan; others are left out."""
    variables = set(variables)
    labels = code_labels(codebook.where(F.col("variable").isin(list(variables))))
    bound = INLINE_LABELS * len(variables)
    fetched = labels.limit(bound + 1).collect()
    if len(fetched) > bound:
        sizes = labels.groupBy("variable").count().where(F.col("count") <= INLINE_LABELS)
        variables = {row.variable for row in sizes.collect()}
        fetched = labels.where(F.col("variable").isin(list(variables))).collect()
    maps = {name: {} for name in variables}
    for row in fetched:
        maps[row.variable][row.code] = row.label
    return {name: labels for name, labels in maps.items() if len(labels) <= INLINE_LABELS}


def decode(df: DataFrame, codebook: DataFrame, targets: dict) -> DataFrame:
    """Add label columns: ``targets`` maps a new column to ``(code column, variable)``.

    Short label lists become literal maps, so the rows do not move; a long one is joined.
    """
    maps = label_maps(codebook, {variable for _, variable in targets.values()})
    for out, (code, variable) in targets.items():
        if variable in maps:
            df = df.withColumn(out, lookup(F.col(code).cast("long"), maps[variable]))
        else:
            df = decode_by_join(df, codebook, code, variable, out)
    return df


def decode_by_join(df: DataFrame, codebook: DataFrame, code: str, variable: str, out: str) -> DataFrame:
    """Left join on the code: an unknown code gets no label and no row is lost."""
    labels = code_labels(codebook.where(F.col("variable") == variable)).select(
        F.col("code").alias("_code"), F.col("label").alias(out)
    )
    return lookup_join(df.withColumn("_code", F.col(code).cast("long")), labels, ["_code"]).drop("_code")
