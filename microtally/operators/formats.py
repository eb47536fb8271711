"""File formats compared on one table, and what partition pruning saves."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from microtally.settings import PARTITION_COLUMN

WRITERS = {
    "csv": lambda df, path: df.write.mode("overwrite").option("header", True).csv(path),
    "json": lambda df, path: df.write.mode("overwrite").json(path),
    "parquet": lambda df, path: df.write.mode("overwrite").parquet(path),
}
READERS = {
    "csv": lambda spark, path: spark.read.option("header", True).option("inferSchema", True).csv(path),
    "json": lambda spark, path: spark.read.json(path),
    "parquet": lambda spark, path: spark.read.parquet(path),
}


def write_formats(df: DataFrame, folder: str) -> dict[str, str]:
    """One copy of the table per format."""
    paths = {name: f"{folder}/{name}" for name in WRITERS}
    for name, path in paths.items():
        WRITERS[name](df, path)
    return paths


def changed_types(original: DataFrame, reloaded: DataFrame) -> list[str]:
    """Columns whose type is another after writing and reading."""
    types = dict(reloaded.dtypes)
    return [name for name, kind in original.dtypes if types.get(name) != kind]


def format_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Number and total size of the data files per format."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    kind = F.element_at(F.split("path", "/"), -2).alias("format")
    return files.groupBy(kind).agg(F.count("*").alias("files"), F.sum("length").alias("size_bytes"))


def format_fidelity(df: DataFrame, folder: str) -> DataFrame:
    """Per format: rows read back, columns, columns that changed type."""
    spark = df.sparkSession
    reports = None
    for name, path in write_formats(df, folder).items():
        reloaded = READERS[name](spark, path)
        changed = changed_types(df, reloaded)
        report = reloaded.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("format"),
            "rows",
            F.lit(len(df.columns)).alias("columns"),
            F.lit(len(changed)).alias("changed_columns"),
            F.lit(",".join(sorted(changed))).alias("changed"),
        )
        reports = report if reports is None else reports.unionByName(report)
    return reports


def pruning_report(dataset: DataFrame, value, key: str = PARTITION_COLUMN) -> DataFrame:
    """Rows and files read for the whole dataset and for one partition."""

    def reads(df, label):
        path = F.col("_metadata.file_path")
        return df.select(path.alias("path")).groupBy("path").agg(F.count("*").alias("n")).agg(
            F.lit(label).alias("scope"), F.count("*").alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")
        )

    return reads(dataset, "all").unionByName(reads(dataset.where(F.col(key) == value), "one partition"))
