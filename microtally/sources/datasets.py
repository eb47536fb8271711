"""Parquet tables and datasets partitioned by one column."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from microtally.errors import SourceError
from microtally.session import path_exists, shuffles_removed
from microtally.settings import PARTITION_COLUMN

# Rows one file of a partition may hold; a larger partition is split over several files.
ROWS_PER_FILE = 5_000_000


def read_partitioned(spark: SparkSession, path: str, value=None, key: str = PARTITION_COLUMN, schema=None) -> DataFrame:
    """The whole dataset, or the one folder whose key equals ``value``; the key is a long.

    With ``schema`` no file footer is read to plan the scan; without ``value`` all folders are listed.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    dataset = reader.parquet(path)
    if value is not None:
        dataset = dataset.where(F.col(key) == value)
    return dataset.withColumn(key, F.col(key).cast("long"))


def write_table(df: DataFrame, path: str) -> None:
    """Replace a table."""
    df.write.mode("overwrite").parquet(path)


def write_parts(frames, path: str) -> None:
    """Replace a table by the rows of several frames, each written in a job of its own.

    The shuffle files of one frame are gone before the next one starts. The table gets its name
    after the last frame, so readers never see some of the parts.
    """
    first, *others = frames
    if not others:
        return write_table(first, path)
    spark = first.sparkSession
    folder, name = path.rsplit("/", 1)
    unseen = f"{folder}/_parts-{name.replace('=', '-')}"
    to, made = (spark._jvm.org.apache.hadoop.fs.Path(place) for place in (path, unseen))
    system = to.getFileSystem(spark._jsc.hadoopConfiguration())
    for place in (to, made):
        system.delete(place, True)
    try:
        with shuffles_removed(spark):
            for frame in frames:
                frame.write.mode("append").parquet(unseen)
    except BaseException:
        system.delete(made, True)
        raise
    system.delete(to, True)
    if not system.rename(made, to):
        raise SourceError(f"{unseen} was written, but could not be renamed to {path}")


def write_partitioned(df: DataFrame, path: str, key: str = PARTITION_COLUMN, sort_by=()) -> None:
    """Replace a whole partitioned dataset, so that no old partition survives.

    Rows are hashed on the key and rebalanced: a small partition gets one file, and a
    partition holding most of the rows is spread over many tasks.
    """
    spread = df.hint("rebalance", key)
    if sort_by:
        spread = spread.sortWithinPartitions(key, *sort_by)
    (
        spread.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(key)
        .parquet(path)
    )


def write_csv_copy(df: DataFrame, path: str, one_file: bool = False) -> None:
    """A CSV copy with a header; ``one_file`` is for results that are known to be short."""
    if one_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").option("header", True).csv(path)


def read_published(spark: SparkSession, parquet: str, csv: str, schema) -> DataFrame:
    """A result table from Parquet, or from its CSV copy where Parquet is missing."""
    if path_exists(spark, parquet):
        return spark.read.parquet(parquet)
    return spark.read.schema(schema).option("header", True).csv(csv)
