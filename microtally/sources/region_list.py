"""The region list: a JSON array of flat records with a fallback snapshot."""

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from microtally.errors import SourceError
from microtally.session import path_exists
from microtally.settings import MIN_REGIONS, REGION_FIELDS


def read_region_list(spark: SparkSession, path: str, fields=REGION_FIELDS) -> DataFrame:
    """Records of a JSON array, every field as text."""
    schema = ", ".join(f"`{name}` string" for name in fields)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def region_list_facts(regions: DataFrame, fields=REGION_FIELDS) -> DataFrame:
    """Number of records and, per required field, of records without it."""
    return regions.agg(
        F.count("*").alias("records"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in fields],
    )


def check_region_list(regions: DataFrame, fields=REGION_FIELDS, minimum: int = MIN_REGIONS) -> int:
    """Fail unless the list is long enough and every record carries every field."""
    facts = region_list_facts(regions, fields).first()
    missing = [name for name in fields if facts[name]]
    if not facts.records:
        raise SourceError("the region list is empty")
    if missing:
        raise SourceError(f"region records lack fields: {sorted(missing)}")
    if facts.records < minimum:
        raise SourceError(f"{facts.records} regions, expected at least {minimum}")
    return facts.records


def load_region_list(spark: SparkSession, fresh: str, snapshot: str, fields=REGION_FIELDS,
                     minimum: int = MIN_REGIONS) -> DataFrame:
    """The fresh list if it is usable, else the last good snapshot, with a ``status`` column.

    A usable fresh list becomes the new snapshot.
    """
    try:
        regions = read_region_list(spark, fresh, fields)
        check_region_list(regions, fields, minimum)
    except (SourceError, PySparkException) as unusable:
        return read_snapshot(spark, snapshot, unusable)
    regions.write.mode("overwrite").parquet(snapshot)
    return regions.withColumn("status", F.lit("fresh"))


def read_snapshot(spark: SparkSession, snapshot: str, reason: Exception) -> DataFrame:
    if not path_exists(spark, snapshot):
        raise SourceError(f"region list unusable and no snapshot exists: {reason}") from reason
    return spark.read.parquet(snapshot).withColumn("status", F.lit("cached"))
