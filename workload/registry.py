"""Query registry: key, Spark callable and, where SQL can say it, the reference SQL."""

from pyspark.sql import Window
from pyspark.sql import functions as F

QUERIES = {}
ORACLES = {}


def query(key, sql=None):
    """Register a callable ``(spark, sf_dir) -> DataFrame`` under ``key``."""

    def register(function):
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def read(spark, sf_dir, table):
    """A test table; its footer is read once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, table)
    if key not in _FRAMES:
        _FRAMES[key] = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return _FRAMES[key]


_FRAMES = {}


def in_order(frame):
    """A short result with the place of each row, so that its order is part of what is compared."""
    placed = frame.coalesce(1).withColumn("_seen", F.monotonically_increasing_id())
    return placed.withColumn("position", F.row_number().over(Window.orderBy("_seen"))).drop("_seen")
