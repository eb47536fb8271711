"""Queries of the training-data operators, and their reference SQL where SQL can say it."""

from microtally.session import send_package

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
    """A whole table of the scale folder, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def in_batches(spark, rows):
    """Prepares Python workers: they get this package, and at most so many rows at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    send_package(spark)
