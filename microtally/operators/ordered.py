"""Operations that depend on row order."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows of one group that are filled in one task; longer groups are cut into such pieces.
CHUNK_ROWS = 100_000


def fill_down(df: DataFrame, group: str, order: str, value: str, chunk: int = CHUNK_ROWS) -> DataFrame:
    """Give every row the last non-null ``value`` at or above it within its group.

    ``order`` is an integer row number. A group is cut into chunks of consecutive numbers
    that are filled on their own; what a chunk inherits comes from a table with one row
    per chunk, so even a group with most of the rows is spread over many tasks.
    """
    cut = df.withColumn("_chunk", F.floor(F.col(order) / chunk))
    above = Window.partitionBy(group, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    last = F.max_by(F.when(F.col(value).isNotNull(), F.col(value)), F.when(F.col(value).isNotNull(), F.col(order)))
    inherited = cut.groupBy(group, "_chunk").agg(last.alias("_last")).select(
        group, "_chunk", F.last("_last", ignorenulls=True).over(earlier).alias("_inherited")
    )
    filled = cut.withColumn(value, F.last(value, ignorenulls=True).over(above))
    return (
        filled.join(inherited, [group, "_chunk"])
        .withColumn(value, F.coalesce(value, "_inherited"))
        .drop("_chunk", "_inherited")
    )
