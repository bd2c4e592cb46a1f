"""Tables bucketed by a join or grouping column, so that later jobs need no shuffle for it."""

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, table: str, path: str, column: str, buckets: int) -> DataFrame:
    """Store the rows under a name of the session's catalog, in `buckets` hash buckets sorted by the column; returns the
    stored table.

    Rows are shuffled once. Adaptive execution merges buckets too small for one task and
    cuts one too big for it, so a small table's bucket is one file, a large one's several,
    and no writing task takes a whole bucket. Tables bucketed alike join and group on the
    column without an exchange: a reader takes a bucket's files in one task, of the columns
    it asks for. The number is for the table's life: one with which those are a few hundred
    MB. A column of which one value has a large share of all rows is not one to bucket by.
    """
    spark = df.sparkSession
    writer = df.hint("rebalance", column).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, column).sortBy(column).saveAsTable(table)
    return spark.table(table)
