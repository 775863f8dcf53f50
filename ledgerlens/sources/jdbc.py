"""Relational database source and sink over JDBC.

Connection settings come from the caller; nothing is stored in code.  Not
exercised by the tests (no database server is available to them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_query(spark: SparkSession, url: str, query: str, properties: dict[str, str],
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, partitions: int | None = None) -> DataFrame:
    """Result of ``query`` in the database as a DataFrame.  With a numeric
    ``partition_column`` and bounds the read is split into ``partitions``
    parallel range queries instead of one connection reading everything."""
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    if partition_column:
        reader = (reader.option("dbtable", f"({query}) q")
                  .option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", partitions))
    else:
        reader = reader.option("query", query)
    return reader.load()


def write_table(df: DataFrame, url: str, table: str, properties: dict[str, str],
                mode: str = "append", batch_size: int = 5000) -> None:
    """Insert the rows in batches of ``batch_size`` from every partition."""
    (df.write.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
     .option("batchsize", batch_size).mode(mode).save())
