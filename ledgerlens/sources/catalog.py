"""Catalog tables: append, round trip, keyed publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.versions import drop_replaceable, physical_table, replace_table

#: Bytes of rows (as JSON) that a bucket of a published table is to hold.
BUCKET_BYTES = 256 << 20


def append_table(df: DataFrame, name: str) -> None:
    """Append rows, matching columns by name; creates the table on first use.
    An existing table keeps its own layout (partitioning, format)."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df.select(*spark.table(name).columns).write.insertInto(physical_table(spark, name))
    else:
        df.write.mode("append").saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    drop_replaceable(spark, name)


def table_roundtrip(spark: SparkSession, df: DataFrame, name: str,
                    database: str = "default") -> DataFrame:
    """Select the database, drop the table, save the frame as the table and read it
    back with ``SELECT *``.  The database is selected in a session of its own: the
    caller's (and whatever else runs in it) keeps the one it has."""
    own = spark.newSession()
    own.sql(f"USE {database}")
    drop_table(own, name)
    df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
    return spark.sql(f"SELECT * FROM {database}.{name}")


def measured_buckets(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> tuple[int, int]:
    """Buckets for a dataset's measured bytes (a power of two, so that tables of like size
    agree), and the rows of a bucket.  One pass on the executors; two numbers come back."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long"))
    n, held = df.agg(F.count(F.lit(1)), size).first()
    buckets = 1 << max(0, (-(-int(held or 0) // bucket_bytes) - 1)).bit_length()
    return buckets, max(1, -(-int(n) // buckets))


def publish_table(df: DataFrame, name: str, key: str, buckets: int | None = None, bloom: bool = True) -> int:
    """Store a dataset for keyed access: bucketed and sorted by ``key``.  Returns the buckets.

    The rows are dealt to the buckets before the write, so every bucket is one
    file.  Each file is sorted by the key: an equality or IN filter on the key
    (pushed into the scan) skips all but a few row groups by their min/max
    statistics, and a bucketed scan reads the key's bucket only.  A Bloom filter of
    the key in every row group (sized by a bucket's rows) also skips groups that a
    key lies within but is not in.  A join on the key with a table of as many
    buckets needs no shuffle on that side; without ``buckets`` their number
    follows from the measured bytes.  The table is replaced whole or not at all.
    """
    measured, rows = measured_buckets(df) if buckets is None or bloom else (buckets, 0)
    count = measured if buckets is None else buckets
    filters = {f"parquet.bloom.filter.enabled#{key}": "true",
               f"parquet.bloom.filter.expected.ndv#{key}": str(max(1, rows * measured // count))} if bloom else {}
    replace_table(df.repartition(count, key), name, lambda w: w.options(**filters).bucketBy(count, key).sortBy(key))
    return count
