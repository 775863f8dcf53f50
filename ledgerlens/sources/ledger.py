"""Repeatable append: every batch counts once, however often it is sent.

A ledgered table has a row's batch as its partition and a ledger table beside it,
one row per committed batch.  An append

1. leaves out the batches that the ledger holds (anti-join on the batch);
2. writes the others, each replacing its own partition, so that what a crashed
   attempt left in a batch's partition is overwritten and not added to;
3. enters them, with their rows, into the ledger in one append.

Readers go through the ledger (``committed_rows``): rows of a batch that was written
but not entered are not seen, and a repeated attempt makes them whole.  A batch is
all its rows in one call; a batch sent again is not looked at again.  Two writers of
one batch at once both write all of it to one partition and may enter it twice, which
readers do not notice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SUFFIX = "__ledger"
LEDGER_SCHEMA = "batch string, n_rows long, committed timestamp_ntz"


def ledger_name(name: str) -> str:
    return name + LEDGER_SUFFIX


def committed_batches(spark: SparkSession, name: str) -> DataFrame:
    """The ledger's batches, each once (no rows for an unknown table)."""
    ledger = ledger_name(name)
    if not spark.catalog.tableExists(ledger):
        return spark.createDataFrame([], LEDGER_SCHEMA).select("batch")
    return spark.table(ledger).select("batch").distinct()


def new_rows(rows: DataFrame, name: str, batch_col: str) -> DataFrame:
    """The rows of batches that are not committed yet, the batch as text."""
    texts = rows.withColumn(batch_col, F.col(f"`{batch_col}`").cast("string"))
    known = committed_batches(rows.sparkSession, name).withColumnRenamed("batch", batch_col)
    return texts.join(known, batch_col, "left_anti").select(*[F.col(f"`{c}`") for c in rows.columns])


def write_batches(rows: DataFrame, name: str, batch_col: str) -> None:
    """Write batches, each replacing its own partition; nothing is committed yet."""
    spark = rows.sparkSession
    ordered = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != batch_col], F.col(f"`{batch_col}`"))
    if not spark.catalog.tableExists(name):
        # kept with the table: an overwrite replaces the partitions that it has rows for, no others
        (ordered.limit(0).write.option("partitionOverwriteMode", "dynamic").partitionBy(batch_col).saveAsTable(name))
    table = spark.table(name).columns
    ordered.select(*[F.col(f"`{c}`") for c in table]).write.mode("overwrite").insertInto(name)


def append_once(rows: DataFrame, name: str, batch_col: str = "batch_id") -> dict[str, int]:
    """Append the rows of batches not committed yet; the rows taken in by batch.

    A row without a batch is an error.  The number of batches in one call is small
    (files, days): their names and row counts reach the driver."""
    spark = rows.sparkSession
    checked = rows.withColumn(batch_col, F.coalesce(
        F.col(f"`{batch_col}`").cast("string"), F.raise_error(F.lit(f"a row without {batch_col}")).cast("string")))
    write_batches(new_rows(checked, name, batch_col), name, batch_col)
    return commit_written(spark, name, batch_col, checked)


def commit_written(spark: SparkSession, name: str, batch_col: str, sent: DataFrame) -> dict[str, int]:
    """Enter the sent batches that the ledger lacks, with the rows found in their partitions."""
    wanted = new_rows(sent, name, batch_col).select(F.col(f"`{batch_col}`").alias("batch")).distinct()
    written = (spark.table(name).select(F.col(f"`{batch_col}`").cast("string").alias("batch"))
               .join(wanted, "batch", "left_semi").groupBy("batch").agg(F.count(F.lit(1)).alias("n_rows")))
    entries = [(r.batch, r.n_rows) for r in written.collect()]
    if entries:
        (spark.createDataFrame(entries, "batch string, n_rows long").coalesce(1)
         .withColumn("committed", F.current_timestamp().cast("timestamp_ntz"))
         .write.mode("append").saveAsTable(ledger_name(name)))
    return dict(entries)


def committed_rows(spark: SparkSession, name: str, batch_col: str = "batch_id") -> DataFrame:
    """The rows of committed batches; the ledger's batches prune the partitions read."""
    known = committed_batches(spark, name).withColumnRenamed("batch", batch_col)
    return spark.table(name).join(known, batch_col, "left_semi")
