"""Datasets published by month, and reads that touch the wanted months only.

``publish_by_month`` stores rows in a partition for each month (integer yyyymm); a
month of many rows is written by several tasks (rebalanced at run time), a month of few
by one.  ``in_latest_months`` takes the months wanted from the catalog's partition list,
not from the rows, and filters the partition column by them, so that no file of another
month is listed or opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.dates import month_num
from ledgerlens.sources.versions import physical_table, replace_table


def publish_by_month(rows: DataFrame, name: str, date_col: str, month_col: str = "month") -> int:
    """Replace ``name`` with the rows, partitioned by the month of ``date_col`` (rows without a
    date have a partition of their own).  Returns the rows."""
    if month_col in rows.columns:
        raise ValueError(f"the rows have a column {month_col} already")
    dated = rows.withColumn(month_col, month_num(date_col))
    return replace_table(dated.hint("rebalance", F.col(month_col)), name, lambda w: w.partitionBy(month_col))


def latest_months(spark: SparkSession, name: str, n: int, month_col: str = "month") -> list[int]:
    """The ``n`` latest months present, from the catalog's partition list (a value for
    each month of the calendar that has rows)."""
    listed = (spark.sql(f"SHOW PARTITIONS {physical_table(spark, name)}")
              .select(F.element_at(F.split("partition", "="), -1).try_cast("int").alias(month_col)).where(F.col(month_col).isNotNull()))
    return sorted((r[0] for r in listed.collect()), reverse=True)[:n]


def in_latest_months(spark: SparkSession, name: str, n: int, month_col: str = "month") -> DataFrame:
    """The rows of the ``n`` latest months present."""
    return spark.table(name).where(F.col(month_col).isin(latest_months(spark, name, n, month_col)))
