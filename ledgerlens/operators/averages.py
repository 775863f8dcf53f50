"""Group average against the average of the whole period, in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.money import money_units, sum_units, units_to_double


def indicator(diff: Column) -> Column:
    """'Above' for a positive difference, 'Equal' for zero, else 'Below'
    (a NULL difference falls to 'Below', as in the source CASE)."""
    return F.when(diff > 0, "Above").when(diff == 0, "Equal").otherwise("Below")


def group_and_overall_avg(df: DataFrame, period_col: str, grain_col: str,
                          value_col: str) -> DataFrame:
    """Per (period, grain): the group's average and the whole period's average.

    One scan: sums and counts per (period, grain), then the period totals as a
    window over that small aggregate (rows = periods x grains), instead of a
    second scan and a join.  Sums are exact (whole units) so both averages do not
    depend on partition order.
    """
    agg = df.groupBy(period_col, grain_col).agg(
        sum_units(money_units(value_col)).alias("_s"), F.count(F.col(value_col)).alias("_n"))
    w = Window.partitionBy(period_col)
    return agg.select(
        period_col, grain_col,
        F.try_divide(units_to_double(F.col("_s")), F.col("_n")).alias("group_avg"),
        F.try_divide(units_to_double(F.sum("_s").over(w)), F.sum("_n").over(w)).alias("overall_avg"),
    )
