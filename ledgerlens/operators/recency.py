"""Last purchase per (customer, month) and the days back to the previous two."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.dates import days_between, month_num, month_text


def purchase_recency(orders: DataFrame, customer_col: str, date_col: str, key_col: str,
                     depth: int = 3) -> DataFrame:
    """One row per (month, customer) with a purchase in that month:
    ``last_date`` (last purchase of the month), ``prev_date`` and
    ``prev2_date`` (the customer's two purchases before it over the whole
    history, not only the month).  Purchases are ordered by (date, key).

    A window over each customer's whole history would put a customer with a
    third of all orders into one task.  Instead:

    1. per (customer, month) only the ``depth`` latest purchases can matter:
       the purchases just before a month's last one are its month's next
       ones, else the latest ones of the previous active months.
       ``row_number() <= depth`` lets Spark cut each map task's rows to
       ``depth`` per group before the shuffle;
    2. ``lag`` over a customer's kept purchases (at most ``depth`` per active
       month, so bounded by the calendar, not by the data) then gives the
       predecessors of each month's last purchase.
    """
    w_month = Window.partitionBy(customer_col, "_mes").orderBy(F.col(date_col).desc(), F.col(key_col).desc())
    kept = (orders.select(customer_col, date_col, key_col, month_num(date_col).alias("_mes"))
            .withColumn("_r", F.row_number().over(w_month)).where(F.col("_r") <= depth))
    w_hist = Window.partitionBy(customer_col).orderBy(F.col(date_col), F.col(key_col))
    names = ["prev_date", "prev2_date"][: depth - 1]
    with_prev = kept.select(
        "_mes", customer_col, "_r", F.to_date(date_col).alias("last_date"),
        *[F.to_date(F.lag(date_col, i + 1).over(w_hist)).alias(n) for i, n in enumerate(names)])
    return with_prev.where(F.col("_r") == 1).select(
        month_text("_mes").alias("mes"), customer_col, "last_date", *names)


def recency_days(recency: DataFrame) -> DataFrame:
    """Adds the two day counts (NULL where the history is too short)."""
    return recency.withColumns({
        "diasuc_pc": days_between("last_date", "prev_date"),
        "diaspc_apc": days_between("prev_date", "prev2_date"),
    })
