"""The business reports, each one lazy DataFrame plan over the report schema.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame; nothing is
collected except where a bounded literal (the cut-off month of a "last six
months" report) is cheaper to push into the scan as a constant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import tables as T
from ledgerlens.functions.dates import month_num, month_text
from ledgerlens.functions.money import money_units
from ledgerlens.functions.status import SHIPPED
from ledgerlens.operators.averages import group_and_overall_avg, indicator
from ledgerlens.operators.joins import broadcast_if_small
from ledgerlens.operators.recency import purchase_recency, recency_days
from ledgerlens.operators.runs import ordered_run_counts, run_counts_by_key, spaced_runs
from ledgerlens.operators.status import status_breakdown, status_pivot
from ledgerlens.operators.topk import positional_pivot


def orders_with_territory(spark: SparkSession, sf_dir: str,
                          header: DataFrame | None = None) -> DataFrame:
    """Order header (with its own territoryid) with its territory's name and group."""
    h = header if header is not None else T.header_with_territory(spark, sf_dir)
    return with_territory(h, T.territory(spark, sf_dir))


def with_territory(header: DataFrame, territory: DataFrame) -> DataFrame:
    """Header rows with their territory's columns.  The territory table is a bounded
    dimension and is broadcast after a check of its size."""
    return header.join(broadcast_if_small(territory), "territoryid", "inner")


def with_month_text(df: DataFrame, num_col: str = "_m", name: str = "mes") -> DataFrame:
    """Replace the integer month used for grouping by its ``yyyy-MM`` text
    (formatted once per output row, not once per input row)."""
    return df.select(month_text(num_col).alias(name), *[c for c in df.columns if c != num_col])


def monthly_status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions and amounts per month, territory and status code."""
    return monthly_status(T.header_with_territory(spark, sf_dir), T.territory(spark, sf_dir))


def monthly_status(header: DataFrame, territory: DataFrame) -> DataFrame:
    """The same over given tables (header: territoryid, orderdate, status, totaldue;
    territory: territoryid, name_t), e.g. those that the loader made."""
    return status_by_month_and_territory(with_territory(header, territory.select("territoryid", "name_t")))


def status_by_month_and_territory(orders: DataFrame) -> DataFrame:
    """The report over orders that have their territory's name (orderdate, name_t, status, totaldue)."""
    src = orders.select(
        month_num("orderdate").alias("_m"),
        F.col("name_t").alias("nombreterritorio"),
        "status", "totaldue")
    return with_month_text(status_breakdown(src, ["_m", "nombreterritorio"], "status", "totaldue"))


# --------------------------------------------------------------------------
# Top three products and customers per month (shipped orders only)
# --------------------------------------------------------------------------

def shipped_orders(spark: SparkSession, sf_dir: str, check_customer: bool = True) -> DataFrame:
    """Shipped orders with their month (integer yyyymm in ``_m``); with
    ``check_customer`` only those whose customer exists.

    The filter ``status = 5`` is pushed under every join.  The customer check
    is a left-semi join (equal to the source's inner join because customerid
    is the customer key) and carries no columns into the shuffle.  Callers
    that join customer data anyway pass ``check_customer=False``: their
    inner join already drops orders without a customer, and one full shuffle
    of the orders is saved.
    """
    h = T.sales_header(spark, sf_dir).where(F.col("status") == SHIPPED)
    if check_customer:
        h = h.join(T.customer(spark, sf_dir).select("customerid"), "customerid", "left_semi")
    return h.withColumn("_m", month_num("orderdate"))


def product_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units shipped per (month, product name).

    Lines are summed per (month, productid) first: the partial aggregate
    shrinks the line stream before the product join, and the product join
    then touches one row per product and month instead of one per line.
    Products sharing a name are merged afterwards, as the source groups by
    name.
    """
    orders = shipped_orders(spark, sf_dir).select("salesorderid", "_m")
    lines = T.sales_detail(spark, sf_dir)
    per_product = (orders.join(lines, "salesorderid", "inner")
                   .groupBy("_m", "productid").agg(F.sum("orderqty").alias("qty")))
    return (per_product.join(T.product(spark, sf_dir), "productid", "inner")
            .groupBy("_m", F.col("name_t").alias("producto"))
            .agg(F.sum("qty").alias("qty")))


def top_products_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 product names per month by units shipped (ties: name)."""
    ranked_by = [F.col("qty").desc(), F.col("producto").asc_nulls_last()]
    return with_month_text(positional_pivot(product_quantities(spark, sf_dir), ["_m"], ranked_by, "producto",
                                            ["producto_n1", "producto_n2", "producto_n3"]))


def customer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customerid -> name as the source builds it: title, first, middle and
    last name glued without blanks; NULL when any part is NULL.  Also a
    readable form that skips NULL and empty parts."""
    c = T.customer(spark, sf_dir).select("customerid", "personid")
    p = T.person(spark, sf_dir)
    parts = ["title", "firstname_t", "middlename_t", "lastname_t"]
    joined = c.join(p, c.personid == p.businessentityid, "inner")
    return joined.select(
        "customerid",
        F.concat(*[F.col(x) for x in parts]).alias("cliente"),
        F.concat_ws(" ", *[F.nullif(F.col(x), F.lit("")) for x in parts]).alias("nombre"),
    )


def customer_totals_per_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped amount per (month, customer name) counted once per order line.

    The source joins the order lines before summing the order total, so an
    order weighs its total times its number of lines.  The lines are
    therefore reduced to a count per order (partial aggregate next to the
    scan) and multiplied in, instead of joining every line row.
    """
    orders = shipped_orders(spark, sf_dir, check_customer=False).select(
        "salesorderid", "customerid", "_m", "totaldue")
    # only the lines of shipped orders are counted
    lines = T.sales_detail(spark, sf_dir).join(orders.select("salesorderid"), "salesorderid", "left_semi")
    n_lines = lines.groupBy("salesorderid").agg(F.count(F.lit(1)).alias("n_lines"))
    weighted = orders.join(n_lines, "salesorderid", "inner")
    return (weighted.join(customer_names(spark, sf_dir), "customerid", "inner")
            .groupBy("_m", "cliente")
            .agg(F.sum(money_units("totaldue") * F.col("n_lines")).alias("total")))


def top_customers_monthly_per_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 customer names per month by shipped amount, as the source
    computes it (per order line; NULL names form one group)."""
    ranked_by = [F.col("total").desc_nulls_first(), F.col("cliente").asc_nulls_last()]
    return with_month_text(positional_pivot(customer_totals_per_line(spark, sf_dir), ["_m"], ranked_by,
                                            "cliente", ["cliente_n1", "cliente_n2", "cliente_n3"]))


def top_customers_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 customers per month by invoiced shipped amount (each order
    once), per customer key, shown with the readable name; ties by key."""
    orders = shipped_orders(spark, sf_dir, check_customer=False).select("customerid", "_m", "totaldue")
    per_customer = orders.groupBy("_m", "customerid").agg(F.sum(money_units("totaldue")).alias("total"))
    named = per_customer.join(customer_names(spark, sf_dir).select("customerid", "nombre"),
                              "customerid", "inner")
    ranked_by = [F.col("total").desc_nulls_first(), F.col("customerid").asc()]
    return with_month_text(positional_pivot(named, ["_m"], ranked_by, "nombre",
                                            ["cliente_n1", "cliente_n2", "cliente_n3"]))


def top3_products_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products and customers side by side per month (inner join on month:
    a month missing in either half is not shown)."""
    products = top_products_monthly(spark, sf_dir)
    customers = top_customers_monthly_per_line(spark, sf_dir)
    return products.join(customers, "mes", "inner")


# --------------------------------------------------------------------------
# Averages against the whole organisation
# --------------------------------------------------------------------------

def territory_vs_org_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the source computes it: per month and territory name, the
    organisation's monthly average subtotal and (organisation - territory),
    'Above' when the organisation's average is the higher one."""
    src = orders_with_territory(spark, sf_dir).select(
        month_num("orderdate").alias("_m"), "name_t", "subtotal")
    avgs = group_and_overall_avg(src, "_m", "name_t", "subtotal")
    diff = F.col("overall_avg") - F.col("group_avg")
    return avgs.select(month_text("_m").alias("mes"), F.col("name_t").alias("nombreterritorio"),
                       F.col("overall_avg").alias("monthavg"), diff.alias("diff"),
                       indicator(diff).alias("indicador"))


def last_months_cutoff(header: DataFrame, n: int) -> str | None:
    """First day of the n-th latest month that has orders, as text.

    Distinct months are a tiny partial aggregate of one column; only n
    month keys reach the driver.  The cut-off is then a literal, so the
    report's filter is pushed into the Parquet scan and skips row groups.
    """
    months = (header.where(F.col("orderdate").isNotNull()).select(month_num("orderdate").alias("m")).distinct()
              .orderBy(F.col("m").desc()).limit(n).collect())
    if not months:
        return None
    m = min(r.m for r in months)
    return f"{m // 100:04d}-{m % 100:02d}-01"


def group_vs_org_avg_last6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As specified: last 6 months present in the orders, per territory group,
    (group - organisation) and 'Above' when the group's average is higher."""
    cutoff = last_months_cutoff(T.sales_header(spark, sf_dir), 6)
    header = T.header_with_territory(spark, sf_dir)
    if cutoff is not None:
        header = header.where(F.col("orderdate") >= F.lit(cutoff).cast("timestamp_ntz"))
    return group_vs_org(orders_with_territory(spark, sf_dir, header))


def group_vs_org(orders: DataFrame) -> DataFrame:
    """The same over given orders (orderdate, group_t, subtotal), all their months."""
    src = orders.select(month_num("orderdate").alias("_m"), "group_t", "subtotal")
    avgs = group_and_overall_avg(src, "_m", "group_t", "subtotal")
    diff = F.col("group_avg") - F.col("overall_avg")
    return avgs.select(month_text("_m").alias("ordermonth"), F.col("group_t").alias("territorygroup"),
                       F.col("overall_avg").alias("monthavg"), diff.alias("diff"),
                       indicator(diff).alias("indicator"))


# --------------------------------------------------------------------------
# Codes in a row along the sequence key
# --------------------------------------------------------------------------

def consecutive_code_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the source computes it: per code, how many positions k have the same
    code at k, k-1 and k-2 (a missing position drops the row; codes with no
    such run are listed with 0), most frequent first."""
    seq = T.sequence(spark, sf_dir)
    counts = run_counts_by_key(seq, "secuencial", "codigo", length=3, step=1)
    return counts.orderBy(F.col("cantidad_veces_seguidos").desc(), F.col("codigo"))


def consecutive_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As specified: codes that appear at least three times in a row in the
    order of the sequence key (gaps in the key do not break a run), with
    the number of rows that end a run of three."""
    seq = T.sequence(spark, sf_dir)
    return ordered_run_counts(seq, "secuencial", "codigo", length=3)


def spaced_code_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at positions n-4, n-2 and n sharing one code, all columns of the
    three rows (first_, middle_, last_), ordered by the last position."""
    seq = T.sequence(spark, sf_dir)
    return spaced_runs(seq, "secuencial", "codigo", step=2)


# --------------------------------------------------------------------------
# Purchase recency, pivots
# --------------------------------------------------------------------------

def purchase_recency_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per month and customer with a purchase: customer name, last purchase
    date of the month, days to the purchase before it and days between that
    one and the one before (over the whole history)."""
    header = T.sales_header(spark, sf_dir)
    rec = recency_days(purchase_recency(header, "customerid", "orderdate", "salesorderid"))
    names = customer_names(spark, sf_dir).select("customerid", F.col("nombre").alias("nombrecliente"))
    return (rec.join(names, "customerid", "inner")
            .select("mes", "customerid", "nombrecliente",
                    F.col("last_date").alias("fechaultcompra"), "diasuc_pc", "diaspc_apc"))


def positional_pivot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional crosstab on the event stream: per user, the types of the
    first three events (by event id) in columns evento_1..evento_3."""
    ev = T.read(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return positional_pivot(ev, ["user_id"], [F.col("event_id").asc()], "event_type",
                            ["evento_1", "evento_2", "evento_3"])


def category_pivot_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per month and status as one column per code (pivot over the
    fixed code list; absent codes give 0)."""
    header = T.sales_header(spark, sf_dir).select(month_num("orderdate").alias("_m"), "status")
    return with_month_text(status_pivot(header, ["_m"], "status"))
