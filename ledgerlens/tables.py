"""The report schema over a folder of Parquet tables.

The reports are written against a sales schema (order header and detail,
territory, product, customer, person, an ordered code sequence).  The test
folders hold TPC-H-like tables; each function below is a lazy projection of
one of them onto the report schema, so Catalyst prunes the unused columns at
the scan and pushes filters into it.

Mapping (report column <- test column):

* header: salesorderid <- o_orderkey, customerid <- o_custkey,
  orderdate <- o_orderdate, status <- first character of o_orderpriority,
  totaldue and subtotal <- o_totalprice; with its own territoryid
  (``header_with_territory``) <- c_nationkey of its customer
* customer: customerid <- c_custkey, territoryid <- c_nationkey,
  personid <- c_custkey
* territory: territoryid <- n_nationkey, name_t <- n_name, group_t <- r_name
* detail: salesorderid <- l_orderkey, productid <- l_partkey,
  orderqty <- l_quantity
* product: productid <- p_partkey, name_t <- p_name
* person: businessentityid <- c_custkey, title <- c_mktsegment except
  'MACHINERY' (gives NULL titles), firstname_t <- c_name, middle and last
  name empty
* sequence: secuencial <- event_id, codigo <- event_type
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a folder, as its files are now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("salesorderid"),
        F.col("o_custkey").alias("customerid"),
        F.col("o_orderdate").alias("orderdate"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("status"),
        F.col("o_totalprice").alias("totaldue"),
        F.col("o_totalprice").alias("subtotal"),
    )


def header_with_territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header with the order's own territory.  The test tables keep it with
    the customer: a shuffle join on customerid (both sides grow with the data;
    AQE splits a skewed customer partition)."""
    c = customer(spark, sf_dir).select("customerid", "territoryid")
    return sales_header(spark, sf_dir).join(c, "customerid", "inner")


def sales_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("salesorderid"),
        F.col("l_partkey").alias("productid"),
        F.col("l_quantity").alias("orderqty"),
    )


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customerid"),
        F.col("c_nationkey").alias("territoryid"),
        F.col("c_custkey").alias("personid"),
    )


def territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.operators.joins import broadcast_if_small
    n = read(spark, sf_dir, "nation")
    r = broadcast_if_small(read(spark, sf_dir, "region"))
    return n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
        F.col("n_nationkey").alias("territoryid"),
        F.col("n_name").alias("name_t"),
        F.col("r_name").alias("group_t"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("productid"), F.col("p_name").alias("name_t"))


def person(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("businessentityid"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("title"),
        F.col("c_name").alias("firstname_t"),
        F.lit("").alias("middlename_t"),
        F.lit("").alias("lastname_t"),
    )


def sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("secuencial"), F.col("event_type").alias("codigo"))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Temp views with the report schema's table names, for SQL scripts."""
    views = {
        "sales_salesorderheader": header_with_territory,
        "sales_salesorderdetail": sales_detail,
        "sales_customer": customer,
        "sales_salesterritory": territory,
        "production_product": product,
        "person_person": person,
        "secuenciales": sequence,
    }
    for name, fn in views.items():
        fn(spark, sf_dir).createOrReplaceTempView(name)
