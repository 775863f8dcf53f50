"""A customer with a third of all orders: AQE splits that customer's
partition of the orders x customer shuffle join (thresholds lowered so the
small test data counts as skewed), and the report stays exact."""

from pyspark.sql import functions as F

from ledgerlens import tables as T
from ledgerlens.plans import reports as R
from tests.conftest import SF_CHECK

SETTINGS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}


def test_hot_customer_partition_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        h = T.sales_header(spark, SF_CHECK)
        hot = h.agg(F.min("customerid")).first()[0]
        skewed = (h.withColumn("customerid", F.when(F.col("salesorderid") % 3 == 0, F.lit(hot))
                               .otherwise(F.col("customerid")))
                  .repartition(8))  # several map tasks, as any large input has
        placed = skewed.join(T.customer(spark, SF_CHECK).select("customerid", "territoryid"), "customerid")
        df = (R.orders_with_territory(spark, SF_CHECK, placed)
              .groupBy("name_t").agg(F.count(F.lit(1)).alias("n"), F.sum("totaldue").alias("amount"),
                                     F.max("orderdate").alias("last")))
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        assert sum(r.n for r in rows) == h.count()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
